"""Joins of intervals that overlap, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F, types as T


def as_number(df: DataFrame, column: str) -> Column:
    """A timestamp's microseconds, a date's day or a whole number, as a long."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    raise TypeError(f"{column} is no timestamp, date or whole number")


def _levels(side: DataFrame) -> list[int]:
    """The levels in use: at most 64."""
    return sorted(r[0] for r in side.select("_level").distinct().collect())


def _prepared(df: DataFrame, span: tuple[str, str], prefix: str, finest: int) -> DataFrame:
    """With the ends as numbers, and the level whose bins the interval fits in.

    A bin of level n is 2^n wide. An interval shorter than that lies in two
    neighbouring bins at most.
    """
    start, end = as_number(df, span[0]), as_number(df, span[1])
    renamed = df.select(
        *(F.col(c).alias(f"{prefix}{c}") for c in df.columns), start.alias("_start"), end.alias("_end")
    ).where(F.col("_start") <= F.col("_end"))
    # the number of binary digits of the length, in steps of two
    digits = F.expr("if(_end = _start, 0, length(bin(_end - _start)))")
    level = F.greatest(F.lit(finest), F.ceil(digits / 2) * 2).cast("int")
    return renamed.withColumn("_level", level)


def _binned(df: DataFrame, others: list[int], name: str) -> DataFrame:
    """A row per bin of the own level and of the other side's coarser levels."""
    coarser = F.filter(F.array(*map(F.lit, others)), lambda x: x > F.col("_level"))
    at = F.explode(F.concat(F.array("_level"), coarser))
    first = F.expr("shiftright(_start, _at)")
    bins = F.explode(F.sequence(first, F.expr("shiftright(_end, _at)")))
    own = {f"_start": f"_{name}_start", "_end": f"_{name}_end", "_level": f"_{name}_level"}
    return (
        df.withColumn("_at", at)
        .withColumn("_bin", bins)
        .withColumn(f"_{name}_first", first)
        .withColumnsRenamed(own)
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    keys: Sequence[str] = (),
    prefix: str = "right_",
    finest: int = 0,
) -> DataFrame:
    """All pairs of rows of the same ``keys`` whose intervals overlap.

    A span names the columns of an interval's ends, both of which belong to it:
    timestamps, dates or whole numbers, of one kind on both sides (timestamps without
    a zone are taken as the session's, best UTC). A point is an
    interval from a column to itself. Right columns get ``prefix``. Null ends and
    intervals that end before they begin overlap nothing; null keys match nothing.

    Time is cut into bins of widths that are powers of four. An interval lies in
    one or two bins of the least width that exceeds its length; a pair meets at the
    wider of its two widths, in the first bin that both have, and only there. So
    intervals of any lengths make a few rows each: two for their own width, two
    for each greater width in use on the other side. The join is an equi-join on
    keys, width and bin, whose crowded bins Spark splits; nothing is compared
    beyond a bin. ``finest`` is the least width, as a power of two: a larger one
    spares widths where most intervals are short. Runs a job that counts widths.
    """
    if list(keys) and set(keys) - set(left.columns) | set(keys) - set(right.columns):
        raise ValueError(f"both sides need {list(keys)}")
    a, b = _prepared(left, left_span, "", finest), _prepared(right, right_span, prefix, finest)
    low, high = _levels(a), _levels(b)
    a, b = _binned(a, high, "left"), _binned(b, low, "right")
    b = b.withColumnsRenamed({"_at": "_right_at", "_bin": "_right_bin"})
    meets = (F.col("_at") == F.col("_right_at")) & (F.col("_bin") == F.col("_right_bin"))
    for key in keys:
        meets &= F.col(key) == F.col(f"{prefix}{key}")
    once = (F.col("_at") == F.greatest("_left_level", "_right_level")) & (
        F.col("_bin") == F.greatest("_left_first", "_right_first")
    )
    overlap = (F.col("_left_start") <= F.col("_right_end")) & (F.col("_right_start") <= F.col("_left_end"))
    return a.join(b, meets & once & overlap).select(
        *left.columns, *(f"{prefix}{c}" for c in right.columns)
    )


#: Points beside an end of an interval in a bin, per point and interval, that may
#: be looked at one by one.
LOOKED_AT = 8


def whole_bins(
    left: DataFrame,
    right: DataFrame,
    span: tuple[str, str],
    at: str,
    by: Sequence[str],
    measures: dict[str, tuple[str, str]],
) -> tuple[DataFrame, DataFrame, int]:
    """Totals of the points in the bins that lie wholly within each interval, and the rest.

    For totals of points in long intervals, whose pairs grow with the square of the
    rows in a span of time. ``left`` has intervals, ``right`` points ``at``; these and
    the ends of ``span`` are whole numbers (``as_number``). ``measures`` names totals:
    ``("count", column)`` counts rows; sum, min and max are those of a column.

    Time is cut into bins of 2^width, and four bins are one of the next level. An
    interval is its rest at either end, which is shorter than a bin, and whole bins,
    at most six of a level. So each point is in one total a level, each interval
    meets a few totals a level, and nothing is a pair of rows but in the rest.
    The width is the widest for which the bins with ends of intervals hold
    ``LOOKED_AT`` points per row or fewer; the narrowest is 1, where no rest is left.

    Returns rows of ``left`` with ``by`` and the totals, of which there are several
    per interval (to be summed, or the least or greatest taken), the rests as rows of
    ``left`` with other ends, and the width for ``interval_join`` of these with the
    points (its ``finest``). Intervals without an end or before it overlap nothing.
    Runs jobs.
    """
    start, end = span
    spans_ = left.where(F.col(start) <= F.col(end))
    points = right.where(F.col(at).isNotNull())
    longest = spans_.agg(F.max(F.col(end) - F.col(start) + 1)).first()[0] or 1
    n_rows, width = None, min(60, (longest.bit_length() + 1) // 2 * 2)
    ends = spans_.select(F.explode(F.array(start, end)).alias("_p"))
    both = points.select(F.col(at).alias("_p"), F.lit(1).alias("_r"), F.lit(0).alias("_l")).union(
        ends.select("_p", F.lit(0), F.lit(1))
    )
    while width > 0:
        bins = both.groupBy(F.shiftright("_p", width).alias("_b")).agg(F.sum("_r").alias("_r"), F.sum("_l").alias("_l"))
        met, n_rows = bins.agg(
            F.sum(F.col("_r").cast("double") * F.col("_l")), F.sum(F.col("_r") + F.col("_l"))
        ).first()
        if (met or 0) <= LOOKED_AT * (n_rows or 0):
            break
        width = max(0, width - 4)
    size, levels = 1 << width, [0]
    while size << 2 * len(levels) <= longest:
        levels.append(len(levels))

    first, stop = (
        F.shiftright(F.col(start) + F.lit(size - 1), width), F.shiftright(F.col(end) + F.lit(1), width)
    )
    framed = spans_.withColumns({"_first": first, "_stop": stop})
    has = F.col("_first") < F.col("_stop")
    before = F.struct(F.col(start).alias("_s"), (F.col("_first") * size - 1).alias("_e"))
    after = F.struct((F.col("_stop") * size).alias("_s"), F.col(end).alias("_e"))
    whole = F.struct(F.col(start).cast("long").alias("_s"), F.col(end).cast("long").alias("_e"))
    rest = (
        framed.withColumn("_cut", F.explode(F.when(has, F.array(before, after)).otherwise(F.array(whole))))
        .withColumns({start: F.col("_cut._s"), end: F.col("_cut._e")})
        .where(F.col(start) <= F.col(end))
        .select(*left.columns)
    )

    def up(k: int) -> tuple[Column, Column]:
        """The first whole bin of level k within the interval, and the one after its last."""
        return F.shiftright(F.col("_first") + F.lit((1 << 2 * k) - 1), 2 * k), F.shiftright("_stop", 2 * k)

    def run(low: Column, high: Column) -> Column:
        return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))

    def node(k: int, number: Column) -> Column:
        return F.struct(F.lit(k).alias("_level"), number.alias("_bin"))

    nodes = []
    for k in levels:
        (low, high), (next_low, next_high) = up(k), up(k + 1)
        covered = F.concat(run(low, next_low * 4), run(next_high * 4, high))
        numbers = F.when(next_low < next_high, covered).otherwise(run(low, high))
        nodes.append(F.transform(numbers, partial(node, k)))
    asked = framed.where(has).select(*left.columns, F.inline(F.concat(*nodes)))

    kinds = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    base = points.groupBy(F.shiftright(at, width).alias("_b"), *by).agg(
        *(
            (F.count(F.lit(1)) if kind == "count" else kinds[kind](column)).alias(name)
            for name, (kind, column) in measures.items()
        )
    )
    above = F.explode(F.array(*map(F.lit, levels)))
    totals = (
        base.withColumn("_level", above)
        .withColumn("_bin", F.expr("shiftright(_b, 2 * _level)"))
        .groupBy("_level", "_bin", *by)
        .agg(*(kinds[kind](name).alias(name) for name, (kind, _) in measures.items()))
    )
    return asked.join(totals, ["_level", "_bin"]).drop("_level", "_bin"), rest, width
