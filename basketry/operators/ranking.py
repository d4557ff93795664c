"""Global positions and exact quantiles without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.session import materialize

_POSITION = "_position"
_PART = "_part"


def _frozen_order(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` sorted over all partitions, with partition and position columns.

    Runs a job: the sorted rows are written out, because a position is only
    meaningful while the partitioning it came from stays the same.
    """
    ordered = df.orderBy(*order).withColumn(_POSITION, F.monotonically_increasing_id())
    # monotonically_increasing_id is (partition << 33) + position in partition
    return materialize(ordered).withColumns(
        {
            _PART: F.shiftright(_POSITION, 33),
            _POSITION: F.col(_POSITION).bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )


def _before_part(frozen: DataFrame, amount: Column) -> DataFrame:
    """Per partition, the total of ``amount`` in all earlier partitions.

    One row per partition of the sort, so the un-partitioned window and the
    broadcast are bounded by the shuffle partition count.
    """
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return (
        frozen.groupBy(_PART)
        .agg(amount.alias("_in_part"))
        .withColumn(
            "_before", F.coalesce(F.sum("_in_part").over(earlier), F.lit(0))
        )
    )


def with_row_number(
    df: DataFrame, order: Sequence[Column | str], name: str = "row_number"
) -> DataFrame:
    """Number all rows 1..N in ``order``, which should be a total order.

    The sort is spread by range over the whole ordering key, so equal leading
    values are split as long as the later keys differ. Runs a job.
    """
    frozen = _frozen_order(df, order)
    before = _before_part(frozen, F.count(F.lit(1)))
    return (
        frozen.join(F.broadcast(before), _PART)
        .withColumn(name, F.col("_before") + F.col(_POSITION) + 1)
        .drop(_PART, _POSITION, "_before", "_in_part")
    )


def rows_at(
    df: DataFrame, order: Sequence[Column | str], positions: Sequence[int], name: str = "position"
) -> DataFrame:
    """The rows at some positions of the sorted result, with their position from 1.

    ``positions`` count from 0, or from the end if negative, as in a list; those
    beyond it have no row. ``order`` should be a total order. Runs jobs.
    """
    numbered = materialize(with_row_number(df, order, name))
    n_rows = numbered.count()
    wanted = {(p if p >= 0 else n_rows + p) + 1 for p in positions}
    return numbered.where(F.col(name).isin(sorted(wanted)))


def ntile_of(position: Column, n_rows: Column, tiles: int) -> Column:
    """SQL ``ntile`` from a 1-based position and the number of rows."""
    small = F.floor(n_rows / tiles)  # rows in a small tile
    large = n_rows % tiles  # number of tiles with one row more
    edge = large * (small + 1)
    return (
        F.when(position <= edge, F.floor((position - 1) / (small + 1)) + 1)
        .otherwise(large + F.floor((position - edge - 1) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float]
) -> DataFrame:
    """Linearly interpolated quantiles of one column, as one row ``q_<p>``.

    For columns with any number of distinct values: values are counted first
    and sorted by range. Totals per range tell which few ranges hold a wanted
    rank, and only these are searched. No task holds all values. Runs a job.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .select(F.col(column).cast("double").alias("_value"))
        .groupBy("_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    frozen = _frozen_order(counts, ["_value"])
    ranges = _before_part(frozen, F.sum("_n")).withColumn(
        "_total", frozen.agg(F.sum("_n")).scalar()
    )
    spots = [(F.col("_total") - 1) * F.lit(float(p)) for p in probabilities]

    def within(rank: Column, start: str, size: str) -> Column:
        return (F.col(start) <= rank) & (rank < F.col(start) + F.col(size))

    wanted = F.lit(False)
    for spot in spots:
        for rank in (F.floor(spot), F.ceil(spot)):
            wanted = wanted | within(rank, "_before", "_in_part")
    earlier = (
        Window.partitionBy(_PART)
        .orderBy(_POSITION)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    located = frozen.join(F.broadcast(ranges.where(wanted)), _PART).withColumn(
        "_start", F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(within(rank, "_start", "_n"), F.col("_value")))

    results = []
    for p, spot in zip(probabilities, spots):
        low, high = at(F.floor(spot)), at(F.ceil(spot))
        part = F.max(spot - F.floor(spot))
        results.append((low + (high - low) * part).alias(f"q_{p:g}"))
    return located.agg(*results)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    name: str = "previous",
) -> DataFrame:
    """The value of ``column`` in the row before, within the same ``keys``.

    Like ``lag(column) over (partition by keys order by order)``, but a key
    that holds a large part of all rows is spread over many tasks: rows are
    sorted by range, looked up within each range, and the first row of a range
    takes the last row of the range before. Runs a job.
    """
    frozen = _frozen_order(df, [*keys, *order])
    here = F.struct(*keys, F.col(column).alias("_was"))
    local = Window.partitionBy(_PART).orderBy(_POSITION)
    # one row per range
    tails = frozen.groupBy(_PART).agg(F.max_by(here, _POSITION).alias("_tail"))
    carried = tails.select(
        _PART, F.lag("_tail").over(Window.orderBy(_PART)).alias("_carried")
    )
    seen = F.coalesce(F.lag(here).over(local), F.col("_carried"))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"_before.{key}").eqNullSafe(F.col(key))
    return (
        frozen.join(F.broadcast(carried), _PART)
        .withColumn("_before", seen)
        .withColumn(name, F.when(same, F.col("_before._was")))
        .drop(_PART, _POSITION, "_before", "_carried")
    )


def with_number_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, kind: str = "int"
) -> DataFrame:
    """``row_number`` within ``keys``, spread like ``with_previous``.

    ``kind`` is the number's type; take ``long`` where a group may have over 2^31 rows.

    A row's number is its global position less the first position of its
    group. Where a group began in an earlier range, that position is carried
    over from range to range, so nothing is joined on the keys. Runs a job.
    """
    numbered = _with_start(df, keys, order)
    number = F.col(_GLOBAL) - F.col(_START) + 1
    return numbered.withColumn(name, number.cast(kind)).drop(_GLOBAL, _START)


_GLOBAL, _START = "_global", "_start"


def _with_start(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with their global position and that of their group's first row."""
    frozen = _frozen_order(df, [*keys, *order])
    group = F.struct(*keys)
    local = Window.partitionBy(_PART).orderBy(_POSITION)
    before = _before_part(frozen, F.count(F.lit(1)))
    placed = frozen.join(F.broadcast(before), _PART).withColumn(
        _GLOBAL, F.col("_before") + F.col(_POSITION)
    )
    # one row per range: its last group, and where that group begins in it
    spans = placed.groupBy(_PART).agg(F.max_by(group, _POSITION).alias("_tail"))
    first = (
        placed.join(F.broadcast(spans), _PART)
        .where(group.eqNullSafe(F.col("_tail")))
        .groupBy(_PART)
        .agg(F.min(_GLOBAL).alias("_at"))
    )
    tails = spans.join(first, _PART)
    so_far = Window.partitionBy("_tail").orderBy(_PART)
    carried = tails.withColumn("_at", F.min("_at").over(so_far)).select(
        _PART,
        *(
            F.lag(c).over(Window.orderBy(_PART)).alias(f"{c}_before")
            for c in ("_tail", "_at")
        ),
    )
    opens = F.lag(group).over(local)
    is_first = F.when(
        ~F.coalesce(opens, F.col("_tail_before")).eqNullSafe(group), F.col(_GLOBAL)
    )
    return (
        placed.join(F.broadcast(carried), _PART)
        .withColumn("_new", is_first)
        .withColumn(
            _START, F.coalesce(F.last("_new", ignorenulls=True).over(local), F.col("_at_before"))
        )
        .drop(_PART, _POSITION, "_before", "_in_part", "_new", "_tail_before", "_at_before")
    )
