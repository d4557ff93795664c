"""Sessions: runs of a key's rows with no long gap between neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.operators.ranking import _PART, _POSITION, _before_part, _frozen_order


def with_sessions(
    df: DataFrame, keys: Sequence[str], at: str, gap: Column, name: str = "session"
) -> DataFrame:
    """Number the sessions of all keys, from 1, in the order of keys and time.

    A row more than ``gap`` (an interval, or a number for numeric times) after the
    one before it begins a session. Rows of a null key are a key of their own; a
    row without a time belongs to no session and has a null number.

    One range sort by key and time, so a hot key and a long session are spread over
    many tasks; each range takes the last row and the number of sessions of the
    ranges before it. Runs a job.
    """
    frozen = _frozen_order(df, [*keys, at])
    here = F.struct(*keys, F.col(at).alias("_at"))
    local = Window.partitionBy(_PART).orderBy(_POSITION)
    # one row per range
    tails = frozen.groupBy(_PART).agg(F.max_by(here, _POSITION).alias("_tail"))
    carried = tails.select(_PART, F.lag("_tail").over(Window.orderBy(_PART)).alias("_carried"))
    before = F.coalesce(F.lag(here).over(local), F.col("_carried"))
    same = F.lit(True)
    for key in keys:
        same &= F.col(f"_before.{key}").eqNullSafe(F.col(key))
    near = same & F.coalesce(F.col(at) <= F.col("_before._at") + gap, F.lit(False))
    opened = (
        frozen.join(F.broadcast(carried), _PART)
        .withColumn("_before", before)
        .withColumn("_opens", (F.col(at).isNotNull() & ~near).cast("int"))
        .drop("_before", "_carried")
    )
    earlier = _before_part(opened, F.sum("_opens"))
    so_far = F.sum("_opens").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        opened.join(F.broadcast(earlier), _PART)
        .withColumn(name, F.when(F.col(at).isNotNull(), F.col("_before") + so_far))
        .drop(_PART, _POSITION, "_before", "_in_part", "_opens")
    )


def sessions(
    df: DataFrame, keys: Sequence[str], at: str, gap: Column, **measures: Column
) -> DataFrame:
    """A row per session: keys, started, ended, n_rows and the given aggregates."""
    numbered = with_sessions(df, keys, at, gap, "_session").where("_session IS NOT NULL")
    found = numbered.groupBy("_session", *keys).agg(
        F.min(at).alias("started"),
        F.max(at).alias("ended"),
        F.count(F.lit(1)).alias("n_rows"),
        *(column.alias(name) for name, column in measures.items()),
    )
    return found.drop("_session")
