"""As-of join: the last row of another table at or before each row's time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.operators.ranking import _PART, _POSITION, _frozen_order


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_on: str,
    right_on: str,
    columns: Sequence[str],
    direction: str = "backward",
    strict: bool = False,
    within: Column | None = None,
) -> DataFrame:
    """Every row of ``left`` with ``columns`` of its latest row of ``right``.

    That is the row of the same ``keys`` with the greatest ``right_on`` not after
    ``left_on`` (before it, if ``strict``), or, with ``direction="forward"``, the
    smallest one not before it. Of right rows at the same time, the greatest by
    ``columns`` counts. ``within`` is an interval or number that the two times may
    be apart at most. Where there is none, and where a key or time is null, the
    columns are null.

    Both tables go through one range sort by key and time, so a hot key is spread
    over many tasks. Each range carries its last right row forward, and a range
    that begins in the middle of a key takes the row from the ranges before it:
    there is no window and no join per key. ``columns`` must not be names of
    ``left``. Runs a job.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction}")
    if clash := sorted(set(columns) & set(left.columns)):
        raise ValueError(f"columns of both tables: {clash}")
    types = {f.name: f.dataType for f in left.schema.fields}
    names = [f"_key{i}" for i in range(len(keys))]
    given = F.struct(*(F.col(c) for c in left.columns))
    brought = F.struct(*(F.col(c) for c in columns)) if columns else F.struct(F.lit(True).alias("_"))

    def side(df: DataFrame, number: int, at: str, **payload: Column) -> DataFrame:
        own = [F.col(k).cast(types[k]).alias(n) for k, n in zip(keys, names)]
        return df.select(
            *own,
            F.col(at).cast(types[left_on]).alias("_at"),
            F.lit(number).alias("_side"),
            *(column.alias(name) for name, column in payload.items()),
        )

    usable = reduce(Column.__and__, [F.col(k).isNotNull() for k in (*keys, right_on)])
    asked = side(left, 1, left_on, _left=given)
    told = side(right.where(usable), 0, right_on, _right=brought)
    both = asked.unionByName(told, allowMissingColumns=True)
    at = F.col("_at") if direction == "backward" else F.desc("_at")
    first = F.desc("_side") if strict else F.col("_side")
    frozen = _frozen_order(both, [*names, at, first, "_right"])

    row = F.when(F.col("_side") == 0, F.struct(*names, "_at", "_right"))
    local = Window.partitionBy(_PART).orderBy(_POSITION)
    here = F.last(row, ignorenulls=True).over(
        local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # one row per range, also for ranges without a right row
    tails = frozen.groupBy(_PART).agg(
        F.max_by(row, F.when(F.col("_side") == 0, F.col(_POSITION))).alias("_tail")
    )
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(_PART, F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    seen = frozen.join(F.broadcast(carried), _PART).withColumn("_seen", F.coalesce(here, F.col("_carried")))

    fits = reduce(
        Column.__and__, [F.col(f"_seen.{n}") == F.col(n) for n in names], F.col("_at").isNotNull()
    )
    if within is not None:
        then, now = F.col("_seen._at"), F.col("_at")
        fits &= then >= now - within if direction == "backward" else then <= now + within
    found = F.when(fits, F.col("_seen._right"))
    return (
        seen.where("_side = 1")
        .withColumn("_found", found)
        .select("_left.*", *(F.col(f"_found.{c}").alias(c) for c in columns))
    )
