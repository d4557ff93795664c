"""Wide tables to long ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def wide_to_long(
    df: DataFrame,
    id_columns: Sequence[str],
    value_columns: Sequence[str],
    name: str = "day",
    value: str = "sales",
) -> DataFrame:
    """One row per id and value column.

    Same result as ``unpivot``, but as one array generator instead of one
    projection per column, which matters with thousands of columns.
    """
    names = F.array(*[F.lit(c) for c in value_columns])
    cells = F.array(*[df[f"`{c}`"] for c in value_columns])
    return df.select(
        *id_columns, F.posexplode(cells).alias("_slot", value)
    ).select(*id_columns, F.get(names, F.col("_slot")).alias(name), value)


def prefixed(columns: Sequence[str], prefix: str) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]
