"""Two loads of a table as bags of rows: what came, what went, what stayed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def row_counts(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every distinct row of two loads, with ``n_before`` and ``n_after``.

    Rows are equal if all ``columns`` (those of ``before`` if not given) are, nulls
    too. Both loads go through one aggregate, counted before the shuffle, so that
    a row which fills a load is no hot key; nothing is joined.
    """
    columns = list(columns or before.columns)

    def signed(df: DataFrame, old: int) -> DataFrame:
        return df.select(*columns, F.lit(old).alias("_old"), F.lit(1 - old).alias("_new"))

    both = signed(before, 1).unionByName(signed(after, 0))
    return both.groupBy(*columns).agg(F.sum("_old").alias("n_before"), F.sum("_new").alias("n_after"))


def changes(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows whose number differs: ``added`` and ``removed`` copies of each."""
    counted = row_counts(before, after, columns).where("n_before != n_after")
    more = F.col("n_after") - F.col("n_before")
    return counted.select(
        *[c for c in counted.columns if c not in ("n_before", "n_after")],
        F.greatest(more, F.lit(0)).alias("added"),
        F.greatest(-more, F.lit(0)).alias("removed"),
    )


def _repeated(counted: DataFrame, times: str) -> DataFrame:
    columns = [c for c in counted.columns if c not in ("n_before", "n_after")]
    copies = F.explode(F.expr(f"array_repeat(0, int({times}))"))
    return counted.where(f"{times} > 0").select(*columns, copies.alias("_copy")).select(*columns)


def except_all(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of ``before`` beyond those that ``after`` has, each copy a row."""
    return _repeated(row_counts(before, after), "n_before - n_after")


def intersect_all(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows that both have, as often as both have them."""
    return _repeated(row_counts(before, after), "least(n_before, n_after)")
