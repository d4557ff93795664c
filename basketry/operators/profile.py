"""Data-quality and distribution profiles of any DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from basketry.operators.ranking import exact_quantiles

_QUARTILES = (0.25, 0.5, 0.75)


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, one row per column, from a single pass."""
    counted = df.agg(
        *[F.count_if(df[f"`{c}`"].isNull()).alias(c) for c in df.columns]
    )
    return counted.unpivot(
        [], [f"`{c}`" for c in df.columns], "column_name", "n_missing"
    )


def most_missing(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` columns with most NULLs; names break ties."""
    return null_counts(df).orderBy(F.desc("n_missing"), "column_name").limit(n)


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, missing values skipped."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
    )


def top_values(df: DataFrame, column: str, n: int = 20, name: str = "n") -> DataFrame:
    """The ``n`` most frequent values; the value breaks ties."""
    return value_counts(df, column, name).orderBy(F.desc(name), column).limit(n)


def describe(df: DataFrame, column: str, quantiles: str = "approximate") -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum as one row.

    ``quantiles`` picks how the quartiles are found:

    * ``approximate``: the default; bounded memory, rank error 1/10000.
    * ``counted``: exact, in the same pass. Keeps one counter per distinct
      value, so it is for columns of a bounded domain such as basket sizes.
    * ``ranked``: exact for any column, by a distributed sort; runs a job.
    """
    value = F.col(column)
    basics = [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    names = ("p25", "p50", "p75")
    if quantiles == "ranked":
        found = exact_quantiles(df, column, _QUARTILES).toDF(*names)
        row = df.agg(*basics).withColumn("_q", found.select(F.struct(*names)).scalar())
        row = row.select("*", "_q.*")
    else:
        function = {
            "counted": F.percentile,
            "approximate": F.percentile_approx,
        }[quantiles]
        row = df.agg(*basics, function(value, F.lit(list(_QUARTILES))).alias("_q"))
        row = row.select("*", *[F.col("_q")[i].alias(c) for i, c in enumerate(names)])
    return row.select("n", "mean", "std", "min", *names, "max")


def histogram(
    df: DataFrame, column: str, bins: int = 40, upper: float | None = None
) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed.

    ``upper`` clips values first. Empty bins are listed too. Values are
    reduced to counts before the range is known, so the input is read once.
    """
    value = F.col(column).cast("double")
    if upper is not None:
        value = F.when(value.isNotNull(), F.least(value, F.lit(float(upper))))
    counts = (
        df.select(value.alias("_value"))
        .where(F.col("_value").isNotNull())
        .groupBy("_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    lowest = counts.agg(F.min("_value")).scalar()
    highest = counts.agg(F.max("_value")).scalar()
    ranged = counts.withColumns({"_lo": lowest, "_hi": highest})
    slot = F.floor((F.col("_value") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo")))
    filled = (
        ranged.withColumn(
            "bin",
            F.when(F.col("_hi") > F.col("_lo"), F.least(slot, F.lit(bins - 1)))
            .otherwise(F.lit(0))
            .cast("int"),
        )
        .groupBy("bin")
        .agg(F.sum("_n").alias("n"))
    )
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (highest - lowest) / bins
    return (
        axis.join(filled, "bin", "left")
        .select(
            "bin",
            (lowest + F.col("bin") * width).alias("bin_start"),
            (lowest + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns of the rows where none of them is missing."""
    return df.select(*columns).na.drop("any", subset=list(columns))


def sample_rows(
    df: DataFrame, columns: Sequence[str], n: int = 5, seed: int | None = None
) -> DataFrame:
    """``n`` complete rows picked at random."""
    return complete_rows(df, columns).orderBy(F.rand(seed)).limit(n)


def sample_by_key(df: DataFrame, columns: Sequence[str], key: str, n: int = 5) -> DataFrame:
    """``n`` complete rows picked by scattered key order, the same every time.

    Whole numbers of any size are scattered by arithmetic that other engines
    can repeat, keys of other types by a hash.
    """
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    scattered = (F.col(key) % 65521) * 40503 % 65521 if whole else F.xxhash64(key)
    return complete_rows(df, columns).orderBy(scattered, key).limit(n)
