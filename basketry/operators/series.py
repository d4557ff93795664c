"""Daily sales series: totals, zero days, features and splits."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F


def daily_totals(
    sales: DataFrame,
    keys: Sequence[str] = (),
    date: str = "date",
    value: str = "sales",
) -> DataFrame:
    """Sum of ``value`` per day (and per key)."""
    return sales.groupBy(*keys, date).agg(F.sum(value).alias(value))


def period_mean(
    sales: DataFrame,
    date: str = "date",
    value: str = "sales",
    period: Callable[[Column], Column] = F.month,
    name: str = "month",
) -> DataFrame:
    """Mean of ``value`` over the stored rows of each period.

    Days without sales are not stored, so this is a mean over days with sales;
    ``zero_filled_period_mean`` counts the others too.
    """
    return (
        sales.groupBy(period(F.col(date)).alias(name))
        .agg(F.avg(value).alias(f"avg_{value}"))
        .orderBy(name)
    )


def date_range_and_distincts(
    sales: DataFrame,
    date: str = "date",
    columns: Sequence[str] = ("item_id", "store_id"),
    approximate: bool = False,
) -> DataFrame:
    """First and last date and the number of distinct values per column.

    Distinct values are reduced column by column, so the aggregate over the
    whole table only ever sees distinct values, not rows. ``approximate``
    counts with a sketch in one pass, about 2 % off.
    """
    count = partial(F.approx_count_distinct, rsd=0.02) if approximate else F.count_distinct
    return sales.agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        *[count(c).alias(f"n_{c}") for c in columns],
    )


def zero_fill(
    sales: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    value: str = "sales",
    until: Column | None = None,
) -> DataFrame:
    """Add the days without sales between a series' first and last day.

    Takes one row per key and day. Each row brings along the empty days up to
    the next row of its series, so there is one shuffle and no join. ``until``
    extends every series to a common last day.
    """
    following = F.lead(date).over(Window.partitionBy(*keys).orderBy(date))
    last = F.greatest(F.col(date), until) if until is not None else F.col(date)
    stop = F.coalesce(F.date_sub(following, 1), last)
    # never empty, so the outer form saves the check for emptiness
    gaps = F.explode_outer(F.sequence(F.lit(0), F.datediff("_stop", date)))
    return (
        sales.withColumn("_stop", stop)
        .select(*keys, date, value, gaps.alias("_gap"))
        .select(
            *keys,
            F.date_add(date, F.col("_gap")).alias(date),
            F.when(F.col("_gap") == 0, F.col(value)).otherwise(F.lit(0)).alias(value),
        )
    )


def zero_filled_period_mean(
    daily: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    value: str = "sales",
) -> DataFrame:
    """Mean per month of year over all days of every series' active span.

    Equals the mean over ``zero_fill`` rows, without making them: the number
    of days a series is active in a month follows from its first and last day.
    Takes one row per key and day.
    """
    spans = daily.groupBy(*keys).agg(
        F.min(date).alias("_first"), F.max(date).alias("_last")
    )
    n_months = (
        (F.year("_last") - F.year("_first")) * 12 + F.month("_last") - F.month("_first")
    )
    active = (
        spans.select(
            "_first", "_last", F.explode_outer(F.sequence(F.lit(0), n_months)).alias("_n")
        )
        .withColumn("_month", F.add_months(F.trunc("_first", "month"), F.col("_n")))
        .select(
            F.month("_month").alias("month"),
            (
                F.datediff(
                    F.least("_last", F.last_day("_month")),
                    F.greatest("_first", "_month"),
                )
                + 1
            ).alias("_days"),
        )
        .groupBy("month")
        .agg(F.sum("_days").alias("n_days"))
    )
    sold = daily.groupBy(F.month(date).alias("month")).agg(F.sum(value).alias("_sold"))
    return (
        active.join(sold, "month", "left")
        .select(
            "month",
            "n_days",
            (F.coalesce("_sold", F.lit(0)) / F.col("n_days")).alias(f"avg_{value}"),
        )
        .orderBy("month")
    )


def zero_filled_summary(
    daily: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    value: str = "sales",
) -> DataFrame:
    """Active days, days without sales and mean daily sales of every series."""
    return (
        zero_fill(daily, keys, date, value)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_days"),
            F.count_if(F.col(value) == 0).alias("n_zero_days"),
            F.sum(value).alias(f"total_{value}"),
            F.avg(value).alias(f"avg_{value}"),
        )
    )


# --- fixed values: look-back days; none is nearer than the 28-day horizon -----
LAGS = (28, 35, 42)
TRAILING = ((34, 28), (55, 28))


def feature_names() -> list[str]:
    return [f"lag_{n}" for n in LAGS] + [f"mean_{a}_{b}" for a, b in TRAILING]


def lag_features(
    daily: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    value: str = "sales",
    start: str | None = None,
) -> DataFrame:
    """Sales 28, 35 and 42 days ago and means of two earlier spans.

    Takes one row per key and day. Frames are in days, not rows, so days
    without sales count as zero whether or not they are stored. A look-back
    that reaches before the first day of the series is NULL; ``start`` names a
    column with that day if the rows at hand begin later.
    """
    # one ordering for all frames, so one sort serves them all
    series = Window.partitionBy(*keys).orderBy("_day")
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    day = F.unix_date(F.col(date))
    age = day - F.unix_date(F.min(start or date).over(so_far))

    def total(back: int, to: int) -> Column:
        frame = series.rangeBetween(-back, -to)
        return F.coalesce(F.sum(value).over(frame), F.lit(0)).cast("double")

    features = {f"lag_{n}": F.when(age >= n, total(n, n)) for n in LAGS}
    for back, to in TRAILING:
        mean = total(back, to) / (back - to + 1)
        features[f"mean_{back}_{to}"] = F.when(age >= back, mean)
    return daily.withColumn("_day", day).withColumns(features).drop("_day")


def last_day(sales: DataFrame, date: str = "date") -> Column:
    """The last date of a table, as a value other plans can use."""
    return sales.agg(F.max(date)).scalar()


def split_label(last: Column, date: str = "date", holdout_days: int = 28) -> Column:
    """``train`` up to ``holdout_days`` before the last date, ``test`` after."""
    return F.when(F.col(date) <= F.date_sub(last, holdout_days), "train").otherwise(
        "test"
    )


def time_split(
    df: DataFrame, last: Column, date: str = "date", holdout_days: int = 28
) -> tuple[DataFrame, DataFrame]:
    """Earlier rows to train on and the last ``holdout_days`` to test on.

    Time-ordered rows are never shuffled between the two.
    """
    cutoff = F.date_sub(last, holdout_days)
    return df.where(F.col(date) <= cutoff), df.where(F.col(date) > cutoff)
