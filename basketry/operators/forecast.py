"""Four-week demand forecast and the products it puts at risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from basketry.operators.series import (
    TRAILING,
    feature_names,
    lag_features,
    zero_fill,
)
from basketry.schemas import GBT_DEFAULTS
from basketry.session import materialize

HORIZON_DAYS = 28
_CALENDAR = ("day_of_week", "day_of_month", "month_of_year")


def _calendar_features(frame: DataFrame, date: str) -> DataFrame:
    day = F.col(date)
    return frame.withColumns(
        {
            "day_of_week": F.dayofweek(day),
            "day_of_month": F.dayofmonth(day),
            "month_of_year": F.month(day),
        }
    )


def training_frame(
    daily: DataFrame,
    keys: Sequence[str],
    last: Column,
    date: str = "date",
    value: str = "sales",
) -> DataFrame:
    """Every day of every series up to ``last``, with complete features.

    Days without sales count as zero, also those after a series' last sale.
    """
    whole = zero_fill(daily, keys, date, value, until=last)
    filled = lag_features(whole, keys, date, value)
    return _calendar_features(filled, date).na.drop("any", subset=feature_names())


def future_frame(
    daily: DataFrame,
    keys: Sequence[str],
    last: Column,
    date: str = "date",
    value: str = "sales",
    horizon: int = HORIZON_DAYS,
) -> DataFrame:
    """Features of the days after ``last``, one row per series and day.

    No look-back is nearer than the horizon, so all features are known, but
    those that reach before a series' first day are NULL. ``recent_mean`` is the
    mean of the days up to ``last``, ``horizon`` of them or as many as there
    are. Only the recent days with sales are looked at; the history is not
    filled.
    """
    in_span = F.col(date) > F.date_sub(last, horizon)
    n_days = F.least(F.datediff(last, F.col("_start")) + 1, F.lit(horizon))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    future = (
        daily.groupBy(*keys)
        .agg(
            F.min(date).alias("_start"),
            F.coalesce(F.sum(F.when(in_span, F.col(value))), F.lit(0)).alias("_sold"),
        )
        .select(
            *keys,
            ahead.alias("_ahead"),
            "_start",
            (F.col("_sold") / n_days).alias("recent_mean"),
        )
        .select(*keys, F.date_add(last, F.col("_ahead")).alias(date), "_start", "recent_mean")
    )
    deepest = max(back for back, _ in TRAILING)
    recent = daily.where(F.col(date) > F.date_sub(last, deepest))
    rows = recent.select(*keys, date, value).unionByName(
        future, allowMissingColumns=True
    )
    features = lag_features(rows, keys, date, value, start="_start")
    future_only = features.where(F.col(date) > last).drop(value, "_start")
    return _calendar_features(future_only, date)


def stored_frame(train: DataFrame, rows_a_part: int = 100_000) -> DataFrame:
    """A training frame written in as few parts as its rows need.

    Boosting runs several jobs a tree, each with a task a part. Runs jobs.
    """
    whole = materialize(train)
    return whole.coalesce(max(1, -(-whole.count() // rows_a_part)))


def fit_forecaster(train: DataFrame, value: str = "sales", **params) -> PipelineModel:
    """Gradient-boosted trees; ``params`` override the defaults.

    Every tree reads ``train``, so pass a stored or materialised one: then lost
    executors do not make Spark fill and window the series again. The many
    small jobs of a tree cost more than its arithmetic where rows are few, so
    give ``train`` no more partitions than the data needs.
    """
    settings = {**GBT_DEFAULTS, **params}
    assembler = VectorAssembler(
        inputCols=[*feature_names(), *_CALENDAR], outputCol="features"
    )
    trees = GBTRegressor(
        labelCol=value, featuresCol="features", predictionCol="forecast", **settings
    )
    rows = train.withColumn(value, F.col(value).cast("double"))
    return Pipeline(stages=[assembler, trees]).fit(rows)


def forecast(
    model: PipelineModel, future: DataFrame, keys: Sequence[str], date: str = "date"
) -> DataFrame:
    """Predicted sales of each row of ``future``, never negative.

    A series younger than the deepest look-back gets the baseline for the days
    whose features are not all known: the sales 28 days before, or where it had
    not begun then, the mean of its recent days.
    """
    known = F.lit(True)
    for name in feature_names():
        known = known & F.col(name).isNotNull()
    baseline = F.coalesce("lag_28", "recent_mean", F.lit(0.0))
    marked = future.withColumns({"_known": known, "_baseline": baseline})
    scored = model.transform(marked.na.fill(0.0, subset=feature_names()))
    value = F.when(F.col("_known"), F.col("forecast")).otherwise(F.col("_baseline"))
    return scored.select(*keys, date, F.greatest(value, F.lit(0.0)).alias("forecast"))


def seasonal_naive(
    daily: DataFrame,
    keys: Sequence[str],
    last: Column,
    date: str = "date",
    value: str = "sales",
    horizon: int = HORIZON_DAYS,
) -> DataFrame:
    """The baseline: each future day repeats the sales of ``horizon`` days before.

    A row per series and day; one that repeats a day without sales is zero.
    """
    begun = daily.groupBy(*keys).agg(F.lit(1).alias("_one")).drop("_one")
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    future = begun.select(*keys, ahead.alias("_ahead"))
    future = future.select(*keys, F.date_add(last, F.col("_ahead")).alias(date))
    before = daily.where(F.col(date) > F.date_sub(last, horizon)).select(
        *keys,
        F.date_add(date, horizon).alias(date),
        F.col(value).cast("double").alias("forecast"),
    )
    both = before.unionByName(future, allowMissingColumns=True)
    sold = F.coalesce(F.sum("forecast"), F.lit(0.0))
    return both.groupBy(*keys, date).agg(sold.alias("forecast"))


def forecast_error(
    model: PipelineModel, test: DataFrame, value: str = "sales"
) -> tuple[float, float]:
    """Root mean squared error of the model and of the seasonal baseline."""
    scored = model.transform(
        test.withColumn(value, F.col(value).cast("double"))
    )
    rmse = RegressionEvaluator(labelCol=value, metricName="rmse")
    return (
        rmse.setPredictionCol("forecast").evaluate(scored),
        rmse.setPredictionCol("lag_28").evaluate(scored),
    )


def stockout_risk(
    forecasts: DataFrame, stock: DataFrame, keys: Sequence[str], on_hand: str = "on_hand"
) -> DataFrame:
    """Products whose forecast demand exceeds the stock, largest gap first.

    ``stock`` holds one row per product (or product and store). A product
    without one has nothing on hand.
    """
    demand = forecasts.groupBy(*keys).agg(F.sum("forecast").alias("demand"))
    return (
        demand.join(stock.select(*keys, on_hand), list(keys), "left")
        .withColumn(on_hand, F.coalesce(on_hand, F.lit(0)))
        .where(F.col("demand") > F.col(on_hand))
        .withColumn("shortfall", F.col("demand") - F.col(on_hand))
        .orderBy(F.desc("shortfall"), *keys)
    )
