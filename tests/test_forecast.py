"""Forecasts beat the seasonal baseline and look only at known days."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from basketry import schemas as S
from basketry.operators import forecast, series

START = dt.date(2020, 1, 1)
KEYS = ["item"]


@pytest.fixture(scope="module")
def daily(spark):
    rows = []
    for item, level in (("a", 20.0), ("b", 50.0)):
        for n in range(300):
            day = START + dt.timedelta(days=n)
            noise = ((n * 37 + len(item) * 11) % 13) - 6
            amount = level + 10 * math.sin(2 * math.pi * n / 7) + noise
            if n % 11:
                rows.append((item, day, amount))
    rows.append(("young", START + dt.timedelta(days=299), 3.0))
    return spark.createDataFrame(rows, "item string, date date, sales double").cache()


def test_defaults_are_the_stated_ones():
    assert S.GBT_DEFAULTS == {
        "maxIter": 400, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "seed": 42,
    }


def test_future_rows_match_features_of_the_filled_series(daily):
    """The short look at recent days gives what the whole filled history gives."""
    last = series.last_day(daily)
    got = {
        (r.item, r.date): r
        for r in forecast.future_frame(daily, KEYS, last).collect()
    }
    assert len(got) == 3 * 28
    ahead = series.zero_fill(daily, KEYS, until=F.date_add(last, 28))
    filled = series.lag_features(ahead, KEYS).where(F.col("date") > last)
    for r in filled.collect():
        for name in series.feature_names():
            want = r[name]
            value = got[r.item, r.date][name]
            assert value == (want if want is None else pytest.approx(want))


def test_seasonal_naive_repeats_the_last_days(daily):
    rows = forecast.seasonal_naive(daily, KEYS, series.last_day(daily)).collect()
    sold = {(r.item, r.date): r.sales for r in daily.collect()}
    back = dt.timedelta(days=28)
    days = [START + dt.timedelta(days=300 + n) for n in range(28)]
    assert {(r.item, r.date): r.forecast for r in rows} == {
        (i, d): sold.get((i, d - back), 0.0) for i in ("a", "b", "young") for d in days
    }
    assert len(rows) == 3 * 28


def test_training_rows_go_on_to_the_last_day(spark):
    """A series that ended early has its empty days up to the table's last day."""
    rows = [("ends", START + dt.timedelta(days=n), 2.0) for n in range(100)]
    rows.append(("goes on", START + dt.timedelta(days=299), 1.0))
    daily = spark.createDataFrame(rows, "item string, date date, sales double")
    frame = forecast.training_frame(daily, KEYS, series.last_day(daily)).where("item = 'ends'")
    assert frame.count() == 300 - 55
    assert frame.where("sales = 0").count() == 200


def test_model_beats_the_baseline(daily):
    last = series.last_day(daily)
    train, test = series.time_split(forecast.training_frame(daily, KEYS, last), last)
    model = forecast.fit_forecaster(train, maxIter=15, maxDepth=4, stepSize=0.2)
    ours, baseline = forecast.forecast_error(model, test)
    assert ours < baseline
    future = forecast.future_frame(daily, KEYS, last)
    rows = forecast.forecast(model, future, KEYS).collect()
    assert len(rows) == 3 * 28
    young = {r.forecast for r in rows if r.item == "young"}
    assert young == {3.0}  # one day old: the mean of its days so far
    assert all(r.forecast >= 0 for r in rows)


def test_stockout_risk_lists_short_products(spark):
    ahead = spark.createDataFrame(
        [("a", 5.0), ("a", 7.0), ("b", 1.0), ("c", 9.0), ("no stock row", 8.0)],
        "item string, forecast double",
    )
    stock = spark.createDataFrame([("a", 10), ("b", 4), ("c", 2)], "item string, on_hand int")
    rows = forecast.stockout_risk(ahead, stock, KEYS).collect()
    assert [tuple(r) for r in rows] == [
        ("no stock row", 8.0, 0, 8.0), ("c", 9.0, 2, 7.0), ("a", 12.0, 10, 2.0),
    ]


def test_products_without_a_stock_row_have_none(spark):
    ahead = spark.createDataFrame([("a", 3.0), ("a", 2.0), ("b", 1.0), ("c", 0.0)], "product_id string, forecast double")
    stock = spark.createDataFrame([("b", 4)], "product_id string, on_hand int")
    rows = forecast.stockout_risk(ahead, stock, ["product_id"]).collect()
    assert [(r.product_id, r.demand, r.on_hand, r.shortfall) for r in rows] == [("a", 5.0, 0, 5.0)]


def test_stored_frames_have_few_parts(spark):
    frame = spark.range(0, 1000, 1, 7)
    assert forecast.stored_frame(frame).rdd.getNumPartitions() == 1
    assert forecast.stored_frame(frame, 300).count() == 1000


def test_department_forecast_sums_the_sales_once(spark, tmp_path, monkeypatch):
    import __spark_entry__ as driver

    day = "timestamp'2024-01-01' + make_dt_interval(id % 120)"
    spark.range(600).selectExpr(
        "id AS l_orderkey", "id % 5 AS l_partkey", "1L AS l_suppkey", "1D + id % 3 AS l_quantity",
        "10D AS l_extendedprice", f"{day} AS l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(5).selectExpr(
        "id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "concat('t', id % 2) AS p_type"
    ).write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(forecast, "GBT_DEFAULTS", {**forecast.GBT_DEFAULTS, "maxIter": 2})
    ahead = driver._department_forecast(spark, str(tmp_path))
    assert "lineitem" not in ahead._jdf.queryExecution().optimizedPlan().toString()
    assert "l_quantity" not in ahead._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.department, r["count"]) for r in ahead.groupBy("department").count().collect()} == {("t0", 28), ("t1", 28)}
