"""The physical plans hold what the scale notes promise."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from basketry.operators import baskets, series

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="the given tables are not here")
def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(driver.queries()["filtered_sales"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,R)" in plan and "EqualTo(l_linestatus,O)" in plan
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert "l_extendedprice" not in schema


def _tables(spark):
    items = spark.createDataFrame([(1, 1, 1)], "order_id long, product_id long, reordered int")
    products = spark.createDataFrame([(1, "a", "d")], "product_id long, product_name string, department string")
    return items, products


def test_lines_are_reduced_before_the_join(spark):
    plan = _plan(baskets.top_products(*_tables(spark)))
    join = plan.index("Join")
    below = plan[join:]
    assert "partial_count" in below  # aggregated on the lines' side of the join
    assert "TakeOrderedAndProject" in plan


def _daily(spark):
    rows = spark.range(10).select(
        (F.col("id") % 2).alias("item"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.col("id").alias("sales"),
    )
    return rows


def test_filling_and_look_backs_share_one_shuffle(spark):
    filled = series.zero_fill(_daily(spark), ["item"])
    assert _plan(filled).count("Exchange hashpartitioning") == 1
    assert "Join" not in _plan(filled)
    features = series.lag_features(filled, ["item"])
    plan = _plan(features)
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 2  # one to fill, one for all frames
