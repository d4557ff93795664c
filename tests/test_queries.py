"""Every registered query against its SQL counterpart on the given tables."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

OWN = driver._own_queries()
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(
    not Path(SF_DIR).is_dir(), reason="the given tables are not here"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def _cell(value):
    if value is None or value is pd.NA or value is pd.NaT:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value if isinstance(value, str) else round(float(value), 9)


def _bag(frame):
    ordered = frame[sorted(frame.columns)]
    rows = [tuple(_cell(v) for v in row) for row in ordered.itertuples(index=False)]
    return sorted(rows, key=repr)


#: The vector index multiplies matrices in numpy.
NUMPY = {"similar_batch", "similar_batch_checks"}


def _run(spark, name):
    """The query's rows, from a plan without cross joins and Python workers."""
    result = OWN[name][0](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    python = () if name in NUMPY else ("EvalPython", "InPandas", "InArrow")
    for node in ("CartesianProduct", "NestedLoopJoin", *python):
        assert node not in plan
    return result.toPandas()


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in OWN.items() if sql))
def test_query_equals_sql(spark, duck, name):
    ours = _run(spark, name)
    theirs = duck.sql(OWN[name][1]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert _bag(ours) == _bag(theirs)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in OWN.items() if not sql))
def test_query_without_sql_returns_rows(spark, name):
    assert len(_run(spark, name)) > 0


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "product_name", "department", "order_count", "reorder_rate",
    ]
