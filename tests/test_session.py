"""Intermediate tables in the shared folder."""

import os

import pytest

from basketry.session import delete_tables, materialize, new_table_path, shared_dir, tables_end_with


def test_tables_of_a_step_end_with_it(spark):
    folder = shared_dir(spark).removeprefix("file:")
    stays = materialize(spark.range(3))
    before = set(os.listdir(folder))
    with tables_end_with(spark):
        assert materialize(spark.range(5)).count() == 5
        with pytest.raises(ValueError), tables_end_with(spark):
            materialize(spark.range(7))
            raise ValueError
        assert len(set(os.listdir(folder)) - before) == 1
    assert set(os.listdir(folder)) == before and stays.count() == 3
    delete_tables(spark, [new_table_path(spark)])  # one that was never written


def test_tasks_follow_the_rows(spark):
    from basketry.session import ROWS_A_TASK, spread

    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    dealt = spread(df, ["k"], 3 * ROWS_A_TASK + 1)
    assert dealt.rdd.getNumPartitions() == 4  # and not as few as their bytes fill
    totals = dealt.groupBy("k").count()
    assert totals._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert totals.count() == 7 and dealt.count() == 100
    assert spread(df, ["k"], ROWS_A_TASK) is df
