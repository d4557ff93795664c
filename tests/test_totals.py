"""Cubes, sketches, sessions, loads, JSON fields and joint slopes."""

import datetime as dt
import random
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.functions import props
from basketry.operators import compare, cubes, elasticity, sessions, sketches


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables keep all their partitions, so that what ranges carry matters."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


# --- cubes --------------------------------------------------------------------------------
ROWS = [("a", "x", 1), ("a", None, 2), ("b", "x", None), (None, "x", 5), ("a", "x", 7)]
MEASURES = {"total": ("sum", "v"), "n": ("count", "v"), "mean": ("avg", "v"), "low": ("min", "v"), "high": ("max", "v")}


def test_totals_of_all_subsets_tell_null_values_from_subtotals(spark):
    df = spark.createDataFrame(ROWS, "g string, h string, v int")
    got = {(r.grouping_id, r.g, r.h): (r.total, r.n, r["mean"], r.low, r.high)
           for r in cubes.totals(df, ["g", "h"], MEASURES).collect()}
    want = {}
    for number, keep in ((0, (0, 1)), (1, (0,)), (2, (1,)), (3, ())):
        groups = {}
        for row in ROWS:
            key = tuple(row[i] if i in keep else None for i in (0, 1))
            groups.setdefault((number, *key), []).append(row[2])
        for key, values in groups.items():
            known = [v for v in values if v is not None]
            want[key] = (
                sum(known) if known else None, len(known), sum(known) / len(known) if known else None,
                min(known, default=None), max(known, default=None),
            )
    assert got == want


def test_sets_may_be_chosen_and_the_input_is_read_once(spark, tmp_path):
    spark.createDataFrame(ROWS, "g string, h string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = cubes.totals(df, ["g", "h"], MEASURES, cubes.rollup_sets(["g", "h"]))
    assert {r.grouping_id for r in found.collect()} == {0, 1, 3}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    below = plan[plan.index("Expand") :]
    assert "Aggregate" in below  # rows are reduced before they are multiplied
    assert cubes.totals(df.limit(0), ["g"], MEASURES, [("g",)]).count() == 0
    with pytest.raises(ValueError, match="no dimensions"):
        cubes.totals(df, ["g"], MEASURES, [("q",)])


# --- sketches -----------------------------------------------------------------------------
PLAN = sketches.SketchPlan({"users": "user"}, {"values": "value"}, {"items": "item"}, tracked=1000)


def _visits(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 30).alias("day"),
        (F.pmod(F.xxhash64("id"), F.lit(9000))).alias("user"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 100).alias("value"),
        F.expr("if(id % 3 = 0, 7, id % 500)").alias("item"),
    )
    return df


def test_merged_days_answer_for_any_span(spark):
    df = _visits(spark)
    daily = PLAN.build(df, ["day"]).cache()
    assert daily.count() == 30
    for low, high in ((0, 29), (3, 9)):
        rows = df.where(F.col("day").between(low, high))
        exact = rows.agg(
            F.count("*").alias("n"), F.count_distinct("user").alias("users"),
            F.count_if(F.col("item") == 7).alias("seven"),
        ).first()
        merged = PLAN.merge(daily.where(F.col("day").between(low, high)))
        once = PLAN.merge(PLAN.build(rows, []))
        for sketch in (merged, once):
            got = sketch.select(
                PLAN.count("users").alias("users"), PLAN.quantiles("values", [0.1, 0.5, 0.99]).alias("q"),
                PLAN.frequent("items", 1)[0].alias("top"), F.kll_sketch_get_n_double("values").alias("n"),
            ).first()
            assert got.n == exact.n
            assert abs(got.users - exact.users) <= 4 * PLAN.distinct_error * exact.users
            for p, value in zip((0.1, 0.5, 0.99), got.q):
                assert abs(rows.where(F.col("value") <= value).count() / exact.n - p) <= 2 * PLAN.rank_error
            assert got.top.item == 7 and abs(got.top["count"] - exact.seven) <= PLAN.count_error * exact.n
    daily.unpersist()


def test_sketches_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, None, None, None), (1, None, None, None)], "day int, user int, value int, item int")
    merged = PLAN.merge(PLAN.build(df, ["day"]), ["day"])
    row = merged.select(PLAN.count("users"), PLAN.quantiles("values", [0.5])).first()
    assert tuple(row) == (0, None)
    assert PLAN.merge(PLAN.build(df.limit(0), ["day"]), ["day"]).count() == 0


# --- sessions -----------------------------------------------------------------------------
def _sessions(rows, gap):
    out = []
    for key, group in groupby(sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] or -1, r[1])), key=lambda r: r[0]):
        times = [r[1] for r in group]
        run = [times[0]]
        for before, now in zip(times, times[1:]):
            if now - before > gap:
                out.append((key, run[0], run[-1], len(run)))
                run = []
            run.append(now)
        out.append((key, run[0], run[-1], len(run)))
    return sorted(out, key=repr)


def test_sessions_of_a_hot_key_equal_a_plain_loop(spark):
    draw = random.Random(4)
    rows = [(draw.choice([1] * 9 + [2, None]), draw.choice([None, *range(3000)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "user int, at int").repartition(6)
    found = sessions.sessions(df, ["user"], "at", F.lit(5), most=F.max("at"))
    got = [(r.user, r.started, r.ended, r.n_rows) for r in found.collect()]
    assert sorted(got, key=repr) == _sessions(rows, 5)
    numbered = sessions.with_sessions(df, ["user"], "at", F.lit(5))
    assert numbered.count() == len(rows)
    assert numbered.where("(session IS NULL) != (at IS NULL)").count() == 0
    assert numbered.agg(F.count_distinct("session"), F.max("session")).first() == (len(got), len(got))


def test_one_long_session_over_all_ranges_and_none(spark):
    df = spark.range(5000).select(F.lit("u").alias("user"), F.timestamp_seconds("id").alias("at"))
    [row] = sessions.sessions(df, ["user"], "at", F.expr("INTERVAL 1 SECOND")).collect()
    assert row.n_rows == 5000
    apart = sessions.sessions(df, ["user"], "at", F.expr("INTERVAL 0 SECOND"))
    assert apart.count() == 5000
    assert sessions.sessions(df.limit(0), ["user"], "at", F.expr("INTERVAL 1 SECOND")).count() == 0


# --- loads --------------------------------------------------------------------------------
def test_loads_as_bags(spark):
    old = [(1, "a"), (1, "a"), (1, "a"), (2, None), (3, "c")] + [(9, "hot")] * 500
    new = [(1, "a"), (2, None), (2, None), (4, "d")] + [(9, "hot")] * 503
    a = spark.createDataFrame(old, "k int, v string")
    b = spark.createDataFrame(new, "k int, v string").select("v", "k")  # columns by name
    x, y = Counter(old), Counter(new)
    got = {(r.k, r.v): (r.added, r.removed) for r in compare.changes(a, b).collect()}
    assert got == {k: (max(y[k] - x[k], 0), max(x[k] - y[k], 0)) for k in x | y if x[k] != y[k]}
    bag = lambda df: Counter(map(tuple, df.select("k", "v").collect()))
    assert bag(compare.except_all(a, b)) == x - y and bag(compare.except_all(b, a)) == y - x
    assert bag(compare.intersect_all(a, b)) == x & y
    assert compare.changes(a, a).count() == 0 and compare.except_all(a.limit(0), b).count() == 0
    assert {r.k for r in compare.changes(a, b, ["k"]).collect()} == {1, 2, 3, 4, 9}
    assert "Join" not in compare.changes(a, b)._jdf.queryExecution().executedPlan().toString()


# --- JSON ---------------------------------------------------------------------------------
def test_any_text_has_a_defined_value(spark):
    texts = ['{"k": 5, "s": "é"}', '{"k": "7"}', '{"k": {"x": 1}}', '{"j": 1}', "[1]", '{"k": 1', "", None, "null"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = df.select(
        props.value_at(t, "$.k", "bigint").alias("k"), props.is_broken(t).alias("broken"), props.as_map(t).alias("m")
    ).collect()
    assert [r.k for r in got] == [5, 7, None, None, None, None, None, None, None]
    assert [r.broken for r in got] == [False, False, False, False, False, True, True, False, False]
    assert [r.m for r in got] == [{"k": "5", "s": "é"}, {"k": "7"}, {"k": '{"x":1}'}, {"j": "1"}, {}, {}, {}, {}, {}]


# --- joint slopes -------------------------------------------------------------------------
def _points(n, names, seed=0):
    draw = np.random.default_rng(seed)
    price = draw.normal(0, 0.3, (n, len(names)))
    price[:, 1] += 0.8 * price[:, 0]  # prices that move together
    slopes = draw.normal(0, 1, (len(names), len(names)))
    quantity = 3 + price @ slopes.T + draw.normal(0, 0.05, price.shape)
    rows = [
        (dt.date(2020, 1, 1) + dt.timedelta(31 * t), c, float(quantity[t, i]), float(price[t, i]))
        for t in range(n) for i, c in enumerate(names)
    ]
    return rows, price, quantity


@pytest.mark.parametrize("ridge", [0.0, 0.5])
def test_joint_slopes_equal_a_numpy_solve(spark, ridge):
    names = list("abcdef")
    rows, price, quantity = _points(60, names)
    rows = rows[:-1]  # a period that lacks a price does not count
    df = spark.createDataFrame(rows, "period date, category string, ln_quantity double, ln_price double")
    found = elasticity.joint_elasticity(df, drivers=names, ridge=ridge)
    got = {(r.category, r.driver): r.elasticity for r in found.collect()}
    x = price[:-1] - price[:-1].mean(0)
    for i, c in enumerate(names):
        y = quantity[:-1, i] - quantity[:-1, i].mean()
        solved = np.linalg.solve(x.T @ x + ridge * np.eye(6), x.T @ y)
        assert [got[c, d] for d in names] == pytest.approx(solved.tolist(), rel=1e-8, abs=1e-10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "Python" not in plan


def test_joint_slopes_without_one_solution_are_null(spark):
    rows, *_ = _points(40, ["a", "b"])
    same = [(p, "c", q, dict(((r[0], r[1]), r[3]) for r in rows)[p, "a"]) for p, c, q, _ in rows if c == "b"]
    df = spark.createDataFrame(rows + same, "period date, category string, ln_quantity double, ln_price double")
    twice = elasticity.joint_elasticity(df, drivers=["a", "c"]).collect()  # two prices move as one
    assert len(twice) == 6 and all(r.elasticity is None for r in twice)
    assert all(r.elasticity is not None for r in elasticity.joint_elasticity(df, drivers=["a", "c"], ridge=0.1).collect())
    assert elasticity.joint_elasticity(df, drivers=[]).count() == 0
    none = elasticity.joint_elasticity(df, drivers=["a", "nowhere"])
    assert none.count() == 0
