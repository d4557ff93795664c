"""As-of and interval joins against plain loops, with hot keys and odd rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import asof, ranking, spans


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables keep all their partitions, so that what ranges carry matters."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- as-of ------------------------------------------------------------------------------
def _asof(left, right, direction, strict, within):
    out = []
    for row, key, at in left:
        best = None
        for value, other, then in right:
            if key is None or at is None or then is None or other != key:
                continue
            if direction == "backward":
                fits = then < at or (then == at and not strict)
                better = best is None or (then, value) > best
            else:
                fits = then > at or (then == at and not strict)
                better = best is None or (-then, value) > (-best[0], best[1])
            if fits and better:
                best = (then, value)
        if best and within is not None and abs(best[0] - at) > within:
            best = None
        out.append((row, best[1] if best else None))
    return sorted(out)


def _events(n, hot):
    draw = random.Random(7)
    keys = [1] * hot + [2, 3, None]
    left = [(i, draw.choice(keys), draw.choice([None, *range(200)])) for i in range(n)]
    right = [(i, draw.choice([*keys, 4]), draw.choice([None, *range(0, 200, 7)])) for i in range(n // 3)]
    return left, right


@pytest.mark.parametrize(
    "direction, strict, within",
    [("backward", False, None), ("backward", True, 9), ("forward", False, 9), ("forward", True, None)],
)
def test_asof_equals_plain_loop(spark, direction, strict, within):
    left, right = _events(500, 12)  # one key has most rows, over all ranges of the sort
    a = spark.createDataFrame(left, "row int, key int, at int").repartition(5)
    b = spark.createDataFrame(right, "value int, other int, then int").withColumnRenamed("other", "key")
    found = asof.asof_join(
        a, b.repartition(3), ["key"], "at", "then", ["value"], direction, strict,
        None if within is None else F.lit(within),
    )
    assert sorted((r.row, r.value) for r in found.collect()) == _asof(left, right, direction, strict, within)
    assert found.columns == ["row", "key", "at", "value"]


def test_asof_spreads_a_hot_key_without_a_window_on_it(spark):
    left = spark.range(20_000).select(F.lit(1).alias("key"), F.col("id").alias("at"))
    right = spark.range(0, 20_000, 100).select(F.lit(1).alias("key"), F.col("id").alias("then"))
    found = asof.asof_join(left, right, ["key"], "at", "then", ["then"])
    assert found.where("then = at - at % 100").count() == 20_000
    plan = _plan(found)
    assert "NestedLoopJoin" not in plan and "hashpartitioning(key" not in plan
    frozen = ranking._frozen_order(left, ["key", "at"])
    assert frozen.select(ranking._PART).distinct().count() > 1  # the one key is in several ranges


def test_asof_without_right_rows_or_keys(spark):
    left = spark.createDataFrame([(1, 5), (2, None)], "key int, at int")
    none = spark.createDataFrame([], "key int, then int, value string")
    assert [r.value for r in asof.asof_join(left, none, ["key"], "at", "then", ["value"]).collect()] == [None, None]
    assert asof.asof_join(left.limit(0), none, ["key"], "at", "then", ["value"]).count() == 0
    told = spark.createDataFrame([(1, "a"), (4, "b"), (9, "c")], "then int, value string")
    got = asof.asof_join(left, told, [], "at", "then", ["value"]).collect()
    assert sorted((r.key, r.value) for r in got) == [(1, "b"), (2, None)]
    with pytest.raises(ValueError, match="both tables"):
        asof.asof_join(left, left, ["key"], "at", "at", ["at"])
    with pytest.raises(ValueError, match="direction"):
        asof.asof_join(left, told, [], "at", "then", ["value"], direction="sideways")


# --- intervals ----------------------------------------------------------------------------
def _spans(n, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        start = draw.randint(-500, 500)
        length = draw.choice([0, 0, 1, 3, 4, 15, 16, 17, 63, 64, 400, -2])
        key = draw.choice([1, 1, 1, 2, None])
        rows.append((i, key, draw.choice([start, start, start, None]), start + length))
    return rows


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("finest", [0, 5])
def test_interval_join_equals_plain_loop(spark, keys, finest):
    left, right = _spans(150, 1), _spans(140, 2)
    names = "row int, key int, low long, high long"
    a, b = spark.createDataFrame(left, names), spark.createDataFrame(right, names)
    found = spans.interval_join(a, b, ("low", "high"), ("low", "high"), keys, finest=finest)
    want = [
        (x[0], y[0])
        for x in left
        for y in right
        if x[2] is not None and y[2] is not None and x[2] <= x[3] and y[2] <= y[3]
        and x[2] <= y[3] and y[2] <= x[3] and (not keys or (x[1] == y[1] and x[1] is not None))
    ]
    got = sorted((r.row, r.right_row) for r in found.collect())
    assert got == sorted(want)
    assert "NestedLoopJoin" not in _plan(found) and "Cartesian" not in _plan(found)


def test_points_dates_and_times(spark):
    day = dt.date(2024, 2, 28)
    spells = spark.createDataFrame([(1, day, day + dt.timedelta(2)), (2, day, day)], "id int, low date, high date")
    days = spark.createDataFrame([(day + dt.timedelta(i),) for i in range(-1, 4)], "day date")
    got = spans.interval_join(spells, days, ("low", "high"), ("day", "day"), prefix="d_")
    assert sorted((r.id, r.d_day.day) for r in got.collect()) == [(1, 1), (1, 28), (1, 29), (2, 28)]
    at = dt.datetime(2024, 1, 1)
    times = spark.createDataFrame([(at + dt.timedelta(seconds=s),) for s in (0, 5, 10)], "at timestamp_ntz")
    near = times.select("at", (F.col("at") - F.expr("INTERVAL 5 SECONDS")).alias("since"))
    assert spans.interval_join(near, times, ("since", "at"), ("at", "at")).count() == 5
    with pytest.raises(TypeError, match="no timestamp"):
        spans.interval_join(spark.createDataFrame([("a",)], "x string"), days, ("x", "x"), ("day", "day"))
    with pytest.raises(ValueError, match="both sides"):
        spans.interval_join(spells, days, ("low", "high"), ("day", "day"), ["id"])
    assert spans.interval_join(spells.limit(0), days, ("low", "high"), ("day", "day")).count() == 0


def test_long_intervals_make_few_rows(spark):
    # one interval as long as all points together makes no row per narrow bin
    points = spark.range(0, 3000).select(F.col("id").alias("at"))
    whole = spark.createDataFrame([(0, 10_000_000_000_000)], "low long, high long")
    binned = spans._binned(spans._prepared(whole, ("low", "high"), "", 0), [0], "left")
    assert binned.count() <= 2
    assert spans.interval_join(points, whole, ("at", "at"), ("low", "high")).count() == 3000


def test_whole_bins_and_rests_make_the_totals_of_all_pairs(spark):
    rng = random.Random(5)
    times = [None, 0, 4095, 4096, *(rng.randrange(-3000, 90_000) for _ in range(800)), *[50_000] * 300]
    points = spark.createDataFrame(
        [(t, "ab"[i % 2] if i % 7 else None, float(i)) for i, t in enumerate(times)], "at long, kind string, value double"
    )
    ends = [(1, None, 5), (2, 9, 3), (3, 4096, 8191), (4, 0, 0), (4, -5000, 99_999)]
    ends += [(i, t - 60_000, t) for i, t in enumerate(times[3::3], 10)]
    asked = spark.createDataFrame(ends, "id int, since long, until long")
    measures = {"n": ("count", "at"), "most": ("max", "value")}
    inner, rest, width = spans.whole_bins(asked, points, ("since", "until"), "at", ["kind"], measures)
    pairs = spans.interval_join(rest, points, ("since", "until"), ("at", "at"), prefix="p_", finest=width)
    outer = pairs.selectExpr("id", "p_kind AS kind", "1L AS n", "p_value AS most")
    both = inner.select("id", "kind", "n", "most").union(outer)
    found = both.groupBy("id", "kind").agg(F.sum("n").alias("n"), F.max("most").alias("most"))
    true = {}
    for number, since, until in ends:
        for i, t in enumerate(times):
            if None not in (since, t) and since <= t <= until:
                kind = "ab"[i % 2] if i % 7 else None
                n, most = true.get((number, kind), (0, 0.0))
                true[number, kind] = (n + 1, max(most, float(i)))
    assert {(r.id, r.kind): (r.n, r.most) for r in found.collect()} == true
    n_pairs = sum(n for n, _ in true.values())
    assert 2 * both.count() < n_pairs  # not a row per pair


def test_whole_bins_of_nothing(spark):
    none = spark.createDataFrame([], "id int, since long, until long")
    points = spark.createDataFrame([(1, "a")], "at long, kind string")
    for asked, some in ((none, points), (none, points.limit(0))):
        inner, rest, _ = spans.whole_bins(asked, some, ("since", "until"), "at", ["kind"], {"n": ("count", "at")})
        assert inner.count() == rest.count() == 0
