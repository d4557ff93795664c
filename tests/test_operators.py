"""Operators against brute force on small inputs, with one hot key where it matters."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketry import schemas as S
from basketry.functions import (
    cosine,
    mentions_or_missing,
    month_label,
    percent_text,
    present,
    thousands_text,
    weekday_label,
)
from basketry.operators import (
    baskets,
    elasticity,
    profile,
    ranking,
    reorder,
    reshape,
    segments,
    series,
    similar,
)
from basketry.session import materialize, shared_dir


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- functions ----------------------------------------------------------------
def test_present_removes_each_token(spark):
    texts = [*S.NA_TOKENS, "Na", " NA", "nothing", None]
    df = _frame(spark, [(t,) for t in texts], "t string")
    kept = [r.t for r in df.select(present(F.col("t")).alias("t")).collect() if r.t is not None]
    assert kept == ["Na", " NA", "nothing"]
    assert len(S.NA_TOKENS) == 19


def test_mentions_or_missing(spark):
    df = _frame(spark, [("AUSTRALIA,x",), ("x",), (None,), ("australians",)], "t string")
    assert [r.t for r in df.where(mentions_or_missing(F.col("t"), "Australia")).collect()] == [
        "AUSTRALIA,x", None, "australians",
    ]


def test_labels(spark):
    df = _frame(spark, [(0, 1), (6, 12), (None, None), (9, 13)], "d int, m int")
    rows = df.select(weekday_label(F.col("d")).alias("d"), month_label(F.col("m")).alias("m"))
    assert [tuple(r) for r in rows.collect()] == [
        ("Sat", "Jan"), ("Fri", "Dec"), (None, None), (None, None),
    ]


def test_number_texts(spark):
    row = spark.range(1).select(percent_text(F.lit(0.5897)), thousands_text(F.lit(3421083))).first()
    assert tuple(row) == ("59.0%", "3,421,083")


def test_cosine(spark):
    rows = [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])]
    df = _frame(spark, rows, "a array<float>, b array<float>")
    values = [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert values[0] == pytest.approx(1 / np.sqrt(2))
    assert values[1] is None


# --- baskets --------------------------------------------------------------------
@pytest.fixture(scope="module")
def shop(spark):
    rng = random.Random(1)
    lines = []
    for order in range(200):
        for _ in range(rng.randint(1, 60)):
            product = 1 if rng.random() < 0.4 else rng.randint(2, 30)
            lines.append((order, product, rng.choice([0, 1, 1, None])))
    lines.append((7, 999, 1))  # a product the product table does not have
    products = [(i, f"p{i % 20}", f"d{i % 3}") for i in range(1, 31)]
    items = _frame(spark, lines, "order_id long, product_id long, reordered int")
    table = _frame(spark, products, "product_id long, product_name string, department string")
    joined = pd.DataFrame(lines, columns=["order_id", "product_id", "reordered"]).merge(
        pd.DataFrame(products, columns=["product_id", "product_name", "department"])
    )
    return items, table, joined


def test_popularity_equals_join_then_group(shop):
    items, products, joined = shop
    got = {
        (r.product_name, r.department): (r.order_count, r.reorder_rate)
        for r in baskets.product_popularity(items, products).collect()
    }
    grouped = joined.groupby(["product_name", "department"]).reordered.agg(["size", "mean"])
    assert set(got) == set(grouped.index)
    for key, row in grouped.iterrows():
        assert got[key][0] == row["size"]
        assert got[key][1] == pytest.approx(row["mean"])


def test_top_products_order_and_limit(shop):
    items, products, joined = shop
    top = baskets.top_products(items, products, n=5).collect()
    counts = joined.groupby(["product_name", "department"]).size()
    best = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert [(r.product_name, r.department) for r in top] == [k for k, _ in best]


def test_rate_of_product_with_unknown_flags_only(spark):
    items = _frame(spark, [(1, 1, None)], "order_id long, product_id long, reordered int")
    products = _frame(spark, [(1, "a", "d")], "product_id long, product_name string, department string")
    row = baskets.product_popularity(items, products).first()
    assert (row.order_count, row.reorder_rate) == (1, None)


def test_items_by_department(shop):
    items, products, joined = shop
    got = [(r.department, r.n_items) for r in baskets.items_by(items, products).collect()]
    counts = joined.groupby("department").size().to_dict()
    assert dict(got) == counts
    assert [n for _, n in got] == sorted(counts.values(), reverse=True)
    assert sum(n for _, n in got) == len(joined)


def test_reorder_rate_skips_missing(shop):
    row = baskets.reorder_rate(shop[0]).first()
    flags = [r.reordered for r in shop[0].collect() if r.reordered is not None]
    assert row.reorder_rate == pytest.approx(np.mean(flags))
    assert row.reorder_rate + row.first_time_rate == pytest.approx(1)


def test_orders_by_code_skips_missing(spark):
    df = _frame(spark, [(1,), (0,), (1,), (None,)], "order_dow int")
    rows = baskets.orders_by(df, "order_dow", weekday_label).collect()
    assert [tuple(r) for r in rows] == [(0, 1, "Sat"), (1, 2, "Sun")]


# --- profiles -------------------------------------------------------------------
@pytest.mark.parametrize("how", ["counted", "ranked"])
def test_describe_equals_pandas(spark, shop, how):
    sizes = baskets.basket_sizes(shop[0])
    values = sizes.toPandas()["basket_size"]
    row = profile.describe(sizes, "basket_size", quantiles=how).first()
    want = values.describe()
    assert [row.n, row.min, row.max] == [want["count"], want["min"], want["max"]]
    assert row.mean == pytest.approx(want["mean"])
    assert row["std"] == pytest.approx(want["std"])
    assert [row.p25, row.p50, row.p75] == pytest.approx([want["25%"], want["50%"], want["75%"]])


def test_describe_approximate_is_close(spark):
    df = spark.range(1, 1001)
    row = profile.describe(df, "id", quantiles="approximate").first()
    assert [row.p25, row.p50, row.p75] == pytest.approx([250, 500, 750], abs=2)


def test_exact_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=400), np.full(300, 0.5), [np.pi]])
    df = _frame(spark, [(float(v),) for v in values] + [(None,)], "v double").repartition(7)
    ps = [0, 0.1, 0.25, 0.5, 0.75, 0.999, 1]
    row = ranking.exact_quantiles(df, "v", ps).first()
    assert list(row) == pytest.approx(list(np.quantile(values, ps)))


@pytest.mark.parametrize("upper", [None, 40])
def test_histogram_equals_numpy(spark, shop, upper):
    sizes = baskets.basket_sizes(shop[0])
    values = sizes.toPandas()["basket_size"].clip(upper=upper)
    rows = profile.histogram(sizes, "basket_size", 40, upper).collect()
    counts, edges = np.histogram(values, bins=40)
    assert [r.n for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == pytest.approx(edges[:-1])
    assert [r.bin_end for r in rows] == pytest.approx(edges[1:])
    assert sum(r.n for r in rows) == len(values)


def test_histogram_of_one_value(spark):
    rows = profile.histogram(_frame(spark, [(2,), (2,), (None,)], "v int"), "v", 4).collect()
    assert [r.n for r in rows] == [2, 0, 0, 0]


def test_null_counts_and_shape(spark):
    rows = [(1, None, None), (2, None, "x"), (3, 1.0, "y")]
    df = _frame(spark, rows, "`a-1` int, b double, c string")
    assert [tuple(r) for r in profile.most_missing(df, 2).collect()] == [("b", 2), ("c", 1)]
    assert {r[0] for r in profile.null_counts(df).collect()} == {"a-1", "b", "c"}
    assert tuple(profile.shape(df).first()) == (3, 3)


def test_top_values_break_ties_by_value(spark):
    df = _frame(spark, [(v,) for v in ["b", "a", "c", "c", None]], "v string")
    assert [tuple(r) for r in profile.top_values(df, "v", 2).collect()] == [("c", 2), ("a", 1)]


def test_samples_are_complete_rows(spark):
    rows = [(i, None if i % 3 else "x") for i in range(60)]
    df = _frame(spark, rows, "k long, t string")
    for sample in (
        profile.sample_rows(df, ["k", "t"], 5, seed=1),
        profile.sample_by_key(df, ["k", "t"], "k", 5),
    ):
        taken = sample.collect()
        assert len(taken) == 5
        assert all(r.t == "x" for r in taken)


# --- ranking --------------------------------------------------------------------
@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        user = 1 if rng.random() < 0.4 else rng.randint(2, 60)
        rows.append((user, rng.randint(0, 300), i))
    df = _frame(spark, rows, "user long, day int, key long").repartition(9)
    return df, pd.DataFrame(rows, columns=["user", "day", "key"])


def test_row_number(visits):
    df, table = visits
    got = {r.key: r.n for r in ranking.with_row_number(df, ["user", "day", "key"], "n").collect()}
    ordered = table.sort_values(["user", "day", "key"]).key.tolist()
    assert [got[k] for k in ordered] == list(range(1, len(ordered) + 1))


def test_number_in_group_with_a_hot_user(visits):
    df, table = visits
    numbered = ranking.with_number_in_group(df, ["user"], ["day", "key"], "n")
    got = {r.key: r.n for r in numbered.collect()}
    ordered = table.sort_values(["user", "day", "key"])
    want = ordered.groupby("user").cumcount() + 1
    assert got == dict(zip(ordered.key, want))


def test_previous_with_a_hot_user(visits):
    df, table = visits
    seen = ranking.with_previous(df, ["user"], ["day", "key"], "day", "before")
    got = {r.key: r.before for r in seen.collect()}
    ordered = table.sort_values(["user", "day", "key"])
    before = ordered.groupby("user").day.shift()
    want = {k: None if pd.isna(b) else int(b) for k, b in zip(ordered.key, before)}
    assert got == want


@pytest.mark.parametrize("n", [1, 3, 5, 6, 23, 100])
def test_ntile(spark, n):
    numbered = spark.range(1, n + 1)
    numbered.createOrReplaceTempView("numbered")
    want = spark.sql("SELECT id, ntile(5) OVER (ORDER BY id) AS t FROM numbered").collect()
    got = numbered.withColumn("t", ranking.ntile_of(F.col("id"), F.lit(n), 5)).collect()
    assert {r.id: r.t for r in got} == {r.id: r.t for r in want}


def test_intermediate_tables_go_to_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert folder == named.rstrip("/") if named else folder
    fixed = materialize(spark.range(3).withColumn("`odd name`", F.lit("x")))
    assert fixed.count() == 3
    assert all(f"{folder}/stage-" in path for path in fixed.inputFiles())


# --- reshape and series -----------------------------------------------------------
def test_wide_to_long_equals_unpivot(spark):
    rows = [("a", 1, None, 3), ("b", 0, 5, 6)]
    df = _frame(spark, rows, "id string, d_1 int, d_2 int, d_10 int")
    days = reshape.prefixed(df.columns, "d_")
    got = reshape.wide_to_long(df, ["id"], days)
    want = df.unpivot(["id"], days, "day", "sales")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.agg(F.sum("sales")).first()[0] == 15


@pytest.fixture(scope="module")
def sold(spark):
    rng = random.Random(8)
    start = dt.date(2020, 1, 1)
    rows = {}
    for item in ("a", "b", "c"):
        for _ in range(60):
            day = start + dt.timedelta(days=rng.randint(0, 200))
            rows[item, day] = float(rng.randint(1, 9))
    rows["z", start] = 4.0  # sold on a single day
    data = [(i, d, s) for (i, d), s in rows.items()]
    return _frame(spark, data, "item string, date date, sales double"), rows


def _dense(rows):
    spans = {}
    for item, day in rows:
        lo, hi = spans.get(item, (day, day))
        spans[item] = min(lo, day), max(hi, day)
    return {
        (item, lo + dt.timedelta(days=n)): rows.get((item, lo + dt.timedelta(days=n)), 0.0)
        for item, (lo, hi) in spans.items()
        for n in range((hi - lo).days + 1)
    }


def test_zero_fill(sold):
    df, rows = sold
    got = series.zero_fill(df, ["item"]).collect()
    assert {(r.item, r.date): r.sales for r in got} == _dense(rows)
    assert len(got) == len(_dense(rows))
    assert sum(r.sales for r in got) == sum(rows.values())


def test_zero_fill_until(sold):
    df, rows = sold
    until = dt.date(2020, 8, 1)
    got = series.zero_fill(df, ["item"], until=F.lit(until))
    assert {r[0] for r in got.groupBy("item").agg(F.max("date")).select("max(date)").collect()} == {until}
    assert got.agg(F.sum("sales")).first()[0] == sum(rows.values())


def test_zero_filled_mean_equals_mean_over_filled_rows(sold):
    df, rows = sold
    got = {r.month: (r.n_days, r.avg_sales) for r in series.zero_filled_period_mean(df, ["item"]).collect()}
    months = {}
    for (_, day), amount in _dense(rows).items():
        months.setdefault(day.month, []).append(amount)
    assert set(got) == set(months)
    for month, amounts in months.items():
        assert got[month] == (len(amounts), pytest.approx(np.mean(amounts)))


def test_lag_features_on_sold_days_and_on_all_days(sold):
    df, rows = sold
    dense = _dense(rows)
    for table in (df, series.zero_fill(df, ["item"])):
        for r in series.lag_features(table, ["item"]).collect():
            first = min(d for i, d in rows if i == r.item)
            age = (r.date - first).days

            def at(n):
                return dense.get((r.item, r.date - dt.timedelta(days=n)), 0.0)

            for n in (28, 35, 42):
                assert r[f"lag_{n}"] == (at(n) if age >= n else None)
            for back, to in ((34, 28), (55, 28)):
                want = np.mean([at(n) for n in range(to, back + 1)]) if age >= back else None
                assert r[f"mean_{back}_{to}"] == (want if want is None else pytest.approx(want))


def test_time_split_never_mixes(sold):
    df, rows = sold
    train, test = series.time_split(df, series.last_day(df))
    assert train.count() + test.count() == len(rows)
    last_train = train.agg(F.max("date")).first()[0]
    first_test = test.agg(F.min("date")).first()[0]
    assert last_train < first_test
    assert first_test > max(d for _, d in rows) - dt.timedelta(days=28)


def test_range_and_distincts(sold):
    df, rows = sold
    row = series.date_range_and_distincts(df, columns=["item"]).first()
    days = [d for _, d in rows]
    assert tuple(row) == (min(days), max(days), 4)
    assert series.date_range_and_distincts(df, columns=["item"], approximate=True).first() == row


# --- customers --------------------------------------------------------------------
def test_rfm_undated(spark):
    orders = _frame(
        spark,
        [(1, 10, 1, None), (2, 10, 2, 7.0), (3, 20, 1, None)],
        "order_id long, user_id long, order_number int, days_since_prior_order double",
    )
    items = _frame(spark, [(1, 5), (2, 5), (2, 6)], "order_id long, product_id long")
    rows = {r.user_id: tuple(r)[1:] for r in segments.rfm_undated(orders, items).collect()}
    assert rows == {10: (7.0, 2, 3), 20: (7.0, 1, 0)}  # one order: the longest gap


def test_scores_are_equal_sized_with_a_hot_value(spark):
    rows = [(u, 5 if u < 40 else u, 1, float(u % 7)) for u in range(101)]
    df = _frame(spark, rows, "user_id long, recency_days int, frequency long, monetary double")
    scored = segments.rfm_scores(df).toPandas()
    for name in ("r_score", "f_score", "m_score"):
        assert scored[name].value_counts().to_dict() == {1: 21, 2: 20, 3: 20, 4: 20, 5: 20}
    assert scored.loc[scored.recency_days == 100, "r_score"].item() == 1


def test_segments_are_separated(spark):
    rng = np.random.default_rng(0)
    rows = []
    for u in range(120):
        good = u % 2
        rows.append((u, int(rng.integers(1, 5) if good else rng.integers(200, 300)),
                     int(rng.integers(50, 60) if good else rng.integers(1, 3)),
                     float(rng.uniform(900, 999) if good else rng.uniform(1, 5))))
    df = _frame(spark, rows, "user_id long, recency_days int, frequency long, monetary double")
    model = segments.fit_segments(df, k=2)
    assigned = segments.assign_segments(model, df)
    assert segments.silhouette(assigned) > 0.5
    pairs = {(r.user_id % 2, r.segment) for r in assigned.collect()}
    assert len(pairs) == 2


# --- elasticity -------------------------------------------------------------------
def test_own_elasticity_recovers_the_slope(spark):
    rows = []
    for category, slope in (("a", -1.5), ("b", -0.5)):
        for week in range(30):
            price = 2 + (week % 7) / 3
            quantity = 100 * price**slope
            rows.append((category, week, quantity, quantity * price))
    rows.append(("a", 99, 0.0, 0.0))  # no sales, no point
    df = _frame(spark, rows, "category string, week int, quantity double, revenue double")
    points = elasticity.price_points(df, ["category", "week"])
    fitted = {r.category: r for r in elasticity.own_elasticity(points, ["category"]).collect()}
    assert fitted["a"].elasticity == pytest.approx(-1.5)
    assert fitted["b"].elasticity == pytest.approx(-0.5)
    assert fitted["a"].r2 == pytest.approx(1)
    assert fitted["a"].n_points == 30


@pytest.mark.parametrize("batch", [1, 2, 100])
def test_cross_elasticity_equals_pairwise_fits(spark, batch):
    rng = np.random.default_rng(4)
    rows = [
        (c, w, float(rng.normal()), float(rng.normal()))
        for c in "abcd"
        for w in range(40)
        if rng.random() < 0.8  # not every category sells every week
    ]
    df = _frame(spark, rows, "category string, period int, ln_quantity double, ln_price double")
    got = {
        (r.category, r.driver): (r.elasticity, r.n_points)
        for r in elasticity.cross_elasticity(df, drivers=list("abcd"), batch=batch).collect()
    }
    table = pd.DataFrame(rows, columns=["c", "w", "q", "p"])
    both = table.merge(table, on="w", suffixes=("", "_d"))
    both = both[both.c != both.c_d]
    assert len(got) == 12
    for key, group in both.groupby(["c", "c_d"]):
        slope = np.polyfit(group.p_d, group.q, 1)[0]
        assert got[key] == (pytest.approx(slope), len(group))


def test_cross_elasticity_of_chosen_drivers(spark):
    rows = [(c, w, w * 0.1, w * (1.0 if c == "a" else 2.0)) for c in "abc" for w in range(5)]
    df = _frame(spark, rows, "category string, period int, ln_quantity double, ln_price double")
    got = elasticity.cross_elasticity(df, drivers=["a"]).collect()
    assert sorted((r.category, r.driver) for r in got) == [("b", "a"), ("c", "a")]


# --- similarity -------------------------------------------------------------------
@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(50, 8))
    rows = [(i, f"c{i % 3}", [float(x) for x in v]) for i, v in enumerate(data)]
    rows.append((50, "c0", [0.0] * 8))
    df = _frame(spark, rows, "product_id long, category string, embedding array<double>")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    return df, unit


def test_similar_products(vectors):
    df, unit = vectors
    scores = unit @ unit[4]
    want = [i for i in np.argsort(-scores) if i != 4][:6]
    got = similar.similar_to(df, 4, 6).collect()
    assert [r.product_id for r in got] == want
    assert [r.similarity for r in got] == pytest.approx(list(scores[want]))


def test_similar_to_a_vector_with_filter(vectors):
    df, unit = vectors
    target = [float(x) for x in unit[0] + unit[1]]
    scores = unit @ np.array(target)
    want = [i for i in np.argsort(-scores) if i % 3 == 2][:4]
    got = similar.similar_to_vector(df, target, 4, where=F.col("category") == "c2").collect()
    assert [r.product_id for r in got] == want


def test_substitutes_stay_in_the_category(vectors):
    df, unit = vectors
    scores = unit @ unit[4]
    want = [i for i in np.argsort(-scores) if i % 3 == 1 and i != 4][:5]
    got = similar.substitutes(df, 4, 5).collect()
    assert [r.product_id for r in got] == want
    assert {r.category for r in got} == {"c1"}


# --- reorders ---------------------------------------------------------------------
def _history(spark, n_users=80):
    rng = random.Random(11)
    orders, items = [], []
    order = 0
    for user in range(n_users):
        for number in range(1, rng.randint(2, 8)):
            order += 1
            orders.append((order, user, number))
            for product in range(8):
                if rng.random() < (0.9 if product < 2 else 0.15):
                    items.append((order, product))
    return (
        _frame(spark, orders, "order_id long, user_id long, order_number int"),
        _frame(spark, items, "order_id long, product_id long"),
        orders,
        items,
    )


def test_reorder_features_use_earlier_orders_only(spark):
    orders, items, order_rows, item_rows = _history(spark)
    placed = {o: (u, n) for o, u, n in order_rows}
    last = {}
    for _, user, number in order_rows:
        last[user] = max(last.get(user, 0), number)
    bought = {}
    for order, product in item_rows:
        user, number = placed[order]
        bought.setdefault((user, product), set()).add(number)
    want = {}
    for (user, product), numbers in bought.items():
        end = last[user]
        before = {n for n in numbers if n < end}
        if before:
            want[user, product] = (
                len(before), len(before) / (end - 1), end - max(before), end - 1, int(end in numbers),
            )
    got = {(r.user_id, r.product_id): tuple(r)[2:] for r in reorder.reorder_features(orders, items).collect()}
    assert got == want


def test_reorder_model_beats_chance(spark):
    orders, items, *_ = _history(spark)
    table = reorder.reorder_features(orders, items)
    scored = reorder.score_reorders(reorder.fit_reorder_model(table), table)
    assert reorder.area_under_roc(scored) > 0.7
    low, high = scored.agg(F.min("reorder_probability"), F.max("reorder_probability")).first()
    assert 0 <= low < high <= 1


def test_class_weights_balance(spark):
    df = _frame(spark, [(1,)] + [(0,)] * 9, "label int")
    totals = dict(reorder.with_class_weight(df).groupBy("label").agg(F.sum("weight")).collect())
    assert totals == {0: pytest.approx(5), 1: pytest.approx(5)}


def test_numbers_in_a_hot_group_without_a_join_on_it(spark):
    """One user holds two thirds of the rows and spans many ranges."""
    rows = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 7 ELSE id END AS user_id", "id AS order_id"
    )
    with_numbers = ranking.with_number_in_group(rows, ["user_id"], ["order_id"], "number")
    got = {r.order_id: r.number for r in with_numbers.collect()}
    hot = [o for o in range(30_000) if o % 3 < 2]
    assert all(got[o] == n for n, o in enumerate(hot, 1))
    assert all(got[o] == 1 for o in range(2, 30_000, 3))
    plan = with_numbers._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" not in plan


def test_similarity_rejects_what_it_cannot_compare(spark):
    rows = [(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [0.0, 0.0]), (4, [1.0, 1.0]), (5, None)]
    vectors = _frame(spark, rows, "product_id int, embedding array<double>")
    assert [r.product_id for r in similar.similar_to(vectors, 1, 10).collect()] == [4]
    for product in (3, 5, 99):
        with pytest.raises(PySparkException, match="no vector"):
            similar.similar_to(vectors, product, 10).collect()
    longer = vectors.union(_frame(spark, [(6, [1.0])], "product_id int, embedding array<double>"))
    with pytest.raises(PySparkException, match="different numbers"):
        similar.similar_to(longer, 1, 10).collect()


def test_sample_takes_large_and_text_keys(spark):
    large = spark.range(3).selectExpr("9300000000000000 + id AS k", "1 AS v")
    assert profile.sample_by_key(large, ["k", "v"], "k", 2).count() == 2
    texts = _frame(spark, [("x0012", 1), ("y", 2)], "k string, v int")
    assert profile.sample_by_key(texts, ["k", "v"], "k", 5).count() == 2


def test_no_drivers_no_slopes(spark):
    points = _frame(
        spark, [("a", 1, 0.5, 0.5)], "category string, period int, ln_quantity double, ln_price double"
    )
    assert elasticity.cross_elasticity(points).collect() == []


def test_reorder_labels_need_a_known_last_order(spark):
    orders = _frame(
        spark,
        [(1, 10, 1), (2, 10, 2), (3, 20, 1), (4, 20, 2)],
        "order_id int, user_id int, order_number int",
    )
    items = _frame(spark, [(1, 5), (2, 5), (3, 5)], "order_id int, product_id int")
    rows = {r.user_id: r for r in reorder.reorder_features(orders, items).collect()}
    assert (rows[10].label, rows[20].label) == (1, None)
    ahead = {r.user_id: r for r in reorder.next_order_features(orders, items).collect()}
    assert (ahead[10].times_bought, ahead[10].n_orders, ahead[10].orders_since) == (2, 2, 1)
    assert (ahead[20].times_bought, ahead[20].n_orders, ahead[20].orders_since) == (1, 1, 1)


def test_boosted_trees_find_what_a_line_cannot_and_are_calibrated(spark):
    rng = np.random.default_rng(8)
    rows = []
    for user in range(1500):
        for product in range(3):
            share = float(rng.random())
            chance = 0.8 if 0.3 < share < 0.6 else 0.1  # neither end: no line tells these apart
            label = None if user % 50 == 0 else int(rng.random() < chance)
            rows.append((user, product, int(rng.integers(1, 5)), share, 1, 5, label))
    names = "user_id int, product_id int, times_bought int, order_share double, orders_since int, n_orders int, label int"
    fits, tests = reorder.split_customers(_frame(spark, rows, names).cache())
    trees = reorder.fit_reorder_trees(fits, maxIter=10)
    line = reorder.fit_reorder_model(fits)
    area = reorder.area_under_roc(trees.trees.transform(tests))
    assert area > 0.8 > 0.7 > reorder.area_under_roc(line.transform(tests))
    scored = trees.score(tests)
    assert scored.columns == [*tests.columns, "reorder_probability"]
    high = scored.where("reorder_probability > 0.5").agg({"label": "avg", "reorder_probability": "avg"}).first()
    assert abs(high[0] - high[1]) < 0.1 and high[0] > 0.7
    assert scored.where("reorder_probability NOT BETWEEN 0 AND 1").count() == 0


# --- positions and lines ----------------------------------------------------------
def test_rows_at_positions_of_a_sorted_result(spark):
    df = _frame(spark, [(i * 7 % 50,) for i in range(50)], "v int").repartition(5)
    rows = ranking.rows_at(df, ["v"], [0, 3, -1, -50, 49, 50, -51]).collect()
    assert sorted((r.position, r.v) for r in rows) == [(1, 0), (4, 3), (50, 49)]
    assert ranking.rows_at(df.limit(0), ["v"], [0, -1]).count() == 0


def test_answers_as_aligned_lines(spark):
    from basketry.plans.report import text_lines

    df = _frame(spark, [("milk", 5), ("é", None), ("a long name", 12345)], "item string, n int")
    lines = [r.line for r in text_lines(df, ["item"]).orderBy("line_number").collect()]
    assert lines == ["       item     n", "a long name 12345", "       milk     5", "          é  NULL"]
    assert [r.line for r in text_lines(df.limit(0), ["item"]).collect()] == ["item n"]


def test_reorder_models_fit_on_rows_that_differ(spark):
    rows = [(u, u % 3 + 1, (u % 3 + 1) / 4, u % 2 + 1, 4, int(u % 5 < u % 3)) for u in range(600)]
    names = "user_id int, times_bought int, order_share double, orders_since int, n_orders int, label int"
    table = _frame(spark, rows, names)
    alike = reorder.alike(table).collect()
    assert len(alike) <= 12 and sum(r.n_alike for r in alike) == 600
    weighted = reorder.with_class_weight(reorder.alike(table), count="n_alike")
    halves = {r.label: r.w for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert halves[0] == pytest.approx(halves[1]) == pytest.approx(300)
    trees = reorder.fit_reorder_trees(table, maxIter=3)
    left = {r.user_id: r.reorder_probability for r in trees.score(table).collect()}
    assert len(left) == 600 and all(0 <= p <= 1 for p in left.values())
