"""The inverted-file index against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import vector_index
from basketry.session import shared_dir


def _clusters(n, hot=0.0, seed=1, centres=60):
    """Vectors around many centres; a share of all rows around one of them."""
    draw = np.random.default_rng(seed)
    at = draw.standard_normal((centres, 16))
    which = np.where(draw.random(n) < hot, 0, draw.integers(0, centres, n))
    return which, at[which] + 0.25 * draw.standard_normal((n, 16))


def _table(spark, which, whole):
    rows = [(i, [float(x) for x in v], int(c) % 3) for i, (c, v) in enumerate(zip(which, whole))]
    return spark.createDataFrame(rows, "product_id long, embedding array<double>, category int")


def _true(whole, query, k, allowed=None):
    unit = whole / np.linalg.norm(whole, axis=1, keepdims=True)
    near = unit @ unit[query]
    near[query] = -2
    if allowed is not None:
        near[~allowed] = -2
    order = np.lexsort((np.arange(len(near)), -near))[:k]
    return [i for i in order if near[i] > -2], near


def test_search_finds_most_neighbours_in_a_share_of_cells(spark, tmp_path):
    which, whole = _clusters(3000, hot=0.33)
    df = _table(spark, which, whole).repartition(5)
    index = vector_index.build_index(df, str(tmp_path / "index"))
    rows = index.rows(spark)
    assert rows.count() == 3000 and rows.agg(F.max("cell")).first()[0] < math.isqrt(3000)
    probes = vector_index.probes_for(index, spark, recall=0.95, n_queries=60)
    assert probes < math.isqrt(3000) / 3
    got = {}
    for r in vector_index.search(index, df.where("product_id % 50 = 0"), probes=probes).collect():
        got.setdefault(r.query, []).append((r.position, r.product_id, r.similarity))
    hits = 0
    for query in range(0, 3000, 50):
        true, near = _true(whole, query, 10)
        found = sorted(got[query])
        assert [p for p, _, _ in found] == list(range(1, 11))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        assert all(s == pytest.approx(near[i], abs=1e-12) and i != query for _, i, s in found)
        hits += len(set(true) & {i for _, i, _ in found})
    assert hits >= 0.9 * 600


def test_all_cells_and_blocks_are_exact_and_filters_hold(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK", 37)  # so that cells have many blocks
    which, whole = _clusters(600, hot=0.5)
    df = _table(spark, which, whole)
    index = vector_index.build_index(df, str(tmp_path / "index"), cells=5)
    assert index.rows(spark).agg(F.max("block")).first()[0] > 3
    asked = df.where("product_id IN (0, 7, 599)")
    for where, allowed in ((None, None), (F.col("category") == 1, which % 3 == 1)):
        found = vector_index.search(index, asked, k=20, probes=99, where=where).collect()
        for query in (0, 7, 599):
            ours = [r.product_id for r in sorted(found, key=lambda r: r.position) if r.query == query]
            assert ours == _true(whole, query, 20, allowed)[0]


def test_the_looked_at_share_falls_as_the_table_grows(spark, tmp_path):
    shares = []
    for n in (500, 4000):
        which, whole = _clusters(n, centres=n // 10)
        df = _table(spark, which, whole)
        index = vector_index.build_index(df, str(tmp_path / f"index{n}"))
        probes = vector_index.probes_for(index, spark, recall=0.9, n_queries=40)
        shares.append(probes / len(index.centres(spark)))
    assert shares[1] < shares[0] / 1.5


def test_rows_that_have_no_direction_take_no_part(spark, tmp_path):
    nan, inf = math.nan, math.inf
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [1e200, 1e200])]
    df = spark.createDataFrame(rows, "product_id int, embedding array<double>")
    index = vector_index.build_index(df, str(tmp_path / "index"))
    found = vector_index.search(index, df, k=5, probes=9).collect()
    got = {(r.query, r.product_id): round(r.similarity, 9) for r in found}
    half = round(math.sqrt(0.5), 9)
    assert got == {(1, 2): 1, (2, 1): 1, (1, 9): half, (2, 9): half, (9, 1): half, (9, 2): half}
    assert [r.position for r in found if r.query == 1] == [1, 2]
    empty = vector_index.build_index(df.limit(0), str(tmp_path / "empty"))
    assert vector_index.search(empty, df, k=5).count() == 0
    assert shared_dir(spark)


def test_products_are_made_in_bounded_slices():
    for n_rows, width in ((10_000, 65_536), (10_000, 1), (3, 1 << 22), (0, 5)):
        taken = [range(n_rows)[s] for s in vector_index._slices(n_rows, width)]
        assert [i for part in taken for i in part] == list(range(n_rows))
        assert all(len(part) == 1 or len(part) * width <= vector_index.PRODUCTS for part in taken)


def test_search_in_several_slices_finds_all(spark, tmp_path):
    rows = np.random.default_rng(3).normal(size=(1500, 4))
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "product_id int, embedding array<double>")
    index = vector_index.build_index(vectors.coalesce(1), str(tmp_path / "index"), cells=1)
    found = vector_index.search(index, vectors.coalesce(1), k=3, probes=1).collect()
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T
    np.fill_diagonal(near, -2)
    best = np.argsort(-near, 1)[:, :3]
    assert len(found) == 4500
    assert all(best[r.query, r.position - 1] == r.product_id for r in found)
