"""Near-duplicates, near vectors and nearest neighbours against brute force."""

import itertools
import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import euclid, forest, neardup
from basketry.llm.graph import components

INF, NAN = math.inf, math.nan


def _roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    links += [(7, 7), (300, 200), (200, 300), (159, 40), (None, 3), (500, None)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components(df).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == _roots({x for p in real for x in p}, real)
    assert components(df.limit(0)).count() == 0


def _set(text, words):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", folded)
    width = min(words, len(found)) or 1
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def _texts():
    """Copies, near copies, documents that share a passage, and odd cases."""
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    some = lambda n: list(random.choice(words, n))
    base, passage = some(120), some(60)
    rows = [(1000 + i, " ".join(base), "hot") for i in range(40)]
    for i in range(40):  # near copies, some of which are linked only through others
        copy = list(base)
        for at in random.choice(120, int(random.integers(1, 9)), replace=False):
            copy[at] = f"e{i}-{at}"
        rows.append((2000 + i, " ".join(copy), "near"))
    rows += [(3000 + i, " ".join(passage + some(60)), "passage") for i in range(40)]
    rows += [(i, " ".join(some(int(random.integers(1, 80)))), "own") for i in range(100, 140)]
    rows += [(i, f"one {i % 3}", "tiny") for i in range(10)]
    rows += [(20, "", "e"), (21, None, "e"), (22, " \t\n", "e"), (23, "Word", None), (24, "wORD", "")]
    rows += [(25, " ".join(words * 50), "very long"), (26, " ".join(words * 50) + " x", "long")]
    rows += [(None, "one 1", "no key"), (2001, None, "again")]
    return rows


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, words, monkeypatch):
    monkeypatch.setattr(neardup, "SKETCH_CELL", (3, 7))  # so that groups have many cells
    monkeypatch.setattr(neardup, "SET_CELL", (2, 5))
    rows = [r for r in _texts() if r[0] is not None][:-1]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string").repartition(5)
    sets = {k: _set(t, words) for k, t, _ in rows}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = _roots(sets, links)
    got = {r.doc_id: r for r in neardup.near_duplicates(df, words).collect()}
    assert len(got) == len(rows)
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert all(r.kept == (k == want[k]) for k, r in got.items())


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "a b c", "x"), (4, "a b c", "y"), (4, "a b c", "y"), (9, "A B c", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(
        (tuple(r) for r in neardup.near_duplicates(df, 2).collect()), key=lambda r: (r[0] or 0, r[3])
    )
    assert got == [(None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False)]
    assert neardup.near_duplicates(df.limit(0), 2).count() == 0
    kept = sorted((r.doc_id or 0, r.component_id) for r in neardup.deduplicate(df, 2).collect())
    assert kept == [(0, "x"), (4, "y")]


def test_rows_of_one_document_link_by_each_text(spark):
    first, second = "one two three four five six", "red blue green grey white black pink"
    rows = [(1, first), (1, second), (2, first + " seven"), (3, second + " gold"), (4, "none of these words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df, 2).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)}
    kept = neardup.deduplicate(df.union(df), 2).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, first), (1, second), (4, rows[4][1])]


def test_few_kept_rows_are_merged_as_many_are(spark):
    df = spark.createDataFrame([(i, f"a b c d e {i % 3}") for i in range(30)], "doc_id long, text string")
    plan = neardup.deduplicate(df, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"LeftSemi.*merge", plan)
    assert "BroadcastHashJoin" not in neardup.deduplicate(df, 2)._jdf.queryExecution().executedPlan().toString()


def test_intermediate_tables_are_deleted(spark):
    from basketry.session import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    df = spark.createDataFrame([(i, f"a b c d {i % 3}") for i in range(30)], "doc_id long, text string")
    assert neardup.near_duplicates(df, 2).count() == 30
    assert len(set(os.listdir(folder)) - before) <= 6


def test_sketches_estimate_how_many_samples_differ():
    random = np.random.default_rng(0)
    least = random.integers(0, 1 << 32, neardup.SAMPLES, np.uint64).astype(np.uint32)
    for changed in (0, 10, 26, 60):
        found = []
        for _ in range(50):
            other = least.copy()
            at = random.choice(neardup.SAMPLES, changed, replace=False)
            other[at] = random.integers(0, 1 << 32, changed, np.uint64)
            both = neardup.odd_sketch(least) ^ neardup.odd_sketch(other)
            found.append(sum(int(x).bit_count() for x in both.view(np.uint64)))
        n = neardup.SKETCH_BITS
        assert abs(np.mean(found) - n / 2 * (1 - (1 - 2 / n) ** (2 * changed))) < 4


def _vectors():
    random = np.random.default_rng(2)
    rows = []
    centre = random.standard_normal(16)
    for i in range(60):
        rows.append((i, (centre + random.standard_normal(16) * 0.08).tolist(), "hot", "x"))
    for i in range(60, 120):
        rows.append((i, random.standard_normal(16).tolist(), "cold", "y"))
    rows += [(200 + i, centre.tolist(), "hot", "copy") for i in range(5)]
    rows += [(300, (centre * 3).tolist(), "hot", "scaled"), (301, centre.tolist(), None, "no label")]
    rows += [(302, None, "hot", "x"), (303, [0.0] * 16, "hot", "x"), (304, [], "hot", "x")]
    rows += [(305, [NAN] + centre.tolist()[1:], "hot", "x"), (306, [INF] * 16, "hot", "x")]
    rows += [(307, [None] + centre.tolist()[1:], "hot", "x"), (308, centre.tolist()[:8], "hot", "x")]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label string, n_links string"


def _usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(euclid, "BLOCK", 7)  # so that a hot bucket has many blocks
    rows = _vectors()
    able = {i: np.array(v) for i, v, label, _ in rows if label and _usable(v)}
    labels = {i: label for i, _, label, _ in rows}
    links = [
        (a, b)
        for a, b in itertools.combinations(able, 2)
        if labels[a] == labels[b] and len(able[a]) == len(able[b])
        and able[a] @ able[b] >= 0.93 * np.linalg.norm(able[a]) * np.linalg.norm(able[b])
    ]
    n = dict.fromkeys(labels, 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    want = _roots(labels, links)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.vec_id: r for r in euclid.near_vectors(df, 0.93).collect()}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {
        i: (n[i], want[i], want[i] == i) for i in labels
    }
    assert euclid.near_vectors(df.limit(0)).count() == 0
    unnamed = spark.createDataFrame([(None, [1.0], "a", "")], SCHEMA)
    assert [tuple(r) for r in euclid.near_vectors(unnamed).collect()] == [(None, 0, None, True)]


def test_buckets_hold_a_falling_share_and_planted_pairs_meet():
    random = np.random.default_rng(4)
    shares = []
    for n in (5000, 20_000, 50_000):
        tables, cells = euclid.shape(n, 0.93)
        whole = random.standard_normal((n, 64))
        whole /= np.linalg.norm(whole, axis=1, keepdims=True)
        names = euclid.cells(whole, tables, cells, euclid.WIDTH)
        met = 0
        for t in range(tables):
            _, counts = np.unique(names[:, t], return_counts=True)
            met += int((counts * (counts - 1) // 2).sum())
        shares.append(met / (n * (n - 1) / 2))
        # vectors at a cosine of 0.93 with some of these
        near = whole[:2000]
        other = random.standard_normal(near.shape)
        other -= (other * near).sum(1, keepdims=True) * near
        other /= np.linalg.norm(other, axis=1, keepdims=True)
        moved = euclid.cells(0.93 * near + math.sqrt(1 - 0.93**2) * other, tables, cells, euclid.WIDTH)
        assert (moved == names[:2000]).any(1).mean() >= 0.998
    assert shares[0] > 1.5 * shares[1] > 2 * shares[2]


def test_nearest_of_few_rows_are_exact(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 9)  # so that leaves have many blocks
    rows = _vectors() + [(None, [1.0] * 16, "a", "x")]
    able = {i: np.array(v) for i, v, *_ in rows if i is not None and _usable(v) and len(v) == 16}
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = forest.nearest(df, F.col("vec_id") % 20 == 0, k=10, recall=1.0)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in able if i % 20 == 0}
    hits = 0
    for query, ranked in got.items():
        ranked.sort()
        assert [r for r, _, _ in ranked] == list(range(1, 11))
        gaps = {i: float(np.sqrt(((v - able[query]) ** 2).sum())) for i, v in able.items() if i != query}
        assert all(s == pytest.approx(gaps[i], rel=1e-12) for _, i, s in ranked)
        assert [(s, i) for _, i, s in ranked] == sorted((s, i) for _, i, s in ranked)
        best = sorted(gaps, key=lambda i: (gaps[i], i))[:10]
        hits += len(set(best) & {i for _, i, _ in ranked})
    assert hits >= 0.95 * 10 * len(got)
    few = df.where("vec_id IN (0, 1, 200, 303)")
    assert forest.nearest(few, F.col("vec_id") == 0, k=10).count() == 2
    assert forest.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_forest_recall_on_the_given_vectors(spark):
    sf_dir = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = {}
    for r in forest.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    table = df.toPandas()
    ids, whole = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), float)
    hits = 0
    for query, found in got.items():
        gaps = np.sqrt(((whole - whole[ids == query]) ** 2).sum(1))
        gaps[ids == query] = np.inf
        hits += len(found & set(ids[np.lexsort((ids, gaps))[:10]]))
    assert hits >= 0.9 * 10 * len(got)
