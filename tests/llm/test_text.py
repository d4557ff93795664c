"""Pages, toxicity, quality, licences and mixing."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import licences, mixing, pages, quality, toxicity

SF_DIR = "/root/testdata/sf0.01"


# --- pages ---------------------------------------------------------------------------
ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<script>var t="</p><article>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href=a>One</a></li><li><a>Two</a></ul></nav>
<!-- ad <p>no</p> --><div class="ad">A longer line that somebody has paid for, to be read.</div>
<div class="cookie-notice">We keep cookies.</div>
<article><h1>Head &amp; line</h1><p><b>First   para<i>graph</i>
of text.<br><p>Second &lt;one&gt;, <a href=x>linked</a>.</p><aside><p>Beside the point, at length.</p></aside>
<form><label>Your name</label><input><select><option>x</select></form><p>Sh is.</p>
<ul><li>an item<li>another</ul><section id="comments"><p>What a fine article, thank you.</p></section>
</article><div id=sidebar>More of it</div><footer>&copy; all of us</footer></body></html>"""


def test_main_text_of_a_page_with_everything():
    text = pages.main_text(ARTICLE, pages.train())
    assert text == (
        "Head & line First paragraph of text. Second <one>, linked. Sh is. an item another"
    )


def test_training_table_is_learned():
    tree, rows = pages.train(), pages.labelled_table()
    assert all(pages.classify(tree, r[:-1]) == r[-1] for r in rows)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<p", ""), ("<article>", ""), ("<script>x", ""),
        ("<article><p>cut o", "cut o"),
        ("<article><p>a &am", "a &am"),
        ("<ARTICLE><P>Loud</P></ARTICLE>", "Loud"),
        ("<article><p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<nav><a>x</a></nav>", ""),
        ("<article>" + "<p>a b</p>" * 20_000, " ".join(["a b"] * 20_000)),
    ],
)
def test_broken_and_odd_pages(page, text):
    assert pages.main_text(page, pages.train()) == text


_LONG = " ".join(f"word{i}" for i in range(70))
_MAIN = f"<p>{_LONG}</p>" * 4


@pytest.mark.parametrize(
    "page, words",
    [
        # a teaser as article, before or behind, marked or in a side bar
        (f"<div>{_MAIN}</div><article><h3><a href=x>More</a></h3><p>A short teaser.</p></article>", 280),
        (f"<article><p>A short teaser.</p></article><div>{_MAIN}</div>", 280),
        (f"<div>{_MAIN}</div><aside><article><p>{_LONG}</p></article></aside>", 280),
        (f"<div>{_MAIN}</div><div class=related><article><p>{_LONG}</p></article></div>", 280),
        # a large block outside the article
        (f"<article>{_MAIN}</article><div>{_LONG} {_LONG}</div><div>Short.</div>", 420),
        # a wrapper with a marked name; what is marked within it stays out
        (f"<div class='page has-sidebar sidebar'><article>{_MAIN}</article></div>", 280),
        (f"<div class=widget><h1>Head</h1>{_MAIN}<div class=comments><p>{_LONG}</p></div></div>", 281),
        (f"<div class=social>{_MAIN}</div>", 280),
        # long comments beside a short article
        (f"<article><p>Short news.</p></article><div class=comments>{_MAIN}</div>", 2),
        (f"<div hidden class=modal><h1>x</h1>{_MAIN}</div>", 0),
    ],
)
def test_main_text_wherever_it_lies(page, words):
    assert len(pages.main_text(page, pages.train()).split()) == words


def test_extract_keeps_columns_and_rows(spark):
    rows = [(1, "u", ARTICLE, "clash"), (2, None, None, None), (2, None, None, None), (None, "x", "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = pages.extract(df).collect()
    assert len(got) == 4 and [r.n_chars for r in got] == [len(r.text) for r in got]
    assert pages.extract(df.limit(0)).count() == 0


def test_given_pages_give_their_articles(spark):
    df = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    import html

    for r in pages.extract(df).select("html", "text").collect():
        inner = re.search(r"(?s)<article>(.*?)(</article>|$)", r.html)[1]
        inner = re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(inner).split())


# --- toxicity ------------------------------------------------------------------------
def _labelled(spark):
    random = np.random.default_rng(1)
    words = [f"calm{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        own = list(random.choice(words, int(random.integers(5, 60))))
        toxic = i % 4 == 0
        if toxic:
            for at in random.choice(len(own), int(random.integers(1, 4)), replace=False):
                own[at] = ("nasty", "vilex", "grumbl")[at % 3] + str(at)
        docs.append((i, " ".join(own), "clash"))
        labels.append((i, int(toxic)))
    docs += [(9001, "", "x"), (9002, None, "x"), (None, "nasty1 words", None), (5, docs[5][1], "again")]
    labels += [(None, 1), (9001, None), (77_777, 1), (0, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, features string").repartition(3),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_toxicity_on_held_out_documents(spark):
    docs, labels = _labelled(spark)
    model = toxicity.fit(docs, labels)
    assert {w[:4] for w in model.lexicon} >= {"nast", "vile", "grum"}
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 604 and rows[0].features is not None
    assert all(0 <= r.toxic_score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(r.toxic_score >= 0.5) == (r.doc_id % 4 == 0) for r in held if r.doc_id < 600]
    assert np.mean(right) >= 0.95
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_held_out_labels_are_not_looked_at(spark):
    docs, labels = _labelled(spark)
    held = (F.crc32(F.col("doc_id").cast("string")) % 5) == 0
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.lexicon == b.lexicon


def test_toxicity_without_both_classes(spark):
    docs, labels = _labelled(spark)
    for some, constant in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0)):
        model = toxicity.fit(docs, some)
        assert {r.toxic_score for r in toxicity.score(docs, model).collect()} == {constant}


def test_capped_samples_keep_the_meaning_of_a_score(spark, monkeypatch):
    """A third of the documents with a lexicon word are toxic, at any caps."""
    docs = [
        (i, " ".join(f"calm{(i * k) % 97}" for k in range(1, 12)) + (" nasty" if i % 8 == 0 else ""))
        for i in range(4000)
    ]
    labels = [(i, int(i % 24 == 0)) for i in range(4000)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "TOXIC_ROWS", 120)
    monkeypatch.setattr(toxicity, "OTHER_ROWS", 240)
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).where("doc_id % 8 = 0")
    mean, above = scored.agg(F.avg("toxic_score"), F.avg((F.col("toxic_score") >= 0.5).cast("int"))).first()
    assert 0.2 <= mean <= 0.47 and above <= 0.1


@pytest.mark.parametrize("times", [1, 1000])
def test_features_of_a_text_whatever_its_length(times):
    text = "You ROTTEN fool, γειά ΣΟΥ é É! b4dword w-o-r-d soooo "
    lexicon = {"rott": 2.0, "badw": 1.0}
    got = toxicity.features(text * times, lexicon, frozenset({"rott", "badw"}))
    names = ("log_words", "hits", "per_1000", "most", "sum", "dense", "near", "second", "capitals", "marks",
             "shouts", "mixed", "stretched", "spaced", "hidden")
    f = dict(zip(names, got, strict=True))
    words, chars = 10 * times, len(text) * times
    assert f["log_words"] == pytest.approx(math.log1p(words))
    assert (f["hits"], f["most"], f["sum"]) == (times, 2.0, 2.0 * times)
    assert f["capitals"] == 11 / len(text) and f["second"] == pytest.approx(1000 * 1 / 10)
    assert f["marks"] == 2 / len(text) and f["shouts"] == 1 / len(text)
    assert f["near"] == times and f["hidden"] == times  # b4dword reads badword
    assert f["stretched"] == pytest.approx(1000 * times / chars)
    assert f["spaced"] == pytest.approx(1000 * times / chars)
    assert f["mixed"] == pytest.approx(1000 * times / words)


def test_features_of_an_empty_text():
    assert toxicity.features("", {"rott": 1.0}, frozenset({"rott"})) == [0.0] * 15


def test_ngrams_are_counted_with_repeats():
    one, two = quality.slots("abc"), quality.slots("abc xyz abc")
    # triples of letter classes, words, pairs of words
    assert len(one) == 1 + 1 + 0 and len(two) == 9 + 3 + 2
    counts = np.bincount(two)
    assert sorted(counts[counts > 0]) == [1, 1, 1, 2, 2, 2, 3] or counts.sum() == 14
    assert len(quality.slots("")) == 0
    assert set(quality.slots("Abc 12")) & set(quality.slots("Xyz 98"))  # classes, not letters


# --- quality -------------------------------------------------------------------------
def test_quality_keeps_good_and_rejects_junk(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = quality.select(docs, labels).join(labels, "doc_id").select("quality", "selected").toPandas()
    assert got.groupby("quality").selected.mean()[1] == 1.0
    assert got.groupby("quality").selected.mean()[0] <= 0.1


def test_quality_writes_no_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    written, write = [], quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df: written.extend(df.columns) or write(df))
    assert quality.select(docs, labels).count() == 6
    assert "quality_key" in written and "text" not in written


def test_quality_draws_the_k_largest_keys(spark):
    docs = spark.createDataFrame(
        [(1, "plain words here", "a"), (2, "junk ### ###", "b"), (3, None, "c"), (None, "", None),
         (1, "plain words here", "a")],
        "doc_id long, text string, selected string",
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = quality.select(docs, labels).collect()
    k = sum(r.log_importance >= 0 for r in rows)
    least = sorted((r.quality_key for r in rows), reverse=True)[k - 1]
    assert all(r.selected == (r.quality_key >= least) for r in rows)
    same = [r for r in rows if r.doc_id == 1]
    assert len(rows) == 5 and same[0] == same[1]
    again = quality.select(docs, labels).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert all(r.selected for r in quality.select(docs, labels.limit(0)).collect())
    assert quality.select(docs.limit(0), labels).count() == 0


# --- licences ------------------------------------------------------------------------
def test_licences_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    marks = {
        "apache": "Apache License", "creative-commons": "CC BY", "gpl": "GNU General Public",
        "mit": "MIT License", "all-rights-reserved": "All rights reserved",
    }
    want = {
        (r.doc_id, n, family)
        for r in docs.select("doc_id", "text").collect()
        for n, line in enumerate((r.text or "").split("\n"))
        for family, mark in marks.items()
        if mark in line
    }
    got = {(r.doc_id, r.paragraph, r.family) for r in licences.scan(docs, licences.fit(docs)).collect()}
    assert want and got == want


def test_licence_classes(spark):
    docs = spark.createDataFrame(
        [
            (1, "Nothing here.\nThis program is released under the MIT License. See below.", "x"),
            (2, "We license our songs under no terms of the general public.", "y"),
            (3, None, "z"), (4, "", None), (None, "All rights reserved.", "n"),
            (5, "x " * 50_000 + "\nLicensed under the Apache License, Version 2.0.", "long"),
        ],
        "doc_id long, text string, family string",
    )
    model = licences.fit(docs)
    got = sorted((r.doc_id or 0, r.paragraph, r.family) for r in licences.scan(docs, model).collect())
    assert got == [(0, 0, "all-rights-reserved"), (1, 1, "mit"), (5, 1, "apache")]
    assert licences.scan(docs.limit(0), licences.fit(docs.limit(0))).count() == 0

    wordings = {
        "SPDX-License-Identifier: GPL-2.0-only": "gpl",
        "// SPDX-License-Identifier: MIT": "mit",
        "The MIT License (MIT)": "mit",
        "This is free and unencumbered software released into the public domain.": "public-domain",
        "Distributed under the Boost Software License, Version 1.0.": "boost",
        "It may be used under the terms of the GNU Affero General Public License.": "agpl",
        "It may be used under the terms of the GNU General Public License.": "gpl",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted": "isc",
    }
    lines = spark.createDataFrame([(i, w) for i, w in enumerate(wordings)], "doc_id long, text string")
    found = {r.doc_id: r.family for r in licences.scan(lines, model).collect()}
    assert found == dict(enumerate(wordings.values()))


# --- mixing --------------------------------------------------------------------------
def _targets(words, weights, share, most):
    """Targets by stopping sources round by round."""
    order = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = min(share * sum(words.values()), most * sum(words.values())), {}
    while len(stopped) < len(words):
        open_ = [s for s in order if s not in stopped]
        left, all_ = total - sum(stopped.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / all_ > most * words[s]]
        if not over:
            return stopped | {s: left * weight[s] / all_ for s in open_}
        stopped |= {s: float(most * words[s]) for s in over}
    return stopped


def _sources(spark):
    random = np.random.default_rng(4)
    rows, key = [], 0
    for source, n in (("a", 2000), ("b", 150), ("é", 90), (None, 200), ("Z", 1), ("empty", 3)):
        for _ in range(n):
            size = 0 if source == "empty" else int(random.integers(1, 60))
            rows.append((key, "w " * size, source, "clash"))
            key += 1
    rows += [(None, "no key", "a", "x"), (key, None, "b", "x"), rows[0], rows[0]]
    return rows, spark.createDataFrame(
        rows, "doc_id long, text string, source string, mix_size string"
    ).repartition(4)


def test_mix_meets_its_targets(spark):
    rows, docs = _sources(spark)
    planned = mixing.plan_mix(docs, shard_words=8000)
    got = planned.collect()
    assert len(got) == len(rows)
    words = {}
    for _, text, source, _ in rows:
        words[source] = words.get(source, 0) + len((text or "").split())
    want = _targets(words, (5, 2, 1), 1.5, 2)
    taken = dict.fromkeys(words, 0)
    for r in got:
        assert r.mix_source_size == words[r.source]
        assert r.mix_target == pytest.approx(want[r.source])
        assert r.mix_size == len((r.text or "").split()) and len(r.mix_shards) <= 2
        taken[r.source] += r.mix_size * len(r.mix_shards)
    for source, target in want.items():
        if source != "Z":  # one document, taken whole or not
            assert target - 60 <= taken[source] <= target + 1e-6
    again = {(r.doc_id, r.text): r.mix_shards for r in mixing.plan_mix(docs, shard_words=8000).collect()}
    assert all(again[r.doc_id, r.text] == r.mix_shards for r in got)
    mixed = mixing.mix(docs, shard_words=8000)
    assert mixed.columns == [*docs.columns, "mix_shard", "mix_order"]
    assert mixed.count() == sum(len(r.mix_shards) for r in got)
    assert mixing.plan_mix(docs.limit(0)).count() == 0


def test_mix_fills_a_target_beside_a_very_long_document(spark):
    """What the long document's block leaves goes to the blocks behind it."""
    rows = [(i, "w " * (4 + i % 3), "a") for i in range(1500)] + [(9000, "w " * 20_000, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.plan_mix(docs, share=0.26, shard_words=1000).collect()
    took = sum(r.mix_size * len(r.mix_shards) for r in got)
    target = got[0].mix_target
    assert len(got) == 1501 and 7000 < target and target - 4 < took <= target
    assert {x for r in got for x in r.mix_shards} <= set(range(8))


def test_tree_splits_all_quotas_evenly(spark):
    draws = {"a": 4000, "b": 300, "c": 1, "d": 0}
    df = spark.createDataFrame(list(draws.items()), "source_key string, draws long")
    ends = {r.source_key: r.ends for r in mixing.shard_quotas(df, 3).collect()}
    each = {s: np.diff([0, *e]) for s, e in ends.items()}
    assert {s: e[-1] for s, e in ends.items()} == draws
    assert all((x >= 0).all() for x in each.values())
    totals = sum(each.values())
    assert totals.max() - totals.min() <= 3  # a block may go either way at each level
    assert abs(each["a"] - 500).max() < 60 and abs(each["b"] - 37.5).max() < 25


def test_hypergeometric_draws_have_their_distribution(spark):
    """Frequencies over evenly spaced numbers equal the exact probabilities."""
    from math import comb

    good, bad, n = 7, 12, 8
    us = spark.range(2000).select(((F.col("id") + 0.5) / 2000).alias("u"))
    lit = lambda x: F.lit(float(x))
    found = us.select(mixing._hypergeometric(F.col("u"), lit(good), lit(bad), lit(n)).alias("x"))
    counts = {r.x: r["count"] / 2000 for r in found.groupBy("x").count().collect()}
    for x in range(0, 8):
        exact = comb(good, x) * comb(bad, n - x) / comb(good + bad, n) if n - x <= bad else 0
        assert counts.get(x, 0) == pytest.approx(exact, abs=0.001)
