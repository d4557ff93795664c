"""Spelling variants against counts and comparisons in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.llm import queries, spelling
from basketry.llm.common import table


def _words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def _near(words):
    """Pairs one edit apart, by words with a hole and words with a letter less."""
    holes, found = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
            less = w[:i] + w[i + 1 :]
            if less in words:
                found[w].add(less)
                found[less].add(w)
    for group in holes.values():
        for w in group:
            found[w].update(x for x in group if x != w)
    return found


def _expected(rows):
    words = _words(rows)
    near = _near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 10 * n:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def _found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def _texts():
    draw = random.Random(3)
    stems = ["".join(draw.choices("abcdeéÀÿz", k=draw.randint(6, 11))) for _ in range(60)]
    rows = []
    for i in range(250):
        words = []
        for stem in draw.choices(stems, weights=[1 / (1 + k) ** 2 for k in range(60)], k=60):
            if draw.random() < 0.2:
                at = draw.randrange(len(stem))
                stem = stem[:at] + draw.choice(["", "x", "q" + stem[at], stem[at] * 2]) + stem[at + 1 :]
            words.append(stem.upper() if draw.random() < 0.1 else stem)
        rows.append((i, " ".join(words)))
    return rows + [(900, "hotword " * 30_000 + "hotwords hotwords hotwordss hotwordss")]


def test_variants_equal_plain_comparisons(spark):
    rows = _texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = _expected(rows)
    assert any(r[2] != r[1] is not None for r in expected)  # a chain of forms
    assert _found(spelling.spelling_variants(docs)) == expected


@pytest.mark.parametrize("symbols", [2, 5, 32])
def test_any_alphabet_finds_the_same_pairs(spark, symbols):
    words = _words(_texts())
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [(r.a, r.b) for r in spelling.near_words(df, symbols).collect()]
    near = _near(words)
    assert len(got) == len({frozenset(p) for p in got}) == sum(map(len, near.values())) // 2
    assert all(b in near[a] for a, b in got)


def test_full_neighbourhood_is_covered_from_both_sides(spark):
    # r and every reduced word one edit away share a key of one with the other itself
    letters = "012"
    base = "0121"
    edits = {base[:i] + base[i + 1 :] for i in range(4)}
    edits |= {base[:i] + s + base[i + 1 :] for i in range(4) for s in letters}
    edits |= {base[:i] + s + base[i:] for i in range(5) for s in letters}
    df = spark.createDataFrame([(e,) for e in edits], "r string")
    keys = {r.r: set(r.k) for r in df.select("r", spelling.neighbourhood(F.col("r"), 3).alias("k")).collect()}
    own = keys[base]
    assert all(e in own or base in keys[e] for e in edits)


def test_runs_of_any_kind(spark):
    rows = [
        (None, "Examples examples"), (None, "Examples"), (1, None), (2, ""), (3, "a b c ×÷××××××"),
        (4, "ÀÉÎÕÜÝÞ àéîõüýþ ÀÉÎÕÜÝÞ"), (5, "short longer_than longer_than"), (5, "examplé́ examplé"),
        (6, "longword" * 5000 + " " + "longword" * 5000), (6, "x1234567 letters9letters"),
    ]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, word int")
    assert _found(spelling.spelling_variants(docs)) == _expected(rows)
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_more_words_take_more_symbols():
    assert spelling.symbols_for(0) == 4 < spelling.symbols_for(10**6) < spelling.symbols_for(10**9) <= 32


def test_query_equals_plain_comparisons(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents").collect()
    assert _found(queries.op13_spelling(spark, sf_dir)) == _expected([(r.doc_id, r.text) for r in docs])
