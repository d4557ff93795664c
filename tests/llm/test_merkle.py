"""The Merkle manifest against a tree built row by row."""

import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from basketry.llm import merkle, queries
from basketry.llm.common import table

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, path int, node int"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(doc_id, source, lang, n_chars, text):
    fields = (doc_id, source, lang, n_chars, text)
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def _lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _tree(nodes):
    """Per node its path of (left, right), and the root."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for number, i in enumerate(at):
            begin = i - i % 16
            paths[number].append(("".join(nodes[begin:i]), "".join(nodes[i + 1 : begin + 16])))
        nodes = [_h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return paths, nodes[0]


def _expected(rows):
    """A list of result rows, built without Spark."""
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    leaves = [(r[1], r[0], _leaf(*r[:5]), r) for r in rows]
    leaves.sort(key=lambda x: (first(x[0]), first(x[1]), x[2]))
    trees = []
    for source, group in groupby(leaves, key=lambda x: x[0]):
        group = list(group)
        trees.append((group, *_tree([x[2] for x in group])))
    above, root = _tree([t[2] for t in trees])
    out = []
    for (group, paths, subroot), over in zip(trees, above):
        for (_, doc_id, leaf, row), path in zip(group, paths):
            whole = path + over
            now, tampered = leaf, False
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                now, tampered = _leaf(*row[:4], _lower(row[4])), True
            for left, right in whole:
                now = _h(left, now, right)
            proof = _h(*(a + b for a, b in whole))
            assert tampered or now == root
            out.append((doc_id, leaf, subroot, root, proof, now, now == root))
    return out


def _found(docs):
    got = merkle.verify(merkle.manifest(docs))
    return [
        (r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
        for r in got.collect()
    ]


def _same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_trees_of_all_shapes(spark):
    # sizes around the arity, the block and more than a block of blocks would need
    rows = []
    for source, n in (("one", 1), ("é", 2), ("full", 16), ("more", 17), ("b", 256), ("b1", 257), ("hot", 4400)):
        rows += [(len(rows) + i, source, "en", i, f"Text {i} É", 1, 2) for i in range(n)]
    _same(_found(spark.createDataFrame(rows, SCHEMA).repartition(7)), _expected(rows))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (5, None, None, None, None, 0, 0), (5, None, None, None, None, 0, 0),
        (5, None, "-", None, "-", 0, 0), (5, "", "", 0, "", 0, 0), (None, "", "en", 1, "Abc", 0, 0),
        (None, None, "en", 1, "Abc", 0, 0), (-7, "s", "en", -1, "x" * 100_000 + "Y", 0, 0),
        *((i, "s", "en", 3, "ABC", 0, 0) for i in range(40)),
    ]
    _same(_found(spark.createDataFrame(rows, SCHEMA)), _expected(rows))


def test_one_row_and_none(spark):
    rows = [(3, "s", "en", 1, "a", 0, 0)]
    [only] = _found(spark.createDataFrame(rows, SCHEMA))
    assert only[1] == only[2] == only[3] and only[4] == _h()
    assert _found(spark.createDataFrame([], SCHEMA)) == []


def test_many_sources(spark):
    rows = [(i, f"s{i}", "en", 1, "T", 0, 0) for i in range(600)]
    _same(_found(spark.createDataFrame(rows, SCHEMA)), _expected(rows))


def test_changed_texts_and_only_those_fail(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = queries.op12_merkle(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == docs.count() and len({r.root for r in got}) == 1
    changed = {
        r.doc_id
        for r in docs.collect()
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and _lower(r.text) != r.text
    }
    assert changed and {r.doc_id for r in got if not r.verified} == changed


@pytest.mark.parametrize("text,lowered", [("AZ É az", "az É az"), (None, None), ("", "")])
def test_tampering_lowers_ascii_alone(spark, text, lowered):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(merkle.tampered_text(F.col("text"))).first()[0] == lowered
