"""Encoding into pieces and decoding, against the sentencepiece library."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest

from basketry.llm import pieces, queries
from basketry.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    return pieces.PieceCodec(MODEL)


def _odd_texts():
    draw = random.Random(1)
    letters = "ab \t\n▁  <s></s>éÉ😀͸\0漢字0123.,-'\"=&<0x41>"
    made = ["".join(draw.choices(letters, k=draw.randint(0, 200))) for _ in range(1500)]
    return [*made, "", " ", "x" * 5000, " " * 3000, "ab" * 3000, "aaaa", "a" * 41, "<s> ▁▁ </s>"]


def test_ids_and_texts_equal_the_library(own):
    texts = _odd_texts()
    theirs = own.library.encode(texts, num_threads=1)
    for text, ids, found in zip(texts, theirs, own.encode(texts)):
        ours = array("I", found).tolist()
        assert ours == ids
        assert own.decode(ours) == own.library.decode(ids) == text.replace("▁", " ")


def test_equal_scores_go_leftmost_first(own):
    # every run of spaces has the same score
    for n in range(1, 60):
        [found] = own.encode([" " * n])
        assert array("I", found).tolist() == own.library.encode(" " * n)


def test_cutting_at_impossible_neighbours_changes_nothing(own):
    texts = [own.library.normalize(t) for t in _odd_texts()[:300] if t]
    for text, parts in zip(texts, own._parts(texts)):
        assert "".join(parts) == text
        assert b"".join(own._part(p) for p in parts) == own._part(text)


def test_words_are_kept_whole(monkeypatch):
    own = pieces.PieceCodec(MODEL)
    texts = ["one two.\nThree two.", "\nThree  two", "two.\n\n2.0 ", "▁two. \nThree", "", "one"]
    for _ in range(2):  # unknown and known words
        for text, found in zip(texts, own.encode(texts)):
            assert array("I", found).tolist() == own.library.encode(text)
    assert set(own.words) >= {"two.", "\nThree", "\n", "\n2.0", ""}
    assert not any(" " in w or "▁" in w for w in own.words)
    monkeypatch.setattr(pieces, "CACHE_WORDS", len(own.words))
    own.encode(["another word"])
    assert "another" not in own.words


def test_agendas_side_by_side_equal_single_ones(own):
    parts = sorted({p for x in own._parts([t for t in _odd_texts() if t]) for p in x if len(p) <= 32}, key=len)
    for part, ids in zip(parts, own._side_by_side(parts)):
        assert ids is None or ids == own._part(part)
    assert own._side_by_side(["unused"]) == [own._part("unused")]


def test_bytes_that_are_no_character_are_replaced_one_by_one(own):
    for values in ([0xE2, 0x82], [0xFF, 0x41], [0xC3, 0xA9, 0xA9]):
        ids = [own.bytes[b] for b in values]
        assert own.decode(ids) == own.library.decode(ids)
    assert own.decode([]) == ""


def test_rows_of_any_kind(spark):
    rows = [(1, "Two words", 5), (1, "Two words", 5), (2, None, 5), (3, "", 5), (None, "x", 5),
            (4, "long " * 20_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = pieces.recode(docs, MODEL).collect()
    assert len(got) == len(rows) and all(r.same_as_library for r in got)
    by_text = {(r.doc_id, r.decoded): r.ids for r in got}
    assert by_text[(2, "")] == by_text[(3, "")] == [2]
    assert by_text[(None, "x")][-1] == 2 and len(by_text[(4, "long " * 20_000)]) > 20_000
    unchecked = pieces.recode(docs, MODEL, end=False, check=False).where("doc_id = 2").first()
    assert unchecked.ids == [] and unchecked.same_as_library is None
    assert pieces.recode(docs.limit(0), MODEL).count() == 0


def test_query_returns_digests(spark, own):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op11_sentencepiece(spark, sf_dir).collect()}
    docs = table(spark, sf_dir, "documents").collect()
    assert len(got) == len(docs)
    for doc in docs[:40]:
        ids = own.library.encode(doc.text or "", add_eos=True)
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids) and row.same_as_library
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = own.library.decode(ids)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
