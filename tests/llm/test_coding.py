"""Token ids, their coded files, and packing."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from basketry.llm import idcoder, idfiles, packing, tokens
from basketry.llm.idcoder import decode_segment, encode_segment
from basketry.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = [
    (3, "Two  spaces and\ta tab, it's  \n\n fine", "x"),
    (1, "", None),
    (2, None, "y"),
    (7, "word " * 3000, "long"),
    (5, "same text here", "a"),
    (6, "same text here", "b"),
    (None, "no key", "c"),
    (9, " lead and trail ", ""),
    (5, "same text here", "a"),
]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n.,'s!é中1aB-_|$ ", max_size=30), max_size=4))
def test_words_give_the_ids_of_whole_texts(encoder, plain, texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [
        plain(t) for t in texts
    ]


def test_words_are_cut_at_line_breaks_too(plain):
    own = Encoder(PATH)
    texts = ["one two.\nThree four.\nThree", "\nThree, four.", "x\n\nThree", "a \nb", "two.\n2.0.\n's ends\n"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [plain(t) for t in texts]
    assert {"two.", "\nThree", "four.", "\n2.0."} <= set(own.words)
    assert "two.\nThree" not in own.words


def test_words_beyond_the_cache_are_never_put_into_it(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 2)
    own, put = Encoder(PATH), []
    monkeypatch.setattr(
        type(own.words), "__setitem__", lambda d, k, v: (put.append(k), dict.__setitem__(d, k, v))
    )
    texts = ["x one two three. three", "x four. four four \nfive \nfive,"]
    for text in texts * 2:
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([text])] == [plain(text)]
    assert put == list(own.words) == ["one", "two"]


def test_mixing_is_the_weighted_mean():
    draw = np.random.default_rng(4)
    q = draw.integers(0, 32768, (3, 5000)).astype(np.int32)
    w = draw.integers(256, (1 << 13) - 255, (2, 5000)).astype(np.int32)
    whole = (q[:2] * w).sum(0) + q[2] * ((1 << 14) - w.sum(0))
    assert (idcoder._mixed(*q.copy(), *w) == whole >> 14).all()


def test_coded_bytes_stay_as_they_are():
    step = np.arange(5000, dtype=np.uint64)
    ids = (step**2 % 997 % (step // 40 + 1)).astype("<u4")
    found = [zlib.crc32(encode_segment(x)) for x in (ids, ids * np.uint32(70001))]
    assert found == [1145016369, 2259624325]


@settings(max_examples=40, deadline=None)
@given(
    st.integers(0, 3000), st.sampled_from([2, 300, 60_000, 2**32 - 1]), st.integers(0, 99),
    st.sampled_from([1, 7, 1024]),
)
def test_coder_round_trip(n, high, seed, block):
    ids = np.random.default_rng(seed).integers(0, high, n, dtype=np.uint64).astype("<u4")
    ids = np.repeat(ids, 1 + seed % 3)[:n]
    n_blocks = -(-n // block) if n else 0
    if n_blocks <= 4000:
        assert (decode_segment(encode_segment(ids, block)) == ids).all()


def test_coder_learns_and_detects_damage():
    words = np.random.default_rng(1).integers(0, 50_000, 40)
    ids = np.tile(words, 500).astype("<u4")
    coded = encode_segment(ids)
    assert len(coded) < len(ids)  # far less than the two bytes an id would need
    damaged = bytearray(coded)
    damaged[len(coded) // 2] ^= 255
    with pytest.raises(ValueError, match="checksum"):
        decode_segment(bytes(damaged))


def _docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string, ids string")
    return df.withColumnRenamed("ids", "start")  # a column that clashes with the result's


def test_files_hold_every_document_in_order(spark, tmp_path, plain):
    path = str(tmp_path / "ids")
    idfiles.write_ids(_docs(spark).repartition(3), path, PATH, end_id=2, segment_ids=2000)
    rows = idfiles.read_ids(spark, path).orderBy("start").collect()
    assert len(rows) == len(DOCS)
    keys = [r.doc_id for r in rows]
    assert keys == [None, 1, 2, 3, 5, 5, 6, 7, 9]
    at = 0
    texts = {k: t or "" for k, t, _ in DOCS}
    for row in rows:
        assert row.start == at and row.n_tokens == len(row.ids) // 4
        assert np.frombuffer(row.ids, "<u4").tolist() == [*plain(texts[row.doc_id]), 2]
        at += row.n_tokens


def test_files_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "ids")
    idfiles.write_ids(_docs(spark).limit(0), path, PATH, end_id=2)
    assert idfiles.read_ids(spark, path).count() == 0


def _check_pieces(pieces, ids_of, size):
    """Every id once, sequences without gaps, and short ones only at powers of two."""
    documents, sequences = {}, {}
    for p in pieces:
        documents.setdefault(p[0], []).append(p)
        sequences.setdefault(p[5], []).append(p)
    for key, own in documents.items():
        own.sort(key=lambda p: p[1])
        at = 0
        for _, start, length, crc, total, _, _ in own:
            assert start == at and length > 0 and total == len(ids_of[key])
            assert crc == zlib.crc32(ids_of[key][start : start + length].tobytes())
            at += length
        assert at == len(ids_of[key])
    for own in sequences.values():
        own.sort(key=lambda p: p[6])
        ends = np.cumsum([p[2] for p in own])
        assert [p[6] for p in own] == [0, *ends[:-1]]
        assert ends[-1] == size or (ends[-1] < size and ends[-1] & (ends[-1] - 1) == 0)
    return sequences


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60), st.integers(1, 8))
def test_packer_places_every_id(lengths, most_open):
    ids = {k: np.arange(n, dtype="<u4") + k for k, n in enumerate(lengths)}
    packer = packing.Packer(16, most_open=most_open)
    for key, values in ids.items():
        packer.add(key, values.tobytes())
        assert packer.n_open <= most_open
    packer.flush()
    _check_pieces([p[:7] for p in packer.done], ids, 16)


def test_level_is_the_one_with_the_least_squares():
    """Against trying every level."""
    random = np.random.default_rng(3)
    for _ in range(200):
        packer = packing.Packer(32)
        packer.counts[1:32] = random.integers(0, 4, 31)
        need = int(random.integers(1, 32))

        def squares(level):
            counts = packer.counts.copy()
            counts[level] -= level > 0
            if level + need < 32:
                counts[level + need] += 1
            counts[0] = counts[32] = 0
            return int((counts**2).sum())

        able = [0] + [h for h in range(1, 33 - need) if packer.counts[h]]
        assert squares(packer.level(need)) == min(map(squares, able))


def test_pack_documents(spark, plain):
    docs = _docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    pieces = [tuple(r) for r in packing.pack(docs, PATH, end_id=0, size=64).collect()]
    ids = {k: np.array([*plain(t or ""), 0], "<u4") for k, t, _ in DOCS if k is not None}
    sequences = _check_pieces(pieces, ids, 64)
    assert len(sequences) >= sum(map(len, ids.values())) // 64
    assert packing.pack(docs.limit(0), PATH).count() == 0
    everything = packing.pack(_docs(spark), PATH, size=64)
    assert sum(r.length for r in everything.collect()) == sum(
        len(plain(t or "")) + 1 for _, t, _ in DOCS
    )


def test_open_windows_of_many_partitions_are_gone_on_with(spark, plain, monkeypatch):
    random = np.random.default_rng(2)
    texts = [" ".join(["word"] * int(n)) for n in random.integers(1, 200, 6000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(100)
    ids = {k: np.array([*plain(t), 0], "<u4") for k, t in enumerate(texts)}
    monkeypatch.setattr(packing, "PARTS_A_TASK", 20)  # so that there are two rounds
    pieces = [tuple(r) for r in packing.pack(docs, PATH, end_id=0, size=64).collect()]
    sequences = _check_pieces(pieces, ids, 64)
    assert len(sequences) <= sum(map(len, ids.values())) // 64 + 7
    # of what is left of the documents after their full windows, little is cut (if each
    # partition closed its windows itself: nearly all)
    rests = {k: len(v) % 64 for k, v in ids.items() if len(v) % 64}
    kept = {p[0] for p in pieces if p[2] == rests.get(p[0]) and p[1] == len(ids[p[0]]) - p[2]}
    assert sum(n for k, n in rests.items() if k not in kept) < 0.16 * sum(rests.values())
