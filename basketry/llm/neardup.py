"""Near-duplicate documents by MinHash bands, odd sketches and an exact check.

1. Each text becomes its set of word shingles, as 64-bit hashes, and 256 MinHash
   samples of it. The samples are folded into an odd sketch: a bitmap in which
   each sample flips one bit, so that the population count of two sketches' XOR
   estimates how many samples differ.
2. Documents with equal sets become one class. From here on, rows are classes.
3. Classes that agree in all four samples of one of 32 bands share a bucket.
4. Each class is compared with one central class, which shares most buckets with
   others: the one of its buckets' central classes whose sketch is closest. Links
   confirmed on the full sets give components. This joins most of a family of
   copies with one comparison a class.
5. Buckets that still hold several components may hide links. Those with the same
   largest component make a group; every member outside that component meets all
   members of the group, first by sketches alone, then, where these are close,
   by full sets. Groups are cut into cells: a bounded block of the members
   outside, held in memory, against a bounded block of all members. A cell gives
   back only links that join components, never all pairs.

Nothing is dropped: a linked pair is missed only if it shares no band (5e-8 at a
similarity of 0.8) or if its sketches differ by more than ``MOST_BITS`` (over 5
deviations at 0.8, about 2e-7), and then only if no other links join the two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.common import SEED, Tables, group_bounds, python_tasks, texts_of, whole_groups
from basketry.llm.graph import components

BANDS, ROWS = 32, 4
SAMPLES = 256  # the first 128 make the bands
SKETCH_BITS, WORDS = 512, 8
#: XOR population count up to which a pair is checked on its full sets. At a
#: similarity of 0.8 about 84 of 512 bits differ, give or take 11.
MOST_BITS = 140
#: Rows that a cell holds and that pass it by, on average: for sketches, for sets.
#: Cells of sets are also bounded by their shingles.
SKETCH_CELL, SET_CELL = (512, 2048), (64, 256)
HELD_SHINGLES, PASSING_SHINGLES = 200_000, 800_000

_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     "
)
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(1 << (n - 1).bit_length(), base, _U)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(text: str, fold: bytes = _FOLD) -> np.ndarray:
    """64-bit hashes of the text's words in order.

    By default A-Z are lower-cased and words are runs of bytes other than space
    and tab to carriage return; ``fold`` is the table of bytes that does so.
    """
    folded = text.encode("utf-8", "surrogatepass").translate(fold)
    data = np.frombuffer(b" " + folded + b" ", np.uint8)
    edge = np.diff((data != 32).view(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:-1], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def shingles(text: str, words: int = 2) -> np.ndarray:
    """The text's distinct shingles as sorted 64-bit hashes.

    A text of fewer words is one shingle; without words there is none.
    """
    one = word_hashes(text)
    if not len(one):
        return one
    width = min(words, len(one))
    whole = one[: len(one) - width + 1].copy()
    for i in range(1, width):
        whole = _mix(whole * _U(0xD6E8FEB86659FD93) + one[i : len(one) - width + 1 + i])
    return np.unique(whole)


_RANDOM = np.random.default_rng(SEED)
_A = _RANDOM.integers(0, 1 << 32, (SAMPLES, 1), np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RANDOM.integers(0, 1 << 32, (SAMPLES, 1), np.uint64).astype(np.uint32) | np.uint32(1)


def samples(hashes: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that is not empty."""
    low, high = hashes.astype(np.uint32), (hashes >> _U(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 2048):
        part = low[i : i + 2048] * _A + high[i : i + 2048] * _B
        np.minimum(least, part.min(1), out=least)
    return least


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The samples' parity bitmap as signed 64-bit integers."""
    number = np.arange(SAMPLES, dtype=_U) << _U(32)
    bit = _mix(number + least.astype(_U) + _U(SEED)) % _U(SKETCH_BITS)
    parity = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view("<i8")  # WORDS of them


def bands(least: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band's samples and its number."""
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS).astype(_U)
    found = np.arange(BANDS, dtype=_U) + _U(SEED)
    for i in range(ROWS):
        found = _mix(found * _U(0xD6E8FEB86659FD93) + rows[:, i])
    return found.view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, set_key, sketch and bands (null if empty).

    ``text_key`` is a hash of the text, which tells rows of one doc_id apart.
    """

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known: dict[str, tuple] = {}
            for text in frame["text"]:
                if text not in known:
                    found = shingles(text, words)
                    known[text] = (0, None, None, None)
                    if len(found):
                        least = samples(found)
                        key = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                        known[text] = (len(found), key, odd_sketch(least), bands(least))
            rows = [known[text] for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "text_key": frame["text_key"],
                    "n_shingles": [r[0] for r in rows],
                    "set_key": [r[1] for r in rows],
                    "sketch": [r[2] for r in rows],
                    "bands": [r[3] for r in rows],
                }
            )

    return keyed_texts(docs).mapInPandas(
        sign,
        "doc_id long, text_key long, n_shingles long, set_key binary, sketch array<bigint>, "
        "bands array<bigint>",
    )


def keyed_texts(docs: DataFrame) -> DataFrame:
    return texts_of(docs).withColumn("text_key", F.xxhash64("text"))


_SKETCH = ["n", *(f"s{i}" for i in range(WORDS))]


def _close(a: str, b: str, threshold: int) -> Column:
    """Whether two rows' sketches and set sizes allow a link."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    return (100 * F.least(n, m) >= threshold * F.greatest(n, m)) & (_bits(a, b) <= MOST_BITS)


def _bits(a: str, b: str) -> Column:
    return reduce(
        Column.__add__,
        [F.bit_count(F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}"))) for i in range(WORDS)],
    )


def _cells(rows: DataFrame, size: tuple[int, int], shingles_too: bool) -> DataFrame:
    """Rows (g, node, held, n, ...) dealt to the cells (g, i, j) of their group.

    A group's held rows are cut into blocks i, the others into blocks j, and each
    goes to all cells of its block. Average sizes of blocks are bounded.
    """

    def blocks(held: bool, most: int, most_shingles: int) -> Column:
        this = F.col("held") == held
        need = F.count(F.when(this, 1)) / most
        if shingles_too:
            need = F.greatest(need, F.sum(F.when(this, F.col("n"))) / most_shingles)
        return F.greatest(F.ceil(need), F.lit(1)).cast("int")

    grid = rows.groupBy("g").agg(
        blocks(True, size[0], HELD_SHINGLES).alias("high"),
        blocks(False, size[1], PASSING_SHINGLES).alias("wide"),
    )
    own = F.pmod(F.xxhash64("node", "held"), F.when(F.col("held"), F.col("high")).otherwise(F.col("wide")))
    every = F.explode(F.sequence(F.lit(0), F.when(F.col("held"), F.col("wide")).otherwise(F.col("high")) - 1))
    dealt = rows.join(grid, "g").withColumn("own", own.cast("int")).withColumn("every", every)
    return dealt.select(
        *rows.columns,
        F.when(F.col("held"), F.col("own")).otherwise(F.col("every")).alias("i"),
        F.when(F.col("held"), F.col("every")).otherwise(F.col("own")).alias("j"),
    )


def _in_cells(cells: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run`` to frames of whole cells, whose held rows come first."""
    order = ["g", "i", "j"]
    return (
        cells.repartition(*order)
        .sortWithinPartitions(*order, F.desc("held"))
        .mapInPandas(lambda frames: run(whole_groups(frames, order)), schema)
    )


def _open_pairs(cell: pd.DataFrame, threshold: int) -> tuple[int, np.ndarray]:
    """The number of held rows, and which (held, other) pairs may be links to find.

    These are in different components, close by their sketches, not compared
    yet, and, where both are held in their group, in order.
    """
    top = int(cell["held"].sum())
    node, part, n, hub = (cell[c].to_numpy() for c in ("node", "part", "n", "hub"))
    outside = cell["outside"].to_numpy()
    sketch = cell[[f"s{i}" for i in range(WORDS)]].to_numpy().view(_U)
    a, b = slice(0, top), slice(top, None)
    able = part[a, None] != part[None, b]
    able &= (hub[a, None] != node[None, b]) & (node[a, None] != hub[None, b])
    able &= ~outside[None, b] | (node[a, None] < node[None, b])
    able &= 100 * np.minimum(n[a, None], n[None, b]) >= threshold * np.maximum(n[a, None], n[None, b])
    bits = np.zeros(able.shape, np.int32)
    for w in range(WORDS):
        bits += np.bitwise_count(sketch[a, w, None] ^ sketch[None, b, w])
    return top, able & (bits <= MOST_BITS)


def _candidates(rows: DataFrame, threshold: int) -> DataFrame:
    """The rows (g, node, held) of groups that full sets have to decide."""

    def run(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in cells:
            edges, found = group_bounds(frame, ["g", "i", "j"]), []
            for start, end in zip(edges[:-1], edges[1:]):
                cell = frame.iloc[start:end]
                top, able = _open_pairs(cell, threshold)
                if able.any():
                    found.append(cell[np.concatenate([able.any(1), able.any(0)])])
            if found:
                yield pd.concat(found)[["g", "node", "held"]]

    cells = _cells(rows, SKETCH_CELL, False)
    return _in_cells(cells, run, "g long, node long, held boolean").distinct()


def _confirmed(rows: DataFrame, texts: DataFrame, words: int, threshold: int) -> DataFrame:
    """Links (a, b) between components of the groups' rows, by their full sets.

    Enough of them to connect what is linked within each cell, not all.
    """

    def run(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in cells:
            edges, found = group_bounds(frame, ["g", "i", "j"]), []
            for start, end in zip(edges[:-1], edges[1:]):
                found += _links(frame.iloc[start:end], words, threshold)
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    cells = _cells(rows, SET_CELL, True).join(texts, "node")
    return _in_cells(cells, run, "a long, b long")


def _links(cell: pd.DataFrame, words: int, threshold: int) -> list[tuple[int, int]]:
    top, able = _open_pairs(cell, threshold)
    if not able.any():
        return []
    node, part, text = (cell[c].to_numpy() for c in ("node", "part", "text"))
    held = {x: shingles(text[x], words) for x in np.flatnonzero(able.any(1))}
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = parent[x]
        return x

    found = []
    for y in np.flatnonzero(able.any(0)):
        other = shingles(text[top + y], words)
        for x in np.flatnonzero(able[:, y]):
            a, b = root(part[x]), root(part[top + y])
            if a == b:
                continue
            one = held[x]
            both = len(np.intersect1d(one, other, assume_unique=True))
            if 100 * both >= threshold * (len(one) + len(other) - both):
                parent[max(a, b)] = min(a, b)
                found.append((int(node[x]), int(node[top + y])))
    return found


def _classes(signed: DataFrame) -> DataFrame:
    """A row per distinct set: a number, its smallest document and where its text is."""
    return (
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min(F.struct("doc_id", "text_key")).alias("least"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        )
        .select(
            F.monotonically_increasing_id().alias("node"), "set_key", "least.*", "n", "bands",
            *(F.col("sketch")[i].alias(f"s{i}") for i in range(WORDS)),
        )
    )


def _same_document(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between classes that share a doc_id, whose rows have several texts."""
    several = (
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
        .where("low != high")
    )
    first = several.join(classes.select(F.col("set_key").alias("low"), F.col("node").alias("a")), "low")
    own = signed.select("doc_id", "set_key").join(classes.select("set_key", F.col("node").alias("b")), "set_key")
    return first.select("doc_id", "a").join(own.select("doc_id", "b"), "doc_id").where("a != b").select("a", "b")


def _class_components(
    signed: DataFrame, classes: DataFrame, docs: DataFrame, words: int, threshold: int, tables: Tables
) -> DataFrame:
    """The component (id, component) of every class that has a link."""
    same = tables.write(_same_document(signed, classes))
    banded = classes.select(F.posexplode("bands").alias("band", "bucket"), "node")
    sizes = tables.write(banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"))
    shared = tables.write(banded.join(sizes, "bucket").select("bucket", "node", "size"))
    degrees = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    central = tables.write(
        classes.join(degrees, "node").select("node", "doc_id", "text_key", "degree", *_SKETCH)
    )
    # merged at any size: Spark's choice of a broadcast would change the plan with the input
    wanted = central.select("doc_id", "text_key", "node").hint("merge")
    texts = tables.write(
        keyed_texts(docs)
        .join(wanted, ["doc_id", "text_key"])
        .dropDuplicates(["doc_id", "text_key"])  # as the join has sorted them: no further shuffle
        .select("node", "text")
    )
    members = tables.write(shared.join(central.select("node", "degree", *_SKETCH), "node").drop("size"))
    tables.free(sizes, shared)
    hub = members.groupBy("bucket").agg(F.max(F.struct("degree", "node", *_SKETCH)).alias("r"))
    hub = hub.select("bucket", *(F.col(f"r.{c}").alias(f"r_{c}") for c in ("node", *_SKETCH)))
    met = members.join(hub, "bucket").where((F.col("node") != F.col("r_node")) & _close("", "r_", threshold))
    nearest = F.min(F.struct(_bits("", "r_").alias("bits"), "r_node"))
    tried = tables.write(met.groupBy("node").agg(nearest["r_node"].alias("hub")))
    plain = central.select("node", *_SKETCH)
    passing = tried.select(F.col("hub").alias("g"), "node", F.lit(False).alias("held"))
    holding = tried.select(F.col("hub").alias("g"), F.col("hub").alias("node"), F.lit(True).alias("held"))
    rows = passing.union(holding.distinct()).join(plain, "node").select(
        "*", F.col("node").alias("part"), F.lit(-1).cast("long").alias("hub"), F.lit(False).alias("outside")
    )
    found = tables.write(_confirmed(rows, texts, words, threshold))
    known = tables.write(components(same.union(found)))

    # what is left: buckets of several components, by their largest one
    parted = tables.write(
        members.drop("degree")
        .join(known.select(F.col("id").alias("node"), "component"), "node", "left")
        .withColumn("part", F.coalesce("component", "node"))
        .drop("component")
    )
    parts = parted.groupBy("bucket", "part").agg(F.count("*").alias("count"))
    mixed = parts.groupBy("bucket").agg(
        F.max(F.struct("count", "part"))["part"].alias("g"), F.count("*").alias("several")
    )
    group = (
        parted.join(mixed.where("several > 1").select("bucket", "g"), "bucket")
        .drop("bucket")
        .dropDuplicates(["g", "node"])
        .join(tried, "node", "left")
        .withColumn("hub", F.coalesce("hub", F.lit(-1)))
        .withColumn("outside", F.col("part") != F.col("g"))
    )
    group = tables.write(group)
    tables.free(members, parted)
    every = group.withColumn("held", F.lit(False)).union(
        group.where("outside").withColumn("held", F.lit(True))
    )
    marked = tables.write(_candidates(every, threshold))
    left = tables.write(_confirmed(marked.join(group, ["g", "node"]), texts, words, threshold))
    tables.free(group, marked, texts)
    edges = known.select(F.col("id").alias("a"), F.col("component").alias("b")).union(left)
    return tables.write(components(edges))


def near_duplicates(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Links documents whose sets of ``words``-word shingles have a Jaccard
    similarity of ``threshold`` percent or more. ``component_id`` is the
    smallest doc_id reachable by links, ``kept`` whether it is the row's own.

    Other columns are left out. A null or empty text, or one without words, has
    no shingles and links with nothing. A row without doc_id takes no part in
    links: its component is null and it is kept. Rows that share a doc_id count
    as one document, which links what each of its texts links with. An empty
    table gives an empty result.

    Runs jobs; intermediate tables are deleted once they have been read.
    """
    python_tasks(docs.sparkSession)
    tables = Tables(docs.sparkSession)
    signed = tables.write(signatures(docs, words))
    classes = tables.write(_classes(signed))
    known = _class_components(signed, classes, docs, words, threshold, tables)
    own = classes.select("set_key", "node", "doc_id").join(
        known.withColumnRenamed("id", "node"), "node", "left"
    )
    own = tables.write(own.select("set_key", "doc_id", F.coalesce("component", "node").alias("part")))
    least = own.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    named = own.join(least, "part").select("set_key", "component_id")
    found = tables.write(
        signed.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select("doc_id", "n_shingles", "component_id")
    )
    tables.keep(found)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.withColumn("component_id", component).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicate(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs``, one document of each group of near-duplicates.

    The smallest doc_id of a group stays, with each of its texts; rows that share
    doc_id and text come once. Rows without doc_id all stay.
    """
    found = near_duplicates(docs, words, threshold)
    tables = Tables(docs.sparkSession)
    kept = tables.write(
        found.where("kept AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_kept_id"))
        .agg(F.count("*").alias("_rows"))
    )
    unnamed = docs.where(F.col("doc_id").isNull())
    # merged at any size, as above: beyond a broadcast the texts are shuffled once more
    wanted = kept.hint("merge")
    rows = docs.join(wanted, F.col("doc_id").cast("long") == F.col("_kept_id"), "left_semi")
    if not kept.where("_rows > 1").isEmpty():
        text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
        rows = rows.withColumn("_text", text).dropDuplicates(["doc_id", "_text"]).drop("_text")
    return rows.unionByName(unnamed)
