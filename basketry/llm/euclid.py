"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines.

Vectors are scaled to length 1, where a cosine of c is a distance of
sqrt(2 - 2c). Each of several tables cuts k random Gaussian projections at a
common width; the k cell numbers name a bucket. Both numbers come from the number
of vectors: k so that a bucket holds about ``MATES`` vectors that are at right
angles, however many there are, and then as many tables as it takes for a pair at
the least cosine to miss all of them with probability ``MISS``. So the share of all
pairs that meet falls as the table grows: with n^0.2 tables, n^1.2 pairs meet.

Equal vectors of one label are one class with a count. A bucket is compared in
blocks of at most ``BLOCK`` classes: a task gets two blocks of it and gives back
a count for each class and links that span what it has found, never the pairs
themselves. A pair that meets in several tables counts in the first one only,
which each class's cells tell, so no pairs have to be made distinct.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import SEED, group_bounds, python_tasks, whole_groups
from basketry.llm.graph import components
from basketry.session import materialize

#: Width of a cell; unrelated vectors in a bucket; probability to miss a pair at
#: the least cosine.
WIDTH, MATES, MISS = 2.0, 16, 5e-4
#: Classes in a block of a bucket.
BLOCK = 512


def usable(column: str) -> F.Column:
    """Whether a vector is neither null, empty nor zero and all its numbers finite."""
    v = F.col(column)
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _same_cell(distance: float, width: float) -> float:
    """The probability that two points at a distance share a cell of a projection."""
    if distance <= 0:
        return 1.0
    ratio = width / distance
    tail = math.erfc(ratio / math.sqrt(2)) / 2
    edge = (1 - math.exp(-ratio * ratio / 2)) * 2 / (math.sqrt(2 * math.pi) * ratio)
    return 1 - 2 * tail - edge


def shape(n: int, least_cosine: float, width: float = WIDTH) -> tuple[int, int]:
    """Tables, and cells of each, for the vectors of the largest label."""
    apart = _same_cell(math.sqrt(2), width)
    cells_ = max(2, math.ceil(math.log(max(n, MATES) / MATES) / -math.log(apart)))
    near = _same_cell(math.sqrt(max(0.0, 2 - 2 * least_cosine)), width) ** cells_
    return max(1, math.ceil(math.log(MISS) / math.log1p(-near))) if near < 1 else 1, cells_


def cells(vectors: np.ndarray, tables: int, cells_: int, width: float) -> np.ndarray:
    """A 64-bit bucket name per vector and table, of vectors of length 1."""
    random = np.random.default_rng(SEED + vectors.shape[1])
    axes = random.standard_normal((vectors.shape[1], tables * cells_))
    shifts = random.uniform(0, width, tables * cells_)
    numbers = np.floor((vectors @ axes + shifts) / width).astype(np.int64)
    numbers = numbers.reshape(len(vectors), tables, cells_).astype(np.uint64)
    name = np.full((len(vectors), tables), SEED, np.uint64)
    for i in range(cells_):
        name = (name ^ numbers[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    return name.view(np.int64)


def _spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links (in order) join what was apart before."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = parent[x]
        return x

    keep = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep[i] = True
    return keep


def near_vectors(
    vectors: DataFrame,
    least_cosine: float = 0.93,
    tables: int | None = None,
    cells_per_table: int | None = None,
    width: float = WIDTH,
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    Takes ``vec_id``, ``embedding`` and ``label``; other columns are left out.
    Links rows of one label whose cosine, in double precision, is
    ``least_cosine`` or more. ``n_links`` counts the other rows a row is linked
    with directly, copies included; ``component_id`` is the smallest vec_id
    reachable. A null label, and a vector that is null, empty, zero or not
    finite throughout, link with nothing, nor do vectors of unequal length. A
    row without vec_id takes no part: no links, a null component, kept. Rows
    that share a vec_id have the links of each of their vectors. An empty
    table gives an empty result. ``tables`` and ``cells_per_table`` come from
    ``shape`` if not given.
    """
    python_tasks(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("string"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    able = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = rows.select(
        "vec_id",
        F.when(able, F.concat_ws(":", "label", F.sha2(F.to_json("embedding"), 256))).alias("key"),
        "label",
        "embedding",
    )
    # the smallest row of each class, and how many rows it has
    sizes = materialize(
        keyed.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("count"), F.first("label").alias("label"))
    )
    if tables is None or cells_per_table is None:
        most = sizes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
        wanted = shape(most, least_cosine, width)
        tables, cells_per_table = tables or wanted[0], cells_per_table or wanted[1]
    sizes = sizes.drop("label")
    one = keyed.join(
        sizes.select("key", F.col("node").alias("vec_id"), "count"), ["key", "vec_id"]
    ).dropDuplicates(["key"])

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lengths = frame["embedding"].map(len)
            for _, same in frame.groupby(lengths, sort=False):
                whole = np.stack(same["embedding"].to_numpy()).astype(float)
                whole /= np.abs(whole).max(1, keepdims=True)  # no overflow of squares
                unit = whole / np.sqrt((whole * whole).sum(1, keepdims=True))
                names = cells(unit, tables, cells_per_table, width)
                yield pd.DataFrame(
                    {
                        "node": same["vec_id"].to_numpy(),
                        "label": same["label"].to_numpy(),
                        "count": same["count"].to_numpy(),
                        "unit": [x.tobytes() for x in unit],
                        "names": [x for x in names],
                    }
                )

    classes = materialize(
        one.mapInPandas(
            hashed, "node long, label string, count long, unit binary, names array<bigint>"
        )
    )
    spread = classes.select("node", "label", F.length("unit").alias("width"), F.posexplode("names").alias("table", "name"))
    bucket = ["label", "width", "table", "name"]
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = materialize(
        spread.groupBy(*bucket)
        .agg(F.count("*").alias("size"))
        .where("size > 1")
        .select(F.xxhash64(*bucket).alias("bucket"), blocks.alias("blocks"))
    )
    # each class goes to all pairs of blocks of its bucket that its own is in
    placed = (
        spread.select("node", "table", F.xxhash64(*bucket).alias("bucket"))
        .join(large, "bucket")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node", "table", "bucket", "own",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
    )
    meeting = placed.join(classes.drop("label"), "node")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["bucket", "i", "j"]
        for frame in whole_groups(frames, keys):
            node = frame["node"].to_numpy()
            count, own = frame["count"].to_numpy(), frame["own"].to_numpy()
            table, i, j = (frame[c].to_numpy() for c in ("table", "i", "j"))
            units = [np.frombuffer(x) for x in frame["unit"]]
            names = np.stack(frame["names"].to_numpy())
            edges = group_bounds(frame, keys)
            out_node, out_links, a, b = [], [], [], []
            for start, end in zip(edges[:-1], edges[1:]):
                if end - start < 2:
                    continue
                part = slice(start, end)
                unit = np.stack(units[start:end])
                near = unit @ unit.T >= least_cosine
                t = table[start]
                for earlier in range(t):  # counted there
                    column = names[part, earlier]
                    near &= column[:, None] != column
                if i[start] != j[start]:  # within a block: in the pair (i, i)
                    near &= own[part, None] != own[part]
                np.fill_diagonal(near, False)
                if not near.any():
                    continue
                out_node.append(node[part])
                out_links.append(near @ count[part])
                x, y = np.nonzero(np.triu(near))
                x, y = node[part][x], node[part][y]
                keep = _spanning(x, y)
                a.append(x[keep])
                b.append(y[keep])
            if out_node:
                links = np.concatenate(out_links)
                nodes = np.concatenate(out_node)[links > 0]
                yield pd.DataFrame({"node": nodes, "links": links[links > 0], "other": -1, "edge": False})
                yield pd.DataFrame(
                    {"node": np.concatenate(a), "links": 0, "other": np.concatenate(b), "edge": True}
                )

    found = materialize(
        meeting.repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
        .mapInPandas(compare, "node long, links long, other long, edge boolean")
    )
    totals = found.where("NOT edge").groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(
        found.where("edge").select(F.col("node").alias("a"), F.col("other").alias("b"))
    )
    per_class = (
        sizes.join(totals, "node", "left")
        .join(labels.withColumnRenamed("id", "node"), "node", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    return keyed.select("vec_id", "key").join(materialize(per_class), "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
