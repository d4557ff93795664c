"""Nearest neighbours by a forest of random-projection trees.

Trees are grown on a bounded sample: a node cuts its part of the sample at the
median of a projection on the line between two of its points. Every row is
indexed in one leaf of each tree. A query walks all trees through one priority
queue: the branches that it did not take wait there, nearest cut first. It
visits leaves until they hold a wanted share of the sample, which estimates the
share of all rows; that share is the least one that reaches the wanted recall
on sample queries, checked against brute force. All rows of the visited leaves
are candidates, ranked by their exact distances.

Rows and queries meet by leaf in blocks of bounded size on either side, so a
leaf that holds a third of all rows is many tasks' work.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.llm.common import SEED, group_bounds, python_tasks, whole_groups
from basketry.llm.euclid import usable
from basketry.session import materialize

#: Vectors that the trees are grown on, trees, and sample vectors in a leaf.
SAMPLE, TREES, LEAF = 4096, 8, 64
#: Rows, and queries, of a leaf that meet in one block.
BLOCK = 4096
#: Recall on the sample that fixes the share of rows to look at; sample queries.
RECALL, TRIALS = 0.96, 128


@dataclass
class Forest:
    """Nodes of all trees in arrays; a child below 0 is the leaf -child - 1."""

    axes: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    roots: list[int]
    held: list[int]  # for each leaf the sample's rows in it, as bits
    n_sample: int
    share: float = 1.0

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        side = (vectors @ self.axes.T >= self.cuts).astype(np.int64)
        every = np.arange(len(vectors))
        out = np.empty((len(vectors), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(vectors), root)
            while (inner := at >= 0).any():
                node = at[inner]
                at[inner] = self.children[node, side[every[inner], node]]
            out[:, t] = -at - 1
        return out

    def visits(self, offsets: np.ndarray, share: float) -> list[int]:
        """The leaves a query visits; ``offsets`` are its places at all cuts."""
        waiting = [(0.0, i, root) for i, root in enumerate(self.roots)]
        number, covered, found = len(waiting), 0, []
        wanted = share * self.n_sample
        children = self.children
        while waiting and (covered.bit_count() < wanted or not found):
            far, _, node = heapq.heappop(waiting)
            while node >= 0:
                offset = offsets[node]
                low, high = children[node]
                near, other = (high, low) if offset >= 0 else (low, high)
                heapq.heappush(waiting, (max(far, abs(offset)), number, other))
                number += 1
                node = near
            found.append(-node - 1)
            covered |= self.held[-node - 1]
        return found


def grow(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF) -> Forest:
    random = np.random.default_rng(SEED)
    axes, cuts, children, held, roots = [], [], [], [], []

    def plant(rows: np.ndarray) -> int:
        if len(rows) > leaf:
            for _ in range(3):
                a, b = sample[random.choice(rows, 2, replace=False)]
                axis = a - b
                size = np.sqrt(axis @ axis)
                axis = axis / size if size > 0 else random.standard_normal(len(axis))
                places = sample[rows] @ axis
                cut = np.median(places)
                high = places >= cut
                if 0 < high.sum() < len(rows):
                    node = len(axes)
                    axes.append(axis)
                    cuts.append(cut)
                    children.append([0, 0])
                    children[node] = [plant(rows[~high]), plant(rows[high])]
                    return node
        held.append(sum(1 << int(r) for r in rows))
        return -len(held)

    for _ in range(trees):
        roots.append(plant(np.arange(len(sample))))
    d = sample.shape[1]
    return Forest(
        np.array(axes).reshape(-1, d), np.array(cuts), np.array(children, np.int64).reshape(-1, 2),
        roots, held, len(sample),
    )


def calibrate(forest: Forest, sample: np.ndarray, recall: float, k: int) -> float:
    """The least share of rows, in steps of 5 %, that reaches ``recall``."""
    queries = sample[: min(TRIALS, len(sample))]
    squares = (sample * sample).sum(1)
    far = squares - 2 * queries @ sample.T
    far[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1.0
    nearest = np.argpartition(far, k - 1, axis=1)[:, :k]
    offsets = queries @ forest.axes.T - forest.cuts
    for share in np.arange(0.05, 1.0, 0.05):
        hits = 0
        for near, offset in zip(nearest, offsets):
            covered = 0
            for leaf in forest.visits(offset, share):
                covered |= forest.held[leaf]
            hits += sum(covered >> int(r) & 1 for r in near)
        if hits >= recall * nearest.size:
            return float(share)
    return 1.0


def _nearest(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """For each query its k nearest rows: positions of queries, ids, distances.

    A product finds all that may be among them, ties included; distances come
    from differences.
    """
    squares = (queries * queries).sum(1)[:, None] + (rows * rows).sum(1)
    rough = squares - 2 * queries @ rows.T
    rough[own[:, None] == ids] = np.inf
    n = rough.shape[1]
    bound = np.partition(rough, min(k, n) - 1, axis=1)[:, min(k, n) - 1]
    slack = 1e-12 * (squares.max(1) + 1e-300)
    at, which = np.nonzero((rough <= (bound + slack)[:, None]) & (rough < np.inf))
    gaps = queries[at] - rows[which]
    return at, ids[which], np.sqrt((gaps * gaps).sum(1))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    trees: int = TREES,
    recall: float = RECALL,
) -> DataFrame:
    """The ``k`` nearest rows found for each row that ``is_query`` holds for.

    Takes ``vec_id`` and ``embedding``; ``is_query`` is a condition on vec_id.
    Returns query_id, rank (from 1), vec_id and score, the Euclidean distance
    in double precision; ties go to the smaller vec_id. A row is no candidate
    of its own id. Rows without vec_id, and vectors that are null, empty, zero
    or not finite throughout, take no part, nor do those whose length is not
    the most common one. Rows that share a vec_id are one candidate, the
    nearest of them. With fewer candidates, all that are found; from an empty
    table, none.
    """
    spark = vectors.sparkSession
    python_tasks(spark)
    rows = vectors.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        is_query.alias("asks"),
    ).where(usable("embedding"))
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    result = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("embedding") == length.d)
    taken = rows.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(SAMPLE)
    sample = np.array([r.embedding for r in taken.select("embedding").collect()], float)
    forest = grow(sample, trees)
    forest.share = calibrate(forest, sample, recall, k)
    shared = spark.sparkContext.broadcast(forest)  # its size is bounded by the sample's

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown = shared.value
        for frame in frames:
            if len(frame):
                whole = np.stack(frame["embedding"].to_numpy())
                places = grown.leaves(whole)
                asks = frame["asks"].fillna(False).to_numpy(bool)
                visits = [[] for _ in asks]
                offsets = whole[asks] @ grown.axes.T - grown.cuts
                for i, offset in zip(np.flatnonzero(asks), offsets):
                    visits[i] = grown.visits(offset, grown.share)
                yield pd.DataFrame(
                    {
                        "vec_id": frame["vec_id"],
                        "data": [x.tobytes() for x in whole],
                        "leaves": list(places),
                        "visits": visits,
                    }
                )

    indexed = materialize(
        rows.mapInPandas(
            index, "vec_id long, data binary, leaves array<bigint>, visits array<bigint>"
        )
    )
    stored = indexed.select("vec_id", F.explode("leaves").alias("leaf"))
    asked = indexed.select("vec_id", F.explode("visits").alias("leaf"))
    sizes = stored.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("row_blocks"))
    loads = asked.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("query_blocks"))
    blocks = materialize(sizes.join(loads, "leaf"))  # a row for each leaf of the forest

    def dealt(members: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        own_block = F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        pair = ("own", "opposite") if asks else ("opposite", "own")
        return (
            members.join(F.broadcast(blocks), "leaf")
            .withColumn("own", own_block)
            .withColumn("opposite", each)
            .select(
                "leaf",
                F.col(pair[0]).alias("query_block"),
                F.col(pair[1]).alias("row_block"),
                "vec_id",
                "data",
                F.lit(asks).alias("asks"),
            )
        )

    with_data = lambda name: indexed.select("vec_id", "data", F.explode(name).alias("leaf"))
    meeting = dealt(with_data("leaves"), "row_blocks", "query_blocks", False).union(
        dealt(with_data("visits"), "query_blocks", "row_blocks", True)
    )
    keys = ["leaf", "query_block", "row_block"]

    def rank(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            edges = group_bounds(frame, keys)
            ids, asks = frame["vec_id"].to_numpy(), frame["asks"].to_numpy(bool)
            whole = np.frombuffer(b"".join(frame["data"])).reshape(len(frame), -1)
            for start, end in zip(edges[:-1], edges[1:]):
                ask = asks[start:end]
                if not ask.any() or ask.all():
                    continue
                vectors_, names = whole[start:end], ids[start:end]
                own, rows_ = names[ask], vectors_[~ask]
                for i in range(0, len(own), 32):
                    at, found, score = _nearest(
                        vectors_[ask][i : i + 32], rows_, names[~ask], own[i : i + 32], k
                    )
                    got = pd.DataFrame({"query_id": own[i : i + 32][at], "vec_id": found, "score": score})
                    got = got.sort_values(["query_id", "score", "vec_id"])
                    yield got.drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k)

    found = (
        meeting.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(rank, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
