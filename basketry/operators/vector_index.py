"""An inverted-file index of vectors: batch search by cosine in a few cells.

Centres are found on a bounded sample; every row belongs to the cell of its
nearest centre and rows are stored by cell. A search looks only into the cells
whose centres are nearest to its query, so its work is a share of the table that
falls as cells become more: there are about as many of them as a cell has rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from basketry.session import materialize

#: Rows a centre that it is fitted on, at most so many centres, and rows that a
#: task holds at once. A table of more than 4e9 rows has cells of more blocks.
SAMPLE_A_CELL, MOST_CELLS, BLOCK = 64, 65_536, 4096

#: Products of rows with centres or other rows that a task holds at once.
PRODUCTS = 1 << 20


def _slices(n_rows: int, width: int) -> Iterator[slice]:
    """Slices of rows that make at most ``PRODUCTS`` products with ``width`` others."""
    step = max(1, PRODUCTS // max(width, 1))
    return (slice(i, i + step) for i in range(0, n_rows, step))


@dataclass(frozen=True)
class VectorIndex:
    """Where an index is stored: ``rows`` (with cell and block) and ``centres``."""

    path: str
    key: str
    vector: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def centres(self, spark: SparkSession) -> np.ndarray:
        """The centres, one per row: at most ``MOST_CELLS`` of them."""
        found = spark.read.parquet(f"{self.path}/centres").orderBy("cell").collect()
        return np.array([r.centre for r in found], float)


def _usable(vector: str) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def build_index(
    vectors: DataFrame,
    path: str,
    key: str = "product_id",
    vector: str = "embedding",
    cells: int | None = None,
    seed: int = 42,
) -> VectorIndex:
    """Write an index of all rows that have a key and a vector with a direction.

    Other columns stay with the rows, for filters. Vectors must be of one length.
    ``cells`` is the square root of the number of rows if not given. The centres
    are fitted, by cosine, on ``SAMPLE_A_CELL`` rows a cell, chosen by a hash of
    the key. Rows are sorted by cell, and a crowded cell is spread over files, so
    that a search reads few of them. Runs jobs.
    """
    spark = vectors.sparkSession
    able = materialize(
        vectors.where(F.col(key).isNotNull() & _usable(vector)).withColumn(
            vector, F.col(vector).cast("array<double>")
        )
    )
    n_rows = able.count()
    cells = max(1, min(cells or math.isqrt(n_rows) or 1, MOST_CELLS, n_rows or 1))
    if cells == 1:  # one cell needs no centre; its length still fits the vectors
        width = able.agg(F.max(F.size(vector))).first()[0] or 1
        centres = np.zeros((1, width))
    else:
        sample = able.orderBy(F.xxhash64(key), key).limit(SAMPLE_A_CELL * cells)
        features = materialize(sample.select(array_to_vector(vector).alias("features")))
        fitted = KMeans(k=cells, seed=seed, distanceMeasure="cosine", maxIter=10).fit(features)
        centres = np.array(fitted.clusterCenters())
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
    spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(centres)], "cell int, centre array<double>"
    ).write.mode("overwrite").parquet(f"{path}/centres")
    shared = spark.sparkContext.broadcast(centres)  # cells x components

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            whole = np.array(frame[vector].tolist(), float)
            cell = np.zeros(len(frame), np.int32)
            for some in _slices(len(frame), len(shared.value)):
                cell[some] = (whole[some] @ shared.value.T).argmax(1)
            frame["cell"] = cell
            yield frame

    schema = T.StructType([*able.schema.fields, T.StructField("cell", T.IntegerType())])
    placed = materialize(able.mapInPandas(assign, schema))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")
    rows = placed.join(F.broadcast(sizes), "cell").withColumn("block", block)  # a row a cell
    rows.repartitionByRange("cell", "block", F.xxhash64(key)).sortWithinPartitions(
        "cell", "block"
    ).write.mode("overwrite").parquet(f"{path}/rows")
    return VectorIndex(path, key, vector)


def _probed(queries: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """Queries (query, unit) with the cells nearest to them, the nearest first."""
    shared = queries.sparkSession.sparkContext.broadcast(centres)

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            whole = np.array(frame["unit"].tolist(), float).reshape(len(frame), -1)
            for some in _slices(len(frame), len(shared.value)):
                farness = whole[some] @ -shared.value.T
                order = np.argsort(farness, 1, kind="stable")[:, :probes]
                yield frame.iloc[some].assign(cells=list(order.astype(np.int32)))

    found = queries.mapInPandas(near, T.StructType([*queries.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]))
    return found.select("query", "unit", F.posexplode("cells").alias("turn", "cell"))


def search(
    index: VectorIndex,
    queries: DataFrame,
    k: int = 10,
    probes: int = 8,
    where: Column | None = None,
    key: str | None = None,
    vector: str | None = None,
) -> DataFrame:
    """The ``k`` indexed rows closest to each query, of those in ``probes`` cells.

    ``queries`` has a key and a vector (named as in the index if not given); a row
    of the index with the query's own key is left out. ``where`` limits the rows by
    other columns, before any arithmetic. Returns query, position from 1, the row's
    key and similarity: the cosine in double precision; the key breaks ties. A
    query without a direction has no rows, one with few candidates fewer than k.

    Rows and queries meet by cell and block. A task holds one block of rows, which
    is bounded, and lets the queries of its cell pass in batches, so a crowded cell
    or many queries at one spot fill no memory. For each query it keeps a few more
    than ``k`` by single-precision products and ranks these exactly.
    """
    spark = queries.sparkSession
    key, vector = key or index.key, vector or index.vector
    rows = index.rows(spark)
    if where is not None:
        rows = rows.where(where)
    name = rows.schema[index.key].dataType.simpleString()
    asked = queries.where(F.col(key).isNotNull() & _usable(vector)).select(
        F.col(key).cast(name).alias("query"), F.col(vector).cast("array<double>").alias("unit")
    )
    probed = _probed(asked, index.centres(spark), probes)
    blocks = rows.select("cell", "block").distinct()
    held = rows.select(
        "cell", "block", F.lit(0).alias("side"), F.col(index.key).alias("id"), F.col(index.vector).alias("at")
    )
    passing = probed.join(blocks, "cell").select(
        "cell", "block", F.lit(1).alias("side"), F.col("query").alias("id"), F.col("unit").alias("at")
    )

    def rank(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, waiting, whole = None, [], None
        for frame in frames:
            for (cell, block, side), part in frame.groupby(["cell", "block", "side"], sort=True):
                if (cell, block) != place:
                    place, waiting, whole = (cell, block), [], None
                if side == 0:
                    waiting.append(part)
                    continue
                if not waiting and whole is None:
                    continue  # no row of this block is left by the filter
                if whole is None:
                    ids = np.concatenate([w["id"].to_numpy() for w in waiting])
                    whole = np.array([x for w in waiting for x in w["at"]], float)
                    whole /= np.abs(whole).max(1, keepdims=True)  # no overflow of squares
                    whole /= np.linalg.norm(whole, axis=1, keepdims=True)
                    rough, waiting = whole.astype(np.float32), []
                units, keep = np.array(part["at"].tolist(), float), min(k + 8, len(ids))
                units /= np.abs(units).max(1, keepdims=True)
                units /= np.linalg.norm(units, axis=1, keepdims=True)
                for some in _slices(len(part), max(len(ids), keep * units.shape[1])):
                    unit = units[some]
                    near = unit.astype(np.float32) @ -rough.T
                    best = np.argpartition(near, keep - 1, 1)[:, :keep]
                    exact = np.einsum("qd,qkd->qk", unit, whole[best])
                    own = ids[best]
                    query = np.repeat(part["id"].to_numpy()[some], keep)
                    found = pd.DataFrame({"query": query, "found": own.ravel(), "similarity": exact.ravel()})
                    yield found[found["query"] != found["found"]]

    meeting = (
        held.union(passing)
        .repartition("cell", "block")
        .sortWithinPartitions("cell", "block", "side")
    )
    near = meeting.mapInPandas(rank, f"query {name}, found {name}, similarity double")
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "found")
    return (
        near.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= k)
        .select("query", "position", F.col("found").alias(index.key), "similarity")
    )


def probes_for(
    index: VectorIndex, spark: SparkSession, recall: float = 0.95, k: int = 10, n_queries: int = 200
) -> int:
    """How many cells a search needs to find ``recall`` of the true neighbours.

    Takes ``n_queries`` rows by a hash of the key, finds their true neighbours in
    all cells, and looks up at which turn a search would come to each one's cell.
    Runs jobs over the whole index.
    """
    rows, centres = index.rows(spark), index.centres(spark)
    some = materialize(
        rows.orderBy(F.xxhash64(index.key, F.lit(1)), index.key).limit(n_queries).select(index.key, index.vector)
    )
    true = search(index, some, k, len(centres)).join(rows.select(index.key, "cell"), index.key)
    asked = some.select(F.col(index.key).alias("query"), F.col(index.vector).alias("unit"))
    turns = true.select("query", "cell").join(_probed(asked, centres, len(centres)), ["query", "cell"])
    counts = sorted((r.turn, r.n) for r in turns.groupBy("turn").agg(F.count("*").alias("n")).collect())
    wanted, found = recall * sum(n for _, n in counts), 0
    for turn, n in counts:  # a row per cell at the most
        found += n
        if found >= wanted:
            return turn + 1
    return len(centres)
