"""Token ids of documents in files of independently coded blocks.

A file is Parquet, so that Spark commits it whole or not at all on any store;
its rows are segments. A segment holds the ids of whole documents, coded by
``idcoder`` in blocks that are reset and checksummed on their own, the
documents' keys and lengths, and how many ids of its part come before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.llm.common import python_tasks, texts_of

#: Ids after which a segment ends with the document that it is in: wide enough
#: for numpy to step through thousands of blocks at once.
SEGMENT_IDS = 1 << 22

SEGMENTS = (
    "part int, segment int, before long, n_ids long, "
    "doc_ids array<bigint>, lengths array<int>, data binary"
)


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the ids of every whole text, in ascending ``doc_id`` order.

    ``docs`` has ``doc_id`` and ``text``; other columns are left out. A null
    text is empty and so gives the end id alone. Rows that share a ``doc_id``
    are all written, in the order of their texts; null keys come first. An
    empty table gives files without rows. A very long text makes its segment
    longer, as a document is never cut.
    """
    python_tasks(docs.sparkSession)

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from basketry.llm.idcoder import encode_segment
        from basketry.llm.tokens import encoder

        encode, end = encoder(tokenizer).encode, np.uint32(end_id).tobytes()
        part = TaskContext.get().partitionId()
        keys, ids, waiting, before, number = [], [], 0, 0, 0

        def segment() -> pd.DataFrame:
            whole = np.frombuffer(b"".join(ids), "<u4")
            return pd.DataFrame(
                {
                    "part": [part],
                    "segment": [number],
                    "before": [before],
                    "n_ids": [len(whole)],
                    "doc_ids": [list(keys)],
                    "lengths": [[len(x) // 4 for x in ids]],
                    "data": [encode_segment(whole)],
                }
            )

        for frame in frames:
            found = [None if pd.isna(k) else int(k) for k in frame["doc_id"]]
            for key, coded in zip(found, encode(list(frame["text"]))):
                keys.append(key)
                ids.append(coded + end)
                waiting += len(coded) // 4 + 1
                if waiting >= segment_ids:
                    yield segment()
                    before, number = before + waiting, number + 1
                    keys, ids, waiting = [], [], 0
        if ids:
            yield segment()

    ordered = (
        texts_of(docs)
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    ordered.mapInPandas(code, SEGMENTS).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids (little-endian, 32 bits each).

    ``start`` counts the ids of all documents before it. The offsets of the
    parts are broadcast: one row per partition that was written. Fails if a
    block does not match its checksum.
    """
    stored = spark.read.schema(SEGMENTS).parquet(path)
    sizes = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    all_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part", F.coalesce(F.sum("n").over(all_before), F.lit(0)).alias("offset")
    )

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from basketry.llm.idcoder import decode_segment

        for frame in frames:
            for row in frame.itertuples(index=False):
                ids = decode_segment(row.data)
                lengths = np.asarray(row.lengths, np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                whole = ids.tobytes()
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(
                            [None if pd.isna(k) else int(k) for k in row.doc_ids], "Int64"
                        ),
                        "start": row.first + starts,
                        "n_tokens": lengths,
                        "ids": [whole[4 * a : 4 * b] for a, b in zip(starts, ends)],
                    }
                )

    placed = stored.join(F.broadcast(offsets), "part").select(
        "doc_ids", "lengths", "data", (F.col("before") + F.col("offset")).alias("first")
    )
    return placed.mapInPandas(decode, "doc_id long, start long, n_tokens long, ids binary")
