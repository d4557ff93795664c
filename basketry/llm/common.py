"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.session import delete_tables, new_table_path

#: Rows per Arrow batch: bounds what a task holds of long texts at once.
BATCH_ROWS = 1000

#: Seed of everything drawn at random here.
SEED = 20_240_607


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def python_tasks(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Get ready for tasks in Python: call it before planning one.

    Ships this package to the executors, once a Spark context, and lowers the
    session's Arrow batch to ``rows``; a smaller setting stays.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(setting))
    if not 0 < now <= rows:
        spark.conf.set(setting, str(rows))
    context = spark.sparkContext
    if getattr(context, "_basketry_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()).resolve() / "basketry_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._basketry_shipped = True


class Tables:
    """Intermediate tables in the shared folder, deleted when no step reads them.

    What is written has no lineage to replay when executors are lost.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.written: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame) -> DataFrame:
        path = new_table_path(self.spark)
        df.write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.written.append((found, path))
        return found

    def free(self, *frames: DataFrame) -> None:
        delete_tables(self.spark, [p for w, p in self.written if any(w is f for f in frames)])
        self.written = [w for w in self.written if not any(w[0] is f for f in frames)]

    def keep(self, *frames: DataFrame) -> None:
        """Delete all but these, which a lazy result still reads."""
        self.free(*(w for w, _ in self.written if not any(w is f for f in frames)))


def texts_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the whole text, a null one empty; other columns are left out."""
    return df.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def in_folds(key: Column, remainders: Iterable[int], folds: int = 5) -> Column:
    """Whether crc32 of the key as text leaves one of these remainders."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds)).isin(list(remainders))


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value of a double column, exactly.

    Each pass counts the values in equal bins of the interval that holds the
    wanted one and goes on in its bin, so at most ``bins`` counts reach the
    driver however many rows there are. ``df`` is read once a pass; write it
    first. Values are finite; ``k`` is from 1 to the number of rows.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    left = k  # rank among the values up to high
    while low < high:
        inside = df.where(F.col(column).between(low, high))
        width = (high - low) / bins
        if low + width == low or high - width == high:  # fewer doubles than bins
            group = F.col(column)
        else:
            group = F.floor((F.col(column) - F.lit(low)) / F.lit(width))
        counts = (
            inside.groupBy(group.alias("bin"))
            .agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
            .collect()
        )
        for row in sorted(counts, key=lambda r: -r.bin):
            low, high = row.lo, row.hi
            if left <= row.n:
                break
            left -= row.n
    return low


def whole_groups(
    frames: Iterator[pd.DataFrame], keys: list[str]
) -> Iterator[pd.DataFrame]:
    """Frames cut only between groups, of an input sorted by ``keys``.

    Holds one frame and the group at its end; the caller bounds the groups.
    """
    rest: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        tail = frame[keys].iloc[-1]
        same = np.ones(len(frame), bool)
        for key in keys:
            same &= (frame[key] == tail[key]).to_numpy()
        start = len(frame) - int(np.argmin(same[::-1])) if not same.all() else 0
        head = frame.iloc[:start]
        if rest:
            first, ahead = frame[keys].iloc[0], rest[0][keys].iloc[0]
            if start == 0 and all(first[k] == ahead[k] for k in keys):
                rest.append(frame)
                continue
            head = pd.concat([*rest, head], ignore_index=True)
        if len(head):
            yield head
        rest = [frame.iloc[start:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def group_bounds(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where each group of a sorted frame begins, and the frame's length."""
    new = np.zeros(len(frame), bool)
    new[0] = True
    for key in keys:
        values = frame[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), len(frame))
