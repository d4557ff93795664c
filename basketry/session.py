"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # runtime re-planning: coalesce small shuffles, split skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # lets the catalogue read date columns stored as nanosecond timestamps
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def build_session(
    app: str = "basketry",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the engine's settings.

    ``master`` stays unset under spark-submit. ``shuffle_partitions`` is the
    starting count that adaptive execution coalesces from; size it as the
    largest shuffle's bytes over 200 MB. Unless that or Spark's own setting is
    given, a cluster starts with three per core.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    setting = "spark.sql.shuffle.partitions"
    context = spark.sparkContext
    if setting not in dict(context.getConf().getAll()):
        spark.conf.set(setting, str(max(200, 3 * context.defaultParallelism)))
    return spark


def named_shared_dir(spark: SparkSession) -> str | None:
    """The folder in spark.checkpoint.dir, or the context's, if one is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    return named.rstrip("/") if named else None


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that outlives executors, named by spark.checkpoint.dir."""
    named = named_shared_dir(spark)
    if not named:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach"
        )
    return named


#: Intermediate tables that this process has written, in order.
_WRITTEN: list[str] = []


def new_table_path(spark: SparkSession) -> str:
    """Where to write an intermediate table in the shared folder."""
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def delete_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete intermediate tables that nothing reads any more."""
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def tables_end_with(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables that are written within, on leaving.

    For a step whose whole result is written within as well, to a place of its own.
    """
    first = len(_WRITTEN)
    try:
        yield
    finally:
        delete_tables(spark, _WRITTEN[first:])
        del _WRITTEN[first:]


#: Rows of a task that holds them, or their groups, in memory.
ROWS_A_TASK = 500_000


def spread(df: DataFrame, keys: Iterable[str], n_rows: int) -> DataFrame:
    """``df``, of about ``n_rows``, dealt by ``keys`` to tasks of ``ROWS_A_TASK`` each.

    For a join or totals by these keys whose groups are about as many as the rows:
    sized by bytes or by the session's setting, tasks would hold ever more of them.
    What fits one task stays as it is.
    """
    tasks = -(-n_rows // ROWS_A_TASK)
    return df.repartition(tasks, *keys) if tasks > 1 else df


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it from there.

    For rows that must be fixed once: positions that depend on how a sort was
    partitioned, or training rows that an iterative model reads many times.
    What is read back has no lineage to replay when executors are lost, and
    unlike an RDD checkpoint it is compressed and keeps column pruning. Runs a
    job. ``tables_end_with`` deletes it with a step's others; else the folder is
    the cluster's to expire.
    """
    path = new_table_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
