"""Parquet output with a row count."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame

logger = logging.getLogger(__name__)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Overwrite ``path`` with ``df`` and return the number of rows written.

    With ``partition_by`` the rows are first rebalanced on those columns:
    adaptive execution merges small groups and splits a hot one over several
    tasks, so neither many tiny files nor one giant writer results.

    The count reads the row counts in the footers of the files just written,
    no data. (An Observation would save even that, but once a session has used
    one, Spark 4.1 can no longer ship a fitted model that refers to the
    session.)
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out.write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None)
    n_rows = df.sparkSession.read.schema(df.schema).parquet(path).count()
    logger.info("%s: %s rows", path, f"{n_rows:,}")
    return n_rows
