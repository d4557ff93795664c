"""Connected components of a graph of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import Tables


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest reachable id of every id that has a link.

    ``links`` holds pairs of ids, in any direction, repeats and loops allowed;
    pairs with a null are left out. Returns ``id`` and ``component``, a row per
    id in a link with another. Alternates large-star and small-star steps until
    nothing changes, about log(longest path) rounds. The smallest neighbour of
    each id is written before it meets the links again, so that a hub's links
    stay in a plain shuffle, which Spark splits.
    """
    tables = Tables(links.sparkSession)
    edges = tables.write(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    before = _digest(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        least = tables.write(
            both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        )
        large = tables.write(
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = tables.write(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = tables.write(small.union(least).distinct())
        tables.keep(edges)
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
