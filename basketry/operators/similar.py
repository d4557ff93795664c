"""Products similar to a product, by cosine of their vectors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.vectors import dot, norm, unit


def similar_to_vector(
    vectors: DataFrame,
    target: Sequence[float],
    k: int = 10,
    key: str = "product_id",
    vector: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """The ``k`` rows closest to a vector, best first; the key breaks ties.

    ``where`` limits the candidates by other columns (category, brand) before
    any arithmetic. Each task keeps its own best ``k``. Rows whose vector is
    missing, has no length or holds a NaN have no similarity and are left out;
    a vector with another number of components raises.
    """
    length = math.hypot(*target)
    if length == 0:
        raise ValueError("the vector has no length")
    return _closest(
        vectors if where is None else vectors.where(where),
        F.lit([float(x) / length for x in target]),
        k,
        key,
        vector,
    )


def similar_to(
    vectors: DataFrame,
    product: object,
    k: int = 10,
    key: str = "product_id",
    vector: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """The ``k`` products closest to a given one, itself left out.

    Raises, when run, if the product is not there, has no vector of some length
    or several vectors. Other rows are as in ``similar_to_vector``.
    """
    chosen = vectors.where(F.col(key) == F.lit(product))
    others = vectors.where(F.col(key) != F.lit(product))
    return _closest(
        others if where is None else others.where(where),
        F.coalesce(
            chosen.where(norm(F.col(vector)) > 0).select(unit(F.col(vector))).scalar(),
            F.raise_error(F.lit(f"no vector of some length for product {product!r}")),
        ),
        k,
        key,
        vector,
    )


def _closest(
    candidates: DataFrame, target_: Column, k: int, key: str, vector: str
) -> DataFrame:
    """``target_`` has length one, so each row costs one product and one norm."""
    length = norm(F.col(vector))
    target = F.when(
        F.size(vector) != F.size("_target"),
        F.raise_error(F.lit("vectors have different numbers of components")),
    ).otherwise(F.col("_target"))
    return (
        candidates.where(F.col(vector).isNotNull())
        .withColumn("_target", target_)
        .withColumn("_target", target)
        .withColumn(
            "similarity", F.try_divide(dot(F.col(vector), F.col("_target")), length)
        )
        .where(F.col("similarity").isNotNull() & ~F.isnan("similarity"))
        .drop(vector, "_target")
        .orderBy(F.desc("similarity"), key)
        .limit(k)
    )


def substitutes(
    vectors: DataFrame,
    product: object,
    k: int = 10,
    key: str = "product_id",
    vector: str = "embedding",
    category: str = "category",
) -> DataFrame:
    """The closest products of the same category, for one out of stock."""
    same = vectors.where(F.col(key) == F.lit(product)).select(category).scalar()
    return similar_to(vectors, product, k, key, vector, F.col(category) == same)
