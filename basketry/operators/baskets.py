"""Baskets, products and ordering times."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def basket_sizes(items: DataFrame, order: str = "order_id") -> DataFrame:
    """Number of lines of each order."""
    return items.groupBy(order).agg(F.count(F.lit(1)).alias("basket_size"))


def _product_totals(
    items: DataFrame, product: str, flag: str | None = None
) -> DataFrame:
    """Line count (and flag total) per product, before any join.

    A product sold in a third of all lines is one row after the map-side
    combine, so the join that follows has no hot key.
    """
    sums = [F.count(F.lit(1)).alias("_lines")]
    if flag:
        sums += [
            F.sum(F.col(flag).cast("double")).alias("_flagged"),
            F.count(flag).alias("_known"),
        ]
    return items.groupBy(product).agg(*sums)


def product_popularity(
    items: DataFrame,
    products: DataFrame,
    keys: Sequence[str] = ("product_name", "department"),
    product: str = "product_id",
    flag: str = "reordered",
) -> DataFrame:
    """Order count and reorder rate per product name and department."""
    totals = _product_totals(items, product, flag)
    known = F.sum("_known")
    return (
        totals.join(products.select(product, *keys), product)
        .groupBy(*keys)
        .agg(
            F.sum("_lines").alias("order_count"),
            F.try_divide(F.sum("_flagged"), known).alias("reorder_rate"),
        )
    )


def top_products(
    items: DataFrame,
    products: DataFrame,
    n: int = 15,
    keys: Sequence[str] = ("product_name", "department"),
    product: str = "product_id",
    flag: str = "reordered",
) -> DataFrame:
    """The ``n`` most ordered products; names break ties."""
    ranked = product_popularity(items, products, keys, product, flag)
    return ranked.orderBy(F.desc("order_count"), *keys).limit(n)


def items_by(
    items: DataFrame,
    products: DataFrame,
    group: str = "department",
    product: str = "product_id",
) -> DataFrame:
    """Lines sold per product group, largest first."""
    return (
        _product_totals(items, product)
        .join(products.select(product, group), product)
        .groupBy(group)
        .agg(F.sum("_lines").alias("n_items"))
        .orderBy(F.desc("n_items"), group)
    )


def reorder_rate(items: DataFrame, flag: str = "reordered") -> DataFrame:
    """Share of flagged lines and its complement, the class balance."""
    rate = F.avg(F.col(flag).cast("double"))
    return items.agg(
        rate.alias("reorder_rate"), (F.lit(1.0) - rate).alias("first_time_rate")
    )


def orders_by(
    orders: DataFrame,
    code: str = "order_dow",
    label: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Orders per code (weekday, hour) in code order; missing codes are skipped."""
    counts = (
        orders.where(F.col(code).isNotNull())
        .groupBy(code)
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    if label:
        counts = counts.withColumn("label", label(F.col(code)))
    return counts.orderBy(code)
