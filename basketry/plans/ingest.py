"""Raw files to stored tables.

Each ``build_*`` returns one lazy plan; ``run`` writes them and logs row counts.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry import schemas as S
from basketry.functions.text import mentions_or_missing, present, strip_prefix
from basketry.operators.reshape import prefixed, wide_to_long
from basketry.sources.delimited import path_exists, read_delimited, typed
from basketry.sources.sink import write_table

logger = logging.getLogger(__name__)

# --- fixed values: dataset choices of the command line ------------------------
DATASETS = ("instacart", "m5", "off", "all")


def build_orders(spark: SparkSession, path: str) -> DataFrame:
    """One row per order; columns beyond the known ones pass through as text."""
    return typed(read_delimited(spark, path), S.ORDERS_SCHEMA, extras=True)


def build_products(
    spark: SparkSession, products: str, aisles: str, departments: str, multiline: bool = True
) -> DataFrame:
    """Products with aisle and department names; unknown ids are dropped.

    ``multiline`` admits names with line breaks in quotes, at the price of one
    split for each file; turn it off only for files without such names. The two name tables are small files, so Spark broadcasts them by their
    size; should they grow past its threshold it shuffles instead.
    """

    def table(path, schema):
        return typed(read_delimited(spark, path, multiline=multiline), schema)

    return (
        table(products, S.PRODUCTS_SCHEMA)
        .join(table(aisles, S.AISLES_SCHEMA), "aisle_id")
        .join(table(departments, S.DEPARTMENTS_SCHEMA), "department_id")
        .select(*S.PRODUCTS_SCHEMA.names, "aisle", "department")
    )


def build_order_items(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All order lines of the files that are there, matched by column name."""
    there = [p for p in paths if path_exists(spark, p)]
    if not there:
        raise FileNotFoundError(f"none of these is there: {', '.join(paths)}")
    parts = [
        typed(read_delimited(spark, p), S.ORDER_ITEMS_SCHEMA, extras=True)
        for p in there
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def build_daily_sales(spark: SparkSession, sales: str, calendar: str) -> DataFrame:
    """One row per item, store and day with sales, with the day's calendar row.

    Day columns come from the header. Cells stay text until they are rows, so
    the plan has one cast rather than one per day, and cells without sales are
    gone before the join. The calendar has one row per day and is broadcast by
    its file size.
    """
    wide = read_delimited(spark, sales)
    days = prefixed(wide.columns, "d_")
    ids = [present(F.col(c)).alias(c) for c in S.SALES_ID_SCHEMA.names]
    long = (
        wide_to_long(wide.select(*ids, *days), S.SALES_ID_SCHEMA.names, days)
        .withColumn("sales", present(F.col("sales")).cast("int"))
        .where(F.col("sales") > 0)
        .withColumn("day_num", strip_prefix(F.col("day"), "d_").cast("smallint"))
    )
    dates = typed(read_delimited(spark, calendar), S.CALENDAR_SCHEMA)
    return long.join(dates.withColumnRenamed("d", "day"), "day", "left").select(
        *S.DAILY_SALES_COLUMNS
    )


def build_catalogue(
    spark: SparkSession,
    path: str,
    country: str = "australia",
    multiline: bool = True,
    spread: int | None = None,
) -> DataFrame:
    """Named and categorised products sold in ``country`` or with none listed.

    Lines with too many fields are kept without the surplus, short ones are
    padded, and a number that cannot be read is missing. A file that is
    compressed or ``multiline`` is one split: its task only cuts it into
    fields, and its rows are then dealt to ``spread`` tasks, by default as many
    as shuffles have, before anything is cast, filtered or written.
    """
    rows = read_delimited(spark, path, sep="\t", multiline=multiline, strict=False)
    names = [F.col(f"`{c}`") for c in rows.columns if c in S.CATALOGUE_SCHEMA.names]
    one_split = multiline or path.endswith((".gz", ".zst", ".snappy", ".lz4"))
    if one_split:
        width = spread or int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.select(*names).repartition(width)
    return typed(rows, S.CATALOGUE_SCHEMA, strict=False).where(
        F.col("product_name").isNotNull()
        & F.col("categories_en").isNotNull()
        & mentions_or_missing(F.col("countries_en"), country)
    )


def build_sell_prices(spark: SparkSession, prices: str, calendar: str) -> DataFrame:
    """Shelf price per store, item and week, with the week's first date.

    The source of prices for elasticity; the daily sales table has none.
    """
    weeks = (
        read_delimited(spark, calendar)
        .select(
            present(F.col("wm_yr_wk")).cast("int").alias("wm_yr_wk"),
            present(F.col("date")).cast("date").alias("date"),
        )
        .groupBy("wm_yr_wk")
        .agg(F.min("date").alias("week_start"))
    )
    return typed(read_delimited(spark, prices), S.SELL_PRICES_SCHEMA).join(
        weeks, "wm_yr_wk"
    )


def run(
    spark: SparkSession, raw: str, out: str, dataset: str = "all"
) -> dict[str, int | None]:
    """Build the tables of one dataset, or all, under ``out``.

    Returns rows written per table; None where an optional source is absent.
    """
    if dataset not in DATASETS:
        raise ValueError(f"dataset must be one of {', '.join(DATASETS)}")
    raw, out = raw.rstrip("/"), out.rstrip("/")
    counts: dict[str, int | None] = {}

    def source(name: str) -> str:
        return f"{raw}/{name}"

    def write(table: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> None:
        counts[table] = write_table(rows, f"{out}/{table}.parquet", partition_by)

    def write_if_there(table: str, name: str, build: Callable[[str], DataFrame],
                       partition_by: Sequence[str] = ()) -> None:
        if path_exists(spark, source(name)):
            write(table, build(source(name)), partition_by)
        else:
            logger.warning("%s not found, %s skipped", source(name), table)
            counts[table] = None

    if dataset in ("instacart", "all"):
        write(S.ORDERS, build_orders(spark, source(S.RAW_ORDERS)))
        names = (S.RAW_PRODUCTS, S.RAW_AISLES, S.RAW_DEPARTMENTS)
        write(S.PRODUCTS, build_products(spark, *map(source, names)))
        files = [source(p) for p in S.RAW_ORDER_ITEMS]
        write(S.ORDER_ITEMS, build_order_items(spark, files))
    if dataset in ("m5", "all"):
        calendar = source(S.RAW_CALENDAR)
        write_if_there(
            S.DAILY_SALES,
            S.RAW_SALES,
            lambda p: build_daily_sales(spark, p, calendar),
            S.DAILY_SALES_PARTITIONS,
        )
        write_if_there(
            S.SELL_PRICES,
            S.RAW_SELL_PRICES,
            lambda p: build_sell_prices(spark, p, calendar),
        )
    if dataset in ("off", "all"):
        write_if_there(S.CATALOGUE, S.RAW_CATALOGUE, lambda p: build_catalogue(spark, p))
    return counts
