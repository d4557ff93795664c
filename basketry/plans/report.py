"""The exploratory report: one chart-ready DataFrame per question."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.labels import month_label, percent_text, weekday_label
from basketry.operators import baskets, profile, ranking, series
from basketry.sources.catalog import Catalog


def order_report(tables: Catalog) -> dict[str, DataFrame]:
    """When people shop, how much, and which products."""
    orders, products = tables.load_orders(), tables.load_products()
    items = tables.load_order_items()
    sizes = baskets.basket_sizes(items)
    return {
        "orders_shape": profile.shape(orders),
        "products_shape": profile.shape(products),
        "order_items_shape": profile.shape(items),
        "orders_by_weekday": baskets.orders_by(orders, "order_dow", weekday_label),
        "orders_by_hour": baskets.orders_by(orders, "order_hour_of_day"),
        "basket_sizes": profile.describe(sizes, "basket_size"),
        "basket_histogram": profile.histogram(sizes, "basket_size", 40, upper=40),
        "top_products": baskets.top_products(items, products),
        "items_by_department": baskets.items_by(items, products),
        "reorder_rate": baskets.reorder_rate(items).withColumns(
            {
                "reordered": percent_text(F.col("reorder_rate")),
                "first_time": percent_text(F.col("first_time_rate")),
            }
        ),
    }


def sales_report(tables: Catalog) -> dict[str, DataFrame]:
    """Daily totals and the yearly season."""
    sales = tables.load_m5_sales()
    daily = series.daily_totals(sales, ["item_id", "store_id"])
    return {
        "sales_shape": profile.shape(sales),
        "sales_range": series.date_range_and_distincts(sales),
        "daily_sales": series.daily_totals(sales).orderBy("date"),
        "monthly_mean": series.period_mean(sales).withColumn(
            "label", month_label(F.col("month"))
        ),
        "monthly_mean_zero_filled": series.zero_filled_period_mean(
            daily, ["item_id", "store_id"]
        ),
    }


def catalogue_report(tables: Catalog) -> dict[str, DataFrame]:
    """Completeness and categories of the product catalogue."""
    products = tables.load_off_products()
    shown = ["product_name", "brands", "main_category_en", "nutriscore_grade"]
    return {
        "catalogue_shape": profile.shape(products),
        "missing_values": profile.most_missing(products),
        "top_categories": profile.top_values(products, "main_category_en"),
        "sample_products": profile.sample_rows(products, shown),
    }


def text_lines(answer: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """An answer as lines of text: line_number from 0, the header, and line.

    Columns are as wide as their longest text and set to the right, one space
    apart; a missing value is ``NULL``. ``order`` should be a total order. Runs a job.
    """
    numbered = ranking.with_row_number(answer, order, "_number")
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in answer.columns}
    wide = answer.agg(
        F.struct(*(F.greatest(F.coalesce(F.max(F.length(t)), F.lit(0)), F.lit(len(c))).alias(c)
                   for c, t in text.items()))
    ).scalar()

    def line(cells: dict[str, Column]) -> Column:
        return F.concat_ws(" ", *(F.lpad(cell, wide[c], F.lit(" ")) for c, cell in cells.items()))

    header = answer.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("line_number"), line({c: F.lit(c) for c in answer.columns}).alias("line")
    )
    return header.union(numbered.select(F.col("_number").cast("long"), line(text)))


REPORTS = {
    "orders": order_report,
    "sales": sales_report,
    "catalogue": catalogue_report,
}
