"""

The given tables stand in for the retail ones: ``lineitem`` for order lines
and daily sales, ``part`` for products (type as department, brand as aisle),
``orders`` and ``customer`` for orders and customers, ``documents`` for the
product catalogue and ``embeddings`` for product vectors. A returned line
(flag R) plays the reordered one. Every query reads its whole tables.
"""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketry.functions import (
    long_enough,
    mentions_or_missing,
    month_label,
    percent_text,
    strip_prefix,
    thousands_text,
    weekday_label,
    weekday_number,
)
from basketry.operators import (
    baskets,
    elasticity,
    forecast,
    profile,
    ranking,
    reorder,
    reshape,
    segments,
    series,
    similar,
)
from basketry import schemas as S
from basketry.plans import ingest, registered, report
from basketry.session import materialize, named_shared_dir, shared_dir, spread
from basketry.sources.catalog import Catalog
from basketry.sources.sink import write_table

Query = Callable[[SparkSession, str], DataFrame]

# name -> (query, SQL or None)
_REGISTERED: dict[str, tuple[Query, str | None]] = {}


def _register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        _REGISTERED[query.__name__.lstrip("_")] = (query, sql)
        return query

    return add


# --- the retail view of the given tables ---------------------------------------
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
        (F.col("l_returnflag") == "R").cast("int").alias("reordered"),
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("aisle"),
        F.col("p_type").alias("department"),
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
    )


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("store_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("sales"),
        F.col("l_extendedprice").alias("revenue"),
    )


def _by_product(
    spark: SparkSession, sf_dir: str, period: Column | None = None
) -> DataFrame:
    """Sales summed per product and day (or period), then given its brand and type."""
    sales = _sales(spark, sf_dir).select(
        F.col("item_id").alias("product_id"),
        (F.col("date") if period is None else period).alias("date"),
        "sales",
        "revenue",
    )
    totals = (
        spread(sales, ["product_id", "date"], sales.count())
        .groupBy("product_id", "date")
        .agg(F.sum("sales").alias("sales"), F.sum("revenue").alias("revenue"))
    )
    return totals.join(_products(spark, sf_dir), "product_id")


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


# --- baskets and products ---------------------------------------------------------
@_register("""
    SELECT p_name AS product_name, p_type AS department,
           count(*) AS order_count,
           round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS reorder_rate
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_name, p_type
    ORDER BY order_count DESC, product_name, department LIMIT 15
""")
def top_products(spark, sf_dir):
    top = baskets.top_products(_items(spark, sf_dir), _products(spark, sf_dir))
    return _rounded(top, reorder_rate=6)


@_register("""
    SELECT l_orderkey AS order_id, count(*) AS basket_size
    FROM lineitem GROUP BY l_orderkey
""")
def basket_size(spark, sf_dir):
    return baskets.basket_sizes(_items(spark, sf_dir))


@_register("""
    SELECT count(*) AS n, round(avg(c), 6) AS mean, round(stddev_samp(c), 6) AS std,
           min(c) AS min, quantile_cont(c, 0.25) AS p25, quantile_cont(c, 0.5) AS p50,
           quantile_cont(c, 0.75) AS p75, max(c) AS max
    FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey)
""")
def basket_describe(spark, sf_dir):
    sizes = baskets.basket_sizes(_items(spark, sf_dir))
    return _rounded(profile.describe(sizes, "basket_size"), mean=6, std=6)


@_register("""
    SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean,
           round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
           round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
           round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
           round(quantile_cont(l_extendedprice, 0.75), 4) AS p75,
           max(l_extendedprice) AS max
    FROM lineitem
""")
def price_describe(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem")
    summary = profile.describe(lines, "l_extendedprice", quantiles="ranked")
    return _rounded(summary, mean=4, std=4, p25=4, p50=4, p75=4)


@_register("""
    WITH sizes AS (SELECT least(count(*), 40)::DOUBLE AS v FROM lineitem GROUP BY l_orderkey),
         edge AS (SELECT min(v) AS lo, max(v) AS hi FROM sizes),
         slots AS (
             SELECT CASE WHEN hi > lo THEN least(floor((v - lo) * 40 / (hi - lo)), 39)
                         ELSE 0 END::INT AS bin
             FROM sizes, edge),
         filled AS (SELECT bin, count(*) AS n FROM slots GROUP BY bin)
    SELECT a.bin::INT AS bin,
           round(lo + a.bin * ((hi - lo) / 40), 6) AS bin_start,
           round(lo + (a.bin + 1) * ((hi - lo) / 40), 6) AS bin_end,
           coalesce(n, 0) AS n
    FROM (SELECT unnest(generate_series(0, 39)) AS bin) a
    CROSS JOIN edge LEFT JOIN filled f ON f.bin = a.bin
""")
def basket_histogram(spark, sf_dir):
    sizes = baskets.basket_sizes(_items(spark, sf_dir))
    bins = profile.histogram(sizes, "basket_size", bins=40, upper=40)
    return _rounded(bins, bin_start=6, bin_end=6)


@_register("""
    SELECT p_type AS department, count(*) AS n_items
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type
""")
def items_by_department(spark, sf_dir):
    return baskets.items_by(_items(spark, sf_dir), _products(spark, sf_dir))


@_register("""
    SELECT round(avg(r), 6) AS reorder_rate, round(1.0 - avg(r), 6) AS first_time_rate
    FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS r FROM lineitem)
""")
def reorder_rate(spark, sf_dir):
    rates = baskets.reorder_rate(_items(spark, sf_dir))
    return _rounded(rates, reorder_rate=6, first_time_rate=6)


@_register("""
    SELECT format('{:,}', count(*)) AS n_lines,
           printf('%.1f%%', 100 * avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END))
               AS reordered
    FROM lineitem
""")
def rate_texts(spark, sf_dir):
    items = _items(spark, sf_dir)
    rate = baskets.reorder_rate(items).select("reorder_rate").scalar()
    return profile.shape(items).select(
        thousands_text(F.col("n_rows")).alias("n_lines"),
        percent_text(rate).alias("reordered"),
    )


@_register("""
    SELECT ((dayofweek(o_orderdate) + 1) % 7)::INT AS order_dow, count(*) AS n_orders,
           ['Sat','Sun','Mon','Tue','Wed','Thu','Fri'][(dayofweek(o_orderdate) + 1) % 7 + 1]
               AS label
    FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 3
""")
def orders_by_dow(spark, sf_dir):
    dated = _orders(spark, sf_dir).select(
        weekday_number(F.col("order_date")).alias("order_dow")
    )
    return baskets.orders_by(dated, "order_dow", weekday_label)


@_register("""
    SELECT hour(ts)::INT AS order_hour_of_day, count(*) AS n_orders
    FROM events WHERE ts IS NOT NULL GROUP BY 1
""")
def orders_by_hour(spark, sf_dir):
    hours = _table(spark, sf_dir, "events").select(
        F.hour("ts").alias("order_hour_of_day")
    )
    return baskets.orders_by(hours, "order_hour_of_day")


# --- daily sales ------------------------------------------------------------------
@_register("""
    SELECT l_shipdate::DATE AS date, sum(l_quantity) AS sales FROM lineitem GROUP BY 1
""")
def daily_sales(spark, sf_dir):
    return series.daily_totals(_sales(spark, sf_dir)).orderBy("date")


@_register("""
    SELECT month(l_shipdate)::INT AS month, round(avg(l_quantity), 6) AS avg_sales,
           ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']
               [month(l_shipdate)] AS label
    FROM lineitem GROUP BY 1, 3
""")
def monthly_mean(spark, sf_dir):
    means = series.period_mean(_sales(spark, sf_dir))
    return _rounded(means, avg_sales=6).withColumn("label", month_label(F.col("month")))


@_register("""
    SELECT min(l_shipdate)::DATE AS first_date, max(l_shipdate)::DATE AS last_date,
           count(DISTINCT l_partkey) AS n_item_id, count(DISTINCT l_suppkey) AS n_store_id
    FROM lineitem
""")
def date_range_nunique(spark, sf_dir):
    return series.date_range_and_distincts(_sales(spark, sf_dir))


_DAILY_BY_PRODUCT = """
    daily AS (SELECT l_partkey AS item_id, l_shipdate::DATE AS date, sum(l_quantity) AS sales
              FROM lineitem GROUP BY 1, 2),
    span AS (SELECT item_id, min(date) AS lo, max(date) AS hi FROM daily GROUP BY 1),
    filled AS (
        SELECT d.item_id, d.date, coalesce(s.sales, 0) AS sales
        FROM (SELECT item_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date
              FROM span) d
        LEFT JOIN daily s ON s.item_id = d.item_id AND s.date = d.date)
"""


@_register("""
    WITH daily AS (SELECT p_brand AS aisle, l_shipdate::DATE AS date, sum(l_quantity) AS sales
                   FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
         span AS (SELECT aisle, min(date) AS lo, max(date) AS hi FROM daily GROUP BY 1)
    SELECT d.aisle, d.date, coalesce(s.sales, 0) AS sales
    FROM (SELECT aisle, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date
          FROM span) d
    LEFT JOIN daily s ON s.aisle = d.aisle AND s.date = d.date
""")
def zero_filled_daily(spark, sf_dir):
    daily = series.daily_totals(_by_product(spark, sf_dir), ["aisle"])
    return series.zero_fill(daily, ["aisle"])


@_register(f"""
    WITH {_DAILY_BY_PRODUCT}
    SELECT item_id, count(*) AS n_days, count_if(sales = 0)::BIGINT AS n_zero_days,
           sum(sales) AS total_sales, round(avg(sales), 6) AS avg_sales
    FROM filled GROUP BY item_id
""")
def zero_filled_summary(spark, sf_dir):
    daily = series.daily_totals(_sales(spark, sf_dir), ["item_id"])
    return _rounded(series.zero_filled_summary(daily, ["item_id"]), avg_sales=6)


@_register(f"""
    WITH {_DAILY_BY_PRODUCT}
    SELECT month(date)::INT AS month, count(*) AS n_days, round(avg(sales), 6) AS avg_sales
    FROM filled GROUP BY 1
""")
def monthly_mean_zero_filled(spark, sf_dir):
    daily = series.daily_totals(_sales(spark, sf_dir), ["item_id"])
    return _rounded(series.zero_filled_period_mean(daily, ["item_id"]), avg_sales=6)


def _lag_sql(days: int) -> str:
    return f"""CASE WHEN date - lo >= {days} THEN coalesce(
        (sum(sales) OVER (PARTITION BY item_id ORDER BY date RANGE BETWEEN
         INTERVAL {days} DAY PRECEDING AND INTERVAL {days} DAY PRECEDING)), 0) END"""


def _trailing_sql(back: int, to: int) -> str:
    return f"""CASE WHEN date - lo >= {back} THEN round(coalesce(
        (sum(sales) OVER (PARTITION BY item_id ORDER BY date RANGE BETWEEN
         INTERVAL {back} DAY PRECEDING AND INTERVAL {to} DAY PRECEDING)), 0)
        / {back - to + 1}, 6) END"""


@_register(f"""
    WITH {_DAILY_BY_PRODUCT},
         aged AS (SELECT d.*, lo FROM daily d JOIN span USING (item_id))
    SELECT item_id, date, sales,
           {_lag_sql(28)} AS lag_28, {_lag_sql(35)} AS lag_35, {_lag_sql(42)} AS lag_42,
           {_trailing_sql(34, 28)} AS mean_34_28, {_trailing_sql(55, 28)} AS mean_55_28
    FROM aged
""")
def lag_features(spark, sf_dir):
    daily = series.daily_totals(_sales(spark, sf_dir), ["item_id"])
    features = series.lag_features(daily, ["item_id"])
    return _rounded(features, mean_34_28=6, mean_55_28=6)


@_register("""
    SELECT CASE WHEN l_shipdate::DATE <= (SELECT max(l_shipdate)::DATE - 28 FROM lineitem)
                THEN 'train' ELSE 'test' END AS split,
           count(*) AS n_rows, min(l_shipdate)::DATE AS first_date,
           max(l_shipdate)::DATE AS last_date, sum(l_quantity) AS sales
    FROM lineitem GROUP BY 1
""")
def time_split(spark, sf_dir):
    sales = _sales(spark, sf_dir)
    label = series.split_label(series.last_day(sales))
    return (
        sales.withColumn("split", label)
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.sum("sales").alias("sales"),
        )
    )


# --- profiles ---------------------------------------------------------------------
_DOCUMENTS_LABELLED = """
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def _documents_labelled(spark, sf_dir):
    return _table(spark, sf_dir, "documents").join(
        _table(spark, sf_dir, "labels"), "doc_id", "left"
    )


@_register(f"""
    WITH t AS ({_DOCUMENTS_LABELLED})
    SELECT * FROM (
        SELECT 'doc_id' AS column_name, count_if(doc_id IS NULL)::BIGINT AS n_missing FROM t
        UNION ALL SELECT 'text', count_if(text IS NULL)::BIGINT FROM t
        UNION ALL SELECT 'lang', count_if(lang IS NULL)::BIGINT FROM t
        UNION ALL SELECT 'source', count_if(source IS NULL)::BIGINT FROM t
        UNION ALL SELECT 'n_chars', count_if(n_chars IS NULL)::BIGINT FROM t
        UNION ALL SELECT 'quality', count_if(quality IS NULL)::BIGINT FROM t
        UNION ALL SELECT 'toxic', count_if(toxic IS NULL)::BIGINT FROM t)
    ORDER BY n_missing DESC, column_name LIMIT 10
""")
def null_counts(spark, sf_dir):
    return profile.most_missing(_documents_labelled(spark, sf_dir), 10)


@_register("""
    SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL
    GROUP BY lang ORDER BY n DESC, lang LIMIT 20
""")
def top_categories(spark, sf_dir):
    return profile.top_values(_table(spark, sf_dir, "documents"), "lang", 20)


@_register("""
    SELECT count(*) AS n_rows, 11::INT AS n_columns FROM lineitem
""")
def table_shape(spark, sf_dir):
    return profile.shape(_table(spark, sf_dir, "lineitem"))


@_register("""
    SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate::DATE AS order_date,
           o_totalprice AS amount
    FROM orders ORDER BY o_orderkey LIMIT 5
""")
def first_rows(spark, sf_dir):
    return _orders(spark, sf_dir).orderBy("order_id").limit(5)


@_register("""
    SELECT doc_id, source, lang, quality FROM (
        SELECT d.doc_id, source, lang, quality
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    WHERE source IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL
    ORDER BY (doc_id % 65521) * 40503 % 65521, doc_id LIMIT 5
""")
def sample_hash(spark, sf_dir):
    columns = ["doc_id", "source", "lang", "quality"]
    return profile.sample_by_key(
        _documents_labelled(spark, sf_dir), columns, "doc_id", 5
    )


@_register()
def sample_random(spark, sf_dir):
    columns = ["doc_id", "source", "lang", "quality"]
    return profile.sample_rows(_documents_labelled(spark, sf_dir), columns, 5, seed=42)


@_register("""
    SELECT least(5, count(*)) AS n_rows, least(5, count(*)) AS n_distinct, true AS complete
    FROM documents JOIN labels USING (doc_id)
    WHERE source IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL
""")
def sample_random_checks(spark, sf_dir):
    """Facts of a random sample: distinct complete rows of the table."""
    columns = ["doc_id", "source", "lang", "quality"]
    table = _documents_labelled(spark, sf_dir)
    picked = profile.sample_rows(table, columns, 5, seed=42)
    complete = F.lit(True)
    for column in columns:
        complete = complete & F.col(column).isNotNull()
    return picked.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("doc_id").alias("n_distinct"),
        F.bool_and(complete).alias("complete"),
    )


# --- filters, projections, reshape, joins, unions -------------------------------------
@_register("""
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'O'
""")
def filtered_sales(spark, sf_dir):
    chosen = {"l_returnflag": "R", "l_linestatus": "O", "l_suppkey": ""}
    sales = _table(spark, sf_dir, "lineitem")
    for column, value in chosen.items():
        if value:  # an empty choice is no filter
            sales = sales.where(F.col(column) == F.lit(value))
    return sales.select("l_orderkey", "l_partkey", "l_quantity")


@_register("""
    SELECT doc_id, length(text)::INT AS name_length FROM documents WHERE length(text) >= 500
""")
def name_length_filter(spark, sf_dir):
    text = F.col("text")
    documents = _table(spark, sf_dir, "documents").where(long_enough(text, 500))
    return documents.select("doc_id", F.length(text).alias("name_length"))


@_register("""
    SELECT doc_id, lang, source FROM documents
    WHERE text IS NOT NULL AND lang IS NOT NULL AND (source IS NULL OR source ILIKE '%SRC1%')
""")
def region_filter(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").where(
        F.col("text").isNotNull()
        & F.col("lang").isNotNull()
        & mentions_or_missing(F.col("source"), "SRC1")
    )
    return documents.select("doc_id", "lang", "source")


@_register("""
    SELECT l_partkey AS item_id, 'd_' || month(l_shipdate) AS day,
           month(l_shipdate)::SMALLINT AS day_num, sum(l_quantity) AS sales
    FROM lineitem GROUP BY 1, 2, 3 HAVING sum(l_quantity) > 0
""")
def melt_nonzero(spark, sf_dir):
    months = list(range(1, 13))
    wide = (
        _sales(spark, sf_dir)
        .withColumn("month", F.month("date"))
        .groupBy("item_id")
        .pivot("month", months)
        .agg(F.sum("sales"))
        .toDF("item_id", *[f"d_{m}" for m in months])
    )
    days = reshape.prefixed(wide.columns, "d_")
    long = reshape.wide_to_long(wide, ["item_id"], days).where(F.col("sales") > 0)
    number = strip_prefix(F.col("day"), "d_").cast("smallint")
    return long.withColumn("day_num", number)


@_register("""
    WITH calendar AS (SELECT DISTINCT o_orderdate::DATE AS day, dayofweek(o_orderdate)::INT + 1
                             AS wday, year(o_orderdate)::INT AS year FROM orders),
         daily AS (SELECT l_shipdate::DATE AS day, sum(l_quantity) AS sales
                   FROM lineitem GROUP BY 1)
    SELECT daily.day, sales, wday::DOUBLE AS wday, year::DOUBLE AS year FROM daily LEFT JOIN calendar USING (day)
""")
def calendar_left_join(spark, sf_dir):
    date = F.col("d")
    calendar = (
        _orders(spark, sf_dir)
        .select(F.col("order_date").alias("d"))
        .distinct()
        .select(
            "d",
            F.dayofweek(date).cast("double").alias("wday"),
            F.year(date).cast("double").alias("year"),
        )
    )
    daily = series.daily_totals(_sales(spark, sf_dir)).withColumnRenamed("date", "day")
    return daily.join(calendar.withColumnRenamed("d", "day"), "day", "left")


@_register("""
    SELECT c_custkey, c_name, n_name, r_name FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def dimension_join(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    return (
        _table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "n_name", "r_name")
    )


@_register("""
    SELECT part, count(*) AS n_rows, sum(l_quantity) AS quantity FROM (
        SELECT 'prior' AS part, l_quantity FROM lineitem WHERE l_shipdate < DATE '1999-01-01'
        UNION ALL
        SELECT 'train' AS part, l_quantity FROM lineitem WHERE l_shipdate >= DATE '1999-01-01')
    GROUP BY part
""")
def union_items(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_quantity", "l_shipdate")
    cut = F.lit("1999-01-01").cast("date")
    prior = lines.where(F.col("l_shipdate") < cut)
    train = lines.where(F.col("l_shipdate") >= cut).select("l_shipdate", "l_quantity")
    both = prior.withColumn("part", F.lit("prior")).unionByName(
        train.withColumn("part", F.lit("train"))
    )
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")
    )


@_register("""
    SELECT o_orderkey AS order_id,
           ((dayofweek(o_orderdate) + 1) % 7)::TINYINT AS order_dow,
           replace('d_' || dayofyear(o_orderdate), 'd_', '')::SMALLINT AS day_num,
           o_orderdate::DATE AS date, month(o_orderdate)::TINYINT AS month
    FROM orders
""")
def narrow_casts(spark, sf_dir):
    date = F.col("order_date")
    day = F.concat(F.lit("d_"), F.dayofyear(date))
    return _orders(spark, sf_dir).select(
        "order_id",
        weekday_number(date).cast("tinyint").alias("order_dow"),
        strip_prefix(day, "d_").cast("smallint").alias("day_num"),
        date.alias("date"),
        F.month(date).cast("tinyint").alias("month"),
    )


@_register("""
    SELECT p_type AS department, sum(l_quantity)::BIGINT AS total_sales
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 2 DESC
""")
def group_sum_sql(spark, sf_dir):
    folder = sf_dir.rstrip("/")
    return Catalog(spark, folder).query(
        f"""
        SELECT p.p_type AS department, CAST(SUM(i.l_quantity) AS BIGINT) AS total_sales
        FROM parquet.`{folder}/lineitem.parquet` i
        JOIN parquet.`{folder}/part.parquet` p ON i.l_partkey = p.p_partkey
        GROUP BY 1 ORDER BY 2 DESC
        """
    )


# --- customers ----------------------------------------------------------------------
_RFM_SQL = """
    SELECT o_custkey AS user_id,
           ((SELECT max(o_orderdate)::DATE FROM orders) - max(o_orderdate)::DATE)::INT
               AS recency_days,
           count(*) AS frequency, round(sum(o_totalprice), 2) AS monetary
    FROM orders GROUP BY o_custkey
"""


def _rfm(spark, sf_dir):
    return _rounded(segments.rfm(_orders(spark, sf_dir)), monetary=2)


@_register(_RFM_SQL)
def rfm(spark, sf_dir):
    return _rfm(spark, sf_dir)


@_register(f"""
    WITH t AS ({_RFM_SQL})
    SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, user_id)::INT AS r_score,
           ntile(5) OVER (ORDER BY frequency, user_id)::INT AS f_score,
           ntile(5) OVER (ORDER BY monetary, user_id)::INT AS m_score
    FROM t
""")
def rfm_scores(spark, sf_dir):
    return segments.rfm_scores(_rfm(spark, sf_dir))


@_register("""
    SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate::DATE AS order_date,
           (o_orderdate::DATE - lag(o_orderdate::DATE) OVER (
               PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))::DOUBLE
               AS days_since_prior_order
    FROM orders
""")
def order_gap(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("order_id", "user_id", "order_date")
    seen = ranking.with_previous(
        orders, ["user_id"], ["order_date", "order_id"], "order_date", "_before_date"
    )
    gap = F.datediff("order_date", "_before_date").cast("double")
    return seen.withColumn("days_since_prior_order", gap).drop("_before_date")


@_register()
def segments_kmeans(spark, sf_dir):
    table = materialize(_rfm(spark, sf_dir))
    model = segments.fit_segments(table, k=4)
    return segments.assign_segments(model, table).drop("features")


@_register("""
    SELECT count(DISTINCT o_custkey) AS n_customers, count(DISTINCT o_custkey) AS n_rows,
           4::BIGINT AS n_segments, true AS nearest_centre FROM orders
""")
def segments_kmeans_checks(spark, sf_dir):
    """Facts of the segmentation: each customer once, at the nearest centre."""
    table = materialize(_rfm(spark, sf_dir))
    model = segments.fit_segments(table, k=4)
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    assigned = segments.assign_segments(model, table).withColumn(
        "_at", vector_to_array("features")
    )
    gaps = F.array(
        *[
            F.aggregate(
                F.zip_with("_at", F.lit(c), lambda x, y: (x - y) * (x - y)),
                F.lit(0.0),
                lambda acc, x: acc + x,
            )
            for c in centres
        ]
    )
    own = F.element_at("_gaps", F.col("segment") + 1)
    return assigned.withColumn("_gaps", gaps).agg(
        F.count_distinct("user_id").alias("n_customers"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("segment").alias("n_segments"),
        F.bool_and(own <= F.array_min("_gaps") + 1e-9).alias("nearest_centre"),
    )


@_register("""
    SELECT count(DISTINCT o_custkey) AS n_customers, true AS best_is_taken, 5::BIGINT AS n_tried FROM orders
""")
def segments_chosen(spark, sf_dir):
    """Facts of the segmentation whose number of segments has the best silhouette."""
    table = materialize(_rfm(spark, sf_dir))
    model, found = segments.choose_segments(table)
    assigned = segments.assign_segments(model, table)
    best = max(found.values())
    own = len(model.stages[-1].clusterCenters())
    return assigned.agg(F.count_distinct("user_id").alias("n_customers")).withColumns(
        {"best_is_taken": F.lit(found[own] == best), "n_tried": F.lit(len(found)).cast("long")}
    )


def _numbered_orders(spark, sf_dir):
    return ranking.with_number_in_group(
        _orders(spark, sf_dir).select("order_id", "user_id", "order_date"),
        ["user_id"],
        ["order_date", "order_id"],
        "order_number",
    )


def _brand_items(spark, sf_dir):
    """Order lines with the brand as the product: customers do come back to it."""
    brands = _products(spark, sf_dir).select("product_id", "aisle")
    items = _items(spark, sf_dir).join(brands, "product_id")
    return items.select("order_id", F.col("aisle").alias("product_id"))


@_register("""
    WITH numbered AS (
             SELECT o_orderkey, o_custkey AS user_id,
                    row_number() OVER (PARTITION BY o_custkey
                                       ORDER BY o_orderdate, o_orderkey)::INT AS num,
                    count(*) OVER (PARTITION BY o_custkey)::INT AS last
             FROM orders),
         bought AS (
             SELECT user_id, p_brand AS product_id, last,
                    count(DISTINCT CASE WHEN num < last THEN num END) AS times_bought,
                    max(CASE WHEN num < last THEN num END) AS recent,
                    max((num = last)::INT) AS again,
                    max(max((num = last)::INT)) OVER (PARTITION BY user_id) AS told
             FROM lineitem JOIN part ON l_partkey = p_partkey
             JOIN numbered ON l_orderkey = o_orderkey
             GROUP BY 1, 2, 3)
    SELECT user_id, product_id, times_bought,
           round(times_bought / (last - 1), 6) AS order_share,
           last - recent AS orders_since, last - 1 AS n_orders,
           CASE WHEN told = 1 THEN again END AS label
    FROM bought WHERE times_bought > 0
""")
def reorder_features(spark, sf_dir):
    features = reorder.reorder_features(
        _numbered_orders(spark, sf_dir), _brand_items(spark, sf_dir)
    )
    return _rounded(features, order_share=6)


_NUMBERED_SQL = """
    SELECT o_orderkey, o_custkey AS user_id,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS num,
           count(*) OVER (PARTITION BY o_custkey)::INT AS last
    FROM orders
"""


@_register(f"""
    WITH numbered AS ({_NUMBERED_SQL}),
         lines AS (
             SELECT user_id, p_brand AS product_id, o_orderkey, num, last
             FROM lineitem JOIN part ON l_partkey = p_partkey
             JOIN numbered ON l_orderkey = o_orderkey),
         known AS (SELECT user_id, bool_or(num = last) AS told FROM lines GROUP BY 1),
         bought AS (
             SELECT user_id, product_id, max((num = last)::INT) AS again
             FROM lines GROUP BY 1, 2 HAVING count_if(num < last) > 0)
    SELECT CASE WHEN told THEN again END AS label, count(*) AS n
    FROM bought JOIN known USING (user_id) GROUP BY 1
""")
def reorder_labels(spark, sf_dir):
    """How many pairs come back, or do not, or have a last order without lines."""
    features = reorder.reorder_features(_numbered_orders(spark, sf_dir), _brand_items(spark, sf_dir))
    return features.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@_register(f"""
    WITH numbered AS ({_NUMBERED_SQL}),
         lines AS (
             SELECT user_id, p_brand AS product_id, num, last
             FROM lineitem JOIN part ON l_partkey = p_partkey
             JOIN numbered ON l_orderkey = o_orderkey),
         done AS (SELECT user_id, CASE WHEN bool_or(num = last) THEN max(last)
                                       ELSE max(last) - 1 END AS n_orders
                  FROM lines GROUP BY 1)
    SELECT user_id, product_id, count(DISTINCT num) AS times_bought,
           round(count(DISTINCT num) / n_orders, 6) AS order_share,
           n_orders + 1 - max(num) AS orders_since, n_orders
    FROM lines JOIN done USING (user_id) GROUP BY user_id, product_id, n_orders
""")
def next_order_features(spark, sf_dir):
    features = reorder.next_order_features(
        _numbered_orders(spark, sf_dir), _brand_items(spark, sf_dir)
    )
    return _rounded(features, order_share=6)


def _reorder_fit(spark, sf_dir):
    orders, items = _numbered_orders(spark, sf_dir), _brand_items(spark, sf_dir)
    placed = materialize(reorder.purchases(orders, items))
    features = materialize(reorder.reorder_features(orders, items, placed=placed))
    fits, tests = reorder.split_customers(features)
    upcoming = reorder.next_order_features(orders, items, placed=placed)
    return reorder.fit_reorder_model(fits), fits, tests, upcoming


@_register()
def reorder_model(spark, sf_dir):
    """Probabilities for every customer's next order."""
    model, _, _, upcoming = _reorder_fit(spark, sf_dir)
    return reorder.score_reorders(model, upcoming)


@_register(f"""
    WITH numbered AS ({_NUMBERED_SQL}),
         lines AS (SELECT DISTINCT user_id, p_brand AS product_id
                   FROM lineitem JOIN part ON l_partkey = p_partkey
                   JOIN numbered ON l_orderkey = o_orderkey)
    SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
           true AS in_range, true AS beats_chance FROM lines
""")
def reorder_model_checks(spark, sf_dir):
    """Facts of the model: a score per pair; held-out customers better than chance."""
    model, _, tests, upcoming = _reorder_fit(spark, sf_dir)
    scored = reorder.score_reorders(model, upcoming)
    area = reorder.area_under_roc(model.transform(tests))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("user_id").alias("n_users"),
        F.bool_and(F.col("reorder_probability").between(0, 1)).alias("in_range"),
    ).withColumn("beats_chance", F.lit(area > 0.5))


@_register(f"""
    WITH numbered AS ({_NUMBERED_SQL}),
         lines AS (SELECT DISTINCT user_id, p_brand AS product_id
                   FROM lineitem JOIN part ON l_partkey = p_partkey
                   JOIN numbered ON l_orderkey = o_orderkey)
    SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, true AS in_range,
           true AS calibrated, true AS not_below_logistic FROM lines
""")
def reorder_trees_checks(spark, sf_dir):
    """Facts of the boosted trees: a probability per pair, whose mean on held-out
    customers is near their rate; they rank these no worse than the logistic model,
    by more than two standard errors of an area at this number of rows."""
    line, fits, tests, upcoming = _reorder_fit(spark, sf_dir)
    trees = reorder.fit_reorder_trees(fits)
    area = reorder.area_under_roc(trees.trees.transform(tests))
    told, real, n = trees.score(tests).agg(
        F.avg("reorder_probability"), F.avg("label"), F.count(F.lit(1))
    ).first()
    rarer = n * min(real, 1 - real)
    least = reorder.area_under_roc(line.transform(tests)) - 2 * (0.25 / max(rarer, 1)) ** 0.5
    return trees.score(upcoming).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("user_id").alias("n_users"),
        F.bool_and(F.col("reorder_probability").between(0, 1)).alias("in_range"),
    ).withColumns(
        {"calibrated": F.lit(abs(told - real) < 0.1), "not_below_logistic": F.lit(area >= least)}
    )


@_register()
def reorder_trees(spark, sf_dir):
    """Calibrated probabilities of the boosted trees for every customer's next order."""
    orders, items = _numbered_orders(spark, sf_dir), _brand_items(spark, sf_dir)
    placed = materialize(reorder.purchases(orders, items))
    features = materialize(reorder.reorder_features(orders, items, placed=placed))
    fits, _ = reorder.split_customers(features)
    return reorder.fit_reorder_trees(fits).score(
        reorder.next_order_features(orders, items, placed=placed)
    )


# --- prices -------------------------------------------------------------------------
_POINTS_SQL = """
    SELECT {keys}, ln(sum(l_quantity)) AS q,
           ln(sum(l_extendedprice) / sum(l_quantity)) AS p
    FROM lineitem JOIN part ON l_partkey = p_partkey {more}
    GROUP BY ALL HAVING sum(l_quantity) > 0 AND sum(l_extendedprice) > 0
"""


def _monthly(spark, sf_dir):
    return _by_product(spark, sf_dir, F.trunc("date", "month"))


@_register(f"""
    WITH points AS ({_POINTS_SQL.format(
        keys="p_type AS department, l_partkey, date_trunc('month', l_shipdate) AS m", more="")})
    SELECT department, round(regr_slope(q, p), 6) AS elasticity,
           round(regr_intercept(q, p), 5) AS intercept, round(regr_r2(q, p), 6) AS r2,
           regr_count(q, p)::BIGINT AS n_points
    FROM points GROUP BY department
""")
def own_elasticity(spark, sf_dir):
    points = elasticity.price_points(
        _monthly(spark, sf_dir), ["department", "product_id", "date"], "sales"
    )
    fitted = elasticity.own_elasticity(points, ["department"])
    return _rounded(fitted, elasticity=6, intercept=5, r2=6)


@_register(f"""
    WITH points AS ({_POINTS_SQL.format(
        keys="p_type AS department, date_trunc('month', l_shipdate) AS m", more="")})
    SELECT a.department, b.department AS driver,
           round(regr_slope(a.q, b.p), 5) AS elasticity,
           regr_count(a.q, b.p)::BIGINT AS n_points
    FROM points a JOIN points b ON a.m = b.m AND a.department <> b.department
    GROUP BY 1, 2
""")
def cross_elasticity(spark, sf_dir):
    points = elasticity.price_points(
        _monthly(spark, sf_dir), ["department", "date"], "sales"
    )
    # the product table knows the departments; no need to look through the sales
    departments = _products(spark, sf_dir).select("department").distinct()
    drivers = sorted(r.department for r in departments.toLocalIterator())
    fitted = elasticity.cross_elasticity(points, "department", "date", drivers)
    return _rounded(fitted, elasticity=5)


@_register(f"""
    WITH points AS ({_POINTS_SQL.format(
        keys='''c_mktsegment AS segment, p_type AS department, l_partkey,
                date_trunc('month', l_shipdate) AS m''',
        more='''JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey''')})
    SELECT segment, department, round(regr_slope(q, p), 6) AS elasticity,
           round(regr_intercept(q, p), 5) AS intercept, round(regr_r2(q, p), 6) AS r2,
           regr_count(q, p)::BIGINT AS n_points
    FROM points GROUP BY segment, department
""")
def segment_elasticity(spark, sf_dir):
    segment = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )
    placed = _orders(spark, sf_dir).join(segment, "user_id").select("order_id", "segment")
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.trunc("l_shipdate", "month").alias("date"),
        "l_quantity",
        "l_extendedprice",
    )
    n_lines = lines.count()
    by = ["segment", "product_id", "date"]
    bought = (
        spread(spread(lines, ["order_id"], n_lines).join(placed, "order_id"), by, n_lines)
        .groupBy(*by)
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.sum("l_extendedprice").alias("revenue"),
        )
        .join(_products(spark, sf_dir), "product_id")
    )
    keys = ["segment", "department"]
    points = elasticity.price_points(bought, [*keys, "product_id", "date"])
    fitted = elasticity.own_elasticity(points, keys)
    return _rounded(fitted, elasticity=6, intercept=5, r2=6)


# --- similarity ---------------------------------------------------------------------
_COSINE_SQL = """
    SELECT c.vec_id AS product_id, c.label AS category,
           round(list_cosine_similarity(c.embedding::DOUBLE[], t.embedding::DOUBLE[]), 5)
               AS similarity
    FROM embeddings c JOIN (SELECT * FROM embeddings WHERE vec_id = 0) t
         ON c.vec_id <> t.vec_id {more}
    ORDER BY list_cosine_similarity(c.embedding::DOUBLE[], t.embedding::DOUBLE[]) DESC,
             c.vec_id LIMIT 10
"""


def _vectors(spark, sf_dir):
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("product_id"), F.col("label").alias("category"), "embedding"
    )


@_register(_COSINE_SQL.format(more=""))
def similar_topk(spark, sf_dir):
    return _rounded(similar.similar_to(_vectors(spark, sf_dir), 0, 10), similarity=5)


@_register(_COSINE_SQL.format(more="AND c.label = t.label"))
def substitutes(spark, sf_dir):
    return _rounded(similar.substitutes(_vectors(spark, sf_dir), 0, 10), similarity=5)


# --- demand -------------------------------------------------------------------------
# application and folder -> fitted model, so that queries of one session share a fit
_FORECASTERS: dict[tuple[str, str], object] = {}


def _department_forecast(spark, sf_dir):
    """The forecast of departments for the next 28 days; the model has the declared defaults.

    Fitting its 400 trees takes minutes, so a session fits it once per folder. The
    sales are summed once; all else reads a stored row per department and day.
    """
    keys = ["department"]
    last = F.lit(_sales(spark, sf_dir).agg(F.max("date")).first()[0]).cast("date")
    daily = materialize(series.daily_totals(_by_product(spark, sf_dir), keys))
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _FORECASTERS:
        train, _ = series.time_split(forecast.training_frame(daily, keys, last), last)
        _FORECASTERS[name] = forecast.fit_forecaster(forecast.stored_frame(train))
    return forecast.forecast(_FORECASTERS[name], forecast.future_frame(daily, keys, last), keys)


@_register()
def demand_forecast(spark, sf_dir):
    return _rounded(_department_forecast(spark, sf_dir), forecast=4)


@_register("""
    SELECT p_type AS department, 28::BIGINT AS n_days,
           (SELECT max(l_shipdate)::DATE + 1 FROM lineitem) AS first_day,
           (SELECT max(l_shipdate)::DATE + 28 FROM lineitem) AS last_day, true AS none_negative
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def baseline_days(spark, sf_dir):
    """The baseline has all 28 days of every series, days without sales too."""
    daily = series.daily_totals(_by_product(spark, sf_dir), ["department", "product_id"])
    last = series.last_day(_sales(spark, sf_dir))
    ahead = forecast.seasonal_naive(daily, ["department", "product_id"], last)
    per_day = ahead.groupBy("department", "date").agg(F.min("forecast").alias("least"))
    return per_day.groupBy("department").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.bool_and(F.col("least") >= 0).alias("none_negative"),
    )


@_register("""
    SELECT p_type AS department, 28::BIGINT AS n_days, 28::BIGINT AS n_distinct,
           true AS none_negative
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def forecast_days(spark, sf_dir):
    """The forecast has all 28 days of every series."""
    ahead = _department_forecast(spark, sf_dir)
    return ahead.groupBy("department").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_distinct("date").alias("n_distinct"),
        F.bool_and(F.col("forecast") >= 0).alias("none_negative"),
    )


@_register("""
    WITH last AS (SELECT max(l_shipdate)::DATE AS d FROM lineitem),
         daily AS (SELECT p_type AS department, l_shipdate::DATE AS date,
                          sum(l_quantity) AS sales
                   FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
         spine AS (SELECT department, min(date) AS lo FROM daily GROUP BY 1),
         ahead AS (SELECT department, lo,
                          (SELECT d FROM last) + unnest(generate_series(1, 28))::INT AS date
                   FROM spine)
    SELECT a.department, a.date,
           CASE WHEN a.date - lo >= 28 THEN coalesce(
               (SELECT sum(sales) FROM daily s WHERE s.department = a.department
                AND s.date = a.date - 28), 0) END AS lag_28,
           CASE WHEN a.date - lo >= 55 THEN round(coalesce(
               (SELECT sum(sales) FROM daily s WHERE s.department = a.department
                AND s.date BETWEEN a.date - 55 AND a.date - 28), 0) / 28, 6) END AS mean_55_28
    FROM ahead a
""")
def future_features(spark, sf_dir):
    keys = ["department"]
    last = series.last_day(_sales(spark, sf_dir))
    daily = series.daily_totals(_by_product(spark, sf_dir), keys)
    future = forecast.future_frame(daily, keys, last)
    return _rounded(
        future.select(*keys, "date", "lag_28", "mean_55_28"), mean_55_28=6
    )


@_register("""
    WITH demand AS (
        SELECT l_partkey AS product_id, sum(l_quantity) AS demand FROM lineitem
        WHERE l_shipdate::DATE > (SELECT max(l_shipdate)::DATE - 28 FROM lineitem)
        GROUP BY 1)
    SELECT product_id, demand, p_size AS on_hand, demand - p_size AS shortfall
    FROM demand LEFT JOIN part ON p_partkey = product_id WHERE demand > p_size
""")
def stockout_risk(spark, sf_dir):
    sales = _sales(spark, sf_dir).withColumnRenamed("item_id", "product_id")
    daily = series.daily_totals(sales, ["product_id"])
    ahead = forecast.seasonal_naive(daily, ["product_id"], series.last_day(sales))
    stock = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_size").alias("on_hand")
    )
    return forecast.stockout_risk(ahead, stock, ["product_id"])


@_register("""
    WITH recent AS (SELECT l_partkey AS product_id, l_quantity, l_returnflag FROM lineitem
                    WHERE l_shipdate::DATE > (SELECT max(l_shipdate)::DATE - 28 FROM lineitem)),
         demand AS (SELECT product_id, sum(l_quantity) AS demand,
                           coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS on_hand
                    FROM recent GROUP BY 1)
    SELECT product_id, demand, on_hand, demand - on_hand AS shortfall FROM demand WHERE demand > on_hand
""")
def stockout_unknown_stock(spark, sf_dir):
    """With recent returns as the stock: products without one count as having none."""
    sales = _sales(spark, sf_dir).withColumnRenamed("item_id", "product_id")
    daily, last = series.daily_totals(sales, ["product_id"]), series.last_day(sales)
    ahead = forecast.seasonal_naive(daily, ["product_id"], last)
    returned = _table(spark, sf_dir, "lineitem").where(
        (F.col("l_returnflag") == "R") & (F.to_date("l_shipdate") > F.date_sub(last, 28))
    )
    stock = returned.groupBy(F.col("l_partkey").alias("product_id")).agg(F.sum("l_quantity").alias("on_hand"))
    return forecast.stockout_risk(ahead, stock, ["product_id"])


def _department_stock(spark, sf_dir):
    """Stock by department: a third of the sizes, the rest is not on the shelf."""
    parts = _table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("department"))
    return parts.agg(F.expr("sum(p_size) div 3").alias("on_hand"))


@_register()
def stockout_forecast(spark, sf_dir):
    """Departments whose forecast demand of 28 days exceeds what is on hand."""
    ahead = _department_forecast(spark, sf_dir)
    risky = forecast.stockout_risk(ahead, _department_stock(spark, sf_dir), ["department"])
    return _rounded(risky, demand=4, shortfall=4)


@_register("""
    SELECT p_type AS department, (sum(p_size) // 3)::BIGINT AS on_hand, true AS agrees
    FROM part WHERE p_type IN (SELECT p_type FROM part JOIN lineitem ON l_partkey = p_partkey) GROUP BY 1
""")
def stockout_forecast_checks(spark, sf_dir):
    """Facts: a department is at risk exactly if its forecast exceeds its stock, by as much."""
    ahead = materialize(_department_forecast(spark, sf_dir))
    stock = _department_stock(spark, sf_dir)
    risky = forecast.stockout_risk(ahead, stock, ["department"])
    sums = ahead.groupBy("department").agg(F.sum("forecast").alias("sum")).join(stock, "department")
    both = sums.join(risky.select("department", "shortfall"), "department", "left")
    short = F.when(F.col("sum") > F.col("on_hand"), F.col("sum") - F.col("on_hand"))
    agrees = F.coalesce(F.abs(short - F.col("shortfall")) < 1e-6, short.isNull() & F.col("shortfall").isNull())
    return both.select("department", "on_hand", agrees.alias("agrees"))


# --- raw files: the given tables written as text, then built into tables ---------------
def _raw_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}"


def _write_text(df: DataFrame, path: str, sep: str = ",", **options) -> str:
    df.write.options(
        sep=sep,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        **options,
    ).csv(path)
    return path


@_register("""
    SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS eval_set,
           year(o_orderdate)::INT AS order_number,
           ((dayofweek(o_orderdate) + 1) % 7)::TINYINT AS order_dow,
           month(o_orderdate)::TINYINT AS order_hour_of_day,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END
               AS days_since_prior_order
    FROM orders
""")
def ingest_orders(spark, sf_dir):
    raw = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("eval_set"),
        F.year("o_orderdate").alias("order_number"),
        weekday_number(F.col("o_orderdate")).alias("order_dow"),
        F.month("o_orderdate").alias("order_hour_of_day"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
        .alias("days_since_prior_order"),
    )
    path = _write_text(raw, f"{_raw_folder(spark)}/orders.csv")
    return ingest.build_orders(spark, path)


@_register("""
    SELECT p_partkey AS product_id, p_name AS product_name,
           (dense_rank() OVER (ORDER BY p_brand))::INT AS aisle_id,
           (dense_rank() OVER (ORDER BY p_type))::INT AS department_id,
           p_brand AS aisle, p_type AS department
    FROM part
""")
def ingest_products(spark, sf_dir):
    folder = _raw_folder(spark)
    part = _table(spark, sf_dir, "part")
    coded = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        "p_brand",
        "p_type",
    )
    for column, name in (("p_brand", "aisle"), ("p_type", "department")):
        distinct = part.select(F.col(column).alias(name)).distinct()
        names = ranking.with_row_number(distinct, [name], f"{name}_id")
        coded = coded.join(names, F.col(column) == F.col(name)).drop(column, name)
        _write_text(names, f"{folder}/{name}s.csv")
    _write_text(coded, f"{folder}/products.csv")
    files = [f"{folder}/{n}.csv" for n in ("products", "aisles", "departments")]
    return ingest.build_products(spark, *files)


@_register("""
    SELECT l_orderkey AS order_id, l_partkey AS product_id,
           l_linenumber::SMALLINT AS add_to_cart_order,
           (l_returnflag = 'R')::TINYINT AS reordered
    FROM lineitem
""")
def ingest_order_items(spark, sf_dir):
    folder = _raw_folder(spark)
    lines = _items(spark, sf_dir)
    names = lines.columns
    _write_text(lines.where("reordered = 1"), f"{folder}/prior.csv")
    # the second file has its columns the other way round
    later = lines.where("reordered = 0").select(*reversed(names))
    _write_text(later, f"{folder}/train.csv")
    files = [f"{folder}/{n}.csv" for n in ("prior", "train", "absent")]
    return ingest.build_order_items(spark, files)


@_register("""
    WITH cal AS (SELECT 'd_' || day(o_orderdate) AS day, min(o_orderdate)::DATE AS date
                 FROM orders GROUP BY 1),
         sold AS (SELECT l_partkey, 'd_' || day(l_shipdate) AS day,
                         day(l_shipdate) AS num, sum(l_quantity) AS sales
                  FROM lineitem GROUP BY 1, 2, 3 HAVING sum(l_quantity) > 0)
    SELECT p_partkey || '_' || p_brand AS id, p_partkey::VARCHAR AS item_id,
           p_brand AS dept_id, p_type AS cat_id, p_size::VARCHAR AS store_id,
           p_name AS state_id, day, sales::INT AS sales, num::SMALLINT AS day_num, date,
           dayofweek(date)::INT + 1 AS wday, month(date)::INT AS month,
           year(date)::INT AS year,
           CASE WHEN num = 25 THEN 'Payday' END AS event_name_1, (num % 2)::INT AS snap_CA
    FROM sold JOIN part ON p_partkey = l_partkey LEFT JOIN cal USING (day)
""")
def ingest_sales(spark, sf_dir):
    folder = _raw_folder(spark)
    paths = f"{folder}/sales.csv", f"{folder}/calendar.csv"
    _write_raw_sales(spark, sf_dir, *paths)
    return ingest.build_daily_sales(spark, *paths)


def _write_raw_sales(spark, sf_dir, sales_path, calendar_path):
    """Sales by day of the month as a wide file, and the calendar of these days."""
    numbers = list(range(1, 32))
    by_day = (
        _sales(spark, sf_dir)
        .withColumn("day", F.dayofmonth("date"))
        .groupBy("item_id")
        .pivot("day", numbers)
        .agg(F.coalesce(F.sum("sales"), F.lit(0)).cast("int"))
        .na.fill(0)
        .toDF("p_partkey", *[f"d_{n}" for n in numbers])
    )
    wide = _table(spark, sf_dir, "part").join(by_day, "p_partkey").select(
        F.concat_ws("_", "p_partkey", "p_brand").alias("id"),
        F.col("p_partkey").alias("item_id"),
        F.col("p_brand").alias("dept_id"),
        F.col("p_type").alias("cat_id"),
        F.col("p_size").alias("store_id"),
        F.col("p_name").alias("state_id"),
        *[f"d_{n}" for n in numbers],
    )
    date = F.col("date")
    number = F.col("number")
    calendar = (
        _orders(spark, sf_dir)
        .groupBy(F.dayofmonth("order_date").alias("number"))
        .agg(F.min("order_date").alias("date"))
        .select(
            "date",
            F.year(date).alias("year"),
            F.month(date).alias("month"),
            F.dayofweek(date).alias("wday"),
            F.concat(F.lit("d_"), number).alias("d"),
            F.when(number == 25, "Payday").alias("event_name_1"),
            (number % 2).alias("snap_CA"),
        )
    )
    _write_text(wide, sales_path)
    _write_text(calendar, calendar_path)


@_register("""
    SELECT lpad(doc_id::VARCHAR, 13, '0') AS code, md5(text) AS name_md5,
           length(text)::INT AS name_length, source AS countries_en, lang AS categories_en,
           n_chars::DOUBLE AS fat_100g
    FROM documents WHERE source ILIKE '%src1%' AND text IS NOT NULL AND lang IS NOT NULL
""")
def ingest_catalogue(spark, sf_dir):
    path = f"{_raw_folder(spark)}/catalogue.csv"
    _write_raw_catalogue(spark, sf_dir, path, F.col("source"))
    built = ingest.build_catalogue(spark, path, country="SRC1")
    name = F.col("product_name")
    return built.select(
        "code",
        F.md5(name).alias("name_md5"),
        F.length(name).alias("name_length"),
        "countries_en",
        "categories_en",
        "fat_100g",
    )


def _write_raw_catalogue(spark, sf_dir, path, countries):
    documents = _table(spark, sf_dir, "documents")
    known = {
        "code": F.lpad(F.col("doc_id").cast("string"), 13, "0"),
        "product_name": F.col("text"),
        "categories_en": F.col("lang"),
        "countries_en": countries,
        "fat_100g": F.col("n_chars"),
    }
    raw = documents.select(
        F.lit("not wanted").alias("creator"),
        *[
            known.get(n, F.lit(None)).cast("string").alias(n)
            for n in S.CATALOGUE_SCHEMA.names
        ],
    )
    _write_text(raw, path, sep="\t", compression="gzip")


# --- stored tables: written from the given ones, then loaded with filters --------------
@_register("""
    SELECT l_partkey::VARCHAR AS item_id, p_type AS cat_id, l_linestatus AS store_id,
           l_shipdate::DATE AS date, sum(l_quantity)::INT AS sales
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_type = 'PROMO' AND l_linestatus = 'O' GROUP BY 1, 2, 3, 4
""")
def load_sales(spark, sf_dir):
    """Partitioned write, then the loader with both of its filters."""
    sold = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_partkey").alias("product_id"),
            F.col("l_linestatus").alias("store_id"),
            F.to_date("l_shipdate").alias("date"),
        )
        .agg(F.sum("l_quantity").cast("int").alias("sales"))
        .join(_products(spark, sf_dir), "product_id")
        .select(
            F.col("product_id").cast("string").alias("item_id"),
            F.col("department").alias("cat_id"),
            "store_id",
            "date",
            "sales",
        )
    )
    root = _raw_folder(spark)
    stored = Catalog(spark, root)
    write_table(sold, stored.path(S.DAILY_SALES), S.DAILY_SALES_PARTITIONS)
    return stored.load_m5_sales(category="PROMO", store_id="O")


@_register("""
    SELECT doc_id::VARCHAR AS code, length(text)::INT AS name_length FROM documents
    WHERE length(text) >= 3
""")
def load_catalogue(spark, sf_dir):
    """The catalogue loader with its default length filter."""
    named = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("code"), F.col("text").alias("product_name")
    )
    stored = Catalog(spark, _raw_folder(spark))
    write_table(named, stored.path(S.CATALOGUE))
    products = stored.load_off_products()
    return products.select("code", F.length("product_name").alias("name_length"))


# --- the loaders, the whole job and SQL ---------------------------------------------------
def _stored_tables(spark, sf_dir):
    """Orders, lines and products of the given tables as stored tables."""
    stored = Catalog(spark, _raw_folder(spark))
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
    )
    write_table(_orders(spark, sf_dir), stored.path(S.ORDERS))
    write_table(lines, stored.path(S.ORDER_ITEMS))
    write_table(_products(spark, sf_dir), stored.path(S.PRODUCTS))
    return stored


@_register("""
    SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate::DATE AS order_date
    FROM orders
""")
def load_orders(spark, sf_dir):
    stored = _stored_tables(spark, sf_dir)
    return stored.load_orders().select("order_id", "user_id", "order_date")


@_register("""
    SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS aisle,
           p_type AS department FROM part
""")
def load_products(spark, sf_dir):
    return _stored_tables(spark, sf_dir).load_products()


@_register("SELECT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem")
def load_order_items(spark, sf_dir):
    return _stored_tables(spark, sf_dir).load_order_items()


@_register("""
    SELECT p_type AS department, count(*) AS n_lines, 'orders' AS "label"
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def sql_by_name(spark, sf_dir):
    """Stored tables by name in SQL; a literal that is a table's name stays one."""
    return _stored_tables(spark, sf_dir).query(
        "SELECT department, count(*) AS n_lines, 'orders' AS label "
        "FROM order_items JOIN products USING (product_id) GROUP BY department"
    )


@_register("""
    SELECT p_type AS department, count(*) AS n_lines, 'part.parquet' AS note
    FROM lineitem, part WHERE l_partkey = p_partkey GROUP BY 1
""")
def sql_path_list(spark, sf_dir):
    """A comma list of paths, and a literal that looks like one."""
    folder = sf_dir.rstrip("/")
    return Catalog(spark, folder).query(
        f"""
        SELECT p_type AS department, count(*) AS n_lines,
               'part.parquet' AS note
        FROM parquet.`{folder}/lineitem.parquet`, parquet.`{folder}/part.parquet`
        WHERE l_partkey = p_partkey GROUP BY p_type
        """
    )


_WEEKLY_PRICES_SQL = """
    SELECT l_linestatus AS store_id, l_partkey::VARCHAR AS item_id,
           date_diff('day', DATE '1990-01-06', l_shipdate::DATE) // 7 AS wm_yr_wk,
           round(max(l_extendedprice), 2) AS sell_price
    FROM lineitem GROUP BY 1, 2, 3
"""


def _write_prices(spark, sf_dir):
    """Weekly shelf prices and their calendar as raw files; returns their paths."""
    folder = _raw_folder(spark)
    days = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-06").cast("date"))
    lines = _table(spark, sf_dir, "lineitem").withColumn("wm_yr_wk", F.floor(days / 7))
    prices = lines.groupBy(
        F.col("l_linestatus").alias("store_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        "wm_yr_wk",
    ).agg(F.round(F.max("l_extendedprice"), 2).alias("sell_price"))
    calendar = lines.select(F.to_date("l_shipdate").alias("date"), "wm_yr_wk").distinct()
    return (
        _write_text(prices, f"{folder}/prices.csv"),
        _write_text(calendar, f"{folder}/calendar.csv"),
    )


@_register(f"""
    WITH prices AS ({_WEEKLY_PRICES_SQL}),
         weeks AS (SELECT date_diff('day', DATE '1990-01-06', l_shipdate::DATE) // 7 AS wm_yr_wk,
                          min(l_shipdate::DATE) AS week_start FROM lineitem GROUP BY 1)
    SELECT store_id, item_id, wm_yr_wk::INT AS wm_yr_wk, sell_price, week_start
    FROM prices JOIN weeks USING (wm_yr_wk)
""")
def ingest_sell_prices(spark, sf_dir):
    built = ingest.build_sell_prices(spark, *_write_prices(spark, sf_dir))
    return built.select(
        "store_id", "item_id", "wm_yr_wk",
        F.round(F.col("sell_price").cast("double"), 2).alias("sell_price"), "week_start",
    )


@_register(f"""
    SELECT store_id, count(*) AS n, round(max(sell_price), 2) AS highest
    FROM ({_WEEKLY_PRICES_SQL}) GROUP BY 1
""")
def sql_sell_prices(spark, sf_dir):
    stored = Catalog(spark, _raw_folder(spark))
    built = ingest.build_sell_prices(spark, *_write_prices(spark, sf_dir))
    write_table(built, stored.path(S.SELL_PRICES))
    return stored.query(
        "SELECT store_id, count(*) AS n, round(max(CAST(sell_price AS DOUBLE)), 2) AS highest "
        "FROM sell_prices GROUP BY store_id"
    )


@_register("""
    WITH gaps AS (
             SELECT o_custkey AS user_id, o_orderkey,
                    (o_orderdate::DATE - lag(o_orderdate::DATE) OVER w)::DOUBLE AS gap,
                    row_number() OVER w AS num
             FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
         sizes AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT user_id, coalesce(arg_max(gap, num) FILTER (gap IS NOT NULL),
                             (SELECT max(gap) FROM gaps)) AS recency_days,
           count(*) AS frequency, coalesce(sum(n), 0)::BIGINT AS monetary
    FROM gaps LEFT JOIN sizes ON l_orderkey = o_orderkey GROUP BY 1
""")
def rfm_undated(spark, sf_dir):
    """Recency, frequency and value of orders that carry a number and a gap, no date."""
    orders = _orders(spark, sf_dir).select("order_id", "user_id", "order_date")
    numbered = ranking.with_number_in_group(
        orders, ["user_id"], ["order_date", "order_id"], "order_number"
    )
    seen = ranking.with_previous(
        numbered, ["user_id"], ["order_date", "order_id"], "order_date", "_before_date"
    )
    gap = F.datediff("order_date", "_before_date").cast("double")
    undated = seen.select("order_id", "user_id", "order_number", gap.alias("days_since_prior_order"))
    return segments.rfm_undated(undated, _items(spark, sf_dir))


@_register("""
    WITH t AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 1)
    SELECT vec_id AS product_id, label AS category,
           round(list_cosine_similarity(embedding::DOUBLE[], e), 5) AS similarity
    FROM embeddings, t WHERE label <> 0
    ORDER BY list_cosine_similarity(embedding::DOUBLE[], e) DESC, vec_id LIMIT 10
""")
def similar_filtered(spark, sf_dir):
    """The rows closest to a vector among those of some categories."""
    vectors = _vectors(spark, sf_dir)
    target = [float(x) for x in vectors.where("product_id = 1").first().embedding]
    found = similar.similar_to_vector(vectors, target, 10, where=F.col("category") != 0)
    return _rounded(found, similarity=5)


def _write_raw_orders(spark, sf_dir, raw):
    """Orders, products, name tables and both files of lines as raw text files."""
    sources = S.RAW_ORDER_ITEMS
    orders = _orders(spark, sf_dir).select(
        "order_id", "user_id", F.lit("prior").alias("eval_set"),
        F.lit(1).alias("order_number"), F.lit(0).alias("order_dow"),
        F.lit(8).alias("order_hour_of_day"), F.lit(7.0).alias("days_since_prior_order"),
    )
    _write_text(orders, f"{raw}/{S.RAW_ORDERS}")
    parts = _products(spark, sf_dir)
    names = {
        c: parts.select(c).distinct().withColumn(f"{c}_id", F.dense_rank().over(Window.orderBy(c)))
        for c in ("aisle", "department")  # a few names each
    }
    keyed = parts.join(names["aisle"], "aisle").join(names["department"], "department")
    _write_text(keyed.select("product_id", "product_name", "aisle_id", "department_id"), f"{raw}/{S.RAW_PRODUCTS}")
    _write_text(names["aisle"].select("aisle_id", "aisle"), f"{raw}/{S.RAW_AISLES}")
    _write_text(names["department"].select("department_id", "department"), f"{raw}/{S.RAW_DEPARTMENTS}")
    items = _items(spark, sf_dir).select("order_id", "product_id", "add_to_cart_order", "reordered")
    for number, name in enumerate(sources):
        _write_text(items.where(F.col("order_id") % 2 == number), f"{raw}/{name}")
    return raw


@_register("""
    SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'order_items', count(*) FROM lineitem
    UNION ALL SELECT 'products', count(*) FROM part
""")
def job_row_counts(spark, sf_dir):
    """The job that builds the order tables from raw files, and its row counts."""
    root = _raw_folder(spark)
    raw = _write_raw_orders(spark, sf_dir, f"{root}/raw")
    counts = ingest.run(spark, raw, f"{root}/out", "instacart")
    return spark.createDataFrame(list(counts.items()), "table_name string, n_rows long")


@_register("""
    SELECT 'load_orders' AS loader, count(*) AS n_rows, NULL::VARCHAR AS error FROM orders
    UNION ALL SELECT 'load_products', count(*), NULL FROM part
    UNION ALL SELECT 'load_order_items', count(*), NULL FROM lineitem
    UNION ALL SELECT 'load_m5_sales', NULL, 'FileNotFoundError: preprocess_data'
    UNION ALL SELECT 'load_off_products', NULL, 'FileNotFoundError: preprocess_data'
""")
def missing_tables(spark, sf_dir):
    """Each loader on a folder with three of the tables; the others name the step to run."""
    stored, rows = _stored_tables(spark, sf_dir), []
    for loader in ("load_orders", "load_products", "load_order_items", "load_m5_sales", "load_off_products"):
        try:
            rows.append((loader, getattr(stored, loader)().count(), None))
        except FileNotFoundError as error:
            step = "preprocess_data" if "preprocess_data" in str(error) else str(error)
            rows.append((loader, None, f"FileNotFoundError: {step}"))
    return spark.createDataFrame(rows, "loader string, n_rows long, error string")


@_register("""
    SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'order_items', count(*) FROM lineitem
    UNION ALL SELECT 'products', count(*) FROM part
    UNION ALL SELECT 'm5_sales', count(*) FROM (
        SELECT DISTINCT l_partkey, day(l_shipdate) FROM lineitem WHERE l_quantity > 0)
    UNION ALL SELECT 'sell_prices', NULL
    UNION ALL SELECT 'off_products', count(*) FROM documents
    WHERE source ILIKE '%src1%' AND text IS NOT NULL AND lang IS NOT NULL
""")
def job_all_tables(spark, sf_dir):
    """The whole job over raw files of all datasets; one optional file is not there."""
    root = _raw_folder(spark)
    raw = _write_raw_orders(spark, sf_dir, f"{root}/raw")
    _write_raw_sales(spark, sf_dir, f"{raw}/{S.RAW_SALES}", f"{raw}/{S.RAW_CALENDAR}")
    countries = F.regexp_replace("source", "src1", "Australia")
    _write_raw_catalogue(spark, sf_dir, f"{raw}/{S.RAW_CATALOGUE}", countries)
    counts = ingest.run(spark, raw, f"{root}/out", "all")
    return spark.createDataFrame(list(counts.items()), "table_name string, n_rows long")


@_register("""
    SELECT count(*) AS n_rows, true AS same_twice, true AS same_with_empty_filter,
           true AS other_filter_is_other, true AS new_after_clear FROM orders
""")
def remembered_tables(spark, sf_dir):
    """Facts of the loaders' memory: a table per set of arguments until it is cleared."""
    stored = _stored_tables(spark, sf_dir)
    sales = _sales(spark, sf_dir).withColumns({"cat_id": F.lit("FOODS"), "day": F.lit("d_1")})
    write_table(sales, stored.path(S.DAILY_SALES))
    first, foods = stored.load_orders(), stored.load_m5_sales("FOODS")
    facts = {
        "same_twice": stored.load_orders() is first,
        "same_with_empty_filter": stored.load_m5_sales("FOODS", "") is foods,
        "other_filter_is_other": stored.load_m5_sales() is not foods,
    }
    stored.cache_clear("orders")
    facts["new_after_clear"] = stored.load_orders() is not first and stored.load_m5_sales("FOODS") is foods
    counted = first.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumns({name: F.lit(fact) for name, fact in facts.items()})


@_register("""
    WITH t AS (SELECT p_type AS department, count(*) AS n_items FROM lineitem
               JOIN part ON l_partkey = p_partkey GROUP BY 1),
         w AS (SELECT greatest(length('department'), max(length(department))) AS a,
                      greatest(length('n_items'), max(length(n_items::VARCHAR))) AS b FROM t)
    SELECT 0 AS line_number, lpad('department', a::INT, ' ') || ' ' || lpad('n_items', b::INT, ' ') AS line FROM w
    UNION ALL
    SELECT row_number() OVER (ORDER BY n_items DESC, department),
           lpad(department, a::INT, ' ') || ' ' || lpad(n_items::VARCHAR, b::INT, ' ') FROM t, w
""")
def printed_table(spark, sf_dir):
    """A result as aligned lines of text, the header first."""
    items = _items(spark, sf_dir).join(_products(spark, sf_dir), "product_id")
    counted = items.groupBy("department").agg(F.count(F.lit(1)).alias("n_items"))
    return report.text_lines(counted, [F.desc("n_items"), "department"])


@_register("""
    WITH t AS (SELECT p_partkey AS product_id, coalesce(sum(l_quantity), 0) AS units
               FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1),
         r AS (SELECT *, row_number() OVER (ORDER BY units DESC, product_id) AS position,
                      count(*) OVER () AS n FROM t)
    SELECT position, product_id, units FROM r WHERE position IN (1, 2, 100, n - 1, n)
""")
def rows_at_positions(spark, sf_dir):
    """The first two, the hundredth and the last two products by units sold."""
    sold = _items_quantity(spark, sf_dir).groupBy("product_id").agg(F.sum("quantity").alias("units"))
    every = _products(spark, sf_dir).select("product_id").join(sold, "product_id", "left")
    units = every.withColumn("units", F.coalesce("units", F.lit(0.0)))
    return ranking.rows_at(units, [F.desc("units"), "product_id"], [0, 1, 99, -2, -1])


def _items_quantity(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity")
    )


# --- driver entry points ----------------------------------------------------------------
def _with_shared_dir(query: Query) -> Query:
    """Names a folder for intermediate tables where the session has none.

    Only for a local master, whose driver and executors are one process; the
    folder goes when the process ends.
    """

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        master = spark.sparkContext.master
        if not named_shared_dir(spark) and re.fullmatch(r"local(\[.*\])?", master):
            folder = tempfile.mkdtemp(prefix="basketry-shared-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            spark.sparkContext.setCheckpointDir(folder)
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the most ordered products and their reorder rate."""
    return top_products(spark, "/root/testdata/sf0.001")


def _own_queries() -> dict[str, tuple[Query, str | None]]:
    return {**_REGISTERED, **registered.REGISTERED}


def _all_queries() -> dict[str, tuple[Query, str | None]]:
    """The library's own queries, and those of the subpackage that may be left out."""
    found = _own_queries()
    try:
        import corpus_pipeline
        from basketry.llm import queries as llm
    except ImportError:  # deleted, or a library that only the subpackage needs is missing
        return found
    for name, query in llm.QUERIES.items():
        found[name] = (query, llm.ORACLE_SQL.get(name))
    found["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
    return found


def queries() -> dict[str, Query]:
    return {name: _with_shared_dir(query) for name, (query, _) in _all_queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all_queries().items() if sql}
