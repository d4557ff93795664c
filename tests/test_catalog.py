"""Loader contracts: missing files, filters, cache, SQL."""

import datetime as dt

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException

from basketry.sources.catalog import Catalog


def _save(folder, name, **columns):
    path = folder / f"{name}.parquet"
    pd.DataFrame(columns).to_parquet(path, index=False)
    return path


@pytest.fixture()
def tables(spark, tmp_path):
    # a repeated order, one without a number, and one whose gap is missing
    orders = pd.DataFrame(
        {"order_id": [7, 7, None, 12], "user_id": [4, 4, 9, 4], "days_since_prior_order": [1.5, 1.5, 2, None]}
    )
    orders.to_parquet(tmp_path / "orders.parquet", index=False)
    sales = spark.createDataFrame(
        [
            ("A", "FOODS", "001", 1, dt.date(2020, 1, 1)),
            ("A", "FOODS", "002", 2, dt.date(2020, 1, 2)),
            ("B", "HOBBIES", "001", 3, dt.date(2020, 1, 3)),
        ],
        "item_id string, cat_id string, store_id string, sales int, date date",
    )
    sales.write.partitionBy("cat_id", "store_id").parquet(str(tmp_path / "m5_sales.parquet"))
    _save(tmp_path, "off_products", product_name=["ab", "abc", "naïve", None], code=list("1234"))
    return Catalog(spark, str(tmp_path))


@pytest.mark.parametrize(
    "loader",
    ["load_orders", "load_products", "load_order_items", "load_m5_sales", "load_off_products"],
)
def test_missing_file_names_the_step_to_run(spark, tmp_path, loader):
    with pytest.raises(FileNotFoundError, match="preprocess_data"):
        getattr(Catalog(spark, str(tmp_path / "nowhere")), loader)()


def test_load_orders(tables):
    orders = tables.load_orders()
    assert orders.count() == 4
    assert orders.where("order_id IS NULL").first().user_id == 9
    assert orders.where("days_since_prior_order is null").count() == 1


@pytest.mark.parametrize(
    "category, store, expected",
    [
        (None, None, 3),
        ("", "", 3),
        ("FOODS", None, 2),
        (None, "001", 2),
        ("FOODS", "002", 1),
        ("it's", None, 0),
    ],
)
def test_sales_filters(tables, category, store, expected):
    assert tables.load_m5_sales(category, store).count() == expected


def test_sales_filters_prune_partitions(tables):
    plan = tables.load_m5_sales("FOODS", "001")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "FOODS" in filters and "001" in filters


def test_sales_store_codes_stay_text(tables):
    stores = {r.store_id for r in tables.load_m5_sales().select("store_id").collect()}
    assert stores == {"001", "002"}


def test_catalogue_name_length(tables):
    def names(n):
        return {r.product_name for r in tables.load_off_products(n).collect()}

    assert names(3) == {"abc", "naïve"}
    assert names(2) == {"ab", "abc", "naïve"}
    assert names(5) == {"naïve"}  # counted in characters, not bytes


def test_tables_are_remembered_and_forgotten(tables):
    first = tables.load_m5_sales("FOODS")
    assert tables.load_m5_sales("FOODS", "") is first
    assert tables.load_m5_sales("HOBBIES") is not first
    kept = tables.load_orders(persist=True)
    assert kept.storageLevel.useMemory
    tables.cache_clear("orders")
    assert not kept.storageLevel.useMemory
    assert tables.load_orders() is not kept
    assert tables.load_m5_sales("FOODS") is first
    tables.cache_clear()
    assert tables.load_m5_sales("FOODS") is not first


def test_nanosecond_dates_are_read_as_dates(spark, tmp_path):
    moment = pa.array([dt.datetime(2011, 1, 29), None], pa.timestamp("ns"))
    table = pa.table({"item_id": ["A", "B"], "date": moment})
    pq.write_table(table, tmp_path / "m5_sales.parquet", version="2.6")
    rows = Catalog(spark, str(tmp_path)).load_m5_sales().orderBy("item_id").collect()
    assert [r.date for r in rows] == [dt.date(2011, 1, 29), None]


# --- SQL --------------------------------------------------------------------
def test_query_sums_by_department(spark, tmp_path):
    path = _save(
        tmp_path,
        "tills",
        till=["north", "south", "north", "east"],
        taken=[4, 9, 7, 1],
    )
    result = Catalog(spark, str(tmp_path)).query(
        f"SELECT till, count(*) AS n, max(taken) AS most FROM parquet.`{path}` GROUP BY till ORDER BY most DESC"
    )
    assert [tuple(r) for r in result.collect()] == [
        ("south", 1, 9), ("north", 2, 7), ("east", 1, 1),
    ]


def test_query_lists_of_paths_and_literals_with_paths(spark, tmp_path):
    a, b = _save(tmp_path, "a", x=[1, 2]), _save(tmp_path, "b", y=[2, 3])
    found = Catalog(spark, str(tmp_path)).query(
        f"""
        SELECT x, "loaded from 'b.parquet'" AS note, 'b.parquet' AS file -- FROM 'c.parquet'
        FROM parquet.`{a}`, parquet.`{b}` WHERE x = y AND 'd.parquet' IN ('d.parquet', 'e.parquet')
        """
    )
    assert [tuple(r) for r in found.collect()] == [(2, "loaded from 'b.parquet'", "b.parquet")]
    nested = f"SELECT * FROM (SELECT max(y) AS y FROM parquet.`{b}`) t JOIN parquet.`{a}` ON x < y ORDER BY x"
    assert [tuple(r) for r in Catalog(spark, str(tmp_path)).query(nested).collect()] == [(3, 1), (3, 2)]


def test_query_keeps_views_of_the_session(spark, tables):
    spark.range(7).createOrReplaceTempView("orders")
    try:
        assert tables.query("SELECT count(*) AS n FROM orders").first().n == 7
        assert spark.table("orders").count() == 7
    finally:
        spark.catalog.dropTempView("orders")
    assert tables.query("SELECT count(*) AS n FROM orders").first().n == 4
    assert not spark.catalog.tableExists("orders")


def test_query_knows_sell_prices(spark, tables, tmp_path):
    _save(tmp_path, "sell_prices", item_id=["A", "B"], sell_price=[1.5, 2.5])
    assert tables.query("SELECT sum(sell_price) AS s FROM sell_prices").first().s == 4.0


def test_query_by_table_name_with_parameters(tables):
    sql = "SELECT count(*) AS n FROM orders WHERE user_id = :user"
    assert tables.query(sql, user=9).first().n == 1
    assert tables.query(sql, user=4).first().n == 3


def test_query_takes_dataframes_by_name(spark, tables):
    chosen = spark.createDataFrame([(9,)], "user_id int")
    found = tables.query(
        "SELECT count(*) AS n FROM orders JOIN {chosen} USING (user_id) WHERE user_id > :low", chosen=chosen, low=1
    )
    assert found.first().n == 1


def test_query_ordinals_and_other_operators(tables):
    rows = tables.query(
        """
        SELECT user_id, count(*) AS n,
               rank() OVER (ORDER BY count(*) DESC, user_id) AS place
        FROM orders GROUP BY 1 HAVING count(*) > 1 ORDER BY 3
        """
    ).collect()
    assert [tuple(r) for r in rows] == [(4, 3, 1)]
    union = "SELECT item_id FROM m5_sales UNION SELECT item_id FROM m5_sales"
    assert tables.query(union).count() == 2


def test_query_leaves_other_literals_alone(tables):
    row = tables.query("SELECT 'from ''x.csv''' AS a, 'orders' AS b").first()
    assert tuple(row) == ("from 'x.csv'", "orders")


def test_query_reports_an_unknown_table(tables):
    with pytest.raises(AnalysisException):
        tables.query("SELECT * FROM no_such_table")
