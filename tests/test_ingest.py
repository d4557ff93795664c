"""Raw-file fixtures with the edge cases of each build step."""

import datetime as dt
import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketry import schemas as S
from basketry.plans import ingest
from basketry.sources.catalog import Catalog
from basketry.sources.delimited import read_delimited


def _file(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- orders -----------------------------------------------------------------
ORDERS = """order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order
1,10,prior,1,0,8,
2,10,train,2,1,9,7.0
3,20,prior,1,2,10,NA
4,20,test,2,6,23
"""


def test_orders_types_and_missing_values(spark, tmp_path):
    df = ingest.build_orders(spark, _file(tmp_path, "orders.csv", ORDERS))
    kinds = dict(df.dtypes)
    assert kinds["order_dow"] == kinds["order_hour_of_day"] == "tinyint"
    assert kinds["order_id"] == "bigint"
    assert kinds["days_since_prior_order"] == "double"
    gaps = dict(df.select("order_id", "days_since_prior_order").collect())
    assert gaps == {1: None, 2: 7.0, 3: None, 4: None}  # 4 is a short line


def test_orders_extra_column_passes_through(spark, tmp_path):
    text = "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order,note\n1,1,a,1,1.0,2,3,x\n"
    row = ingest.build_orders(spark, _file(tmp_path, "o.csv", text)).first()
    assert row.note == "x"
    assert row.order_dow == 1


def test_orders_long_line_raises_even_when_pruned(spark, tmp_path):
    path = _file(tmp_path, "orders.csv", ORDERS + "5,1,prior,1,1,1,1,surplus\n")
    with pytest.raises(PySparkException, match="too many fields"):
        ingest.build_orders(spark, path).select("order_id").collect()
    with pytest.raises(PySparkException, match="too many fields"):
        ingest.build_orders(spark, path).count()


def test_every_surplus_field_counts(spark, tmp_path):
    beyond = _file(tmp_path, "a.csv", ORDERS + "5,1,prior,1,1,1,1,,lost\n")
    with pytest.raises(PySparkException, match="too many fields"):
        ingest.build_orders(spark, beyond).select("order_id").collect()
    quoted = _file(tmp_path, "b.csv", ORDERS + '5,1,prior,1,1,1,1,,"x,y"\n')
    with pytest.raises(PySparkException, match="too many fields"):
        ingest.build_orders(spark, quoted).count()
    empty = _file(tmp_path, "c.csv", ORDERS + "5,1,prior,1,1,1,1,,\n")
    assert ingest.build_orders(spark, empty).where("order_id = 5").count() == 1


def test_orders_overflow_raises(spark, tmp_path):
    path = _file(tmp_path, "orders.csv", ORDERS.replace("1,10,prior,1,0,8", "1,10,prior,1,300,8"))
    with pytest.raises(PySparkException):
        ingest.build_orders(spark, path).collect()


def test_missing_column_is_named(spark, tmp_path):
    path = _file(tmp_path, "orders.csv", "order_id,user_id\n1,2\n")
    with pytest.raises(ValueError, match="eval_set"):
        ingest.build_orders(spark, path)


# --- products ---------------------------------------------------------------
def test_products_join_names_and_drop_unknown(spark, tmp_path):
    products = _file(
        tmp_path,
        "products.csv",
        "product_id,product_name,aisle_id,department_id\n"
        '1,"Chips, ""Kettle"" style",1,1\n'
        "2,Milk,2,2\n"
        "3,Unknown aisle,99,1\n"
        '4,"Two\nlines",1,1\n',
    )
    aisles = _file(tmp_path, "aisles.csv", "aisle_id,aisle\n1,snacks\n2,dairy\n3,unused\n")
    departments = _file(tmp_path, "departments.csv", "department_id,department\n1,pantry\n2,fridge\n")
    df = ingest.build_products(spark, products, aisles, departments)
    assert _rows(df.select("product_id", "product_name", "aisle", "department")) == [
        (1, 'Chips, "Kettle" style', "snacks", "pantry"),
        (2, "Milk", "dairy", "fridge"),
        (4, "Two\nlines", "snacks", "pantry"),
    ]
    assert {"aisle_id", "department_id"} <= set(df.columns)


# --- order items --------------------------------------------------------------
PRIOR = "order_id,product_id,add_to_cart_order,reordered\n1,100,1,0\n1,101,2,1\n"
TRAIN = "product_id,order_id,add_to_cart_order,reordered\n100,2,1,1\n"


def test_order_items_union_by_name(spark, tmp_path):
    paths = [_file(tmp_path, "a.csv", PRIOR), _file(tmp_path, "b.csv", TRAIN)]
    df = ingest.build_order_items(spark, paths)
    assert dict(df.dtypes) == {
        "order_id": "bigint",
        "product_id": "bigint",
        "add_to_cart_order": "smallint",
        "reordered": "tinyint",
    }
    assert _rows(df) == [(1, 100, 1, 0), (1, 101, 2, 1), (2, 100, 1, 1)]


def test_order_items_one_file_or_none(spark, tmp_path):
    there, absent = _file(tmp_path, "a.csv", PRIOR), str(tmp_path / "absent.csv")
    assert ingest.build_order_items(spark, [there, absent]).count() == 2
    with pytest.raises(FileNotFoundError):
        ingest.build_order_items(spark, [absent])


# --- daily sales ------------------------------------------------------------------
SALES = """id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2,d_3,d_4,d_10
A_X,A,D1,FOODS,X,CA,0,3,0,2,1
A_Y,A,D1,FOODS,Y,TX,5,0,0,0,
B_X,B,D2,HOBBIES,X,CA,1,NA,0,4,0
B_Y,B,D2,HOBBIES,Y,TX,0,0,0,0,7
"""
CALENDAR = """date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,snap_CA
2011-01-29,11101,Saturday,1,1,2011,d_1,,0
2011-01-30,11101,Sunday,2,1,2011,d_2,SuperBowl,1
2011-01-31,11101,Monday,3,1,2011,d_3,,0
2011-02-07,11102,Monday,3,2,2011,d_10,NA,1
"""


@pytest.fixture()
def sales(spark, tmp_path):
    return ingest.build_daily_sales(
        spark,
        _file(tmp_path, "sales.csv", SALES),
        _file(tmp_path, "calendar.csv", CALENDAR),
    )


def test_daily_sales_rows(sales):
    assert tuple(sales.columns) == S.DAILY_SALES_COLUMNS
    assert _rows(sales.select("item_id", "store_id", "day", "day_num", "sales")) == [
        ("A", "X", "d_10", 10, 1),
        ("A", "X", "d_2", 2, 3),
        ("A", "X", "d_4", 4, 2),
        ("A", "Y", "d_1", 1, 5),
        ("B", "X", "d_1", 1, 1),
        ("B", "X", "d_4", 4, 4),
        ("B", "Y", "d_10", 10, 7),
    ]


def test_daily_sales_calendar_is_a_left_join(sales):
    dates = dict(sales.select("day", "date").distinct().collect())
    assert dates["d_2"] == dt.date(2011, 1, 30)
    assert dates["d_4"] is None  # not in the calendar, yet kept
    events = dict(sales.select("day", "event_name_1").distinct().collect())
    assert events == {"d_1": None, "d_2": "SuperBowl", "d_4": None, "d_10": None}
    assert dict(sales.dtypes)["day_num"] == "smallint"
    assert dict(sales.dtypes)["date"] == "date"


def test_daily_sales_keep_the_total(sales):
    assert sales.agg(F.sum("sales")).first()[0] == 23


def test_sell_prices_carry_week_start(spark, tmp_path):
    prices = _file(tmp_path, "p.csv", "store_id,item_id,wm_yr_wk,sell_price\nX,A,11101,2.5\nX,A,11102,\n")
    df = ingest.build_sell_prices(spark, prices, _file(tmp_path, "c.csv", CALENDAR))
    assert _rows(df.select("sell_price", "week_start")) == [
        (2.5, dt.date(2011, 1, 29)),
        (None, dt.date(2011, 2, 7)),
    ]


# --- catalogue ------------------------------------------------------------------------
def _catalogue_line(**values):
    names = ["creator", *S.CATALOGUE_SCHEMA.names]
    return "\t".join(values.get(n.replace("-", "_"), "") for n in names)


def _catalogue(folder, *lines, name="products.csv.gz"):
    header = "\t".join(["creator", *S.CATALOGUE_SCHEMA.names])
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write("\n".join([header, *lines]) + "\n")
    return str(path)


def test_catalogue_rules(spark, tmp_path):
    full = {"categories_en": "Snacks", "countries_en": "France,australia", "main_category_en": "m"}
    path = _catalogue(
        tmp_path,
        _catalogue_line(code="0001", product_name="Kept", fat_100g="1.5", **full),
        _catalogue_line(code="2", product_name="Surplus", **full) + "\textra\textra",
        "x\t3\tShort line",
        _catalogue_line(code="4", product_name='"Tab\there ""q"""', **full),
        _catalogue_line(code="5", product_name="NA", **full),
        _catalogue_line(code="6", product_name="No category", countries_en="Australia"),
        _catalogue_line(code="7", product_name="Anywhere", categories_en="Snacks"),
        _catalogue_line(code="8", product_name="French", categories_en="Snacks", countries_en="France"),
        _catalogue_line(code="9", product_name="Bad number", energy_kcal_100g="many", **full),
    )
    df = ingest.build_catalogue(spark, path)
    assert df.columns == S.CATALOGUE_SCHEMA.names
    names = {r.code: r.product_name for r in df.collect()}
    assert names == {
        "0001": "Kept",
        "2": "Surplus",
        "4": 'Tab\there "q"',
        "7": "Anywhere",
        "9": "Bad number",
    }
    numbers = {r[0]: (r[1], r[2]) for r in df.select("code", "fat_100g", "`energy-kcal_100g`").collect()}
    assert numbers["0001"] == (1.5, None)
    assert numbers["9"] == (None, None)
    assert df.count() == 5
    assert ingest.build_catalogue(spark, path, spread=3).count() == 5


def test_tolerant_read_does_not_depend_on_the_columns(spark, tmp_path):
    path = _file(tmp_path, "t.tsv", "a\tb\n1\t2\n3\t4\t5\n6\n")
    df = read_delimited(spark, path, sep="\t", strict=False)
    assert df.count() == 3
    assert _rows(df.select("a")) == [("1",), ("3",), ("6",)]
    assert _rows(df.select("b")) == [("2",), ("4",), (None,)]


# --- whole runs ---------------------------------------------------------------------------
@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    _file(folder, S.RAW_ORDERS, ORDERS)
    _file(folder, S.RAW_PRODUCTS, "product_id,product_name,aisle_id,department_id\n100,Milk,1,1\n101,Eggs,1,1\n")
    _file(folder, S.RAW_AISLES, "aisle_id,aisle\n1,fridge\n")
    _file(folder, S.RAW_DEPARTMENTS, "department_id,department\n1,dairy eggs\n")
    _file(folder, S.RAW_ORDER_ITEMS[0], PRIOR)
    _file(folder, S.RAW_ORDER_ITEMS[1], TRAIN)
    _file(folder, S.RAW_SALES, SALES)
    _file(folder, S.RAW_CALENDAR, CALENDAR)
    return folder


def test_run_writes_tables_and_skips_absent_sources(spark, raw, tmp_path):
    out = str(tmp_path / "tables")
    counts = ingest.run(spark, str(raw), out)
    assert counts == {
        S.ORDERS: 4,
        S.PRODUCTS: 2,
        S.ORDER_ITEMS: 3,
        S.DAILY_SALES: 7,
        S.SELL_PRICES: None,
        S.CATALOGUE: None,
    }
    tables = Catalog(spark, out)
    assert tables.load_order_items().count() == 3
    assert tuple(tables.load_m5_sales().columns) == S.DAILY_SALES_COLUMNS
    # a second run overwrites
    assert ingest.run(spark, str(raw), out, "m5")[S.DAILY_SALES] == 7
    assert Catalog(spark, out).load_m5_sales().count() == 7


def test_run_one_dataset_only(spark, raw, tmp_path):
    _catalogue(raw / "open_food_facts", _catalogue_line(code="1", product_name="Tea", categories_en="c"))
    counts = ingest.run(spark, str(raw), str(tmp_path / "t"), "off")
    assert counts == {S.CATALOGUE: 1}
    with pytest.raises(ValueError, match="dataset"):
        ingest.run(spark, str(raw), str(tmp_path / "t"), "other")
