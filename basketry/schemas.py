"""Table names, column types, missing-value tokens, labels."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: stored tables -------------------------------------------
ORDERS = "orders"
PRODUCTS = "products"
ORDER_ITEMS = "order_items"
DAILY_SALES = "m5_sales"
CATALOGUE = "off_products"
SELL_PRICES = "sell_prices"
TABLES = (ORDERS, PRODUCTS, ORDER_ITEMS, DAILY_SALES, CATALOGUE, SELL_PRICES)

# --- fixed values: raw files, relative to the raw-data root ------------------
RAW_ORDERS = "instacart/orders.csv"
RAW_PRODUCTS = "instacart/products.csv"
RAW_AISLES = "instacart/aisles.csv"
RAW_DEPARTMENTS = "instacart/departments.csv"
RAW_ORDER_ITEMS = (
    "instacart/order_products__prior.csv",
    "instacart/order_products__train.csv",
)
RAW_SALES = "m5/sales_train_evaluation.csv"
RAW_CALENDAR = "m5/calendar.csv"
RAW_SELL_PRICES = "m5/sell_prices.csv"
RAW_CATALOGUE = "open_food_facts/products.csv.gz"

# --- fixed values: texts that mean "missing" in the raw files -----------------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# --- fixed values: chart labels (order_dow 0 is Saturday) ---------------------
WEEKDAY_LABELS = ("Sat", "Sun", "Mon", "Tue", "Wed", "Thu", "Fri")
MONTH_LABELS = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)

# --- fixed values: forecasting defaults (boosted trees) -----------------------
GBT_DEFAULTS = {
    "maxIter": 400,
    "maxDepth": 6,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "seed": 42,
}


# --- fixed values: columns and types of the raw files -------------------------
def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ORDERS_SCHEMA = _schema(
    order_id=T.LongType(),
    user_id=T.LongType(),
    eval_set=T.StringType(),
    order_number=T.IntegerType(),
    order_dow=T.ByteType(),
    order_hour_of_day=T.ByteType(),
    days_since_prior_order=T.DoubleType(),
)
PRODUCTS_SCHEMA = _schema(
    product_id=T.LongType(),
    product_name=T.StringType(),
    aisle_id=T.IntegerType(),
    department_id=T.IntegerType(),
)
AISLES_SCHEMA = _schema(aisle_id=T.IntegerType(), aisle=T.StringType())
DEPARTMENTS_SCHEMA = _schema(
    department_id=T.IntegerType(), department=T.StringType()
)
ORDER_ITEMS_SCHEMA = _schema(
    order_id=T.LongType(),
    product_id=T.LongType(),
    add_to_cart_order=T.ShortType(),
    reordered=T.ByteType(),
)
SALES_ID_SCHEMA = _schema(
    id=T.StringType(),
    item_id=T.StringType(),
    dept_id=T.StringType(),
    cat_id=T.StringType(),
    store_id=T.StringType(),
    state_id=T.StringType(),
)
CALENDAR_SCHEMA = _schema(
    d=T.StringType(),
    date=T.DateType(),
    wday=T.IntegerType(),
    month=T.IntegerType(),
    year=T.IntegerType(),
    event_name_1=T.StringType(),
    snap_CA=T.IntegerType(),
)
SELL_PRICES_SCHEMA = _schema(
    store_id=T.StringType(),
    item_id=T.StringType(),
    wm_yr_wk=T.IntegerType(),
    sell_price=T.DoubleType(),
)
DAILY_SALES_COLUMNS = (
    *SALES_ID_SCHEMA.names, "day", "sales", "day_num",
    "date", "wday", "month", "year", "event_name_1", "snap_CA",
)
DAILY_SALES_PARTITIONS = ("cat_id", "store_id")
CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("brands", T.StringType()),
        T.StructField("categories_en", T.StringType()),
        T.StructField("countries_en", T.StringType()),
        T.StructField("ingredients_text", T.StringType()),
        T.StructField("energy-kcal_100g", T.DoubleType()),
        T.StructField("fat_100g", T.DoubleType()),
        T.StructField("carbohydrates_100g", T.DoubleType()),
        T.StructField("proteins_100g", T.DoubleType()),
        T.StructField("fiber_100g", T.DoubleType()),
        T.StructField("sugars_100g", T.DoubleType()),
        T.StructField("salt_100g", T.DoubleType()),
        T.StructField("nova_group", T.DoubleType()),
        T.StructField("nutriscore_grade", T.StringType()),
        T.StructField("main_category_en", T.StringType()),
    ]
)
