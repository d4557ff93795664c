"""The stored tables: filtered loaders, cache registry and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from basketry import schemas as S
from basketry.functions.text import long_enough

class Catalog:
    """Tables under one folder, each stored as ``<root>/<table>.parquet``.

    Loaders return lazy DataFrames, so a filter or a projection added later
    still reaches the Parquet scan. Results are remembered per argument set;
    ``persist=True`` also asks Spark to keep the rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._loaded: dict[tuple, DataFrame] = {}
        self._persisted: set[tuple] = set()

    # -- tables --------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table}.parquet"

    def table(self, table: str) -> DataFrame:
        """Scan one stored table."""
        path = self.path(table)
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(
                    f"{path} not found. Build it first: "
                    "spark-submit jobs/preprocess_data.py --raw RAW --out OUT"
                ) from error
            raise

    def load_orders(self, persist: bool = False) -> DataFrame:
        return self._load((S.ORDERS,), persist, lambda: self.table(S.ORDERS))

    def load_products(self, persist: bool = False) -> DataFrame:
        return self._load((S.PRODUCTS,), persist, lambda: self.table(S.PRODUCTS))

    def load_order_items(self, persist: bool = False) -> DataFrame:
        return self._load((S.ORDER_ITEMS,), persist, lambda: self.table(S.ORDER_ITEMS))

    def load_m5_sales(
        self,
        category: str | None = None,
        store_id: str | None = None,
        persist: bool = False,
    ) -> DataFrame:
        """Daily sales, optionally of one category and/or store.

        The table is partitioned by these two columns, so a filter prunes
        folders. An empty string means no filter.
        """

        def build() -> DataFrame:
            sales = self._daily_sales()
            if category:
                sales = sales.where(F.col("cat_id") == F.lit(category))
            if store_id:
                sales = sales.where(F.col("store_id") == F.lit(store_id))
            return sales

        key = (S.DAILY_SALES, category or None, store_id or None)
        return self._load(key, persist, build)

    def load_off_products(
        self, min_name_length: int = 3, persist: bool = False
    ) -> DataFrame:
        """Catalogue products whose name is long enough to be useful."""
        return self._load(
            (S.CATALOGUE, min_name_length),
            persist,
            lambda: self.table(S.CATALOGUE).where(
                long_enough(F.col("product_name"), min_name_length)
            ),
        )

    def load_sell_prices(self, persist: bool = False) -> DataFrame:
        return self._load((S.SELL_PRICES,), persist, lambda: self.table(S.SELL_PRICES))

    def _daily_sales(self) -> DataFrame:
        sales = self.table(S.DAILY_SALES)
        declared = T.StructType(
            [
                # folder names such as store_id=001 are text, not numbers
                T.StructField(f.name, T.StringType())
                if f.name in S.DAILY_SALES_PARTITIONS
                else f
                for f in sales.schema
            ]
        )
        if declared != sales.schema:
            path = self.path(S.DAILY_SALES)
            sales = self.spark.read.schema(declared).parquet(path)
        kind = dict(sales.dtypes).get("date")
        if kind == "bigint":  # stored elsewhere as nanoseconds since the epoch
            sales = sales.withColumn(
                "date", F.timestamp_micros(F.expr("date div 1000")).cast("date")
            )
        elif kind != "date":
            sales = sales.withColumn("date", F.col("date").cast("date"))
        first = [c for c in S.DAILY_SALES_COLUMNS if c in sales.columns]
        return sales.select(*first, *[c for c in sales.columns if c not in first])

    # -- cache ---------------------------------------------------------------
    def _load(
        self, key: tuple, persist: bool, build: Callable[[], DataFrame]
    ) -> DataFrame:
        if key not in self._loaded:
            self._loaded[key] = build()
        if persist and key not in self._persisted:
            self._loaded[key].persist()
            self._persisted.add(key)
        return self._loaded[key]

    def cache_clear(self, table: str | None = None) -> None:
        """Forget remembered tables (all, or one) and release kept rows."""
        for key in [k for k in self._loaded if table in (None, k[0])]:
            frame = self._loaded.pop(key)
            if key in self._persisted:
                frame.unpersist()
                self._persisted.discard(key)

    # -- SQL -----------------------------------------------------------------
    def register(self, *tables: str) -> None:
        """Make stored tables known to SQL under their own names."""
        for name in tables or S.TABLES:
            frame = self._daily_sales() if name == S.DAILY_SALES else self.table(name)
            frame.createOrReplaceTempView(name)

    def query(self, sql: str, **params: object) -> DataFrame:
        """Run any Spark SQL text over the stored tables.

        Tables are known by name; ``:name`` markers take their values from
        ``params``, and ``{name}`` stands for a DataFrame among these. Any other
        Parquet folder is a table as ``parquet.`path```, as in all Spark SQL; the
        text goes to Spark as it is. A view or table of the session that has the
        name of a stored table is used instead of it and stays as it is; this
        catalogue's own views last for the call only, so several catalogues may
        share a session.
        """
        frames = {k: v for k, v in params.items() if isinstance(v, DataFrame)}
        values = {k: v for k, v in params.items() if k not in frames}
        own = []
        for name in S.TABLES:
            if not self.spark.catalog.tableExists(name):
                try:
                    self.register(name)
                    own.append(name)
                except FileNotFoundError:
                    pass  # not built, which matters only if the text names it
        try:
            return self.spark.sql(sql, args=values or None, **frames)
        finally:
            for name in own:
                self.spark.catalog.dropTempView(name)
