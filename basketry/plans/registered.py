"""More queries over the given tables: as-of and interval joins, cubes, sketches,
sessions, loads compared, JSON fields, joint price slopes. Each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions import props
from basketry.functions.vectors import cosine
from basketry.operators import (
    asof,
    compare,
    cubes,
    elasticity,
    sessions,
    sketches,
    spans,
    vector_index,
)
from basketry.session import materialize, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

# name -> (query, SQL or None)
REGISTERED: dict[str, tuple[Query, str | None]] = {}


def _register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTERED[query.__name__] = (query, sql)
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("revenue"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


# --- as-of joins ------------------------------------------------------------------------
@_register("""
    WITH prices AS (SELECT l_partkey AS product_id, date_trunc('month', l_shipdate)::DATE AS price_from,
                           max(l_extendedprice / l_quantity) AS price
                    FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2)
    SELECT l_orderkey AS order_id, l_linenumber AS line_number, l.product_id, l.date, price_from, price
    FROM (SELECT *, l_partkey AS product_id, l_shipdate::DATE AS date FROM lineitem) l
    ASOF LEFT JOIN prices p ON l.product_id = p.product_id AND l.date >= p.price_from
""")
def asof_shelf_price(spark, sf_dir):
    """Every line with the shelf price in force at its date.

    Shelf prices change by the month, in which lines with flag N name them.
    """
    lines = _lines(spark, sf_dir)
    prices = (
        lines.where("flag = 'N'")
        .groupBy("product_id", F.trunc("date", "month").alias("price_from"))
        .agg(F.max(F.col("revenue") / F.col("quantity")).alias("price"))
    )
    asked = lines.select("order_id", "line_number", "product_id", "date")
    return asof.asof_join(asked, prices, ["product_id"], "date", "price_from", ["price_from", "price"])


@_register("""
    WITH clicks AS (SELECT user_id, ts AS click_ts, event_id AS click_id FROM events WHERE event_type = 'click')
    SELECT event_id, CASE WHEN click_ts >= ts - INTERVAL 6 HOUR THEN click_id END AS click_id
    FROM events e ASOF LEFT JOIN clicks c ON e.user_id = c.user_id AND e.ts > c.click_ts
""")
def asof_last_click(spark, sf_dir):
    """Every event with its user's last click before it, at most six hours ago."""
    events = _events(spark, sf_dir)
    clicks = events.where("event_type = 'click'").select(
        "user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id")
    )
    asked = events.select("event_id", "user_id", "ts")
    found = asof.asof_join(
        asked, clicks, ["user_id"], "ts", "click_ts", ["click_id"],
        strict=True, within=F.expr("INTERVAL 6 HOURS"),
    )
    return found.select("event_id", "click_id")


@_register("""
    WITH errors AS (SELECT user_id, ts AS error_ts, event_id AS error_id FROM events WHERE event_type = 'error')
    SELECT event_id, error_id FROM events e
    ASOF LEFT JOIN errors x ON e.user_id = x.user_id AND e.ts <= x.error_ts
""")
def asof_next_error(spark, sf_dir):
    """Every event with its user's next error, which may be itself."""
    events = _events(spark, sf_dir)
    errors = events.where("event_type = 'error'").select(
        "user_id", F.col("ts").alias("error_ts"), F.col("event_id").alias("error_id")
    )
    asked = events.select("event_id", "user_id", "ts")
    found = asof.asof_join(
        asked, errors, ["user_id"], "ts", "error_ts", ["error_id"], direction="forward"
    )
    return found.select("event_id", "error_id")


# --- interval joins ---------------------------------------------------------------------
_OPEN_SQL = """
    SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate::DATE AS ordered,
           max(l_shipdate)::DATE AS shipped
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3
"""


def _open_orders(spark, sf_dir):
    """Orders with the days from their date to their last line's."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("ordered"),
    )
    shipped = _lines(spark, sf_dir).groupBy("order_id").agg(F.max("date").alias("shipped"))
    return orders.join(shipped, "order_id")


@_register(f"""
    WITH o AS ({_OPEN_SQL})
    SELECT a.order_id, b.order_id AS other_id, a.user_id,
           (least(a.shipped, b.shipped) - greatest(a.ordered, b.ordered))::INT AS days
    FROM o a JOIN o b ON a.user_id = b.user_id AND a.order_id < b.order_id
    AND a.ordered <= a.shipped AND b.ordered <= b.shipped
    AND a.ordered <= b.shipped AND b.ordered <= a.shipped
""")
def overlapping_orders(spark, sf_dir):
    """Pairs of a customer's orders that were open at the same time, and for how long."""
    opened = materialize(_open_orders(spark, sf_dir))
    span = ("ordered", "shipped")
    pairs = spans.interval_join(opened, opened, span, span, ["user_id"], prefix="other_", finest=4)
    days = F.datediff(F.least("shipped", "other_shipped"), F.greatest("ordered", "other_ordered"))
    return pairs.where(F.col("order_id") < F.col("other_order_id")).select(
        "order_id", F.col("other_order_id").alias("other_id"), "user_id", days.alias("days")
    )


@_register("""
    SELECT x.event_id AS error_id, e.event_type, count(*) AS n, max(e.value) AS most
    FROM events x JOIN events e ON e.ts BETWEEN x.ts - INTERVAL 10 MINUTE AND x.ts
    WHERE x.event_type = 'error' GROUP BY 1, 2
""")
def events_before_errors(spark, sf_dir):
    """What all users did in the ten minutes up to each error: a join on time alone."""
    events = _events(spark, sf_dir)
    events = events.select("event_type", "value", "event_id", spans.as_number(events, "ts").alias("at"))
    errors = events.where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), (F.col("at") - 600_000_000).alias("since"), F.col("at").alias("until")
    )
    points = events.select("event_type", "value", "at")
    measures = {"n": ("count", "at"), "most": ("max", "value")}
    inner, rest, width = spans.whole_bins(errors, points, ("since", "until"), "at", ["event_type"], measures)
    pairs = spans.interval_join(rest, points, ("since", "until"), ("at", "at"), prefix="e_", finest=width)
    outer = pairs.select(
        "error_id", F.col("e_event_type").alias("event_type"), F.lit(1).cast("long").alias("n"), F.col("e_value").alias("most")
    )
    found = inner.select("error_id", "event_type", "n", "most").union(outer)
    return found.groupBy("error_id", "event_type").agg(F.sum("n").alias("n"), F.max("most").alias("most"))


@_register(f"""
    WITH o AS ({_OPEN_SQL})
    SELECT o.order_id, count(*) AS n_lines, sum(l_quantity) AS quantity
    FROM o JOIN orders p ON p.o_custkey = o.user_id
    JOIN lineitem ON l_orderkey = p.o_orderkey AND l_shipdate::DATE BETWEEN o.ordered AND o.shipped
    GROUP BY 1
""")
def shipped_while_open(spark, sf_dir):
    """Per order, the customer's lines of any order that were shipped while it was open."""
    opened = materialize(_open_orders(spark, sf_dir))
    lines = _lines(spark, sf_dir).join(opened.select("order_id", "user_id"), "order_id")
    lines = lines.select("user_id", "date", "quantity")
    pairs = spans.interval_join(
        opened, lines, ("ordered", "shipped"), ("date", "date"), ["user_id"], prefix="line_", finest=4
    )
    return pairs.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("line_quantity").alias("quantity")
    )


# --- cubes --------------------------------------------------------------------------------
_DIMENSIONS = ("department", "brand", "month")
_MEASURES = {
    "n_lines": ("count", "quantity"),
    "quantity": ("sum", "quantity"),
    "least": ("min", "quantity"),
    "most": ("max", "quantity"),
    "mean_quantity": ("avg", "quantity"),
}
_CUBE_SQL = """
    SELECT department, brand, month, grouping_id(department, brand, month) AS grouping_id,
           count(*) AS n_lines, sum(q) AS quantity, min(q) AS least, max(q) AS most,
           round(avg(q), 6) AS mean_quantity
    FROM (SELECT p_type AS department, p_brand AS brand, date_trunc('month', l_shipdate)::DATE AS month,
                 l_quantity AS q FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY {}
"""


def _sales_over(spark, sf_dir, sets):
    """Lines are reduced to products and months, then to brands, then expanded."""
    monthly = _lines(spark, sf_dir).withColumn("month", F.trunc("date", "month"))
    partials = cubes.at_finest(monthly, ["product_id", "month"], _MEASURES)
    parts = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("department"),
        F.col("p_brand").alias("brand"),
    )
    named = partials.join(parts, "product_id")
    found = cubes.over_sets(cubes.combined(named, _DIMENSIONS, _MEASURES), _DIMENSIONS, _MEASURES, sets)
    return found.withColumn("mean_quantity", F.round("mean_quantity", 6))


@_register(_CUBE_SQL.format("CUBE (department, brand, month)"))
def sales_cube(spark, sf_dir):
    """Lines by department, brand and month, and by every subset of these."""
    return _sales_over(spark, sf_dir, cubes.cube_sets(_DIMENSIONS))


@_register(_CUBE_SQL.format("ROLLUP (department, brand, month)"))
def sales_rollup(spark, sf_dir):
    """Months of brands of departments, with subtotals and the total."""
    return _sales_over(spark, sf_dir, cubes.rollup_sets(_DIMENSIONS))


@_register(_CUBE_SQL.format("GROUPING SETS ((department, month), (brand), ())"))
def sales_grouping_sets(spark, sf_dir):
    """Departments by month, brands, and the total."""
    return _sales_over(spark, sf_dir, [("department", "month"), ("brand",), ()])


# --- sketches -----------------------------------------------------------------------------
_PLAN = sketches.SketchPlan(
    distinct={"orders": "order_id"}, values={"revenues": "revenue"}, items={"stores": "store_id"}
)


@_register("""
    WITH l AS (SELECT date_trunc('month', l_shipdate)::DATE AS month, l_orderkey, l_extendedprice, l_suppkey
               FROM lineitem),
         most AS (SELECT month, sum(n) AS n_top FROM (
                      SELECT month, n, row_number() OVER (PARTITION BY month ORDER BY n DESC) AS place
                      FROM (SELECT month, l_suppkey, count(*) AS n FROM l GROUP BY 1, 2)) WHERE place <= 5 GROUP BY 1)
    SELECT l.month, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, any_value(n_top)::BIGINT AS n_top,
           true AS distinct_within, true AS median_within, true AS high_within
    FROM l JOIN most ON l.month = most.month GROUP BY 1
""")
def sketched_months(spark, sf_dir):
    """Months from stored sketches of days, held against the exact answers.

    Distinct orders are within four standard errors, quantiles' ranks within twice
    the 99 % bound, and the five busiest stores' lines exact, as fewer stores than
    the sketch tracks.
    """
    lines = _lines(spark, sf_dir)
    daily = materialize(_PLAN.build(lines, ["date"]))
    month = F.trunc("date", "month").alias("month")
    merged = materialize(_PLAN.merge(daily, [month]))
    told = materialize(
        merged.select(
            "month",
            F.kll_sketch_get_n_double("revenues").alias("n_rows"),
            _PLAN.count("orders").alias("told_orders"),
            _PLAN.quantiles("revenues", [0.5, 0.9]).alias("told"),
            F.aggregate(
                _PLAN.frequent("stores", 5), F.lit(0).cast("long"), lambda n, x: n + x["count"]
            ).alias("n_top"),
        )
    )
    exact = (
        lines.withColumn("month", month)
        .join(told, "month")
        .groupBy("month")
        .agg(
            F.count_distinct("order_id").alias("n_orders"),
            F.avg((F.col("revenue") <= F.col("told")[0]).cast("double")).alias("rank_50"),
            F.avg((F.col("revenue") <= F.col("told")[1]).cast("double")).alias("rank_90"),
            # rows that have the told value itself
            F.avg((F.col("revenue") == F.col("told")[0]).cast("double")).alias("same_50"),
            F.avg((F.col("revenue") == F.col("told")[1]).cast("double")).alias("same_90"),
        )
    )
    off = 2 * _PLAN.rank_error

    def within(rank: str, same: str, p: float):
        return (F.col(rank) >= p - off) & (F.col(rank) - F.col(same) <= p + off)

    gap = F.abs(F.col("told_orders") - F.col("n_orders"))
    return told.join(exact, "month").select(
        "month",
        "n_rows",
        "n_orders",
        "n_top",
        (gap <= 4 * _PLAN.distinct_error * F.col("n_orders")).alias("distinct_within"),
        within("rank_50", "same_50", 0.5).alias("median_within"),
        within("rank_90", "same_90", 0.9).alias("high_within"),
    )


# --- joint price slopes ---------------------------------------------------------------------
_RIDGE = 0.01


def _joint_sql(drivers: tuple[str, ...], names: str, ridge: float) -> str:
    """The slopes by Gauss-Jordan elimination, one step per driver."""
    d = len(drivers)
    steps = [f"m0 AS (SELECT category, a AS r, b AS c, g + CASE WHEN a = b THEN {ridge} ELSE 0 END AS v FROM gram)"]
    for k in range(d):
        steps.append(
            f"m{k + 1} AS (SELECT m.category, m.r, m.c, CASE WHEN m.r = {k} THEN m.v / p.v "
            f"ELSE m.v - f.v * x.v / p.v END AS v FROM m{k} m "
            f"JOIN m{k} p ON p.category = m.category AND p.r = {k} AND p.c = {k} "
            f"JOIN m{k} f ON f.category = m.category AND f.r = m.r AND f.c = {k} "
            f"JOIN m{k} x ON x.category = m.category AND x.r = {k} AND x.c = m.c)"
        )
    return f"""
    WITH points AS (
        SELECT p_type AS category, date_trunc('month', l_shipdate)::DATE AS period,
               ln(sum(l_quantity)) AS q, ln(sum(l_extendedprice) / sum(l_quantity)) AS p
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
    names AS ({names}),
    prices AS (SELECT period, i, p FROM points JOIN names ON category = name),
    whole AS (SELECT period FROM prices GROUP BY 1 HAVING count(*) = {d}),
    x AS (SELECT category, period, i, prices.p AS v FROM points JOIN prices USING (period) JOIN whole USING (period)
          UNION ALL SELECT category, period, {d}, q FROM points JOIN whole USING (period)),
    centred AS (SELECT category, period, i, v - avg(v) OVER (PARTITION BY category, i) AS v FROM x),
    gram AS (SELECT a.category, a.i AS a, b.i AS b, sum(a.v * b.v) AS g FROM centred a
             JOIN centred b ON a.category = b.category AND a.period = b.period WHERE a.i < {d} GROUP BY 1, 2, 3),
    {", ".join(steps)}
    SELECT category, name AS driver, round(v, 4) AS elasticity,
           (SELECT count(*) FROM points JOIN whole USING (period) WHERE points.category = m{d}.category) AS n_points
    FROM m{d} JOIN names ON i = r WHERE c = {d}
    """


_SIX = tuple(f"TYPE{i}" for i in range(6))


@_register(
    _joint_sql(
        _SIX,
        "SELECT name, row_number() OVER (ORDER BY name) - 1 AS i FROM "
        "(SELECT DISTINCT p_type AS name FROM part ORDER BY 1 LIMIT 6)",
        _RIDGE,
    )
)
def joint_elasticity(spark, sf_dir):
    """Price slopes of every department on six departments' prices at once."""
    parts = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category")
    )
    # six names at the most
    drivers = [r.category for r in parts.select("category").distinct().orderBy("category").limit(6).collect()]
    monthly = (
        _lines(spark, sf_dir)
        .groupBy("product_id", F.trunc("date", "month").alias("period"))
        .agg(F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"))
        .join(parts, "product_id")
    )
    points = materialize(elasticity.price_points(monthly, ["category", "period"]))
    found = elasticity.joint_elasticity(points, drivers=drivers, ridge=_RIDGE)
    return found.withColumn("elasticity", F.round("elasticity", 4))


# --- sessions -----------------------------------------------------------------------------
@_register("""
    WITH opened AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 4 HOUR THEN 0 ELSE 1 END AS opens
                    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
         numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM opened)
    SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n_rows,
           count_if(event_type = 'error') AS n_errors, round(sum(value), 4) AS total
    FROM numbered GROUP BY user_id, s
""")
def event_sessions(spark, sf_dir):
    """Users' sessions: events with no more than four hours between neighbours."""
    found = sessions.sessions(
        _events(spark, sf_dir).select("user_id", "ts", "event_type", "value"),
        ["user_id"],
        "ts",
        F.expr("INTERVAL 4 HOURS"),
        n_errors=F.count_if(F.col("event_type") == "error"),
        total=F.sum("value"),
    )
    return found.withColumn("total", F.round("total", 4))


# --- loads compared -------------------------------------------------------------------------
def _two_loads(spark, sf_dir):
    """Lines of both states as two loads of one table."""
    lines = _lines(spark, sf_dir)
    columns = ["product_id", "quantity", "flag"]
    return lines.where("status = 'F'").select(*columns), lines.where("status = 'O'").select(*columns)


_LOADS_SQL = """
    WITH a AS (SELECT l_partkey AS product_id, l_quantity AS quantity, l_returnflag AS flag
               FROM lineitem WHERE l_linestatus = 'F'),
         b AS (SELECT l_partkey AS product_id, l_quantity AS quantity, l_returnflag AS flag
               FROM lineitem WHERE l_linestatus = 'O')
"""


@_register(_LOADS_SQL + """, d AS (
        SELECT product_id, quantity, flag, sum(n) AS n FROM (
            SELECT *, -1 AS n FROM a UNION ALL SELECT *, 1 FROM b) GROUP BY 1, 2, 3)
    SELECT product_id, quantity, flag, greatest(n, 0)::BIGINT AS added, greatest(-n, 0)::BIGINT AS removed
    FROM d WHERE n <> 0
""")
def load_changes(spark, sf_dir):
    """What came and went from one load to the other, counted by row."""
    return compare.changes(*_two_loads(spark, sf_dir))


@_register(_LOADS_SQL + "SELECT * FROM a EXCEPT ALL SELECT * FROM b")
def load_except_all(spark, sf_dir):
    return compare.except_all(*_two_loads(spark, sf_dir))


@_register(_LOADS_SQL + "SELECT * FROM a INTERSECT ALL SELECT * FROM b")
def load_intersect_all(spark, sf_dir):
    return compare.intersect_all(*_two_loads(spark, sf_dir))


# --- JSON and maps ------------------------------------------------------------------------
@_register("""
    SELECT event_type, count(*) AS n, count_if(NOT json_valid(props)) AS n_broken,
           count(props->>'$.k') AS n_k, sum((props->>'$.k')::BIGINT) AS total, max((props->>'$.k')::BIGINT) AS most
    FROM events GROUP BY 1
""")
def event_props(spark, sf_dir):
    """The field ``k`` of the events' JSON text, by type of event."""
    text = F.col("props")
    typed = _events(spark, sf_dir).select(
        "event_type", props.is_broken(text).alias("broken"), props.value_at(text, "$.k", "bigint").alias("k")
    )
    return typed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("broken").alias("n_broken"),
        F.count("k").alias("n_k"),
        F.sum("k").alias("total"),
        F.max("k").alias("most"),
    )


@_register("""
    SELECT key, props->>('$.' || key) AS value, count(*) AS n
    FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY 1, 2
""")
def event_prop_values(spark, sf_dir):
    """Every field of the events' JSON text with its values and how often they come."""
    fields = _events(spark, sf_dir).select(F.explode(props.as_map(F.col("props"))))
    return fields.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


# --- batch similarity -----------------------------------------------------------------------
def _product_vectors(spark, sf_dir):
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("product_id"), F.col("label").alias("category"), "embedding"
    )


def _index(spark, sf_dir):
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    return vector_index.build_index(_product_vectors(spark, sf_dir), path)


@_register()
def similar_batch(spark, sf_dir):
    """The ten products most similar to every twentieth one, by the index."""
    index = _index(spark, sf_dir)
    asked = _product_vectors(spark, sf_dir).where("product_id % 20 = 0")
    found = vector_index.search(index, asked, probes=vector_index.probes_for(index, spark))
    return found.withColumn("similarity", F.round("similarity", 6))


@_register("""
    SELECT count(*) AS n_queries, (SELECT count(*) FROM embeddings) AS n_indexed,
           true AS recall_reached, true AS exact_scores, true AS all_of_category
    FROM embeddings WHERE vec_id % 20 = 0
""")
def similar_batch_checks(spark, sf_dir):
    """Facts of the index: every row is in it, nine in ten true neighbours are found,
    with their exact cosine, and a filter leaves only its category."""
    vectors = _product_vectors(spark, sf_dir)
    index = _index(spark, sf_dir)
    asked = vectors.where("product_id % 20 = 0")
    probes = vector_index.probes_for(index, spark)
    found = materialize(vector_index.search(index, asked, probes=probes))
    true = vector_index.search(index, asked, probes=vector_index.MOST_CELLS)
    hits = found.join(true.select("query", "product_id"), ["query", "product_id"]).count()
    one = vectors.select(F.col("product_id").alias("query"), F.col("embedding").alias("_a"))
    other = vectors.select("product_id", F.col("embedding").alias("_b"))
    scored = found.join(one, "query").join(other, "product_id")
    off = F.abs(cosine(F.col("_a"), F.col("_b")) - F.col("similarity"))
    limited = vector_index.search(index, asked, probes=probes, where=F.col("category") == 1)
    others = limited.join(vectors, "product_id").where("category != 1").count()
    facts = scored.agg(F.count_distinct("query").alias("n_queries"), (F.max(off) < 1e-9).alias("exact_scores"))
    return facts.withColumns(
        {
            "n_indexed": F.lit(index.rows(spark).count()),
            "recall_reached": F.lit(hits >= 0.9 * true.count()),
            "all_of_category": F.lit(others == 0),
        }
    )
