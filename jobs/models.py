"""spark-submit jobs/models.py --tables OUT --models MODELS [--model NAME]

Fits the demand, segment and reorder models on the stored tables, saves each
under MODELS and writes its result table next to it.
"""

import argparse
import logging

from pyspark.sql import functions as F

from basketry.operators import elasticity, forecast, reorder, segments, series
from basketry.session import build_session, materialize
from basketry.sources.catalog import Catalog
from basketry.sources.sink import write_table

logger = logging.getLogger("models")

#: Departments whose prices may drive all others; the result has their square.
MOST_DRIVERS = 500
#: Up to so many, their joint slopes are written too; the ridge of that model.
JOINT_DRIVERS, RIDGE = 40, 0.01


def demand(tables: Catalog, out: str) -> None:
    keys = ["item_id", "store_id"]
    sales = tables.load_m5_sales()
    last = series.last_day(sales)
    daily = series.daily_totals(sales, keys)
    frame = materialize(forecast.training_frame(daily, keys, last))
    train, test = series.time_split(frame, last)
    model = forecast.fit_forecaster(forecast.stored_frame(train))
    model.write().overwrite().save(f"{out}/demand_model")
    logger.info("rmse, model and baseline: %s", forecast.forecast_error(model, test))
    future = forecast.future_frame(daily, keys, last)
    write_table(forecast.forecast(model, future, keys), f"{out}/demand_forecast")


def segment(tables: Catalog, out: str) -> None:
    table = materialize(
        segments.rfm_undated(tables.load_orders(), tables.load_order_items())
    )
    model, found = segments.choose_segments(table)
    logger.info("mean silhouette by number of segments: %s", found)
    model.write().overwrite().save(f"{out}/segment_model")
    assigned = segments.assign_segments(model, table).drop("features")
    write_table(assigned, f"{out}/customer_segments")


def reorders(tables: Catalog, out: str) -> None:
    """Fit on known last orders, test on held-out customers, score the next order."""
    orders, items = tables.load_orders(), tables.load_order_items()
    placed = materialize(reorder.purchases(orders, items))
    table = materialize(reorder.reorder_features(orders, items, placed=placed))
    fits, tests = reorder.split_customers(table)
    model = reorder.fit_reorder_model(fits)
    model.write().overwrite().save(f"{out}/reorder_model")
    if not tests.isEmpty():
        area = reorder.area_under_roc(model.transform(tests))
        logger.info("area under the curve, held-out customers: %.4f", area)
    upcoming = reorder.next_order_features(orders, items, placed=placed)
    write_table(reorder.score_reorders(model, upcoming), f"{out}/reorder_scores")


def prices(tables: Catalog, out: str) -> None:
    """Own and cross elasticity per category from weekly units and prices."""
    weekly = (
        tables.load_m5_sales()
        .groupBy(
            "cat_id", "dept_id", "item_id", "store_id",
            # sales weeks start on Saturday
            F.date_sub("date", F.dayofweek("date") % 7).alias("week_start"),
        )
        .agg(F.sum("sales").alias("quantity"))
        .join(tables.load_sell_prices(), ["item_id", "store_id", "week_start"])
        .withColumn("revenue", F.col("quantity") * F.col("sell_price"))
    )
    item_weeks = elasticity.price_points(weekly, ["cat_id", "item_id", "week_start"])
    write_table(elasticity.own_elasticity(item_weeks, ["cat_id"]), f"{out}/own_elasticity")
    dept_weeks = materialize(elasticity.price_points(weekly, ["dept_id", "week_start"]))
    names = dept_weeks.select("dept_id").distinct().orderBy("dept_id").limit(MOST_DRIVERS + 1)
    drivers = [row[0] for row in names.collect()]
    if len(drivers) > MOST_DRIVERS:
        raise ValueError(f"more than {MOST_DRIVERS} departments: name the drivers instead")
    crossed = elasticity.cross_elasticity(dept_weeks, "dept_id", "week_start", drivers)
    write_table(crossed, f"{out}/cross_elasticity")
    if len(drivers) <= JOINT_DRIVERS:
        joint = elasticity.joint_elasticity(dept_weeks, "dept_id", "week_start", drivers, RIDGE)
        write_table(joint, f"{out}/joint_elasticity")


MODELS = {
    "demand": demand,
    "segments": segment,
    "reorders": reorders,
    "prices": prices,
}


def main() -> None:
    parser = argparse.ArgumentParser(description="Fit models on the stored tables")
    parser.add_argument("--tables", required=True, help="folder of the tables")
    parser.add_argument("--models", required=True, help="folder for the results")
    parser.add_argument("--model", choices=sorted(MODELS), action="append")
    parser.add_argument("--shuffle-partitions", type=int, help="starting shuffle width")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = build_session("models", shuffle_partitions=args.shuffle_partitions)
    tables = Catalog(spark, args.tables)
    for name in args.model or MODELS:
        MODELS[name](tables, args.models.rstrip("/"))


if __name__ == "__main__":
    main()
