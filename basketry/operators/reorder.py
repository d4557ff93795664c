"""Will a customer buy a product again in the next order?"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from basketry.operators.forecast import stored_frame
from basketry.session import materialize

FEATURES = ("times_bought", "order_share", "orders_since", "n_orders")


def purchases(
    orders: DataFrame,
    items: DataFrame,
    user: str = "user_id",
    order: str = "order_id",
    number: str = "order_number",
    product: str = "product_id",
) -> DataFrame:
    """One row per order line, with what the customer's last order tells.

    ``_last`` is the customer's last order number and ``_last_known`` whether
    that order has lines. Both are reduced to a row per customer and written
    first, so that they meet the orders in a plain join whose hot customers
    Spark splits; the lines then come in by order, not by customer. Where both
    kinds of features are wanted, store the result and pass it to both.
    """
    filled = items.select(order).distinct().withColumn("_has_lines", F.lit(True))
    flagged = materialize(orders.select(order, user, number).join(filled, order, "left"))
    totals = materialize(
        flagged.groupBy(user).agg(
            F.max(number).alias("_last"),
            F.max(F.when(F.col("_has_lines"), F.col(number))).alias("_filled"),
        )
    )
    known = F.coalesce(F.col("_filled") == F.col("_last"), F.lit(False))
    placed = flagged.where("_has_lines").join(
        totals.select(user, "_last", known.alias("_last_known")), user
    )
    return items.select(order, product).join(placed, order)


def reorder_features(
    orders: DataFrame,
    items: DataFrame,
    user: str = "user_id",
    order: str = "order_id",
    number: str = "order_number",
    product: str = "product_id",
    placed: DataFrame | None = None,
) -> DataFrame:
    """One row per customer and product bought before the customer's last order.

    ``label`` is 1 when the last order has the product again, NULL when that
    order has no lines, so that nothing is known of it. Only purchases before
    it feed the other columns. ``number`` counts a customer's orders from 1.
    ``placed`` is what ``purchases`` gives, if it is there already. Runs jobs.
    """
    if placed is None:
        placed = purchases(orders, items, user, order, number, product)
    earlier = F.col(number) < F.col("_last")
    return (
        placed.groupBy(user, product)
        .agg(
            F.count_distinct(F.when(earlier, F.col(number))).alias("times_bought"),
            F.max(F.when(earlier, F.col(number))).alias("_recent"),
            F.max((~earlier).cast("int")).alias("_again"),
            F.max("_last").alias("_last"),
            F.bool_or("_last_known").alias("_last_known"),
        )
        .where(F.col("times_bought") > 0)
        .select(
            user,
            product,
            "times_bought",
            (F.col("times_bought") / (F.col("_last") - 1)).alias("order_share"),
            (F.col("_last") - F.col("_recent")).alias("orders_since"),
            (F.col("_last") - 1).alias("n_orders"),
            F.when(F.col("_last_known"), F.col("_again")).alias("label"),
        )
    )


def next_order_features(
    orders: DataFrame,
    items: DataFrame,
    user: str = "user_id",
    order: str = "order_id",
    number: str = "order_number",
    product: str = "product_id",
    placed: DataFrame | None = None,
) -> DataFrame:
    """The same columns for the order that comes next, without a label.

    All orders of a customer count. A last order without lines is itself the
    next one, as what is in it is still to be told. ``placed`` is what ``purchases``
    gives, if it is there already. Runs jobs.
    """
    if placed is None:
        placed = purchases(orders, items, user, order, number, product)
    done = F.max(F.when(F.col("_last_known"), F.col("_last")).otherwise(F.col("_last") - 1))
    return (
        placed.groupBy(user, product)
        .agg(
            F.count_distinct(number).alias("times_bought"),
            F.max(number).alias("_recent"),
            done.alias("n_orders"),
        )
        .select(
            user,
            product,
            "times_bought",
            (F.col("times_bought") / F.col("n_orders")).alias("order_share"),
            (F.col("n_orders") + 1 - F.col("_recent")).alias("orders_since"),
            "n_orders",
        )
    )


def split_customers(
    table: DataFrame, user: str = "user_id", held_out: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Rows with a label of most customers to fit on, and of the others to test on."""
    known = table.where("label IS NOT NULL")
    bucket = F.pmod(F.xxhash64(user), F.lit(1000))
    edge = round(held_out * 1000)
    return known.where(bucket >= edge), known.where(bucket < edge)


def alike(table: DataFrame, features: Sequence[str] = FEATURES, label: str = "label") -> DataFrame:
    """One row for all rows of the same features and label, ``n_alike`` of them.

    The features are counts of a customer's orders and a share of two of them, so
    customers with like histories share rows: how many there are follows the length
    of histories, not the number of customers. Runs jobs: the rows are written, in
    as few parts as they need.
    """
    grouped = table.groupBy(*features, label).agg(F.count(F.lit(1)).alias("n_alike"))
    return stored_frame(grouped)


def with_class_weight(table: DataFrame, label: str = "label", count: str | None = None) -> DataFrame:
    """Weights that give both classes the same total.

    ``count`` names how many rows a row stands for, each of which has its weight.
    """
    told, each = F.col(label).cast("double"), F.col(count) if count else F.lit(1)
    rate = table.agg(F.try_divide(F.sum(told * each), F.sum(F.when(told.isNotNull(), each)))).scalar()
    weight = F.when(F.col(label) == 1, F.try_divide(F.lit(0.5), rate)).otherwise(
        F.try_divide(F.lit(0.5), F.lit(1.0) - rate)
    )
    return table.withColumn("weight", weight * each)


def fit_reorder_model(
    table: DataFrame, features: Sequence[str] = FEATURES
) -> PipelineModel:
    """Class-weighted logistic regression on the reorder features.

    Rows without a label, of customers whose last order is unknown, are left
    out; if a class is missing its weight is. Every iteration reads ``table``, so pass a stored or materialised one.
    """
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features"),
        LogisticRegression(weightCol="weight", maxIter=50, regParam=0.001),
    ]
    return Pipeline(stages=stages).fit(
        with_class_weight(table.where("label IS NOT NULL"))
    )


@dataclass(frozen=True)
class ReorderTrees:
    """Boosted trees and the curve that turns their margin into a probability."""

    trees: PipelineModel
    curve: IsotonicRegressionModel

    def score(self, table: DataFrame) -> DataFrame:
        """Adds ``reorder_probability``."""
        scored = _with_margin(self.trees.transform(table))
        return self.curve.transform(scored).drop("features", "rawPrediction", "probability", "prediction", "_margin")


def _with_margin(scored: DataFrame) -> DataFrame:
    return scored.withColumn("_margin", vector_to_array("rawPrediction")[1])


def fit_reorder_trees(
    table: DataFrame,
    features: Sequence[str] = FEATURES,
    user: str = "user_id",
    calibrate_on: float = 0.2,
    **params,
) -> ReorderTrees:
    """Class-weighted gradient-boosted trees on the reorder features, calibrated.

    The weights make the trees look at both classes alike, so their scores are no
    probabilities. An isotonic curve of the label on the trees' margin, fitted
    without weights on a share of customers that the trees have not seen, makes
    them so. ``params`` override the trees' settings. Rows without a label are
    left out. Rows of the same features and label are one row of their common
    weight to the trees and the curve. Pass a stored or materialised table. Runs jobs.
    """
    known = table.where("label IS NOT NULL")
    bucket = F.pmod(F.xxhash64(user, F.lit("curve")), F.lit(1000))
    edge = round(calibrate_on * 1000)
    settings = {"maxIter": 40, "maxDepth": 4, "stepSize": 0.1, "seed": 42, **params}
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        GBTClassifier(weightCol="weight", **settings),
    ]
    seen = alike(known.where(bucket >= edge), features)
    trees = Pipeline(stages=stages).fit(with_class_weight(seen, count="n_alike"))
    unseen = _with_margin(trees.transform(alike(known.where(bucket < edge), features)))
    curve = IsotonicRegression(
        featuresCol="_margin", labelCol="label", weightCol="n_alike", predictionCol="reorder_probability"
    )
    return ReorderTrees(trees, curve.fit(unseen.withColumn("label", F.col("label").cast("double"))))


def score_reorders(model: PipelineModel, table: DataFrame) -> DataFrame:
    """Adds ``reorder_probability``."""
    scored = model.transform(table)
    return scored.withColumn(
        "reorder_probability", vector_to_array("probability")[1]
    ).drop("_raw", "features", "probability", "prediction")


def area_under_roc(scored: DataFrame) -> float:
    return BinaryClassificationEvaluator().evaluate(scored)
