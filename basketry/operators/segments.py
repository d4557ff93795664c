"""Customer value: recency, frequency, monetary; scores and segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from basketry.operators.baskets import basket_sizes
from basketry.operators.ranking import ntile_of, with_row_number
from basketry.session import materialize

RFM = ("recency_days", "frequency", "monetary")


def rfm(
    orders: DataFrame,
    user: str = "user_id",
    date: str = "order_date",
    amount: str = "amount",
) -> DataFrame:
    """Days since the last order, number of orders and total spent per customer.

    Recency is measured from the last date in the table.
    """
    today = orders.agg(F.max(date)).scalar()
    return (
        orders.groupBy(user)
        .agg(
            F.max(date).alias("_last"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum(amount).alias("monetary"),
        )
        .select(
            user,
            F.datediff(today, F.col("_last")).alias("recency_days"),
            "frequency",
            "monetary",
        )
    )


def rfm_undated(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The same for orders that carry a sequence number but no date.

    Recency is the gap before the customer's last order and monetary the
    number of lines bought. A customer with a single order has no gap and gets
    the longest one in the table: nothing shows that they came back.
    """
    longest = orders.agg(F.max("days_since_prior_order")).scalar()
    sizes = basket_sizes(items)
    return (
        orders.withColumn("_longest", longest)
        .join(sizes, "order_id", "left")
        .groupBy("user_id")
        .agg(
            F.coalesce(
                F.max_by("days_since_prior_order", "order_number"), F.max("_longest")
            ).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.coalesce(F.sum("basket_size"), F.lit(0)).alias("monetary"),
        )
    )


def rfm_scores(table: DataFrame, user: str = "user_id", tiles: int = 5) -> DataFrame:
    """Scores 1..``tiles`` per measure, as equal-sized groups of customers.

    The best customers score highest; the customer key breaks ties. Each
    measure is ranked by a distributed sort of the measure and the key alone;
    only the first row of each tile is kept of it, and all scores follow from
    comparing each customer with those few borders. A missing recency counts
    as the longest. Runs jobs.
    """
    table = materialize(table)
    n_rows = table.agg(F.count(F.lit(1))).scalar()
    best_last = {
        "r_score": -F.coalesce(F.col("recency_days").cast("double"), F.lit(float("inf"))),
        "f_score": F.coalesce(F.col("frequency").cast("double"), F.lit(float("-inf"))),
        "m_score": F.coalesce(F.col("monetary").cast("double"), F.lit(float("-inf"))),
    }
    scores = {}
    for name, measure in best_last.items():
        narrow = table.select(measure.alias("_m"), user)
        ranked = with_row_number(narrow, ["_m", user], "_rank")
        tile = ntile_of(F.col("_rank"), n_rows, tiles)
        borders = (  # a row for each tile
            ranked.groupBy(tile.alias("_tile"))
            .agg(F.min(F.struct("_m", user)).alias("_first"))
            .orderBy("_tile")
            .collect()
        )
        score = F.lit(None).cast("int")
        for b in borders:
            key = F.lit(b["_first"][user])
            at_least = (measure > b["_first"]["_m"]) | (
                (measure == b["_first"]["_m"]) & (F.col(user) >= key)
            )
            score = F.when(at_least, F.lit(b["_tile"])).otherwise(score)
        scores[name] = score.cast("int")
    return table.withColumns(scores)


def fit_segments(
    table: DataFrame, k: int = 4, seed: int = 42, columns: Sequence[str] = RFM
) -> PipelineModel:
    """KMeans on standardised log measures.

    Every iteration reads ``table``, so pass a stored or materialised one.
    """
    assembler = VectorAssembler(
        inputCols=[f"log_{c}" for c in columns], outputCol="_raw"
    )
    scaler = StandardScaler(
        inputCol="_raw", outputCol="features", withMean=True, withStd=True
    )
    kmeans = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="segment")
    stages = Pipeline(stages=[assembler, scaler, kmeans])
    return stages.fit(log_measures(table, columns))


def choose_segments(
    table: DataFrame, counts: Sequence[int] = (2, 3, 4, 5, 6), seed: int = 42
) -> tuple[PipelineModel, dict[int, float]]:
    """The model with the best mean silhouette of these numbers of segments.

    Returns it and the silhouette of each number. Pass a stored or
    materialised table of more customers than segments.
    """
    models = {k: fit_segments(table, k, seed) for k in counts}
    found = {k: silhouette(assign_segments(m, table)) for k, m in models.items()}
    return models[max(found, key=lambda k: (found[k], -k))], found


def log_measures(table: DataFrame, columns: Sequence[str] = RFM) -> DataFrame:
    """Adds log(1 + x) of each measure, a missing one counting as zero."""
    return table.withColumns(
        {
            f"log_{c}": F.log1p(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)))
            for c in columns
        }
    )


def assign_segments(
    model: PipelineModel, table: DataFrame, columns: Sequence[str] = RFM
) -> DataFrame:
    return model.transform(log_measures(table, columns)).drop(
        "_raw", *[f"log_{c}" for c in columns]
    )


def silhouette(segmented: DataFrame) -> float:
    """Mean silhouette of a segmentation; above zero means separated groups."""
    return ClusteringEvaluator(
        featuresCol="features", predictionCol="segment"
    ).evaluate(segmented)
