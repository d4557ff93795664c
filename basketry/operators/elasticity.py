"""Price elasticity by log-log least squares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def price_points(
    sales: DataFrame,
    keys: Sequence[str],
    quantity: str = "quantity",
    revenue: str = "revenue",
) -> DataFrame:
    """Log quantity and log mean unit price per key (product, period, ...)."""
    return (
        sales.groupBy(*keys)
        .agg(F.sum(quantity).alias("_q"), F.sum(revenue).alias("_r"))
        .where((F.col("_q") > 0) & (F.col("_r") > 0))
        .select(
            *keys,
            F.ln("_q").alias("ln_quantity"),
            F.ln(F.col("_r") / F.col("_q")).alias("ln_price"),
        )
    )


def own_elasticity(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Slope of log quantity on log own price per group.

    ``by`` is a category, or segment and category for price sensitivity by
    customer segment.
    """
    y, x = F.col("ln_quantity"), F.col("ln_price")
    return points.groupBy(*by).agg(
        F.regr_slope(y, x).alias("elasticity"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n_points"),
    )


def cross_elasticity(
    points: DataFrame,
    category: str = "category",
    period: str = "period",
    drivers: Sequence[str] = (),
    batch: int = 100,
) -> DataFrame:
    """Slope of one category's log quantity on another one's log price.

    Takes one row per category and period. The prices of the driver
    categories become columns of a table with one row per period, which is
    joined once; all slopes then come out of one aggregation. So rows never
    multiply by category pairs, only the result has a row per pair.

    The drivers are named by the caller, as the result has a row for each of
    them and each category; without any it is empty. They are handled ``batch``
    at a time to bound the width: pass stored points if there are more.
    """
    if not drivers:
        return points.select(
            category,
            F.lit("").alias("driver"),
            F.lit(0.0).alias("elasticity"),
            F.lit(0).cast("bigint").alias("n_points"),
        ).limit(0)
    parts = [
        _cross_batch(points, category, period, drivers[i : i + batch])
        for i in range(0, len(drivers), batch)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _cross_batch(
    points: DataFrame, category: str, period: str, drivers: Sequence[str]
) -> DataFrame:
    columns = [f"_price_{i}" for i in range(len(drivers))]
    prices = (
        points.groupBy(period)
        .pivot(category, list(drivers))
        .agg(F.first("ln_price"))
        .toDF(period, *columns)
    )
    y = F.col("ln_quantity")
    fitted = (
        points.join(prices, period)
        .groupBy(category)
        .agg(
            F.array(
                *[
                    F.struct(
                        F.lit(driver).alias("driver"),
                        F.regr_slope(y, F.col(c)).alias("elasticity"),
                        F.regr_count(y, F.col(c)).alias("n_points"),
                    )
                    for driver, c in zip(drivers, columns)
                ]
            ).alias("_fits")
        )
    )
    return fitted.select(category, F.inline("_fits")).where(
        F.col("driver") != F.col(category)
    )


def joint_elasticity(
    points: DataFrame,
    category: str = "category",
    period: str = "period",
    drivers: Sequence[str] = (),
    ridge: float = 0.0,
) -> DataFrame:
    """Slopes of one category's log quantity on all drivers' log prices at once.

    Each slope is at equal prices of the other drivers, unlike the single ones of
    ``cross_elasticity``. Takes one row per category and period. Only periods in
    which all drivers have a price count. ``ridge`` is added to the diagonal of
    the centred Gram matrix, which keeps slopes small where prices move together.

    Returns a row per category and driver: elasticity, n_points. Where the
    equations have no single solution (fewer periods than drivers, prices that
    move as one, no ridge) the elasticity is null.

    One aggregate per category gives all products of prices and of prices and
    quantity; the equations are then solved within the row, by elimination over
    an array of arrays, so nothing is collected. The aggregate has about
    drivers^2 / 2 sums: name at most some dozens.
    """
    d = len(drivers)
    if not d:
        return cross_elasticity(points, category, period)
    names = [f"_price_{i}" for i in range(d)]
    prices = (
        points.groupBy(period).pivot(category, list(drivers)).agg(F.first("ln_price")).toDF(period, *names)
    ).na.drop(subset=names)
    y = "ln_quantity"
    columns = [*names, y]
    rows = points.where(F.col(y).isNotNull()).join(prices, period)
    # deviations from a mean are what counts, so sums are taken of those from any
    # fixed point near them: products of raw logarithms would lose digits
    near = rows.agg(F.struct(*(F.avg(c).alias(c) for c in columns))).scalar()
    moved = rows.select(category, *((F.col(c) - near[c]).alias(c) for c in columns))
    products = [F.sum(F.col(a) * F.col(b)).alias(f"_{a}*{b}") for i, a in enumerate(columns) for b in columns[i:]]
    summed = moved.groupBy(category).agg(
        F.count(F.lit(1)).alias("n_points"), *(F.sum(c).alias(f"_{c}") for c in columns), *products
    )

    def gram(a: str, b: str) -> Column:
        a, b = sorted((a, b), key=columns.index)
        return F.col(f"`_{a}*{b}`") - F.col(f"_{a}") * F.col(f"_{b}") / F.col("n_points")

    matrix = F.array(
        *(
            F.array(*(gram(a, b) + (ridge if a == b else 0.0) for b in columns))
            for a in names
        )
    )
    solved = summed.select(category, "n_points", _eliminated(matrix, d).alias("_solved"))
    fits = F.array(
        *(
            F.struct(F.lit(driver).alias("driver"), F.col("_solved")[i][d].alias("elasticity"), "n_points")
            for i, driver in enumerate(drivers)
        )
    )
    return solved.select(category, F.inline(fits))


def _eliminated(matrix: Column, d: int) -> Column:
    """Rows of [A | b] after Gauss-Jordan elimination; nulls where A is singular.

    A is symmetric and not negative, so its pivots need no exchange of rows. A
    pivot that elimination leaves at a 1e-12th of its entry counts as zero.
    """
    least = F.transform(matrix, lambda row, i: F.try_element_at(row, i + 1) * F.lit(1e-12))

    def step(rows: Column, k: Column) -> Column:
        own = F.element_at(rows, k)
        pivot = F.element_at(own, k)
        usable = F.when(pivot > F.element_at(least, k), pivot)
        scaled = F.transform(own, lambda x: x / usable)
        return F.transform(
            rows,
            lambda row, i: F.when(i + 1 == k, scaled).otherwise(
                F.zip_with(row, scaled, lambda x, p: x - F.element_at(row, k) * p)
            ),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(d)), matrix, step)
