"""Forecast errors, blending and model choice, all as one-pass aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.operators.aggregate import first_per_key


def regression_metrics(
    df: DataFrame, by=(), actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Row count, RMSE, MAE and R2 per group, over rows that have both values.

    A constant truth gives R2 = 1 without error and 0 with; a single row has no R2 (NaN).
    """
    error = F.col(actual) - F.col(predicted)
    sums = (
        df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(error * error).alias("_sse"),
            F.avg(F.abs(error)).alias("mae"),
            F.var_pop(actual).alias("_var"),
            F.min(actual).alias("_lo"),
            F.max(actual).alias("_hi"),
        )
    )
    r2 = (
        F.when(F.col("n") < 2, F.lit(float("nan")))
        .when(F.col("_lo") == F.col("_hi"), F.when(F.col("_sse") == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.col("_sse") / (F.col("n") * F.col("_var")))
    )
    return sums.select(
        *by, "n", F.sqrt(F.try_divide("_sse", "n")).alias("rmse"), "mae", r2.alias("r2")
    )


def fit_blend(df: DataFrame, by, first: str, second: str, target: str) -> DataFrame:
    """Least squares of target on two predictors and an intercept, per group: w0, w1, w2.

    Closed form from the population moments. When the predictors are collinear the solution of
    smallest norm is taken.
    """
    rows = df.dropna(subset=[first, second, target])
    m = rows.groupBy(*by).agg(
        F.avg(first).alias("_ma"),
        F.avg(second).alias("_mb"),
        F.avg(target).alias("_my"),
        F.var_pop(first).alias("_vaa"),
        F.var_pop(second).alias("_vbb"),
        F.covar_pop(first, second).alias("_vab"),
        F.covar_pop(first, target).alias("_vay"),
        F.covar_pop(second, target).alias("_vby"),
    )
    product = F.col("_vaa") * F.col("_vbb")
    det = product - F.col("_vab") * F.col("_vab")
    total = F.col("_vaa") + F.col("_vbb")
    independent = det > 1e-12 * product

    def weight(own, other, own_y, other_y):
        exact = (F.col(own_y) * F.col(other) - F.col(other_y) * F.col("_vab")) / det
        smallest = F.coalesce(F.try_divide(F.col(own_y), total), F.lit(0.0))
        return F.when(independent, exact).otherwise(smallest)

    return (
        m.withColumn("w1", weight("_vaa", "_vbb", "_vay", "_vby"))
        .withColumn("w2", weight("_vbb", "_vaa", "_vby", "_vay"))
        .withColumn("w0", F.col("_my") - F.col("w1") * F.col("_ma") - F.col("w2") * F.col("_mb"))
        .select(*by, "w0", "w1", "w2")
    )


def apply_blend(df: DataFrame, weights: DataFrame, by, first: str, second: str) -> DataFrame:
    """Blended prediction. Rows of groups without weights stay, with a null prediction; `unblended` names the groups."""
    blended = F.col("w0") + F.col("w1") * F.col(first) + F.col("w2") * F.col(second)
    return df.join(weights, list(by), "left").withColumn("predicted", blended).drop("w0", "w1", "w2")


def unblended(df: DataFrame, weights: DataFrame, by) -> DataFrame:
    """Groups that `apply_blend` cannot predict, with the reason."""
    groups = df.select(*by).distinct().join(weights, list(by), "left_anti")
    return groups.withColumn("reason", F.lit("no blend weights: no rows with both predictions to fit them on"))


def best_by_error(df: DataFrame, keys, order: str, error: str = "rmse") -> DataFrame:
    """Lowest error per key; equal errors keep the earlier one, and NaN never wins.

    One pass over all runs gives what promoting run after run on strictly lower error gives.
    """
    valid = df.filter(F.col(error).isNotNull() & ~F.isnan(error))
    return first_per_key(valid, keys, [F.col(error), F.col(order)])
