"""From features to forecast rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill import workspace
from daymill.constants import HORIZONS
from daymill.functions.text import model_name
from daymill.models.stacked import predict_with_champions
from daymill.operators.joins import per_horizon
from daymill.operators.topn import latest_row


def forecast_inputs(features: DataFrame, forecast_date, horizons=HORIZONS) -> DataFrame:
    """Newest feature row of each city, once per horizon, with the model to use.

    `target_date` counts from the day of the forecast and `seasonal_date` from the day of the
    features; they differ when the stored data is stale.
    """
    return per_horizon(latest_row(features), horizons).withColumns(
        {
            "forecast_date": F.lit(forecast_date).cast("date"),
            "target_date": F.date_add(F.lit(forecast_date).cast("date"), F.col("horizon")),
            "seasonal_date": F.date_add("date", F.col("horizon")),
            "model": model_name(F.col("city"), F.col("horizon")),
        }
    )


def as_forecasts(scored: DataFrame) -> DataFrame:
    """Scored inputs in the shape of the forecast log."""
    return scored.select(
        "city",
        "forecast_date",
        "target_date",
        F.col("horizon").cast("int").alias("horizon"),
        F.col("predicted").cast("double").alias("predicted"),
        F.lit(None).cast("double").alias("actual"),
    )


def forecast(
    spark: SparkSession, latest: DataFrame, champions: DataFrame, forecast_date, horizons=HORIZONS
) -> DataFrame:
    """Forecast rows of every city with a champion, from its newest features."""
    day = F.lit(forecast_date).cast("date")
    latest = workspace.materialize(latest, "latest")
    champions = workspace.materialize(champions, "champions")
    scored = predict_with_champions(spark, latest, champions, horizons)
    return as_forecasts(
        scored.withColumns({"forecast_date": day, "target_date": F.date_add(day, F.col("horizon"))})
    )
