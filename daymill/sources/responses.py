"""Landed responses to rows, with unusable ones set aside rather than raised."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.constants import POLLUTANTS
from daymill.functions.calendar import day
from daymill.functions.text import first_ten
from daymill.schemas import READING_RESPONSE


def flatten_readings(responses: DataFrame, body: str = "body", city: str = "city", keep=()) -> DataFrame:
    """Nested reading responses to (date, city, pollutants, stated, reason), and the columns to keep.

    A missing pollutant is null. `stated` is the time that the response gives, `date` its day.
    `reason` is null for a usable row, else why it is not.
    """
    parsed = responses.withColumn("_r", F.from_json(F.col(body), READING_RESPONSE))
    values = [
        F.col(f"_r.data.iaqi.{p}.v").try_cast("double").alias(p) for p in POLLUTANTS
    ]
    date = day(first_ten(F.col("_r.data.time.s")))
    return parsed.select(
        date.alias("date"),
        F.col(city).alias("city"),
        *values,
        F.col("_r.data.time.s").alias("stated"),
        _reason(F.col("_r.status"), date, F.col(city)).alias("reason"),
        *keep,
    )


def _reason(status: Column, date: Column, city: Column) -> Column:
    return (
        F.when(status.isNull(), "no status")
        .when(status != "ok", "status not ok")
        .when(date.isNull(), "no date")
        .when(city.isNull(), "no city")
    )


def usable(flattened: DataFrame) -> DataFrame:
    return flattened.filter(F.col("reason").isNull()).drop("reason")


def quarantined(flattened: DataFrame) -> DataFrame:
    return flattened.filter(F.col("reason").isNotNull())
