"""Joins of readings, weather and the city dimension. No side is force-broadcast: the planner
does that where the side's measured size allows, and shuffles on the key otherwise."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.constants import HORIZONS


def merge_weather(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Every reading with the weather of its city and day, where there is any. Readings without a city or a
    day match nothing; they are spread over the partitions of the join instead of meeting in one."""
    known = F.col("city").isNotNull() & F.col("date").isNotNull()
    spread = F.when(known, 0).otherwise(F.pmod(F.xxhash64(*readings.columns), F.lit(1000)) + 1)
    left = readings.withColumn("_spread", spread.cast("int"))
    right = weather.withColumn("_spread", F.lit(0))
    return left.join(right, ["city", "date", "_spread"], "left").drop("_spread")


def with_city(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Coordinates and station of each row's city; rows of unknown cities are dropped."""
    return df.join(cities, "city")


def per_horizon(df: DataFrame, horizons=HORIZONS) -> DataFrame:
    """Each row once per forecast horizon."""
    return df.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
