"""Latest rows: per series and for one city."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_city(df: DataFrame, n: int, *order, key: str = "city") -> DataFrame:
    """First n rows of each city by `order`. Each task keeps at most n rows per city before the
    shuffle, so a long series stays cheap."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def latest_row(df: DataFrame) -> DataFrame:
    """The newest row of every city."""
    return top_n_per_city(df, 1, F.desc("date"))


def in_city(df: DataFrame, city: str) -> DataFrame:
    return df.filter(F.lower("city") == city.lower())


def known_cities(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Rows whose city is in the dimension, ignoring case."""
    names = cities.select(F.lower("city").alias("_name")).distinct()
    return df.join(names, F.lower("city") == F.col("_name"), "left_semi")


FORECAST_COLUMNS = ["city", "forecast_date", "target_date", "horizon", "predicted", "actual"]
HISTORY_COLUMNS = ["date", "city", "pm10"]


def latest_forecast(log: DataFrame, cities: DataFrame, city: str, n: int = 7, strict: bool = False) -> DataFrame:
    """The n newest forecast rows of one city, newest forecast first, then by horizon.

    When the newest forecast has fewer than n horizons the plain form continues with the one
    before it; the strict form stops at the newest date.
    """
    rows = known_cities(in_city(log, city), cities)
    top = rows.orderBy(F.desc("forecast_date"), F.asc("horizon")).limit(n).select(*FORECAST_COLUMNS)
    if not strict:
        return top
    newest = F.max("forecast_date").over(Window.partitionBy("city"))
    return top.withColumn("_newest", newest).filter("forecast_date = _newest").drop("_newest")


def history(readings: DataFrame, cities: DataFrame, city: str, days: int = 30) -> DataFrame:
    """The last `days` rows of one city, newest first."""
    rows = known_cities(in_city(readings, city), cities)
    return rows.orderBy(F.desc("date")).limit(days).select(*HISTORY_COLUMNS)


def latest_forecast_all(log: DataFrame, n: int = 7) -> DataFrame:
    top = top_n_per_city(log, n, F.desc("forecast_date"), F.asc("horizon"))
    return top.select(*FORECAST_COLUMNS)


def history_all(readings: DataFrame, days: int = 30) -> DataFrame:
    return top_n_per_city(readings, days, F.desc("date")).select(*HISTORY_COLUMNS)
