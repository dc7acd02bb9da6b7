"""Latest forecasts and recent history of one city from the stored tables, opening the last months only."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill import schemas
from daymill.operators import topn
from daymill.plans.daily import Tables
from daymill.sources import versions


def _newest(spark: SparkSession, path: str, schema, cities: DataFrame, city: str, n: int) -> DataFrame:
    """Rows of a city in the last months that hold n of them.

    The name is resolved among the stored ones, whatever its case, and must be in the dimension; then equality with the
    spellings found goes to the scan, and the counts by city and month tell where to stop.
    """
    state = versions.current(spark, path)
    names = versions.read_counts(spark, path, state=state).select("city").distinct()
    known = topn.known_cities(topn.in_city(names, city), cities)
    spellings = [r.city for r in known.collect()]
    folders = versions.newest_folders(spark, path, spellings, n, state) if spellings else []
    rows = versions.read(spark, path, schema, folders, state).drop("year", "month")
    return rows.filter(F.col("city").isin(spellings) if spellings else F.lit(False))


def latest_forecast(spark: SparkSession, tables: Tables, cities: DataFrame, city: str, n: int = 7, strict: bool = False) -> DataFrame:
    """As `topn.latest_forecast` over the stored log."""
    rows = _newest(spark, tables.forecasts, schemas.FORECAST, cities, city, n)
    return topn.latest_forecast(rows, cities, city, n, strict)


def history(spark: SparkSession, tables: Tables, cities: DataFrame, city: str, days: int = 30) -> DataFrame:
    """As `topn.history` over the stored readings."""
    return topn.history(_newest(spark, tables.readings, schemas.READING, cities, city, days), cities, city, days)
