"""From landed documents and historical files to the stored tables, for a range of days or all of them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill import schemas, workspace
from daymill.constants import POLLUTANTS, READING_COLUMNS, WEATHER_VARIABLES
from daymill.functions.text import first_ten, parse_day
from daymill.operators.aggregate import date_bounds, last_per_key
from daymill.operators.unnest import unnest_hourly
from daymill.plans.daily import Tables, load_weather, reject
from daymill.schemas import hourly_response
from daymill.sources.landing import read_history_csv, read_landed, rejected_history_csv
from daymill.sources.sinks import merge_by_month, rewrite_series, write_new


def silver_readings(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """Landed flat readings, one JSON object per city and day: typed, with the day they state, the text of it, and the
    day they landed. A reading whose day cannot be read has a null date."""
    text = {"date": "string", "city": "string", **{p: "double" for p in POLLUTANTS}}
    landed = read_landed(spark, root, ", ".join(f"{k} {v}" for k, v in text.items()), start, end)
    day = parse_day(first_ten(F.col("date")))
    return landed.select(day.alias("date"), F.col("date").alias("text"), "city", *POLLUTANTS, "landed_date")


def silver_hours(documents: DataFrame, place: str = "airport", required=("temperature_2m",), variables=WEATHER_VARIABLES) -> DataFrame:
    """Hourly rows of weather documents of a place, with the month folders they are stored in. Rows without one of the
    required variables are dropped."""
    rows = unnest_hourly(documents, variables, keep=(place,), required=required)
    return rows.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})


def load_lake(spark: SparkSession, tables: Tables, readings_root: str, weather_root: str, start=None, end=None) -> None:
    """Landed readings and weather documents of [start, end] into the stored tables; without bounds, of every day present."""
    load_lake_readings(spark, tables, readings_root, start, end)
    load_lake_weather(spark, tables, weather_root, start, end)


def load_lake_readings(spark: SparkSession, tables: Tables, root: str, start=None, end=None) -> None:
    """The reading that landed last counts. What has no readable day or city goes to the rejected tables: each row with
    its values and the day it landed to `lake_rows`, and what there is of (city, text, reason) to `lake`."""
    tables.ensure(spark)
    rows = workspace.materialize(silver_readings(spark, root, start, end), "silver")
    reason = F.when(F.col("date").isNull(), "no date").when(F.col("city").isNull(), "no city")
    bad = rows.withColumn("reason", reason).filter("reason is not null")
    reject(spark, bad.select("city", "text", "reason", "landed_date", *POLLUTANTS), f"{tables.rejected}/lake_rows", "landed_date")
    reject(spark, bad.select("city", "text", "reason"), f"{tables.rejected}/lake")
    good = rows.filter("date is not null and city is not null")
    newest = last_per_key(good, ["city", "date"], [F.col(c) for c in ("landed_date", "text", *POLLUTANTS)])
    merge_by_month(spark, tables.readings, workspace.materialize(newest.select(*READING_COLUMNS), "readings"))


def load_lake_weather(spark: SparkSession, tables: Tables, root: str, start=None, end=None) -> None:
    """The document that landed last counts for an hour."""
    tables.ensure(spark)
    documents = read_landed(spark, root, hourly_response(WEATHER_VARIABLES).add("city", "string"), start, end)
    load_weather(spark, tables, documents.withColumn("landed", F.col("landed_date")))


def bootstrap(spark: SparkSession, readings: str, history: str, new_readings: str, rejected: str | None = None) -> int:
    """Historical files replace whole series: the next version of the readings table, at a path of its own. Lines
    without a readable day go to the table `rejected` with their values, every line; without a path, to the one of
    the new readings with "-rejected" added. It must not exist yet. Returns the number of rejected lines."""
    rows = workspace.materialize(read_history_csv(spark, history), "history")
    # Rejected lines are safe before the series they belong to are replaced.
    left = write_new(rejected_history_csv(spark, history), rejected or f"{new_readings.rstrip('/')}-rejected")
    rewrite_series(spark, readings, rows, new_readings)
    return left


def weather_of_history(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """The weather of exactly the days from the first to the last reading of each city."""
    bounds = date_bounds(readings)
    return weather.join(bounds, "city").filter(F.col("date").between(F.col("first_date"), F.col("last_date"))).select(*weather.columns)
