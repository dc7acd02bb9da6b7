"""Layered models: staging, intermediate, mart. One lazy plan from raw tables to the mart."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.constants import MAX_GAP, POLLUTANTS, STAGED_WEATHER_NAMES, WEATHER_VARIABLES
from daymill.operators.joins import merge_weather
from daymill.operators.series import lag_columns, rolling_mean_columns, series_window


def _keyed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("city").isNotNull() & F.col("date").isNotNull())


def stg_air_quality(readings: DataFrame) -> DataFrame:
    return _keyed(readings.select("city", "date", *POLLUTANTS))


def stg_weather(weather: DataFrame) -> DataFrame:
    columns = weather.select("city", "date", *WEATHER_VARIABLES)
    return _keyed(columns.withColumnsRenamed(STAGED_WEATHER_NAMES))


def _featured(readings: DataFrame, *carried: str) -> DataFrame:
    """Staged readings with lags 1 and 7 and the inclusive 7-row mean of every pollutant."""
    staged = _keyed(readings.select("city", "date", *POLLUTANTS, *carried))
    windows = {**lag_columns(POLLUTANTS, (1, 7)), **rolling_mean_columns(POLLUTANTS)}
    per_pollutant = [
        f"{p}_{suffix}" for p in POLLUTANTS for suffix in ("lag_1d", "lag_7d", "rolling_7d")
    ]
    return staged.withColumns(windows).select("city", "date", *POLLUTANTS, *per_pollutant, *carried)


def int_aq_features(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Series features of all pollutants plus weather.

    The windows run before the join: only the narrow readings are sorted, and the join then
    spreads on (city, date) instead of on the few cities.
    """
    return merge_weather(_featured(readings), stg_weather(weather))


def ml_features(readings: DataFrame, weather: DataFrame) -> DataFrame:
    return int_aq_features(readings, weather)


def refresh_mart(
    readings: DataFrame, weather: DataFrame, changed: DataFrame, lookback: int = MAX_GAP
) -> DataFrame:
    """Mart rows that a set of changed (city, date) can affect: per city from the first change to
    `lookback` rows after the last. Only the series of changed cities are read again; lags count
    rows, so no date bound on the history would be exact."""
    spans = changed.groupBy("city").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    history = readings.join(spans, "city")
    after = F.sum((F.col("date") > F.col("_last")).cast("int")).over(series_window())
    affected = (
        _featured(history, "_first", "_last")
        .withColumn("_after", after)
        .filter((F.col("date") >= F.col("_first")) & (F.col("_after") <= lookback))
        .drop("_first", "_last", "_after")
    )
    return merge_weather(affected, stg_weather(weather))


def register(spark: SparkSession, readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Temp views named after the layers; the mart is a view over the view below it."""
    stg_air_quality(readings).createOrReplaceTempView("stg_air_quality")
    stg_weather(weather).createOrReplaceTempView("stg_weather")
    int_aq_features(readings, weather).createOrReplaceTempView("int_aq_features")
    mart = spark.sql("SELECT * FROM int_aq_features")
    mart.createOrReplaceTempView("ml_features")
    return mart


def save_layers(
    readings: DataFrame, weather: DataFrame, prefix: str = "", folder: str | None = None
) -> DataFrame:
    """Store each layer as a table partitioned by month, every layer built from the stored one
    below it; returns the mart. `folder` puts the tables' files there."""

    def save(df: DataFrame, name: str) -> DataFrame:
        table = f"{prefix}{name}"
        dated = df.withColumns({"storage_year": F.year("date"), "storage_month": F.month("date")})
        writer = dated.hint("rebalance", "storage_year", "storage_month").write.mode("overwrite")
        if folder:
            writer = writer.option("path", f"{folder}/{name}")
        writer.partitionBy("storage_year", "storage_month").saveAsTable(table)
        return df.sparkSession.table(table).select(*df.columns)

    staged = save(stg_air_quality(readings), "stg_air_quality")
    staged_weather = save(stg_weather(weather), "stg_weather")
    joined = save(merge_weather(_featured(staged), staged_weather), "int_aq_features")
    return save(joined, "ml_features")
