"""Aggregations. All combine on the map side, so a hot key costs one row per task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from daymill.constants import DEFAULT_HIGH_WATER_MARK
from daymill.functions.calendar import day


def daily_mean(hours: DataFrame, values=None, key: str = "city", timestamp: str = "timestamp") -> DataFrame:
    """Mean of every numeric column by (date, key). Nulls are skipped; rows without a key or a
    time are dropped. Codes and angles get a plain mean as well."""
    if values is None:
        values = [
            f.name for f in hours.schema if isinstance(f.dataType, NumericType) and f.name != key
        ]
    return (
        hours.withColumn("date", day(timestamp))
        .filter(F.col("date").isNotNull() & F.col(key).isNotNull())
        .groupBy("date", key)
        .agg(*[F.avg(v).alias(v) for v in values])
    )


def high_water_mark(df: DataFrame, default=DEFAULT_HIGH_WATER_MARK) -> DataFrame:
    """Latest stored day over all series, or the default when nothing is stored."""
    return df.agg(F.coalesce(F.max("date"), F.lit(default)).alias("high_water_mark"))


def high_water_mark_by(df: DataFrame, series: DataFrame, default=DEFAULT_HIGH_WATER_MARK) -> DataFrame:
    """Latest stored day of each listed series, so one that lags behind is not hidden."""
    latest = df.groupBy("city").agg(F.max("date").alias("_latest"))
    return (
        series.select("city")
        .join(latest, "city", "left")
        .select("city", F.coalesce("_latest", F.lit(default)).alias("high_water_mark"))
    )


def date_bounds(df: DataFrame, key: str = "city") -> DataFrame:
    return df.groupBy(key).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def _whole_row(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One whole row per key, the smallest by `order`. An aggregate, not a window: copies of one
    key are reduced inside each task before anything is shuffled."""
    keep = F.min_by(_whole_row(df), F.struct(*order))
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        keep.alias("_row")
    ).select("_row.*")


def last_per_key(df: DataFrame, keys, order) -> DataFrame:
    """As first_per_key, keeping the largest."""
    keep = F.max_by(_whole_row(df), F.struct(*order))
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        keep.alias("_row")
    ).select("_row.*")
