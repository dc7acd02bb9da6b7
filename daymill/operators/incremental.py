"""Which days are missing, from a high-water mark or inside the covered range."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.calendar import days_after
from daymill.operators.series import series_window


def backfill_dates(marks: DataFrame, until) -> DataFrame:
    """One row per day after each high-water mark up to and including `until`, as ISO text.
    A mark at or after `until` gives none."""
    days = F.explode(days_after(F.col("high_water_mark"), F.lit(until).cast("date")))
    others = [c for c in marks.columns if c != "high_water_mark"]
    return marks.select(*others, days.alias("_day")).select(
        *others, F.date_format("_day", "yyyy-MM-dd").alias("date")
    )


def _next_date() -> Column:
    return F.lead("date").over(series_window())


def densify(df: DataFrame) -> DataFrame:
    """Readings on a dense daily grid from the first to the last day of each city: days without
    a reading get null values. Expects one row per (city, date).

    Each row stretches up to the day before the next one, so the data is read once and stays
    partitioned by city for the series windows that follow; there is no grid to join to.
    """
    values = [c for c in df.columns if c not in ("city", "date")]
    last_day = F.coalesce(F.date_sub("_next", 1), F.col("date"))
    stretched = df.withColumn("_next", _next_date()).withColumn(
        "_day", F.explode(F.sequence(F.col("date"), last_day))
    )
    own_day = F.col("_day") == F.col("date")
    return stretched.select(
        "city", F.col("_day").alias("date"), *[F.when(own_day, F.col(v)).alias(v) for v in values]
    )


def missing_days(df: DataFrame) -> DataFrame:
    """Days without a reading between the first and last reading of each city. Copies of a day
    are reduced before the series is ordered."""
    days = df.select("city", "date").filter("city is not null and date is not null").distinct()
    gap = days_after(F.col("date"), F.date_sub("_next", 1))
    return days.withColumn("_next", _next_date()).select("city", F.explode(gap).alias("date"))
