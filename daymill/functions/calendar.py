"""Date expressions."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(column) -> Column:
    """Calendar day of a date, timestamp or ISO text; null when the text is no date."""
    return F.col(column).try_cast("date") if isinstance(column, str) else column.try_cast("date")


def epoch_to_timestamp(column: str) -> Column:
    """Epoch seconds to a timestamp, independent of the session time zone."""
    return F.timestamp_seconds(F.col(column))


def calendar_columns(date: str = "date") -> dict[str, Column]:
    """Month, year, weekday from Monday = 0, and their positions on the yearly and weekly circle.

    The yearly circle has 365 steps, so day 366 of a leap year goes past a full turn.
    """
    d = F.col(date)
    weekday = F.weekday(d)
    year_angle = F.lit(2 * math.pi) * F.dayofyear(d) / F.lit(365)
    week_angle = F.lit(2 * math.pi) * weekday / F.lit(7)
    return {
        "month": F.month(d),
        "year": F.year(d),
        "day_of_week": weekday,
        "day_of_year_sin": F.sin(year_angle),
        "day_of_year_cos": F.cos(year_angle),
        "day_of_week_sin": F.sin(week_angle),
        "day_of_week_cos": F.cos(week_angle),
    }


def days_after(start: Column, end: Column) -> Column:
    """Array of the days in (start, end]; null when there are none, so explode drops the row."""
    return F.when(start < end, F.sequence(F.date_add(start, 1), end))


def split_name(train_end, validation_end, meta_end, date: str = "date") -> Column:
    """Which chronological split a day belongs to; every non-null day has exactly one."""
    d = F.col(date)
    return (
        F.when(d <= F.lit(train_end), "train")
        .when(d <= F.lit(validation_end), "validation")
        .when(d <= F.lit(meta_end), "meta")
        .when(d > F.lit(meta_end), "test")
    )
