"""Operators over daily series.

Contract: one row per (city, date), which the keyed tables guarantee. So a window group is
bounded by the calendar (a century of days is 36,525 rows) however large the raw data is and
however uneven the cities are; raw copies were reduced by the aggregates before. All windows
here share one partitioning and one order, so a chain of them costs one exchange and one sort.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymill.constants import HORIZONS, MAX_GAP, POLLUTANTS, target_name

KEY = "city"
ORDER = "date"


def series_window(key: str = KEY, order: str = ORDER):
    return Window.partitionBy(key).orderBy(order)


def lag_columns(columns, steps, window=None) -> dict[str, Column]:
    window = window or series_window()
    return {f"{c}_lag_{n}d": F.lag(c, n).over(window) for c in columns for n in steps}


def rolling_mean_columns(columns, rows: int = 7, window=None) -> dict[str, Column]:
    """Mean of the current row and the rows - 1 before it; nulls skipped, short starts allowed."""
    frame = (window or series_window()).rowsBetween(-(rows - 1), 0)
    return {f"{c}_rolling_{rows}d": F.avg(c).over(frame) for c in columns}


def full_rolling_mean(column: str, rows: int = 7, window=None) -> Column:
    """Mean of the `rows` rows before the current one; null unless all of them have a value."""
    frame = (window or series_window()).rowsBetween(-rows, -1)
    return F.when(F.count(column).over(frame) == rows, F.avg(column).over(frame))


def calendar_window(key: str = KEY, order: str = ORDER):
    """Frames over this window count days of the calendar instead of rows."""
    return Window.partitionBy(key).orderBy(F.unix_date(F.col(order).cast("date")))


def calendar_value(column: str, days: int, window=None) -> Column:
    """The value `days` days later (earlier where negative); null when that day has no row."""
    return F.max(column).over((window or calendar_window()).rangeBetween(days, days))


def add_calendar_features(df: DataFrame, columns=("pm10",), steps=(1, 7), days: int = 7, horizons=()) -> DataFrame:
    """Lags, the mean of the `days` days before (null unless each has a value), and targets, by the calendar: none of
    them reaches across a dropped gap. Expects one row per (city, date); all of them share one exchange and order."""
    window, out = calendar_window(), {}
    for c in columns:
        out |= {f"{c}_lag_{n}d": calendar_value(c, -n, window) for n in steps}
        frame = window.rangeBetween(-days, -1)
        out[f"{c}_rolling_{days}d"] = F.when(F.count(c).over(frame) == days, F.avg(c).over(frame))
    out |= {target_name(h): calendar_value(columns[0], h, window) for h in horizons}
    return df.withColumns(out)


def add_lags(df: DataFrame, columns=POLLUTANTS, steps=(1, 7)) -> DataFrame:
    return df.withColumns(lag_columns(columns, steps))


def add_rolling_mean(df: DataFrame, columns=POLLUTANTS, rows: int = 7) -> DataFrame:
    return df.withColumns(rolling_mean_columns(columns, rows))


def add_full_rolling_mean(df: DataFrame, column: str = "pm10", rows: int = 7) -> DataFrame:
    return df.withColumn(f"{column}_rolling_{rows}d", full_rolling_mean(column, rows))


def add_targets(df: DataFrame, column: str = "pm10", horizons=HORIZONS) -> DataFrame:
    """The value h rows ahead for each horizon; rows that lack any of them are dropped."""
    window = series_window()
    leads = {target_name(h): F.lead(column, h).over(window) for h in horizons}
    return df.withColumns(leads).dropna(how="any", subset=list(leads))


def filled_value(value, row, before_row, before_value, after_row, after_value, max_gap) -> Column:
    """Bounded forward fill of a gap on the line between its neighbours.

    Positions 1..max_gap of a gap are filled; a gap at the end repeats the last value; a gap at
    the start stays. Neighbours are rows, whatever their dates.
    """
    position = row - before_row
    slope = (after_value - before_value) / (after_row - before_row)
    on_line = F.when(after_row.isNull(), before_value).otherwise(before_value + slope * position)
    return F.when(value.isNotNull(), value).when(position <= max_gap, on_line)


def interpolate(df: DataFrame, column: str = "pm10", max_gap: int = MAX_GAP) -> DataFrame:
    """Fill short gaps of one column (see filled_value).

    The next known value comes from lead(...) IGNORE NULLS, which walks the series once; a frame
    up to the unbounded following row would be rescanned for every row.
    """
    window = series_window()
    known = F.when(
        F.col(column).isNotNull(), F.struct(F.col("_row").alias("at"), F.col(column).alias("v"))
    )
    return (
        df.withColumn("_row", F.row_number().over(window))
        .withColumn("_known", known)
        .withColumns(
            {
                "_before": F.last("_known", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)),
                "_after": F.expr(f"lead(_known) IGNORE NULLS OVER (PARTITION BY {KEY} ORDER BY {ORDER})"),
            }
        )
        .withColumn(
            column,
            filled_value(
                F.col(column),
                F.col("_row"),
                F.col("_before.at"),
                F.col("_before.v"),
                F.col("_after.at"),
                F.col("_after.v"),
                max_gap,
            ),
        )
        .drop("_row", "_known", "_before", "_after")
    )


def drop_gaps(df: DataFrame, column: str = "pm10", max_gap: int = MAX_GAP) -> DataFrame:
    """Drop rows without a value, and the max_gap rows after each, whose lags would be damaged."""
    frame = series_window().rowsBetween(-max_gap, 0)
    damaged = F.max(F.col(column).isNull().cast("int")).over(frame)
    return df.withColumn("_damaged", damaged).filter(F.col("_damaged") == 0).drop("_damaged")


def clean_series(df: DataFrame, column: str = "pm10", max_gap: int = MAX_GAP) -> DataFrame:
    return drop_gaps(interpolate(df, column, max_gap), column, max_gap)


def with_lookback(df: DataFrame, start, rows: int, build) -> DataFrame:
    """Features for days from `start` on, reading only `rows` days before it.

    A lower date bound cannot pass below a lag by itself. Exact on a dense daily grid, where
    `rows` rows are `rows` days.
    """
    first = F.date_sub(F.lit(start), rows)
    return build(df.filter(F.col(ORDER) >= first)).filter(F.col(ORDER) >= F.lit(start))
