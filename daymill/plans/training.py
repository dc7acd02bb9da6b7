"""The training frame: clean series, features, targets and the chronological split."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymill.constants import HORIZONS, MAX_GAP, META_END, TRAIN_END, VALIDATION_END, target_name
from daymill.functions.calendar import calendar_columns, split_name
from daymill.functions.weather import interaction_columns
from daymill.operators.joins import merge_weather
from daymill.operators.series import (
    add_full_rolling_mean,
    add_lags,
    add_targets,
    clean_series,
    series_window,
)
from daymill.operators.topn import latest_row


def series_features(readings: DataFrame) -> DataFrame:
    """Cleaned series with its lags. Lags count surviving rows, across dropped gaps."""
    cleaned = clean_series(readings)
    return add_full_rolling_mean(add_lags(cleaned, ["pm10"]))


def row_features(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Features that need no other row: weather, calendar, interactions."""
    return merge_weather(df, weather).withColumns({**calendar_columns(), **interaction_columns()})


def feature_frame(readings: DataFrame, weather: DataFrame) -> DataFrame:
    return row_features(series_features(readings), weather)


def latest_features(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Features of the newest surviving row of each city; only those rows meet the weather."""
    return row_features(latest_row(series_features(readings)), weather)


def latest_of_recent(recent: DataFrame) -> DataFrame:
    """Series features of each city's newest surviving row, from recent days only, with `proven`:
    true where earlier days cannot change them.

    From the first known value on, neighbours of gaps are the same with or without earlier days;
    MAX_GAP rows later so are the drops. A newest row whose 7 rows before it all lie there is
    therefore the same as from the whole history.
    """
    so_far = series_window().rowsBetween(Window.unboundedPreceding, 0)
    first_known = F.min(F.when(F.col("pm10").isNotNull(), F.col("date"))).over(so_far)
    settled = F.sum(F.col("_first").isNotNull().cast("int")).over(so_far)
    marked = recent.withColumn("_first", first_known).withColumn("_settled", settled)
    rows = F.sum((F.col("_settled") > MAX_GAP).cast("int")).over(so_far)
    features = series_features(marked).withColumn("_rows", rows)
    return latest_row(features).withColumn("proven", F.col("_rows") > 7).drop("_first", "_settled", "_rows")


def training_frame(readings: DataFrame, weather: DataFrame, horizons=HORIZONS) -> DataFrame:
    """Features and targets of all cities at once.

    Targets come before the weather join, so every window shares the one exchange by city and
    rows without targets never reach the join.
    """
    return row_features(add_targets(series_features(readings), horizons=horizons), weather)


def chrono_split(
    df: DataFrame, train_end=TRAIN_END, validation_end=VALIDATION_END, meta_end=META_END
) -> DataFrame:
    return df.withColumn("split", split_name(train_end, validation_end, meta_end))


def long_targets(df: DataFrame, horizons=HORIZONS) -> DataFrame:
    """One row per (row, horizon) with its `target`, for work on all horizons in one job."""
    pairs = F.array(
        *[
            F.struct(F.lit(h).alias("horizon"), F.col(target_name(h)).alias("target"))
            for h in horizons
        ]
    )
    others = [c for c in df.columns if c not in {target_name(h) for h in horizons}]
    return df.select(*others, F.inline(pairs))
