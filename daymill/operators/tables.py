"""Keyed-table maintenance on immutable data: each operator returns the next version."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.operators.aggregate import last_per_key

FORECAST_KEY = ["city", "forecast_date", "horizon"]


def replace_by_key(base: DataFrame, new: DataFrame, keys=("city", "date")) -> DataFrame:
    """Rows of base whose key does not occur in new, plus all rows of new. Null keys are equal to each
    other, so merging the same rows again changes nothing."""
    keys = list(keys)
    named = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    kept = base.join(named, same, "left_anti")
    return kept.select(*base.columns).unionByName(new.select(*base.columns))


def replace_series(base: DataFrame, new: DataFrame, series: str = "city") -> DataFrame:
    """Replace whole series. One long series is the hot key of this join; the planner broadcasts
    the few distinct names when they are small, and splits the skewed side otherwise."""
    return replace_by_key(base, new, [series])


def upsert_forecasts(log: DataFrame, new: DataFrame) -> DataFrame:
    """Insert new forecasts; on a key already present only `predicted` changes, so a filled
    `actual` and the stored `target_date` survive. A key that `new` repeats counts once, with its
    largest prediction."""
    new = last_per_key(new, FORECAST_KEY, [F.col(c) for c in ("predicted", "target_date", "actual")])
    old, add = log.alias("old"), new.alias("add")
    known = F.col("old.city").isNotNull()
    return old.join(add, FORECAST_KEY, "full").select(
        *FORECAST_KEY,
        F.when(known, F.col("old.target_date")).otherwise(F.col("add.target_date")).alias("target_date"),
        F.coalesce("add.predicted", "old.predicted").alias("predicted"),
        F.when(known, F.col("old.actual")).otherwise(F.col("add.actual")).alias("actual"),
    ).select(*log.columns)


def fill_actuals(log: DataFrame, readings: DataFrame, on_date=None, value: str = "pm10") -> DataFrame:
    """Fill missing `actual` from the reading of the target day; filled ones are left alone.

    All past days are filled unless `on_date` names one.
    """
    observed = readings.select(
        "city", F.col("date").alias("target_date"), F.col(value).alias("_observed")
    ).filter(F.col("_observed").isNotNull())
    if on_date is not None:
        observed = observed.filter(F.col("target_date") == F.lit(on_date))
    return (
        log.join(observed, ["city", "target_date"], "left")
        .withColumn("actual", F.coalesce("actual", "_observed"))
        .select(*log.columns)
    )


def audit_contract(df: DataFrame, not_null, key) -> DataFrame:
    """Breaches of NOT NULL and UNIQUE as rows (rule, column, breaches), zero breaches included,
    so a passing audit is visible. One scan: null counts ride along with the count per key."""
    key, not_null = list(key), list(not_null)
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in not_null],
    )
    totals = per_key.agg(
        F.count_if(F.col("_n") > 1).alias("_repeated"),
        *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"_null_{c}") for c in not_null],
    )

    def rule(name, column, breaches):
        return F.struct(
            F.lit(name).alias("rule"), F.lit(column).alias("column"), F.col(breaches).alias("breaches")
        )

    rules = [rule("not null", c, f"_null_{c}") for c in not_null]
    rules.append(rule("unique", ",".join(key), "_repeated"))
    return totals.select(F.inline(F.array(*rules)))


def row_count_by_key(df: DataFrame, keys=("city",)) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
