"""Parallel hourly arrays to rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.constants import WEATHER_VARIABLES


def _zipped(documents: DataFrame, variables, keep) -> DataFrame:
    """One row per position. An array that is null, or a variable that the documents do not have, is
    empty: it must not take the other variables with it."""
    hourly = documents.schema["hourly"].dataType
    present = {f.name: f.dataType for f in hourly}
    arrays = []
    for name in ["time", *variables]:
        kind = present[name].simpleString() if name in present else "array<double>"
        value = F.col(f"hourly.{name}") if name in present else F.lit(None)
        arrays.append(F.coalesce(value.cast(kind), F.array().cast(kind)).alias(name))
    return documents.select(*keep, F.inline(F.arrays_zip(*arrays)).alias("time", *variables))


def unnest_hourly(
    documents: DataFrame, variables=WEATHER_VARIABLES, keep=("city",), required=()
) -> DataFrame:
    """One row per readable time of each document. A variable that is short or absent is null there;
    rows without one of the `required` variables are dropped. Times that cannot be read are left to
    `rejected_hours`."""
    rows = _zipped(documents, variables, keep).withColumn("timestamp", F.try_to_timestamp("time"))
    return rows.dropna(subset=["timestamp", *required]).select(*keep, "timestamp", *variables)


def rejected_hours(documents: DataFrame, variables=WEATHER_VARIABLES, keep=("city",)) -> DataFrame:
    """What `unnest_hourly` leaves out, with its text and the reason: whole documents without hours or
    times, and hours whose time is missing or cannot be read although they may hold values."""
    whole = unusable_documents(documents, keep).select(*keep, F.lit(None).cast("string").alias("text"), "reason")
    rows = _zipped(documents, variables, keep)
    has_value = F.coalesce(*[F.col(v).cast("string") for v in variables]).isNotNull()
    reason = F.when(F.col("time").isNull() & has_value, "no time").when(
        F.col("time").isNotNull() & F.try_to_timestamp("time").isNull(), "time not readable"
    )
    known = rows.select(*keep, F.col("time").alias("text"), reason.alias("reason")).filter(F.col("reason").isNotNull())
    return whole.unionByName(known)


def unusable_documents(documents: DataFrame, keep=("city",)) -> DataFrame:
    """Documents without a single time, with the reason: the response was an error, or held no times."""
    times = F.col("hourly.time")
    reason = F.when(times.isNull(), "no hourly data").when(F.array_size(F.array_compact(times)) == 0, "no times")
    return documents.select(*keep, reason.alias("reason")).filter(F.col("reason").isNotNull())


def ragged_documents(documents: DataFrame, variables=WEATHER_VARIABLES, keep=("city",)) -> DataFrame:
    """Documents in which some variable has another length than `time`; an absent one has length 0."""
    present = {f.name for f in documents.schema["hourly"].dataType}
    sizes = [F.coalesce(F.array_size(f"hourly.{v}"), F.lit(0)) if v in present else F.lit(0) for v in variables]
    lengths = F.array(*sizes)
    return documents.select(
        *keep,
        F.coalesce(F.array_size("hourly.time"), F.lit(0)).alias("times"),
        F.array_min(lengths).alias("shortest"),
        F.array_max(lengths).alias("longest"),
    ).filter((F.col("shortest") != F.col("times")) | (F.col("longest") != F.col("times")))
