"""Landing to daily means as a file stream. Each run takes what has landed since the last one.

Two forms. `stream_daily_mean` keeps means as streaming state under a watermark. `run_hours`
keeps the hours in a table instead: corrections replace earlier values, hours count however late
they come, and repeats of one hour are reduced inside each task before the shuffle, where the
state of a stream would send them all to one.
"""

import json
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StructField, StructType

from daymill import workspace
from daymill.operators.aggregate import daily_mean, last_per_key
from daymill.sources.sinks import (
    DAY,
    ensure_table,
    merge_by_month,
    stored_by_month,
    touched_folders,
    with_folders,
)


def hour_stream(spark: SparkSession, folder: str, schema, only: str | None = None) -> DataFrame:
    """New Parquet files of a folder; `only` restricts the file names."""
    reader = spark.readStream.schema(schema)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.parquet(folder)


def stream_daily_mean(
    hours: DataFrame, values, identity=("city", "timestamp"), lateness: str = "2 days"
) -> DataFrame:
    """Mean per (date, city). Repeats of `identity` within `lateness` count once; hours later
    than that are dropped by the watermark, and `run_available` counts them. Where no hour may be lost, use
    `run_hours`, which has no such limit."""
    day = F.window("timestamp", "1 day")
    return (
        hours.filter(F.col("city").isNotNull() & F.col("timestamp").isNotNull())
        .withWatermark("timestamp", lateness)
        .dropDuplicatesWithinWatermark(list(identity))
        .groupBy(day.alias("day"), "city")
        .agg(*[F.avg(v).alias(v) for v in values])
        .select(F.to_date("day.start").alias("date"), "city", *values)
    )


@contextmanager
def _state_partitions(spark: SparkSession, count: int | None):
    """Shuffle partitions for a stream started inside; Spark copies the setting at the start."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, count or before)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def run_available(
    means: DataFrame, path: str, state: str, after=None, state_partitions: int | None = None
) -> int:
    """Take everything that has landed, then stop; returns the number of rows that came too late. Rerunning a batch gives the same table, since
    replacing by key is idempotent. `after(rows)` runs on the stored rows of each merged batch,
    for instance to refresh features that depend on them.

    The number of state partitions holds for the life of `state`; the planner never merges them,
    so choose it for the cores the stream will run on.
    """
    spark = means.sparkSession
    ensure_table(spark, path, means.schema)

    def merge(batch: DataFrame, _) -> None:
        with workspace.held(batch, "batch") as rows:
            if merge_by_month(batch.sparkSession, path, rows) and after:
                after(rows)

    writer = (
        means.writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
    )
    with _state_partitions(spark, state_partitions):
        query = writer.start()
    query.awaitTermination()
    progress = [json.loads(p) if isinstance(p, str) else json.loads(p.json) for p in query.recentProgress]
    return sum(o.get("numRowsDroppedByWatermark", 0) for p in progress for o in p.get("stateOperators", []))


def run_hours(
    hours: DataFrame,
    values,
    hourly: str,
    path: str,
    state: str,
    identity=("city", "timestamp"),
    latest: str | None = None,
    after=None,
) -> None:
    """Merge landed hours into the hourly table (by day), then replace the daily means of the
    (city, date) they touched. Of repeats in one batch the largest `latest` wins, then the
    largest row; a later batch always wins over an earlier one. The identity must hold the timestamp:
    one that could move to another day would leave its old hour behind."""
    if "timestamp" not in identity:
        raise ValueError("identity must hold timestamp")
    columns = list(dict.fromkeys([*identity, "city", "timestamp", *values]))
    order = [F.col(c) for c in ([latest] if latest else []) + columns]

    def merge(batch: DataFrame, _) -> None:
        spark = batch.sparkSession
        keyed = batch.dropna(subset=[*identity, "city", "timestamp"])
        rows = last_per_key(keyed, identity, order).select(*columns, F.to_date("timestamp").alias("date"))
        with workspace.held(rows, "hours") as rows:
            if not merge_by_month(spark, hourly, rows, identity, "date", DAY):
                return
            days = rows.select("city", "date").distinct()
            folders = touched_folders(with_folders(rows, "date", DAY), DAY)
            stored = stored_by_month(spark, hourly, rows.schema, folders, DAY)
            touched = stored.join(days, ["city", "date"], "left_semi")
            with workspace.held(daily_mean(touched, values), "means") as means:
                merge_by_month(spark, path, means)
                if after:
                    after(means)

    fields = {f.name: f for f in hours.schema}
    hour_schema = StructType([*[fields[c] for c in columns], StructField("date", DateType())])
    ensure_table(hours.sparkSession, hourly, hour_schema, DAY)
    mean_fields = [StructField(v, DoubleType()) for v in values]
    mean_schema = StructType([StructField("date", DateType()), fields["city"], *mean_fields])
    ensure_table(hours.sparkSession, path, mean_schema)
    (
        hours.writeStream.foreachBatch(merge)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
