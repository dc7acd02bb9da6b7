"""Session settings this library is written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and timestamps mean the same on every machine.
    "spark.sql.session.timeZone": "UTC",
    # Re-planning at run time: joins switch to broadcast only on measured sizes, skewed
    # partitions are split, small ones are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Target size of a shuffle partition, and so of the files that a rebalanced write makes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    # A write replaces the partitions it has rows for, never the whole table.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # State of a stream lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Apply the settings. Without `shuffle_partitions` Spark's own default holds; on a large
    cluster give two to three times the cores, which the adaptive planner merges when too many."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return builder
