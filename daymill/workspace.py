"""Where intermediate tables and checkpoints go."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_own_roots: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The shared folder the cluster names. Without the setting nothing is written anywhere."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if not named and _own_roots:
        named = _own_roots.get(spark.sparkContext.applicationId)
    if not named:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    return named


def use_own_root(spark: SparkSession) -> None:
    """For tests, checks and benches in one JVM: a temporary folder where the setting is missing. Never on a cluster."""
    context = spark.sparkContext
    if spark.conf.get(CHECKPOINT_SETTING, None) or context.applicationId in _own_roots:
        return
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="daymill-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    _own_roots[context.applicationId] = own


def run_root(spark: SparkSession) -> str:
    """This application's own folder below the root."""
    return f"{root(spark).rstrip('/')}/daymill-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses, so a retry never meets half-written files."""
    return f"{run_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Written once and read back, and removed when the block ends: for batches of a long-lived stream."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _remove(spark, path)


def clear(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder. Call it when no DataFrame
    that reads from there is needed any more; saved tables and models live elsewhere."""
    _remove(spark, run_root(spark))


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(new_path(spark, "checkpoints"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: what follows no longer depends on any executor's memory."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
