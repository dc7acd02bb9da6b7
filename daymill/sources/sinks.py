"""Writers. Each returns the number of rows written, counted during the write."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from daymill.operators.tables import replace_by_key, replace_series
from daymill.sources import versions


def _counted(df: DataFrame, write) -> int:
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_partitioned(
    df: DataFrame, path: str, partition_by=("year", "month"), fmt: str = "parquet"
) -> int:
    """Replace exactly the partitions present in df; all others stay.

    The rebalance hint sends a partition's rows together, so there are few files, and lets
    the adaptive planner split a partition that is too large for one task.
    """
    return _counted(
        df.hint("rebalance", *partition_by),
        lambda out: out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path),
    )


MONTH = ("year", "month")
DAY = ("year", "month", "day")


def with_folders(df: DataFrame, date: str = "date", by=MONTH) -> DataFrame:
    parts = {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}
    return df.withColumns({name: parts[name] for name in by})


def write_by_month(df: DataFrame, path: str, date: str = "date", by=MONTH) -> int:
    return write_partitioned(with_folders(df, date, by), path, by)


def land_documents(df: DataFrame, path: str, date: str = "date", by_city: bool = False) -> int:
    """Land rows as JSON documents under year=/month=/day= folders (and city= when asked)."""
    folders = {
        "year": F.date_format(date, "yyyy"),
        "month": F.date_format(date, "MM"),
        "day": F.date_format(date, "dd"),
    }
    partition_by = [*folders, "city"] if by_city else list(folders)
    return write_partitioned(df.withColumns(folders).drop(date), path, partition_by, "json")


def write_new(df: DataFrame, path: str) -> int:
    """A new version of a table under a path that must not exist yet."""
    return _counted(df, lambda out: out.write.mode("errorifexists").parquet(path))


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def ensure_table(spark: SparkSession, path: str, schema: StructType, by=MONTH) -> None:
    """An empty partitioned table, unless something is stored there already."""
    empty = spark.createDataFrame([], schema)
    for name in by:
        empty = empty.withColumn(name, F.lit(None).cast("int"))
    empty.write.mode("ignore").partitionBy(*by).parquet(path)


def month_number() -> Column:
    """Months since year 0, from the folder columns."""
    return F.col("year") * 12 + F.col("month")


def folder_number(by=MONTH) -> Column:
    """One whole number per folder of a table partitioned by month or by day."""
    return month_number() * 32 + F.col("day") if "day" in by else month_number()


def touched_folders(rows: DataFrame, by=MONTH) -> list[int | None]:
    """Folders that rows belong to, None for rows without a date: at most one per day of the
    calendar, whatever the rows."""
    return [r.n for r in rows.select(folder_number(by).alias("n")).distinct().collect()]


def stored_by_month(
    spark: SparkSession, path: str, schema: StructType, folders=None, by=MONTH
) -> DataFrame:
    """A table partitioned by month (or day). With `folders` (folder numbers) others are not
    opened: a literal filter on the folder columns prunes for sure, a join to them only may. A table
    with a manifest (`versions`) is read as last published."""
    if versions.is_versioned(spark, path):
        return versions.read(spark, path, schema, folders)
    columns = [StructField(name, IntegerType()) for name in by]
    stored = spark.read.schema(StructType([*schema.fields, *columns])).parquet(path)
    if folders is None:
        return stored
    number = folder_number(by)
    chosen = number.isin([n for n in folders if n is not None])
    return stored.filter(chosen | number.isNull() if None in folders else chosen)


def merge_by_month(
    spark: SparkSession, path: str, new: DataFrame, keys=("city", "date"), date: str = "date", by=MONTH
) -> int:
    """Replace-by-key into a stored table partitioned by month (or day), rewriting only the
    folders that the new rows touch. The rest of the table is neither read nor written.

    A table with a manifest gets a new version of those folders, published whole (`versions.merge`). In a plain
    one the merged folders are written whole beside the table, marked as whole, and then moved into place. A driver that is
    lost before the mark has changed nothing; one that is lost later leaves the whole folders, and the
    next merge, or `finish_merge`, puts them in place again. A merge whose rows are not in place raises. The new rows
    are read several times, so hand in a stored or cheap frame. Writers of one table must take turns.
    """
    added = with_folders(new, date, by)
    versioned = versions.is_versioned(spark, path)
    if not versioned:
        finish_merge(spark, path, new.schema, by)
    folders = touched_folders(added, by)
    if not folders:
        return 0
    if versioned:
        return versions.merge(spark, path, added, folders, new.schema, keys, date)
    affected = stored_by_month(spark, path, new.schema, folders, by)
    replace_by_key(affected, added, keys).write.mode("overwrite").parquet(_pending(path))
    # A mark of our own: clusters may switch off those of Spark's writers.
    files, mark = _pending_mark(spark, path)
    files.create(mark, True).close()
    written = finish_merge(spark, path, new.schema, by)
    if not written:
        raise RuntimeError(f"the merge into {path} is not in place")
    return written


def _pending(path: str) -> str:
    """Merged folders on their way. Readers of the table skip names that begin with an underscore."""
    return f"{path.rstrip('/')}/_pending"


def _pending_mark(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_pending(path)}/_whole")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def finish_merge(spark: SparkSession, path: str, schema: StructType, by=MONTH) -> int:
    """Put merged folders that were written whole into place. Doing so again gives the same table."""
    files, mark = _pending_mark(spark, path)
    if not files.exists(mark):
        return 0
    columns = [StructField(name, IntegerType()) for name in by]
    rows = spark.read.schema(StructType([*schema.fields, *columns])).parquet(_pending(path))
    written = write_partitioned(rows, path, by)
    files.delete(mark.getParent(), True)
    return written


def rewrite_series(spark: SparkSession, path: str, new: DataFrame, new_path: str) -> int:
    """Next version of a month-partitioned table in which the cities of `new` have exactly its
    rows. It goes to a path of its own: a month that only the replaced series had would survive
    an overwrite in place."""
    stored = stored_by_month(spark, path, new.schema).drop(*MONTH)
    out = with_folders(replace_series(stored, new))
    return _counted(
        out.hint("rebalance", *MONTH),
        lambda rows: rows.write.mode("errorifexists").partitionBy(*MONTH).parquet(new_path),
    )


def append(df: DataFrame, path: str, partition_by=()) -> int:
    return _counted(df, lambda out: out.write.mode("append").partitionBy(*partition_by).parquet(path))
