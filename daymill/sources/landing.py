"""Readers for landed documents and stored tables.

Layout of a landed dataset: <root>/year=YYYY/month=MM/day=DD/<city>.json. The folders are
partition columns, so a date range prunes folders before any file is opened.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymill.functions.text import (
    blank_to_null,
    key_city,
    key_day,
    number_or_null,
    parse_day,
)
from daymill.constants import POLLUTANTS, READING_COLUMNS


def read_documents(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """One JSON document per line; fields outside the schema are never parsed."""
    return spark.read.schema(schema).json(path)


def folder_day(df: DataFrame) -> Column:
    """Day named by the folder columns; a file one level up counts as the first of its month."""
    day = F.col("day") if "day" in df.columns else F.lit(1)
    return F.make_date(F.col("year"), F.col("month"), day)


def days_between(df: DataFrame, start=None, end=None) -> DataFrame:
    """Keep folders of [start, end]. The year bounds prune on their own; the day bound refines."""
    if start is not None:
        df = df.filter((F.col("year") >= start.year) & (folder_day(df) >= F.lit(start)))
    if end is not None:
        df = df.filter((F.col("year") <= end.year) & (folder_day(df) <= F.lit(end)))
    return df


def read_landed(spark: SparkSession, root: str, schema: StructType, start=None, end=None) -> DataFrame:
    """Landed documents of a date range, with `landed_date` from the folder and `city` from the
    path when the document does not carry it."""
    df = days_between(read_documents(spark, root, schema), start, end)
    df = df.withColumn("landed_date", folder_day(df))
    if "city" not in df.columns:
        df = df.withColumn("city", key_city(F.col("_metadata.file_path")))
    return df


def _objects(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Files under a root. The content column is never asked for, so no file is opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root)


def list_dates(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Distinct days present in a landed dataset, in order."""
    files = _objects(spark, root, pattern)
    return files.select(folder_day(files).alias("date")).distinct().orderBy("date")


def list_objects(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Distinct (city, date) of a landed dataset, both taken from the file path."""
    path = F.col("path")
    files = _objects(spark, root, pattern).select("path")
    return files.select(key_city(path).alias("city"), key_day(path).alias("date")).distinct()


def read_history_csv(spark: SparkSession, path, city=None, delimiter: str = ",") -> DataFrame:
    """Historical readings that have a day; the others are in `rejected_history_csv`."""
    raw = _history_cells(spark, path, city, delimiter)
    return raw.filter(F.col("date").isNotNull()).select(*READING_COLUMNS)


def rejected_history_csv(spark: SparkSession, path, city=None, delimiter: str = ",") -> DataFrame:
    """(city, text, reason) and the values of the lines whose day is missing or in no known format."""
    raw = _history_cells(spark, path, city, delimiter).filter(F.col("date").isNull())
    text = blank_to_null(F.col("_day"))
    reason = F.when(text.isNull(), "no day").otherwise("day not readable")
    return raw.select("city", text.alias("text"), reason.alias("reason"), *POLLUTANTS)


def _history_cells(spark: SparkSession, path, city, delimiter: str) -> DataFrame:
    """Historical readings: padded header names, blank cells as null, several day formats.

    `city` is a name, or a Column over the file path; without it the file must carry the column.
    Files read together must have the same header: a different one is an error, not a mix-up.
    """
    raw = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    raw = raw.toDF(*[name.strip() for name in raw.columns])
    if isinstance(city, Column):
        city_column = city
    elif city is not None:
        city_column = F.lit(city)
    else:
        city_column = blank_to_null(F.col("city"))
    cells = {p: number_or_null(F.col(p)) for p in POLLUTANTS}
    return raw.withColumn("_day", F.col("date")).withColumns(
        {"date": parse_day(F.col("date")), "city": city_column, **cells}
    )


def read_history(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Historical readings of several cities, given as {city: path}."""
    return reduce(
        DataFrame.unionByName, [read_history_csv(spark, path, city) for city, path in files.items()]
    )


def read_parquet(spark: SparkSession, paths, schema: StructType) -> DataFrame:
    """Many Parquet files or folders as one table, under one schema."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).parquet(*paths)


def read_partitioned(
    spark: SparkSession, root: str, start=None, end=None, schema: StructType | None = None
) -> DataFrame:
    """A stored table partitioned by year and month (and day), restricted to a date range.
    `schema` includes the folder columns; without it the file footers give the types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = days_between(reader.parquet(root), start and start.replace(day=1), end)
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start))
    return df if end is None else df.filter(F.col("date") <= F.lit(end))


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict, bounds) -> DataFrame:
    """A database table. `bounds` = (date column, first day, last day, partitions): it is read in
    parallel date ranges, never through one connection as a whole."""
    column, first, last, partitions = bounds
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=str(first),
        upperBound=str(last),
        numPartitions=partitions,
        properties=properties,
    )


def load_tables(spark: SparkSession, readings: str, weather: str) -> tuple[DataFrame, DataFrame]:
    """The stored readings and weather tables by name. Unsorted: consumers that need an order
    ask for it, and windows sort by series anyway."""
    return spark.table(readings), spark.table(weather)
