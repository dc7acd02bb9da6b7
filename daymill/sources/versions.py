"""Month tables with committed versions: a small manifest names the version of each folder, and is published last.

A table is a folder with

    version=<id>/year=…/month=…      rows, as one merge wrote them
    _counts/version=<id>/year=…/…    rows and first and last day of each city in those folders
    _manifest/<number>.json          which version holds for which folder; the highest whole one counts

A merge writes the folders it touches as a new version, then their counts, then the manifest. Until that is there readers
see the state before, afterwards the one after, never a mix; what a lost driver leaves is named by no manifest. No marker
files of Spark's writers and no renames are needed. Two writers of one table publish the same number, of which the
second fails, with nothing changed.
"""

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from daymill.operators.tables import replace_by_key

MONTH = ("year", "month")
UNDATED = "none"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class PublishError(RuntimeError):
    """Another writer has published the version that this one was about to."""


@dataclass(frozen=True)
class State:
    """A published state: its number, the folder columns, and the version of each folder (None: rows without a day)."""

    number: int
    by: tuple[str, ...]
    folders: dict[int | None, str] = field(default_factory=dict)

    def between(self, start=None, end=None) -> list[int | None]:
        """Folders whose month lies between those of two days; without a bound, the undated one as well."""
        if start is None and end is None:
            return list(self.folders)
        width = 32 if "day" in self.by else 1
        low = (start.year * 12 + start.month) * width if start else 0
        high = (end.year * 12 + end.month + 1) * width if end else None
        return [n for n in self.folders if n is not None and n >= low and (high is None or n < high)]


def folder_path(number: int | None, by=MONTH) -> str:
    """year=…/month=… of a folder's number (months since year 0, times 32 plus the day where there are days)."""
    if number is None:
        return "/".join(f"{name}={NO_VALUE}" for name in by)
    month, day = divmod(number, 32) if "day" in by else (number, None)
    values = {"year": (month - 1) // 12, "month": (month - 1) % 12 + 1, "day": day}
    return "/".join(f"{name}={values[name]}" for name in by)


def _files(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _manifests(spark: SparkSession, path: str) -> dict[int, object]:
    files, folder = _files(spark, f"{path}/_manifest")
    if not files.exists(folder):
        return {}
    names = {s.getPath().getName(): s.getPath() for s in files.listStatus(folder)}
    return {int(m[1]): p for n, p in names.items() if (m := re.fullmatch(r"(\d+)\.json", n))}


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_manifests(spark, path.rstrip("/")))


def current(spark: SparkSession, path: str) -> State:
    """The state published last. A manifest whose writer was lost before its end does not count."""
    path = path.rstrip("/")
    files, _ = _files(spark, path)
    for number, place in sorted(_manifests(spark, path).items(), reverse=True):
        stream = files.open(place)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            read = json.loads(text)
        except ValueError:
            continue
        return State(number, tuple(read["by"]), {None if k == UNDATED else int(k): v for k, v in read["folders"].items()})
    raise FileNotFoundError(f"{path} has no manifest")


def publish(spark: SparkSession, path: str, before: State | None, by, folders: dict[int | None, str]) -> State:
    """Make `folders` the state of the table, if the one in `before` is still the last."""
    path = path.rstrip("/")
    present = _manifests(spark, path)
    if before is not None and current(spark, path).number != before.number:
        raise PublishError(f"{path} has been changed by another writer")
    number = max(present, default=0) + 1
    files, place = _files(spark, f"{path}/_manifest/{number:08d}.json")
    text = json.dumps({"by": list(by), "folders": {UNDATED if n is None else str(n): v for n, v in folders.items()}})
    try:
        out = files.create(place, False)  # refuses a file that is there
    except Exception as error:
        raise PublishError(f"{path} has been changed by another writer") from error
    out.write(bytearray(text.encode()))
    out.close()
    return State(number, tuple(by), dict(folders))


def create(spark: SparkSession, path: str, by=MONTH) -> None:
    """An empty table, unless one is there already."""
    if not is_versioned(spark, path):
        publish(spark, path, None, by, {})


def _columns(schema: StructType, by) -> StructType:
    return StructType([*schema.fields, *[StructField(name, IntegerType()) for name in by]])


def _open(spark: SparkSession, base: str, schema: StructType, state: State, folders) -> DataFrame:
    """Rows of the given folders of a state, from exactly their directories."""
    chosen = [n for n in (state.folders if folders is None else folders) if n in state.folders]
    whole = _columns(schema, state.by)
    if not chosen:
        return spark.createDataFrame([], whole)
    places = [f"{base}/version={state.folders[n]}/{folder_path(n, state.by)}" for n in chosen]
    return spark.read.schema(whole).option("basePath", base).parquet(*places).select(*whole.names)


def read(spark: SparkSession, path: str, schema: StructType, folders=None, state: State | None = None) -> DataFrame:
    """The table as last published, or as of `state`, with its folder columns; with `folders` nothing else is opened."""
    return _open(spark, path.rstrip("/"), schema, state or current(spark, path), folders)


COUNTS = StructType([
    StructField("city", StringType()), StructField("rows", LongType()), StructField("first_date", DateType()), StructField("last_date", DateType()),
])


def read_counts(spark: SparkSession, path: str, folders=None, state: State | None = None) -> DataFrame:
    """Rows, first and last day of each city in each folder, as of the state; far smaller than the table."""
    return _open(spark, f"{path.rstrip('/')}/_counts", COUNTS, state or current(spark, path), folders)


def merge(spark: SparkSession, path: str, added: DataFrame, folders: list, schema: StructType, keys, date: str) -> int:
    """Replace by key in the folders that the new rows touch, and publish; returns the rows of those folders.

    `added` has the folder columns. Other folders are neither read nor written, and each touched one is written once.
    """
    path = path.rstrip("/")
    before = current(spark, path)
    affected = read(spark, path, schema, folders, before)
    version, seen = uuid.uuid4().hex, Observation()
    target = f"{path}/version={version}"
    rows = replace_by_key(affected, added, keys).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.hint("rebalance", *before.by).write.mode("errorifexists").partitionBy(*before.by).parquet(target)
    written = seen.get["rows"]
    state = State(0, before.by, dict.fromkeys(folders, version))
    kept = _open(spark, path, schema, state, folders)
    counts = kept.groupBy(*before.by, "city").agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )
    counts.hint("rebalance", *before.by).write.mode("errorifexists").partitionBy(*before.by).parquet(f"{path}/_counts/version={version}")
    publish(spark, path, before, before.by, before.folders | state.folders)
    return written


def expire(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the versions that none of the last `keep` states names, and older manifests; returns the number of versions.
    Plans that were made on those states can no longer run, so keep as many as long jobs need."""
    path = path.rstrip("/")
    files, folder = _files(spark, path)
    numbers = sorted(_manifests(spark, path).items())
    live, last = set(), current(spark, path)
    for number, place in numbers[-keep:]:
        rows = spark.read.text(place.toString(), wholetext=True).first()
        try:
            live |= set(json.loads(rows[0])["folders"].values()) if rows else set()
        except ValueError:
            continue
    live |= set(last.folders.values())
    for number, place in numbers[:-keep]:
        if number != last.number:
            files.delete(place, False)
    dead = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("version=")]
    dead = [p for p in dead if p.getName().removeprefix("version=") not in live]
    for place in dead:
        files.delete(place, True)
        files.delete(_files(spark, f"{path}/_counts/{place.getName()}")[1], True)
    return len(dead)


# What follows from the counts: which folders hold the rows that are asked for.


def newest_folders(spark: SparkSession, path: str, names: list[str], n: int, state: State) -> list[int]:
    """The last folders that together hold n rows of the given spellings of a city, newest first, and no older ones."""
    rows = read_counts(spark, path, state=state).filter(F.col("city").isin(names) & F.col("year").isNotNull())
    by_folder = rows.groupBy(*state.by).agg(F.sum("rows").alias("rows")).orderBy(*[F.desc(c) for c in state.by]).collect()
    chosen, held = [], 0
    for r in by_folder:
        if held >= n:
            break
        chosen.append(number_of(r, state.by))
        held += r.rows
    return chosen


def number_of(row, by=MONTH) -> int | None:
    if row[by[0]] is None:
        return None
    month = row["year"] * 12 + row["month"]
    return month * 32 + row["day"] if "day" in by else month


def marks(spark: SparkSession, path: str) -> DataFrame:
    """(city, last_date): newest stored day of each city, from the counts alone."""
    return read_counts(spark, path).groupBy("city").agg(F.max("last_date").alias("last_date"))
