"""The daily run over stored tables, step by step. Every table is partitioned by month, and each
step rewrites only the months it changes."""

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymill import schemas, workspace
from daymill.constants import HORIZONS, MAX_GAP, WEATHER_VARIABLES
from daymill.operators.aggregate import daily_mean, high_water_mark_by, last_per_key
from daymill.operators.incremental import backfill_dates
from daymill.operators.tables import FORECAST_KEY, fill_actuals, upsert_forecasts
from daymill.operators.unnest import rejected_hours, unnest_hourly
from daymill.plans.forecast import forecast
from daymill.plans.training import latest_features, latest_of_recent, row_features
from daymill.plans.views import refresh_mart
from daymill.sources.responses import flatten_readings, quarantined, usable
from daymill.sources import versions
from daymill.sources.sinks import append, exists, merge_by_month, month_number, stored_by_month, touched_folders, with_folders

HISTORY_DAYS = 120  # enough for the newest features of a city that reports most days


@dataclass(frozen=True)
class Tables:
    """Paths of the stored tables; `rejected` holds one table per kind of input."""

    readings: str
    weather: str
    forecasts: str
    rejected: str

    def ensure(self, spark: SparkSession) -> None:
        """Tables that are not there yet are made, with a manifest; plain ones stay plain."""
        for path in (self.readings, self.weather, self.forecasts):
            if not exists(spark, path):
                versions.create(spark, path)

    def read_readings(self, spark: SparkSession, start=None, end=None) -> DataFrame:
        return _months(spark, self.readings, schemas.READING, start, end)

    def read_weather(self, spark: SparkSession, start=None, end=None) -> DataFrame:
        return _months(spark, self.weather, schemas.WEATHER_DAY, start, end)

    def read_forecasts(self, spark: SparkSession, start=None, end=None) -> DataFrame:
        """By the day the forecast was made."""
        return _months(spark, self.forecasts, schemas.FORECAST, start, end)


def _months(spark: SparkSession, path: str, schema, start, end) -> DataFrame:
    """The whole months from `start` to `end` of a stored table; others are not opened."""
    if versions.is_versioned(spark, path):
        state = versions.current(spark, path)
        return versions.read(spark, path, schema, state.between(start, end), state).drop("year", "month")
    rows = stored_by_month(spark, path, schema)
    if start is not None:
        rows = rows.filter(month_number() >= start.year * 12 + start.month)
    if end is not None:
        rows = rows.filter(month_number() <= end.year * 12 + end.month)
    return rows.drop("year", "month")


def _bounds(rows: DataFrame, date: str):
    """First and last day of a stored frame; (None, None) when it has none."""
    return tuple(rows.agg(F.min(date), F.max(date)).first())


def load_readings(spark: SparkSession, tables: Tables, responses: DataFrame) -> DataFrame:
    """Landed reading responses (city, body) into the readings table; returns the rows stored.

    A response counts for the day it states, not for the day it was asked for. Of repeats of a day the
    one that states the latest time stays; values decide only between equal times. Unusable responses
    go to the rejected table with their body, each (city, body) once; they stop nothing.
    """
    flat = workspace.materialize(flatten_readings(responses, keep=("body",)), "responses")
    reject(spark, quarantined(flat), f"{tables.rejected}/readings")
    good = usable(flat).drop("body")
    order = ["stated", *[c for c in good.columns if c not in ("city", "date", "stated")]]
    newest = last_per_key(good, ["city", "date"], [F.col(c) for c in order]).drop("stated")
    rows = workspace.materialize(newest, "readings")
    merge_by_month(spark, tables.readings, rows)
    return rows


def load_weather(spark: SparkSession, tables: Tables, documents: DataFrame) -> DataFrame:
    """Landed weather documents (city, hourly, and `landed` where there is an order) into the daily
    weather table; returns the rows stored. Of several documents with an hour the latest landed counts.
    Documents without hours, and hours without a readable time, go to the rejected table with their whole
    document, `landed` included, as JSON; alike ones of one document once."""
    whole = documents.withColumn("document", F.to_json(F.struct(*documents.columns)))
    reject(spark, rejected_hours(whole, keep=("city", "document")), f"{tables.rejected}/weather")
    order = ["landed"] if "landed" in documents.columns else []
    hours = unnest_hourly(documents, keep=("city", *order))
    newest = last_per_key(hours, ["city", "timestamp"], [F.col(c) for c in [*order, *WEATHER_VARIABLES]]).drop(*order)
    days = daily_mean(newest).select(*[f.name for f in schemas.WEATHER_DAY])
    rows = workspace.materialize(days, "weather")
    merge_by_month(spark, tables.weather, rows)
    return rows


def reject(spark: SparkSession, rows: DataFrame, path: str, day: str | None = None) -> int:
    """Add rejected rows that the rejected table does not hold yet, so a rerun adds none. Rows are the same when all
    columns are, so hand in what tells one source row from another.

    The table has a `digest` of each row and is partitioned by `part`: the day in column `day`, the one it landed, or
    where there is none the beginning of the digest. Digests alone are compared, and only the parts that the new
    rows fall into are opened (at most one per day of the calendar, or 16)."""
    digest = F.sha2(F.to_json(F.struct(*rows.columns)), 256)
    part = F.coalesce(F.col(day).cast("string"), F.lit("none")) if day else F.substring("digest", 1, 1)
    named = workspace.materialize(rows.withColumn("digest", digest).withColumn("part", part).dropDuplicates(["digest"]), "rejected")
    parts = [r.part for r in named.select("part").distinct().collect()]
    if exists(spark, path):
        stored = spark.read.schema(named.schema).parquet(path).filter(F.col("part").isin(parts))
        named = named.join(stored.select("part", "digest"), ["part", "digest"], "left_anti")
    return append(named.select(*rows.columns, "digest", "part").hint("rebalance", "part"), path, ["part"])


def store_actuals(spark: SparkSession, tables: Tables, readings: DataFrame, on_date=None) -> int:
    """Fill the missing actuals of stored forecasts from `readings`; only rows that change are
    written. Returns the number of rows in the rewritten months."""
    # The days on which these targets were forecast: no other month of the log is opened.
    made = readings.select(F.explode(F.array(*[F.date_sub("date", h) for h in HORIZONS])).alias("date"))
    months = [n for n in touched_folders(with_folders(made.dropna())) if n is not None]
    if not months:
        return 0
    log = stored_by_month(spark, tables.forecasts, schemas.FORECAST, months).drop("year", "month")
    open_rows = log.filter(F.col("actual").isNull())
    filled = fill_actuals(open_rows, readings, on_date).filter(F.col("actual").isNotNull())
    changed = workspace.materialize(filled, "actuals")
    return merge_by_month(spark, tables.forecasts, changed, FORECAST_KEY, "forecast_date")


def store_forecasts(spark: SparkSession, tables: Tables, new: DataFrame) -> int:
    """Upsert forecasts into the stored log: a known key changes its prediction only."""
    log = tables.read_forecasts(spark, *_bounds(new, "forecast_date"))
    known = log.join(new.select(*FORECAST_KEY), FORECAST_KEY, "left_semi").select(*log.columns)
    changed = workspace.materialize(upsert_forecasts(known, new), "forecasts")
    return merge_by_month(spark, tables.forecasts, changed, FORECAST_KEY, "forecast_date")


def fill_known(spark: SparkSession, tables: Tables, forecasts: DataFrame) -> int:
    """Fill the actuals of forecasts that were stored after the reading of their target day: from the
    stored readings of the months that the targets fall in."""
    first, last = _bounds(forecasts, "target_date")
    if first is None:
        return 0
    days = forecasts.select("city", F.col("target_date").alias("date")).distinct()
    readings = tables.read_readings(spark, first, last).join(days, ["city", "date"], "left_semi")
    return store_actuals(spark, tables, workspace.materialize(readings, "known"))


def store_mart(spark: SparkSession, tables: Tables, mart: str, changed: DataFrame) -> int:
    """Bring the stored mart up to date with changed readings. Row lags do not exist on streams,
    so a stream of readings calls this for each batch it has merged. Of tables with a manifest only the months are
    opened that hold rows which the change can reach."""
    if versions.is_versioned(spark, tables.readings):
        readings, weather = reached(spark, tables, changed)
    else:
        readings, weather = tables.read_readings(spark), tables.read_weather(spark)
    rows = workspace.materialize(refresh_mart(readings, weather, changed), "mart")
    if not exists(spark, mart):
        versions.create(spark, mart)
    return merge_by_month(spark, mart, rows)


def reached(spark: SparkSession, tables: Tables, changed: DataFrame, lookback: int = MAX_GAP) -> tuple[DataFrame, DataFrame]:
    """Readings and weather of the months from which `refresh_mart` needs rows.

    Per city these go from the month that holds the `lookback`-th row before its first change to the one that holds the
    `lookback`-th row after its last. Lags count rows, so in a sparse city that may be years; the stored counts by city and
    month tell exactly, without a look at the rows. Only the numbers of those months reach the driver.
    """
    state = versions.current(spark, tables.readings)
    number = month_number()
    spans = changed.groupBy("city").agg(
        F.min(F.year("date") * 12 + F.month("date")).alias("_from"), F.max(F.year("date") * 12 + F.month("date")).alias("_to")
    )
    counts = versions.read_counts(spark, tables.readings, state=state).filter("year is not null").select("city", number.alias("_month"), "rows")
    held = counts.join(spans, "city")
    order = Window.partitionBy("city").orderBy("_month")
    sum_of = lambda which, over: F.coalesce(F.sum(F.when(which, F.col("rows"))).over(over), F.lit(0))
    # Rows strictly between a month and the changed ones: a month counts while these are too few.
    nearer = sum_of(F.col("_month") < F.col("_from"), order.rowsBetween(1, Window.unboundedFollowing))
    later = sum_of(F.col("_month") > F.col("_to"), order.rowsBetween(Window.unboundedPreceding, -1))
    months = held.withColumns({"_nearer": nearer, "_later": later}).filter(
        F.when(F.col("_month") < F.col("_from"), F.col("_nearer") < lookback)
        .when(F.col("_month") > F.col("_to"), F.col("_later") < lookback).otherwise(True)
    )
    bounds = workspace.materialize(
        months.groupBy("city").agg(F.min("_month").alias("_low"), F.max("_month").alias("_high"), F.collect_set("_month").alias("_months")), "reached"
    )
    folders = [r.n for r in bounds.select(F.explode("_months").alias("n")).distinct().collect()]
    readings = versions.read(spark, tables.readings, schemas.READING, folders, state)
    within = number.between(F.col("_low"), F.col("_high"))
    readings = readings.join(bounds.drop("_months"), "city").filter(within).select(*schemas.READING.names)
    return readings, stored_by_month(spark, tables.weather, schemas.WEATHER_DAY, folders).drop("year", "month")


def pending_days(
    spark: SparkSession, tables: Tables, cities: DataFrame, until, of_weather: bool = False
) -> DataFrame:
    """(city, date) still to be fetched up to `until`, counted per city."""
    path = tables.weather if of_weather else tables.readings
    if versions.is_versioned(spark, path):
        # The stored counts hold each city's newest day: no row is read.
        stored = versions.marks(spark, path).withColumnRenamed("last_date", "date")
    else:
        stored = tables.read_weather(spark) if of_weather else tables.read_readings(spark)
    return backfill_dates(high_water_mark_by(stored, cities), until)


def stored_latest_features(
    spark: SparkSession, tables: Tables, cities: DataFrame, day, history_days: int = HISTORY_DAYS
) -> DataFrame:
    """Newest features of the given cities, opening only the months of the last `history_days`.
    Cities for which that is not provably the same as their whole history (sparse, long silent)
    are computed from all of it."""
    start = day - timedelta(days=history_days)
    wanted = cities.select("city").distinct()
    recent = tables.read_readings(spark, start).join(wanted, "city", "left_semi")
    latest = workspace.materialize(latest_of_recent(recent), "recent")
    proven = latest.filter("proven").drop("proven")
    features = row_features(proven, tables.read_weather(spark, start))
    rest = workspace.materialize(wanted.join(proven, "city", "left_anti"), "rest")
    if rest.isEmpty():
        return features
    history = tables.read_readings(spark).join(rest, "city", "left_semi")
    return features.unionByName(latest_features(history, tables.read_weather(spark)))


def daily_run(
    spark: SparkSession,
    tables: Tables,
    responses: DataFrame,
    documents: DataFrame,
    champions: DataFrame,
    forecast_date,
    horizons=HORIZONS,
) -> DataFrame:
    """Landed data in, forecasts out: load, fill actuals, forecast, store."""
    tables.ensure(spark)
    readings = load_readings(spark, tables, responses)
    load_weather(spark, tables, documents)
    store_actuals(spark, tables, readings)
    latest = stored_latest_features(spark, tables, champions, forecast_date)
    forecasts = workspace.materialize(forecast(spark, latest, champions, forecast_date, horizons), "new")
    store_forecasts(spark, tables, forecasts)
    fill_known(spark, tables, forecasts)
    return forecasts
