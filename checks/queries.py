"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from checks import standins as s
from daymill import workspace
from daymill.constants import HORIZONS, MODEL_FEATURES, POLLUTANTS, READING_COLUMNS
from daymill.functions.calendar import calendar_columns
from daymill.functions.weather import interaction_columns
from daymill.operators import aggregate, incremental, joins, metrics, series, tables, topn, unnest
from daymill.functions.text import model_name
from daymill.models import seasonal, stacked, trees
from daymill.operators.flights import clean_flights
from daymill.operators.tables import FORECAST_KEY
from daymill.plans import daily as run
from daymill.plans import forecast, lake, serving, training, views
from daymill.schemas import FLIGHT, READING, WEATHER_DAY, hourly_response
from daymill.sources import landing, responses, sinks, versions
from daymill.streaming import daily

QUERIES = {}

BACKFILL_UNTIL = date(2001, 8, 10)
FORECAST_DAY = date(2001, 8, 3)
SCAN_START, SCAN_END = date(2024, 1, 10), date(2024, 1, 20)


def query(function):
    def registered(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        workspace.use_own_root(spark)
        return s.shown(function(spark, sf_dir))

    QUERIES[function.__name__] = registered
    return registered


# Staging, intermediate and mart models.


@query
def stg_air_quality(spark, sf):
    return views.stg_air_quality(s.readings(spark, sf))


@query
def stg_weather(spark, sf):
    return views.stg_weather(s.weather(spark, sf))


@query
def aq_weather_features(spark, sf):
    return views.int_aq_features(s.readings(spark, sf), s.weather(spark, sf))


@query
def ml_features(spark, sf):
    return views.register(spark, s.readings(spark, sf), s.weather(spark, sf))


@query
def merge_weather(spark, sf):
    return joins.merge_weather(s.readings(spark, sf), s.weather(spark, sf))


@query
def lag_features(spark, sf):
    return series.add_lags(s.readings(spark, sf))


@query
def rolling_incl(spark, sf):
    return series.add_rolling_mean(s.readings(spark, sf))


@query
def rolling_excl_full(spark, sf):
    return series.add_full_rolling_mean(s.readings(spark, sf)).select("city", "date", "pm10", "pm10_rolling_7d")


@query
def mart_refresh(spark, sf):
    readings = s.readings(spark, sf)
    changed = s.sparse_readings(spark, sf).filter("year(date) = 2000 and month(date) between 5 and 6")
    return views.refresh_mart(readings, s.weather(spark, sf), changed)


# Gaps, targets, features.


@query
def calendar_lags(spark, sf):
    """Lags, mean and targets by the calendar, over series whose long gaps have been dropped."""
    clean = series.clean_series(s.readings(spark, sf)).select("city", "date", "pm10")
    return series.add_calendar_features(clean, horizons=HORIZONS)


@query
def bounded_interpolate(spark, sf):
    return series.interpolate(s.readings(spark, sf)).select("city", "date", "pm10")


@query
def gap_drop(spark, sf):
    return series.clean_series(s.readings(spark, sf)).select("city", "date", "pm10")


@query
def targets(spark, sf):
    return series.add_targets(s.readings(spark, sf).select("city", "date", "pm10"))


@query
def latest_row(spark, sf):
    return topn.latest_row(training.series_features(s.readings(spark, sf)))


@query
def calendar_features(spark, sf):
    return s.readings(spark, sf).select("city", "date").withColumns(calendar_columns())


@query
def interaction_features(spark, sf):
    return s.weather(spark, sf).withColumns(interaction_columns())


def _frame(spark, sf):
    frame = training.training_frame(s.readings(spark, sf), s.weather(spark, sf))
    return training.chrono_split(frame, **s.SPLIT)


@query
def training_frame(spark, sf):
    targets = [c for c in _frame(spark, sf).columns if c.startswith("target_")]
    return _frame(spark, sf).select("city", "date", "split", "pm10", *MODEL_FEATURES, *targets)


@query
def chrono_split(spark, sf):
    frame = _frame(spark, sf)
    return frame.groupBy("city", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


# Landed documents, hours, days.


@query
def json_doc_scan(spark, sf):
    path = workspace.new_path(spark, "documents")
    sinks.land_documents(s.documents(spark, sf), path)
    schema = hourly_response(s.HOUR_VARIABLES).add("city", StringType()).add("part", LongType())
    docs = landing.read_landed(spark, path, schema)
    total = F.aggregate("hourly.temperature_2m", F.lit(0.0), lambda a, v: a + v)
    return docs.select(
        "city",
        F.col("landed_date").alias("date"),
        "part",
        F.array_size("hourly.time").alias("times"),
        F.array_min("hourly.time").alias("first_time"),
        total.alias("temperature_sum"),
    )


@query
def hourly_unnest(spark, sf):
    docs = s.documents(spark, sf, ragged=True)
    text = docs.select("city", "part", F.to_json(F.struct("hourly")).alias("body"))
    parsed = text.select(
        "city", "part", F.from_json("body", hourly_response(s.HOUR_VARIABLES)).alias("r")
    ).select("city", "part", "r.hourly")
    return unnest.unnest_hourly(parsed, s.HOUR_VARIABLES, keep=("city", "part")).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


@query
def ragged_audit(spark, sf):
    return unnest.ragged_documents(
        s.documents(spark, sf, ragged=True), s.HOUR_VARIABLES, keep=("city", "date", "part")
    )


@query
def document_quarantine(spark, sf):
    """Documents without hours, and hours without a readable time."""
    docs = s.documents(spark, sf, ragged=True)
    docs = docs.withColumn("hourly", F.when(F.col("part") % 11 != 5, F.col("hourly")))
    return unnest.rejected_hours(docs, s.HOUR_VARIABLES, keep=("city", "date", "part"))


@query
def daily_run_readings(spark, sf):
    """The stored readings after two runs over responses that repeat days: the latest stated time counts."""
    tables = _stored(spark)
    for _ in range(2):
        run.load_readings(spark, tables, s.responses(spark, sf, repeated=True))
    return tables.read_readings(spark).select(*READING_COLUMNS)


@query
def daily_run_rejected(spark, sf):
    """What two runs over the same landed responses reject: each response once."""
    tables = _stored(spark)
    # A landed body is fixed text. Derived again, its means can end in other digits: sums of doubles depend on the order of shuffled blocks.
    landed = workspace.materialize(s.responses(spark, sf, repeated=True), "landed")
    for _ in range(2):
        run.load_readings(spark, tables, landed)
    return spark.read.parquet(f"{tables.rejected}/readings").groupBy("city", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def daily_run_weather(spark, sf):
    """The stored weather after two landings of every document, the second with corrected values."""
    tables = _stored(spark)
    docs = s.documents(spark, sf).withColumn("landed", F.lit(2))
    wrong = F.col("hourly").withField("temperature_2m", F.transform("hourly.temperature_2m", lambda v: v * 3))
    run.load_weather(spark, tables, docs.unionByName(docs.withColumn("hourly", wrong).withColumn("landed", F.lit(1))))
    return tables.read_weather(spark).select("date", "city", *s.HOUR_VARIABLES)


@query
def daily_run_log(spark, sf):
    """Forecasts that are stored after the readings of their target days get their actuals."""
    tables = _stored(spark)
    readings = workspace.materialize(s.readings(spark, sf), "readings")
    run.merge_by_month(spark, tables.readings, readings.select(*READING_COLUMNS))
    new = workspace.materialize(s.forecast_log(spark, sf), "forecasts")
    run.store_forecasts(spark, tables, new)
    run.fill_known(spark, tables, new)
    return tables.read_forecasts(spark)


def _stored(spark):
    tables = run.Tables(*[workspace.new_path(spark, n) for n in ("readings", "weather", "forecasts", "rejected")])
    tables.ensure(spark)
    return tables


@query
def weather_silver(spark, sf):
    """Landed documents to hourly rows with a required variable, the place, and the month folders."""
    path = workspace.new_path(spark, "weather-documents")
    sinks.land_documents(s.documents(spark, sf, ragged=True), path)
    schema = hourly_response(s.HOUR_VARIABLES).add("city", StringType())
    docs = landing.read_landed(spark, path, schema).withColumnRenamed("city", "airport")
    rows = lake.silver_hours(docs, "airport", ("relative_humidity_2m",), s.HOUR_VARIABLES)
    return rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _lake(spark, sf):
    tables, path = _stored(spark), workspace.new_path(spark, "lake-readings")
    readings = s.sparse_readings(spark, sf).withColumn("landed", F.trunc("date", "month"))
    text = F.when(F.dayofmonth("date") == 31, "never").otherwise(F.col("date").cast("string"))
    sinks.land_documents(readings.withColumn("date", text), path, "landed")
    return tables, path


def _lake_readings(spark, sf):
    tables, path = _lake(spark, sf)
    lake.load_lake_readings(spark, tables, path)
    return tables


@query
def lake_readings(spark, sf):
    return _lake_readings(spark, sf).read_readings(spark).select(*READING_COLUMNS)


@query
def lake_rejected(spark, sf):
    rows = spark.read.parquet(f"{_lake_readings(spark, sf).rejected}/lake")
    return rows.groupBy("city", "text", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def lake_rejected_rows(spark, sf):
    """Every rejected reading of two loads of the same landing, each source row once."""
    tables, path = _lake(spark, sf)
    for _ in range(2):
        lake.load_lake_readings(spark, tables, path)
    rows = spark.read.parquet(f"{tables.rejected}/lake_rows")
    return rows.groupBy("city", "reason").agg(F.count(F.lit(1)).alias("rows"), F.sum("pm10").alias("pm10"))


@query
def lake_weather(spark, sf):
    tables, path = _stored(spark), workspace.new_path(spark, "lake-weather")
    sinks.land_documents(s.documents(spark, sf), path)
    lake.load_lake_weather(spark, tables, path)
    return tables.read_weather(spark).select("date", "city", *s.HOUR_VARIABLES)


@query
def history_bootstrap(spark, sf):
    """Historical files of two cities replace what is stored of them, years that the files lack included. Lines whose day
    cannot be read are among them, and go to a table of their own."""
    stored, files, new = (workspace.new_path(spark, n) for n in ("stored", "history", "new"))
    readings = s.sparse_readings(spark, sf)
    sinks.write_by_month(readings, stored)
    part = readings.filter("city in ('5-LOW', '2-HIGH') and year(date) >= 1996")
    lines = part.withColumn("pm10", F.col("pm10") * 2).withColumn("date", F.date_format("date", "yyyy/M/d"))
    unreadable = lines.filter("date like '%/1'").withColumn("date", F.lit("some day"))
    lines.unionByName(unreadable).write.option("header", True).csv(files)
    lake.bootstrap(spark, stored, files, new)
    return spark.read.parquet(new).select(*READING_COLUMNS)


@query
def history_weather(spark, sf):
    weather = s.weather(spark, sf).select("city", "date", *s.HOUR_VARIABLES)
    return lake.weather_of_history(s.sparse_readings(spark, sf), weather)


@query
def stream_late_hours(spark, sf):
    """Two landings, the second with hours of days that the first has long passed: all of them count."""
    landed = workspace.new_path(spark, "landed")
    names = ("stream-hours", "stream-means", "stream-state")
    hourly, path, state = (workspace.new_path(spark, n) for n in names)
    hours, columns = s.hours(spark, sf), s.hours(spark, sf).schema
    for late in (False, True):
        rows = hours.filter((F.col("event_id") % 3 == 0) == late)
        rows.write.mode("append").parquet(landed)
        stream = daily.hour_stream(spark, landed, columns)
        daily.run_hours(stream, s.HOUR_VARIABLES, hourly, path, state, identity=("event_id", "timestamp"))
    return spark.read.parquet(path).drop("year", "month")


@query
def daily_mean(spark, sf):
    return aggregate.daily_mean(s.hours(spark, sf), s.HOUR_VARIABLES)


def _hour_stream(spark, sf):
    events = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    # A glob fits the table as one file and as a folder of part files.
    return daily.hour_stream(spark, f"{sf}/events.parque[t]", events).select(
        "event_id",
        F.col("event_type").alias("city"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("value") * s.UNIT).alias("temperature_2m"),
        (F.col("user_id") * s.USER_UNIT).alias("relative_humidity_2m"),
    )


@query
def stream_daily_mean(spark, sf):
    path = workspace.new_path(spark, "stream-daily")
    means = daily.stream_daily_mean(_hour_stream(spark, sf), s.HOUR_VARIABLES, identity=("event_id",))
    cores = spark.sparkContext.defaultParallelism
    state = workspace.new_path(spark, "stream-state")
    daily.run_available(means, path, state, state_partitions=cores)
    return spark.read.parquet(path).drop("year", "month")


@query
def stream_hours(spark, sf):
    hourly, path, state = (workspace.new_path(spark, n) for n in ("stream-hours", "stream-means", "stream-state"))
    identity = ("event_id", "timestamp")
    daily.run_hours(_hour_stream(spark, sf), s.HOUR_VARIABLES, hourly, path, state, identity=identity)
    return spark.read.parquet(path).drop("year", "month")


@query
def flights_silver(spark, sf):
    path = workspace.new_path(spark, "flights")
    flights = s.flights(spark, sf).drop("event_id")
    sinks.land_documents(flights.withColumn("date", F.to_date(F.timestamp_seconds("firstSeen"))), path)
    landed = landing.read_landed(spark, path, FLIGHT).select(*FLIGHT.names)
    columns = ["icao24", "estDepartureAirport", "callsign", "firstSeen_ts", "lastSeen_ts",
               "duration_minutes", "year", "month"]
    return clean_flights(landed).select(*columns)


@query
def dedup_latest(spark, sf):
    flights = s.flights(spark, sf).withColumn("day", F.to_date(F.timestamp_seconds("firstSeen")))
    newest = aggregate.last_per_key(flights, ["icao24", "day"], [F.col("firstSeen"), F.col("event_id")])
    return newest.select("icao24", "day", "event_id", "firstSeen", "lastSeen")


# Sources written by Spark from the tables and read back.


@query
def api_response_flatten(spark, sf):
    return responses.usable(responses.flatten_readings(s.responses(spark, sf))).drop("stated")


@query
def quarantine_split(spark, sf):
    flat = responses.flatten_readings(s.responses(spark, sf))
    return flat.groupBy("city", F.coalesce("reason", F.lit("usable")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def csv_clean(spark, sf):
    path = workspace.new_path(spark, "csv")
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("  ")).alias(f" {c} ")
    s.sparse_readings(spark, sf).select(
        F.concat(F.lit(" "), F.date_format("date", "yyyy/M/d")).alias("date"),
        F.col("city").alias(" city"),
        *[cell(p) for p in POLLUTANTS],
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return landing.read_history_csv(spark, path)


@query
def csv_quarantine(spark, sf):
    """Lines without a day, or with one that cannot be read, counted by city and reason."""
    path = workspace.new_path(spark, "csv")
    day = F.dayofmonth("date")
    text = F.when(day == 17, "some day").when(day == 23, "  ").otherwise(F.date_format("date", "yyyy/M/d"))
    cells = [F.col(p).cast("string").alias(p) for p in POLLUTANTS]
    s.sparse_readings(spark, sf).select(text.alias("date"), "city", *cells).write.option("header", True).csv(path)
    rejected = landing.rejected_history_csv(spark, path)
    return rejected.groupBy("city", "text", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def path_metadata(spark, sf):
    path = workspace.new_path(spark, "by-city")
    sinks.land_documents(s.documents(spark, sf), path, by_city=True)
    return landing.list_objects(spark, path)


@query
def list_dates(spark, sf):
    path = workspace.new_path(spark, "dates")
    sinks.land_documents(s.documents(spark, sf), path)
    return landing.list_dates(spark, path)


@query
def partition_pruned_scan(spark, sf):
    path = workspace.new_path(spark, "hours")
    stored = s.hours(spark, sf).withColumn("date", F.to_date("timestamp"))
    sinks.write_partitioned(
        stored.withColumns({"year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")}),
        path,
        ("year", "month", "day"),
    )
    rows = landing.days_between(spark.read.parquet(path), SCAN_START, SCAN_END)
    return aggregate.daily_mean(rows, s.HOUR_VARIABLES)


@query
def parquet_concat(spark, sf):
    daily_rows = s.sparse_readings(spark, sf).select(*READING_COLUMNS)
    early, late = workspace.new_path(spark, "early"), workspace.new_path(spark, "late")
    daily_rows.filter(F.col("date") < F.lit(date(1998, 6, 1))).write.parquet(early)
    daily_rows.filter(F.col("date") >= F.lit(date(1998, 6, 1))).write.parquet(late)
    return landing.read_parquet(spark, [early, late], READING)


# Keyed tables.


def _corrections(spark, sf):
    """March readings moved by a day and doubled: some keys exist, some are new."""
    return (
        s.sparse_readings(spark, sf)
        .filter(F.month("date") == 3)
        .withColumns({"date": F.date_add("date", 1), "pm10": F.col("pm10") * 2})
    )


@query
def replace_by_key(spark, sf):
    return tables.replace_by_key(s.sparse_readings(spark, sf), _corrections(spark, sf))


@query
def replace_series(spark, sf):
    new = s.sparse_readings(spark, sf).filter("city = '5-LOW' and year(date) >= 1998")
    return tables.replace_series(s.sparse_readings(spark, sf), new.withColumn("pm10", F.col("pm10") * 2))


@query
def dynamic_overwrite(spark, sf):
    path = workspace.new_path(spark, "months")
    readings = s.sparse_readings(spark, sf)
    sinks.write_by_month(readings, path)
    part = readings.filter("month(date) = 3 and dayofmonth(date) <= 10")
    sinks.write_by_month(part.withColumn("pm10", F.col("pm10") * 2), path)
    return spark.read.parquet(path).select(*READING_COLUMNS)


@query
def merge_by_month(spark, sf):
    path = workspace.new_path(spark, "merged")
    sinks.write_by_month(s.sparse_readings(spark, sf), path)
    sinks.merge_by_month(spark, path, workspace.materialize(_corrections(spark, sf), "corrections"))
    return spark.read.parquet(path).select(*READING_COLUMNS)


def _versioned_readings(spark, sf, corrected=True):
    """Sparse readings in a table with a manifest, and corrections merged into it."""
    tables = _stored(spark)
    for rows in [s.sparse_readings(spark, sf), _corrections(spark, sf)][: 1 + corrected]:
        sinks.merge_by_month(spark, tables.readings, workspace.materialize(rows.select(*READING_COLUMNS), "readings"))
    return tables


@query
def versioned_merge(spark, sf):
    """Merges into a table whose months have committed versions."""
    return _versioned_readings(spark, sf).read_readings(spark).select(*READING_COLUMNS)


@query
def versioned_counts(spark, sf):
    """Rows, first and last day of each city and month, as the merges keep them beside the table."""
    tables = _versioned_readings(spark, sf)
    return versions.read_counts(spark, tables.readings).select("city", "year", "month", "rows", "first_date", "last_date")


@query
def mart_refresh_stored(spark, sf):
    """The stored mart after a change, from the months that the counts name. The series are sparse: their lags count rows."""
    tables = _stored(spark)
    readings = workspace.materialize(s.sparse_readings(spark, sf).select(*READING_COLUMNS), "readings")
    sinks.merge_by_month(spark, tables.readings, readings)
    weather = s.weather(spark, sf).select(*WEATHER_DAY.names)
    sinks.merge_by_month(spark, tables.weather, workspace.materialize(weather, "weather"))
    changed = readings.filter("year(date) = 2000 and month(date) between 5 and 6")
    mart = workspace.new_path(spark, "mart")
    run.store_mart(spark, tables, mart, changed)
    return versions.read(spark, mart, views.ml_features(readings, weather).schema).drop("year", "month")


@query
def pending_stored(spark, sf):
    """Days to fetch, from the newest days that the counts hold."""
    return run.pending_days(spark, _versioned_readings(spark, sf, False), s.cities(spark), BACKFILL_UNTIL)


@query
def forecast_latest_stored(spark, sf):
    """From the stored log, of which the last months only are opened."""
    tables = _stored(spark)
    sinks.merge_by_month(
        spark, tables.forecasts, workspace.materialize(_filled_log(spark, sf), "log"), FORECAST_KEY, "forecast_date"
    )
    return serving.latest_forecast(spark, tables, s.cities(spark), "5-Low")


@query
def history_stored(spark, sf):
    tables = _stored(spark)
    readings = s.sparse_readings(spark, sf).select(*READING_COLUMNS)
    sinks.merge_by_month(spark, tables.readings, workspace.materialize(readings, "readings"))
    return serving.history(spark, tables, s.cities(spark), "5-Low")


def _filled_log(spark, sf):
    return tables.fill_actuals(s.forecast_log(spark, sf), s.readings(spark, sf))


@query
def update_actuals(spark, sf):
    return _filled_log(spark, sf)


@query
def upsert_predictions(spark, sf):
    new = s.forecast_log(spark, sf).withColumns(
        {
            "forecast_date": F.date_add("forecast_date", 30),
            "target_date": F.date_add("target_date", 31),
            "predicted": F.col("predicted") * 1.5,
            "actual": F.col("predicted") * 0.1,
        }
    )
    return tables.upsert_forecasts(_filled_log(spark, sf), new)


@query
def contract_audit(spark, sf):
    return tables.audit_contract(
        s.raw_readings(spark, sf), ["city", "date", "pm25", "pm10"], ["city", "date"]
    )


@query
def row_count_by_key(spark, sf):
    return tables.row_count_by_key(s.raw_readings(spark, sf))


# High-water marks and missing days.


@query
def high_water_mark(spark, sf):
    return aggregate.high_water_mark(s.raw_readings(spark, sf))


@query
def date_bounds(spark, sf):
    return aggregate.date_bounds(s.raw_readings(spark, sf))


@query
def backfill_dates(spark, sf):
    marks = aggregate.high_water_mark_by(s.raw_readings(spark, sf), s.cities(spark))
    return incremental.backfill_dates(marks, BACKFILL_UNTIL)


@query
def missing_days(spark, sf):
    return incremental.missing_days(s.sparse_readings(spark, sf))


# Serving.


@query
def city_dim_join(spark, sf):
    return joins.with_city(s.sparse_readings(spark, sf).select("city", "date", "pm10"), s.cities(spark))


@query
def forecast_rows(spark, sf):
    inputs = forecast.forecast_inputs(training.series_features(s.readings(spark, sf)), FORECAST_DAY)
    rows = inputs.withColumn("predicted", F.col("pm10_rolling_7d"))
    return rows.select("city", "forecast_date", "target_date", "seasonal_date", "horizon", "model", "predicted")


@query
def forecast_latest(spark, sf):
    return topn.latest_forecast(_filled_log(spark, sf), s.cities(spark), "5-Low")


@query
def history_last_n(spark, sf):
    return topn.history(s.sparse_readings(spark, sf), s.cities(spark), "5-Low")


@query
def topn_per_city(spark, sf):
    return topn.latest_forecast_all(_filled_log(spark, sf))


# Errors, blends, champions.


@query
def regression_metrics(spark, sf):
    return metrics.regression_metrics(_filled_log(spark, sf))


@query
def metrics_by_horizon(spark, sf):
    return metrics.regression_metrics(_filled_log(spark, sf), ["horizon"]).orderBy("horizon")


@query
def metrics_by_city_horizon(spark, sf):
    return metrics.regression_metrics(_filled_log(spark, sf), ["city", "horizon"])


BASES = ("pm10_lag_1d", "pm10_rolling_7d")


def _long(spark, sf):
    """Targets of all horizons in long form; weather is not needed and so not joined."""
    base = series.add_targets(training.series_features(s.readings(spark, sf)))
    long = training.long_targets(base)
    return training.chrono_split(long, **s.SPLIT)


@query
def baseline_metrics(spark, sf):
    pairs = F.array(*[F.struct(F.lit(b).alias("baseline"), F.col(b).alias("predicted")) for b in BASES])
    test = _long(spark, sf).filter("split = 'test'").select("city", "horizon", "target", F.inline(pairs))
    return metrics.regression_metrics(test, ["baseline", "horizon"], actual="target")


@query
def stack_blend_fit(spark, sf):
    meta = _long(spark, sf).filter("split = 'meta'")
    return metrics.fit_blend(meta, ["city", "horizon"], *BASES, "target")


@query
def stack_blend_score(spark, sf):
    long = _long(spark, sf)
    keys = ["city", "horizon"]
    weights = metrics.fit_blend(long.filter("split = 'meta'"), keys, *BASES, "target")
    scored = metrics.apply_blend(long.filter("split = 'test'"), weights, keys, *BASES)
    return metrics.regression_metrics(scored, keys, actual="target")


@query
def seasonal_means(spark, sf):
    train = training.chrono_split(s.readings(spark, sf), **s.SPLIT).filter("split = 'train'")
    parts = F.array(
        F.struct(F.lit("weekday").alias("kind"), F.weekday("date").alias("part")),
        F.struct(F.lit("month").alias("kind"), F.month("date").alias("part")),
    )
    return (
        train.select("city", "pm10", F.inline(parts))
        .groupBy("city", "kind", "part")
        .agg(F.avg("pm10").alias("mean"), F.count("pm10").alias("n"))
    )


TRIAL_ROWS = [3, 5, 7, 14]


def _trials(spark, sf, split):
    """Error of trailing means of several lengths on one split, per (city, horizon, trial)."""
    cleaned = series.clean_series(s.readings(spark, sf).select("city", "date", "pm10"))
    means = {f"mean_{n}": series.full_rolling_mean("pm10", n) for n in TRIAL_ROWS}
    long = training.long_targets(series.add_targets(cleaned.withColumns(means)))
    pairs = F.array(
        *[F.struct(F.lit(n).alias("trial"), F.col(f"mean_{n}").alias("predicted")) for n in TRIAL_ROWS]
    )
    rows = training.chrono_split(long, **s.SPLIT).filter(F.col("split") == split)
    rows = rows.select("city", "horizon", "target", F.inline(pairs))
    return metrics.regression_metrics(rows, ["city", "horizon", "trial"], actual="target")


@query
def trial_select(spark, sf):
    best = metrics.best_by_error(_trials(spark, sf, "validation"), ["city", "horizon"], "trial")
    return best.select("city", "horizon", "trial", "rmse")


@query
def champion_select(spark, sf):
    runs = _trials(spark, sf, "test").withColumn("model", model_name(F.col("city"), F.col("horizon")))
    return metrics.best_by_error(runs, ["model"], "trial").select("model", "trial", "rmse", "mae", "r2")


# Fitted models: no SQL form. Small parameter ranges keep the fits short; the rows are all used.

SMALL_RANGES = {
    "trees": (3, 6),
    "learning_rate": (0.05, 0.3),
    "depth": (2, 4),
    "row_sample": (0.6, 1.0),
    "column_sample": (0.6, 1.0),
}


@query
def seasonal_equations(spark, sf):
    """The fit from sums that were added up in two parts solves the normal equations: what the terms give with the
    values, and what they give with the fitted values, each per row of the city."""
    cleaned = series.clean_series(s.readings(spark, sf).select("city", "date", "pm10"))
    train = training.chrono_split(cleaned, **s.SPLIT).filter("split = 'train'")
    halves = [seasonal.seasonal_sums(train.filter(f"year(date) % 2 = {k}")) for k in (0, 1)]
    sums = workspace.materialize(seasonal.add_sums(*halves), "seasonal-sums")
    return seasonal.equations(sums, seasonal.solve_sums(sums))


@query
def seasonal_fit(spark, sf):
    cleaned = series.clean_series(s.readings(spark, sf).select("city", "date", "pm10"))
    split = training.chrono_split(cleaned, **s.SPLIT)
    coefficients = seasonal.fit_seasonal(split.filter("split = 'train'"))
    scored = seasonal.predict_seasonal(split.filter("split <> 'train'"), coefficients)
    return metrics.regression_metrics(scored, ["city", "split"], actual="pm10", predicted="seasonal")


@query
def tree_trials(spark, sf):
    frame = workspace.materialize(_frame(spark, sf), "frame")
    levels = trees.city_levels(frame.filter("split = 'train'"))
    levelled = trees.with_levels(frame, levels)
    vectors = trees.fit_inputs(levelled.filter("split = 'train'")).transform(levelled)
    return trees.run_trials(vectors, [1, 7], trees.draw_trials(spark, 2, ranges=SMALL_RANGES))


@query
def stacked_forecast(spark, sf):
    """Fit, evaluate, log the runs, choose champions, and forecast from the newest features."""
    readings = workspace.materialize(s.readings(spark, sf), "readings")
    weather = workspace.materialize(s.weather(spark, sf), "weather")
    frame = training.chrono_split(training.training_frame(readings, weather), **s.SPLIT)
    frame = workspace.materialize(frame, "frame")
    params = {h: trees.TreeParams(trees=4, depth=3) for h in (1, 2, 3, 4, 5, 6, 7)}
    forecaster = stacked.fit_stacked(frame, params)
    path = workspace.new_path(spark, "forecaster")
    forecaster.save(path)
    log = workspace.new_path(spark, "runs")
    sinks.append(stacked.run_rows(stacked.evaluate(forecaster, frame), params, 1, path), log)
    champions = stacked.champions(spark.read.parquet(log))
    latest = training.latest_features(readings, weather)
    return forecast.forecast(spark, latest, champions, FORECAST_DAY)


def _fitted_twice(spark, sf):
    """Forecasts of the test split by two forecasters of the default size, fitted on the same frame."""
    frame = workspace.materialize(_frame(spark, sf), "frame")
    params = {h: trees.TreeParams() for h in HORIZONS}
    test = frame.filter("split = 'test'")
    first, second = (
        workspace.materialize(stacked.fit_stacked(frame, params, parallelism=len(HORIZONS)).predict(test), "fit") for _ in range(2)
    )
    again = second.select("city", "horizon", "date", F.col("predicted").alias("again"))
    return first.join(again, ["city", "horizon", "date"]).join(test.select("city", "date", "pm10", "pm10_lag_1d"), ["city", "date"])


@query
def full_fit_checks(spark, sf):
    """By city and horizon: the test rows, the error of persistence as `baseline_metrics` has it (the newest value among the
    model's inputs, pm10_lag_1d), and whether all forecasts are finite, equal in both fits (to 1e-6 of their size), and
    better than persistence."""
    both, keys = _fitted_twice(spark, sf), ["city", "horizon"]
    finite = F.col("predicted").isNotNull() & ~F.isnan("predicted") & (F.abs("predicted") < float("inf"))
    equal = F.abs(F.col("predicted") - F.col("again")) <= 1e-6 * F.abs("predicted")
    flags = both.groupBy(*keys).agg(F.every(finite).alias("finite"), F.every(F.coalesce(equal, F.lit(False))).alias("repeatable"))
    naive = metrics.regression_metrics(both, keys, "target", "pm10_lag_1d").select(*keys, "n", F.col("rmse").alias("persistence"))
    errors = metrics.regression_metrics(both, keys, "target").select(*keys, F.col("rmse").alias("error"))
    rows = flags.join(naive, keys).join(errors, keys)
    return rows.select(*keys, "n", "persistence", "finite", "repeatable", (F.col("error") < F.col("persistence")).alias("better"))
