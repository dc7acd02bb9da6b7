"""Readings, weather, hours, documents, flights and forecasts derived from the test tables.

Prices and quantities are scaled by UNIT factors to sensor-like sizes; the factors also keep
means off exact decimal ties, where two engines may round differently.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, IntegerType, TimestampType

from daymill.operators.incremental import densify
from daymill.operators.joins import per_horizon
from daymill.operators.series import series_window
from daymill.schemas import CITY, small_table

PRICE_UNIT = 0.000314159265
UNIT = 0.7182818
USER_UNIT = 0.0577215
CHUNK = 256  # rows per document: event_id is unique, so no document can grow with the data

TRAIN_END = date(1998, 12, 31)
VALIDATION_END = date(1999, 12, 31)
META_END = date(2000, 12, 31)
SPLIT = {"train_end": TRAIN_END, "validation_end": VALIDATION_END, "meta_end": META_END}

HOUR_VARIABLES = ["temperature_2m", "relative_humidity_2m"]

CITY_ROWS = [
    ("1-URGENT", 52.52, 13.40, 6132),
    ("2-HIGH", 51.51, -0.13, 5724),
    ("3-MEDIUM", 48.86, 2.35, 5722),
    ("5-LOW", 52.37, 4.90, 5771),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shown(df: DataFrame) -> DataFrame:
    """Comparable output: doubles to 4 places, whole numbers as bigint, dates as text."""
    def column(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            c = F.round(c, 4)
        elif isinstance(field.dataType, IntegerType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def cities(spark: SparkSession) -> DataFrame:
    return small_table(spark, CITY_ROWS, CITY)


def raw_readings(spark, sf_dir) -> DataFrame:
    """One reading per order: many per (city, date)."""
    price = F.col("o_totalprice")
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("city"),
        F.col("o_orderdate").cast("date").alias("date"),
        price.alias("pm10"),
        F.when(status == "F", price).alias("pm25"),
        F.when(status == "O", price).alias("o3"),
        F.when(status == "P", price).alias("no2"),
        F.col("o_orderkey"),
        F.col("o_custkey"),
    )


def _daily(raw: DataFrame) -> DataFrame:
    means = [(F.avg(c) * PRICE_UNIT).alias(c) for c in ("pm10", "pm25", "o3", "no2")]
    return raw.groupBy("city", "date").agg(*means, (F.max("pm10") * PRICE_UNIT).alias("co"))


def sparse_readings(spark, sf_dir) -> DataFrame:
    return _daily(raw_readings(spark, sf_dir))


def _with_gaps(df: DataFrame) -> DataFrame:
    """Dense daily grid, with injected short gaps and one of 15 days a year, at every scale."""
    day = F.dayofyear("date")
    gap = (day % 11 < 3) | day.between(100, 114)
    return densify(df).withColumn("pm10", F.when(~gap, F.col("pm10")))


def readings(spark, sf_dir) -> DataFrame:
    return _with_gaps(sparse_readings(spark, sf_dir))


def many_series(spark, sf_dir) -> DataFrame:
    """Readings of 125 series: priority x nation of the customer."""
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    raw = raw_readings(spark, sf_dir).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return _with_gaps(_daily(raw.withColumn("city", F.concat_ws("/", "city", "n_name"))))


def weather(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    measures = {
        "temperature_2m": F.avg(q),
        "relative_humidity_2m": F.avg(d * 100),
        "wind_speed_10m": F.avg(t * 100),
        "wind_gusts_10m": F.max(t * 100),
        "wind_direction_10m": F.avg(q * 7),
        "precipitation": F.avg(F.col("l_extendedprice") / 10000),
        "snowfall": F.min(d),
        "snow_depth": F.avg(t),
        "cloud_cover": F.avg(d * 1000),
        "surface_pressure": F.avg(1000 + q),
    }
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_orderpriority").alias("city"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            *[(c * UNIT).alias(name) for name, c in measures.items()],
            F.max("l_linenumber").cast("double").alias("weather_code"),
        )
    )


def hours(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("city"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("value") * UNIT).alias("temperature_2m"),
        (F.col("user_id") * USER_UNIT).alias("relative_humidity_2m"),
    )


def documents(spark, sf_dir, ragged: bool = False) -> DataFrame:
    """Hourly documents by (city, date, part), at most CHUNK times each, ordered by event_id.

    The ragged form cuts the last `part % 3` entries off the second variable, leaves it out where
    `part % 5 = 1`, and spoils the first time where `part % 7 = 3`.
    """
    hour = F.struct(
        "event_id",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
        *HOUR_VARIABLES,
    )
    grouped = (
        hours(spark, sf_dir)
        .groupBy(
            "city",
            F.to_date("timestamp").alias("date"),
            F.expr(f"event_id div {CHUNK}").alias("part"),
        )
        .agg(F.sort_array(F.collect_list(hour)).alias("h"))
    )
    humidity, time = F.col("h.relative_humidity_2m"), F.col("h.time")
    if ragged:
        spoiled = F.concat(F.array(F.lit("not a time")), F.slice(time, F.lit(2), F.greatest(F.size(time) - 1, F.lit(0))))
        time = F.when(F.col("part") % 7 == 3, spoiled).otherwise(time)
        kept = F.greatest(F.size("h") - (F.col("part") % 3).cast("int"), F.lit(0))
        humidity = F.when(F.col("part") % 5 != 1, F.slice(humidity, F.lit(1), kept))
    return grouped.select(
        "city",
        "date",
        "part",
        F.struct(
            time.alias("time"),
            F.col("h.temperature_2m").alias("temperature_2m"),
            humidity.alias("relative_humidity_2m"),
        ).alias("hourly"),
    )


def responses(spark, sf_dir, repeated: bool = False) -> DataFrame:
    """Reading responses as JSON text: absent pollutants missing, an error on every 13th of a
    month and no time on every 29th. Repeated: each day a second time, earlier and with larger values."""
    daily = sparse_readings(spark, sf_dir).withColumn("hour", F.lit(" 12:00:00"))
    if repeated:
        larger = {p: F.col(p) * 3 for p in ("pm25", "pm10", "o3", "no2", "co")}
        daily = daily.unionByName(daily.withColumns({**larger, "hour": F.lit(" 06:00:00")}))
    day = F.dayofmonth("date")
    pollutants = F.struct(
        *[
            F.when(F.col(p).isNotNull(), F.struct(F.col(p).alias("v"))).alias(p)
            for p in ("pm25", "pm10", "o3", "no2", "co")
        ]
    )
    stamp = F.when(day != 29, F.concat(F.col("date").cast("string"), "hour"))
    body = F.struct(
        F.when(day == 13, "error").otherwise("ok").alias("status"),
        F.struct(pollutants.alias("iaqi"), F.struct(stamp.alias("s")).alias("time")).alias("data"),
    )
    return daily.select("city", F.to_json(body).alias("body"))


def flights(spark, sf_dir) -> DataFrame:
    first_seen = F.unix_seconds(F.col("ts").cast("timestamp"))
    null_long = F.lit(None).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("icao24"),
        first_seen.alias("firstSeen"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("estDepartureAirport"),
        (first_seen + F.floor(F.col("value") * 60)).alias("lastSeen"),
        F.lit(None).cast("string").alias("estArrivalAirport"),
        F.concat(F.lit("F"), F.col("event_id").cast("string")).alias("callsign"),
        *[
            null_long.alias(c)
            for c in (
                "estDepartureAirportHorizDistance",
                "estDepartureAirportVertDistance",
                "estArrivalAirportHorizDistance",
                "estArrivalAirportVertDistance",
                "departureAirportCandidatesCount",
                "arrivalAirportCandidatesCount",
            )
        ],
        F.col("event_id"),
    )


def forecast_log(spark, sf_dir) -> DataFrame:
    """Each day with a mean of the 7 rows before it, as forecast for 7 horizons; no actuals yet."""
    before = series_window().rowsBetween(-7, -1)
    predicted = readings(spark, sf_dir).select(
        "city", F.col("date").alias("forecast_date"), F.avg("pm10").over(before).alias("predicted")
    ).filter(F.col("predicted").isNotNull())
    return per_horizon(predicted).select(
        "city",
        "forecast_date",
        F.date_add("forecast_date", F.col("horizon")).alias("target_date"),
        "horizon",
        "predicted",
        F.lit(None).cast("double").alias("actual"),
    )
