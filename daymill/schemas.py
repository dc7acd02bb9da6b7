"""Explicit schemas: no file is ever read with an inferred type."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from daymill.constants import CITIES, POLLUTANTS, WEATHER_VARIABLES


def _doubles(names) -> list[StructField]:
    return [StructField(name, DoubleType()) for name in names]


READING = StructType(
    [StructField("date", DateType()), StructField("city", StringType()), *_doubles(POLLUTANTS)]
)

WEATHER_DAY = StructType(
    [StructField("date", DateType()), StructField("city", StringType()), *_doubles(WEATHER_VARIABLES)]
)

WEATHER_HOUR = StructType(
    [
        StructField("city", StringType()),
        StructField("timestamp", TimestampType()),
        *_doubles(WEATHER_VARIABLES),
    ]
)

# Field names of the flight record.
FLIGHT = StructType(
    [
        StructField("icao24", StringType()),
        StructField("firstSeen", LongType()),
        StructField("estDepartureAirport", StringType()),
        StructField("lastSeen", LongType()),
        StructField("estArrivalAirport", StringType()),
        StructField("callsign", StringType()),
        StructField("estDepartureAirportHorizDistance", LongType()),
        StructField("estDepartureAirportVertDistance", LongType()),
        StructField("estArrivalAirportHorizDistance", LongType()),
        StructField("estArrivalAirportVertDistance", LongType()),
        StructField("departureAirportCandidatesCount", LongType()),
        StructField("arrivalAirportCandidatesCount", LongType()),
    ]
)

# Doubles inside the response are read as text, then cast with try_cast: a station that
# reports "-" for one pollutant must not lose the others.
READING_RESPONSE = StructType(
    [
        StructField("status", StringType()),
        StructField(
            "data",
            StructType(
                [
                    StructField(
                        "iaqi",
                        StructType(
                            [
                                StructField(p, StructType([StructField("v", StringType())]))
                                for p in POLLUTANTS
                            ]
                        ),
                    ),
                    StructField("time", StructType([StructField("s", StringType())])),
                ]
            ),
        ),
    ]
)

FORECAST = StructType(
    [
        StructField("city", StringType(), False),
        StructField("forecast_date", DateType(), False),
        StructField("target_date", DateType(), False),
        StructField("horizon", IntegerType(), False),
        StructField("predicted", DoubleType(), False),
        StructField("actual", DoubleType()),
    ]
)

# A run is one fitted model version with its parameters and its error on the test split.
MODEL_RUN = StructType(
    [
        StructField("model", StringType(), False),
        StructField("run_order", LongType(), False),
        StructField("city", StringType(), False),
        StructField("horizon", IntegerType(), False),
        StructField("trees", IntegerType()),
        StructField("learning_rate", DoubleType()),
        StructField("depth", IntegerType()),
        StructField("row_sample", DoubleType()),
        StructField("column_sample", DoubleType()),
        StructField("rmse", DoubleType()),
        StructField("mae", DoubleType()),
        StructField("r2", DoubleType()),
        StructField("path", StringType()),
    ]
)

CITY = StructType(
    [
        StructField("city", StringType(), False),
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
        StructField("station_id", IntegerType()),
    ]
)


def hourly_response(variables=WEATHER_VARIABLES) -> StructType:
    """Weather response: one struct of parallel arrays. Variables left out are not parsed."""
    arrays = [StructField(v, ArrayType(DoubleType())) for v in variables]
    hourly = StructType([StructField("time", ArrayType(StringType())), *arrays])
    return StructType([StructField("hourly", hourly)])


def small_table(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """A few rows as literals in the plan, so the planner knows how small they are."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def cities(spark: SparkSession) -> DataFrame:
    """The city dimension."""
    return small_table(spark, CITIES, CITY)
