"""Flight records from landed to cleaned form."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.functions.calendar import epoch_to_timestamp
from daymill.operators.aggregate import first_per_key

# Fields a flight must have, and its identity.
REQUIRED = ["icao24", "firstSeen", "lastSeen", "estDepartureAirport"]
IDENTITY = ["icao24", "firstSeen"]


def clean_flights(raw: DataFrame, identity=IDENTITY, order=None) -> DataFrame:
    """Required fields present, one row per identity, epochs as timestamps, duration in minutes,
    and storage columns from the departure day."""
    order = order or [F.col(c) for c in raw.columns if c not in identity]
    flights = first_per_key(raw.dropna(subset=REQUIRED), identity, order)
    first_seen = epoch_to_timestamp("firstSeen")
    return flights.withColumns(
        {
            "firstSeen_ts": first_seen,
            "lastSeen_ts": epoch_to_timestamp("lastSeen"),
            "duration_minutes": (F.col("lastSeen") - F.col("firstSeen")) / F.lit(60),
            "year": F.year(first_seen),
            "month": F.month(first_seen),
        }
    )
