"""Text expressions: cleaning cells, parsing days, object paths and model names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day formats seen in the historical files.
DAY_FORMATS = ["yyyy-M-d", "yyyy/M/d"]


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def number_or_null(column: Column) -> Column:
    return blank_to_null(column).try_cast("double")


def parse_day(column: Column, formats=DAY_FORMATS) -> Column:
    """First format that fits wins."""
    text = F.trim(column)
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def first_ten(column: Column) -> Column:
    return F.substring(column, 1, 10)


def object_key(dataset: str, city: Column, date: Column, suffix: str = "json") -> Column:
    """Key of one landed document: dataset/year=YYYY/month=MM/day=DD/city.suffix."""
    return F.format_string(
        f"{dataset}/year=%d/month=%02d/day=%02d/%s.{suffix}",
        F.year(date),
        F.month(date),
        F.dayofmonth(date),
        city,
    )


def key_day(key: Column) -> Column:
    """Day encoded in an object key or file path."""
    part = lambda name: F.regexp_extract(key, rf"{name}=(\d+)", 1).try_cast("int")
    year, month, day = part("year"), part("month"), part("day")
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.make_date(year, month, day))


def key_city(key: Column) -> Column:
    """City encoded in an object key: a city=... folder, else the file name without .json."""
    literal_plus = F.replace(key, F.lit("+"), F.lit("%2B"))
    decoded = F.coalesce(F.try_url_decode(literal_plus), key)
    folder = F.regexp_extract(decoded, r"city=([^/]+)/", 1)
    file_name = F.regexp_extract(decoded, r"([^/]+)\.json$", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), F.nullif(file_name, F.lit("")))


def model_name(city: Column, horizon: Column) -> Column:
    """Registry name of the model for one city and horizon."""
    return F.format_string("pm10_%s_%dd", F.lower(city), horizon)
