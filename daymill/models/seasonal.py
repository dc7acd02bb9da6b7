"""Additive seasonal model per city: linear trend, weekly and yearly Fourier terms (the
decomposition of Taylor & Letham, "Forecasting at Scale", 2018), fitted by least squares.

The fit needs the sums of the normal equations only. Tasks add them up per city with numpy, so a row per city and
task is shuffled, not the days; sums of further days are added to stored ones, and each city's small system is solved.
"""

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORIGIN = "2000-01-01"
YEAR_DAYS = 365.25
YEARLY_ORDER = 10
WEEKLY_ORDER = 3
TERMS = 2 + 2 * YEARLY_ORDER + 2 * WEEKLY_ORDER


def basis(date: Column) -> Column:
    """Array of the model's terms at a date."""
    days = F.datediff(date, F.lit(ORIGIN).cast("date")).cast("double")
    terms = [F.lit(1.0), days / YEAR_DAYS]
    for period, order in ((YEAR_DAYS, YEARLY_ORDER), (7.0, WEEKLY_ORDER)):
        for k in range(1, order + 1):
            angle = days * F.lit(2 * math.pi * k / period)
            terms += [F.sin(angle), F.cos(angle)]
    return F.array(*terms)


# A city's sums: number of rows, the products of all pairs of terms, row by row, and the products of terms and value.
SUMS = "city string, rows long, xx array<double>, xy array<double>"
HELD_CITIES = 2000  # cities whose sums a task holds before it hands them on


def _sums(day_origin: str):
    """Nested, so that it travels to the workers by value and needs no package there."""
    orders, terms, held_cities = ((YEAR_DAYS, YEARLY_ORDER), (7.0, WEEKLY_ORDER)), TERMS, HELD_CITIES

    def add_up(batches):
        held = {}

        def handed_on():
            return pd.DataFrame(
                [(c, n, xx.ravel().tolist(), xy.tolist()) for c, (n, xx, xy) in held.items()], columns=["city", "rows", "xx", "xy"]
            )

        for batch in batches:
            days = (pd.to_datetime(batch["date"]) - pd.Timestamp(day_origin)).dt.days.to_numpy(float)
            x = np.empty((len(days), terms))
            x[:, 0], x[:, 1] = 1.0, days / orders[0][0]
            at = 2
            for period, order in orders:
                for k in range(1, order + 1):
                    angle = days * (2 * math.pi * k / period)
                    x[:, at], x[:, at + 1] = np.sin(angle), np.cos(angle)
                    at += 2
            y = batch["value"].to_numpy(float)
            for city, rows in batch.groupby("city", sort=False).indices.items():
                n, xx, xy = held.get(city, (0, 0.0, 0.0))
                held[city] = (n + len(rows), xx + x[rows].T @ x[rows], xy + x[rows].T @ y[rows])
            if len(held) >= held_cities:
                yield handed_on()
                held.clear()
        yield handed_on()

    return add_up


def seasonal_sums(df: DataFrame, value: str = "pm10") -> DataFrame:
    """SUMS of the rows that have a value, one row per city."""
    rows = df.filter(F.col("city").isNotNull() & F.col("date").isNotNull() & F.col(value).isNotNull())
    rows = rows.select("city", "date", F.col(value).cast("double").alias("value"))
    return _together(rows.mapInPandas(_sums(ORIGIN), SUMS))


def add_sums(*parts: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Sums of all rows of the parts, less those of `removed`: days that are stored again with another value are
    removed as they were and added as they are."""
    whole = reduce(DataFrame.unionByName, parts)
    if removed is not None:
        minus = [F.transform(c, lambda v: -v).alias(c) for c in ("xx", "xy")]
        whole = whole.unionByName(removed.select("city", (-F.col("rows")).alias("rows"), *minus))
    return _together(whole)


def _together(sums: DataFrame) -> DataFrame:
    """One row per city. Each number is added up on its own, combined in the tasks before the shuffle."""
    numbers = F.posexplode(F.concat("xx", "xy", F.array(F.col("rows").cast("double")))).alias("at", "v")
    added = sums.select("city", numbers).groupBy("city", "at").agg(F.sum("v").alias("v"))
    lists = added.groupBy("city").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("all"))
    return lists.select(
        "city", F.col("all")[TERMS * TERMS + TERMS].cast("long").alias("rows"),
        F.slice("all", 1, TERMS * TERMS).alias("xx"), F.slice("all", TERMS * TERMS + 1, TERMS).alias("xy"),
    )


def _solver():
    terms = TERMS

    def solve(batches):
        for batch in batches:
            solved = [
                # Least squares of smallest norm, so a short history is no error.
                np.linalg.lstsq(np.array(xx).reshape(terms, terms), np.array(xy), rcond=1e-10)[0].tolist()
                for xx, xy in zip(batch["xx"], batch["xy"])
            ]
            yield pd.DataFrame({"city": batch["city"], "coefficients": solved})

    return solve


def solve_sums(sums: DataFrame) -> DataFrame:
    """(city, coefficients) from a city's sums; cities without rows are left out."""
    return sums.filter("rows > 0").mapInPandas(_solver(), "city string, coefficients array<double>")


def fit_seasonal(df: DataFrame, value: str = "pm10") -> DataFrame:
    """(city, coefficients) from the rows that have a value."""
    return solve_sums(seasonal_sums(df, value))


def equations(sums: DataFrame, coefficients: DataFrame) -> DataFrame:
    """(city, term, rows, with_values, with_fit): per row of the city, the products of a term with the values and with the
    fitted values. Coefficients solve the normal equations where the two are equal."""
    row = lambda i: F.slice("xx", i * TERMS + 1, F.lit(TERMS))
    fitted = F.transform(
        F.sequence(F.lit(0), F.lit(TERMS - 1)),
        lambda i: F.aggregate(F.zip_with(row(i), "coefficients", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v),
    )
    each = sums.join(coefficients, "city").select("city", "rows", F.posexplode(F.arrays_zip(F.col("xy"), fitted.alias("fit"))).alias("term", "s"))
    return each.select("city", "term", "rows", (F.col("s.xy") / F.col("rows")).alias("with_values"), (F.col("s.fit") / F.col("rows")).alias("with_fit"))


def seasonal_value(date: Column, coefficients: Column) -> Column:
    products = F.zip_with(coefficients, basis(date), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, v: total + v)


def predict_seasonal(df: DataFrame, coefficients: DataFrame, date: str = "date", name: str = "seasonal") -> DataFrame:
    """Adds the seasonal prediction at `date`; null for a city without a fit."""
    return (
        df.join(coefficients, "city", "left")
        .withColumn(name, seasonal_value(F.col(date), F.col("coefficients")))
        .drop("coefficients")
    )


def seasonal_input(df: DataFrame) -> DataFrame:
    """The series under the column names usual for seasonal models: ds and y."""
    return df.select("city", F.col("date").alias("ds"), F.col("pm10").alias("y")).dropna()
