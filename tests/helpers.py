"""Small frames and plan inspection."""

from datetime import date, timedelta

from pyspark.sql import DataFrame

START = date(2024, 1, 1)


def daily(spark, values, city="A", start=START, column="pm10") -> DataFrame:
    """One row per value, on consecutive days."""
    rows = [(city, start + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"city string, date date, {column} double")


def values(df: DataFrame, column: str, order="date"):
    return [r[column] for r in df.orderBy(order).select(column).collect()]


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count_in_plan(df: DataFrame, word: str) -> int:
    return plan(df).count(word)
