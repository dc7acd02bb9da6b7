"""Daily multi-series sensor data and forecasts, written for Spark.

Every operator takes DataFrames and returns a DataFrame without running a job;
only sinks, fits and streams act.
"""
