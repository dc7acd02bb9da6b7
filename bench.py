"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Each query runs once to warm up,
then BENCH_RUNS times; the median counts. Results go to a sink that keeps nothing.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks import standins  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from daymill import workspace  # noqa: E402
from daymill.session import configure  # noqa: E402
from daymill.plans import training, views  # noqa: E402

HEADLINE = [
    "aq_weather_features",
    "training_frame",
    "gap_drop",
    "daily_mean",
    "hourly_unnest",
    "json_doc_scan",
    "flights_silver",
    "dedup_latest",
    "replace_by_key",
    "merge_by_month",
    "upsert_predictions",
    "update_actuals",
    "missing_days",
    "topn_per_city",
    "metrics_by_city_horizon",
    "stack_blend_score",
    "champion_select",
    "seasonal_fit",
    "stream_daily_mean",
]


def many_series_features(spark, sf_dir):
    """The mart's windows over 125 series instead of 5."""
    return views.stg_air_quality(standins.many_series(spark, sf_dir)).transform(training.series_features)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"), int(cpus))
        .appName("daymill-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    workspace.use_own_root(spark)
    jobs = {name: QUERIES[name] for name in HEADLINE} | {"many_series_features": many_series_features}
    seconds = {}
    for name, job in jobs.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            job(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
