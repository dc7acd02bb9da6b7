from pyspark.sql import functions as F

from checks import standins as s
from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES
from daymill.operators import incremental, series, topn
from daymill.plans import training, views
from daymill.sources import landing, sinks
from tests.helpers import count_in_plan, daily, plan


def test_feature_windows_share_one_exchange(spark):
    frame = training.series_features(daily(spark, [1.0] * 20))
    assert count_in_plan(series.add_targets(frame), "Exchange hashpartitioning") == 1
    assert count_in_plan(series.add_targets(frame), "+- Sort [city") == 1


def test_mart_windows_share_one_window(spark, sf_dir):
    readings = views.stg_air_quality(s.sparse_readings(spark, sf_dir))
    featured = readings.withColumns(
        {**series.lag_columns(["pm10", "co"], (1, 7)), **series.rolling_mean_columns(["pm10", "co"])}
    )
    assert count_in_plan(featured, "+- Window") == 1


def test_densify_keeps_the_partitioning(spark):
    dense = incremental.densify(daily(spark, [1.0, 2.0]))
    assert count_in_plan(series.add_lags(dense, ["pm10"]), "Exchange hashpartitioning") == 1


def test_scans_read_only_needed_columns(spark, sf_dir):
    text = plan(s.sparse_readings(spark, sf_dir).select("city", "date", "pm10"))
    assert "o_orderkey" not in text and "o_custkey" not in text


def test_city_filter_passes_below_the_windows(spark, tmp_path):
    path = str(tmp_path / "t")
    daily(spark, [1.0] * 30).write.parquet(path)
    lagged = series.add_lags(spark.read.parquet(path), ["pm10"]).filter("city = 'A'")
    assert "EqualTo(city,A)" in plan(lagged)


def test_month_pruning(spark, tmp_path):
    from datetime import date

    path = str(tmp_path / "t")
    sinks.write_by_month(daily(spark, [1.0] * 90), path)
    pruned = landing.read_partitioned(spark, path, date(2024, 2, 5), date(2024, 2, 10))
    assert pruned.count() == 6
    assert "PartitionFilters: []" not in plan(pruned)


def test_top_n_limits_before_the_shuffle(spark):
    df = topn.history_all(daily(spark, [1.0] * 50), 3)
    assert count_in_plan(df, "WindowGroupLimit") == 2


def test_no_python_in_expressible_operators(spark, sf_dir):
    from checks.queries import QUERIES

    for name in ("training_frame", "aq_weather_features", "stack_blend_fit", "update_actuals", "hourly_unnest"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    from daymill.operators import aggregate, metrics

    df = daily(spark, [1.0, 2.0])
    for reduced in (
        aggregate.last_per_key(df, ["city"], [df.date]),
        metrics.regression_metrics(df, ["city"], "pm10", "pm10"),
        metrics.fit_blend(df, ["city"], "pm10", "pm10", "pm10"),
    ):
        text = plan(reduced)
        assert text.index("Exchange") < text.index("partial_")


def test_both_runs_reject_the_same_landed_text(spark, sf_dir, monkeypatch):
    """Responses that come out in other text each time they are derived, as means do in other orders of rows."""
    derived, made = s.responses, []

    def other_text(*args, **kwargs):
        made.append(1)
        return derived(*args, **kwargs).withColumn("body", F.concat("body", F.lit(" " * len(made))))

    monkeypatch.setattr(s, "responses", other_text)
    assert compare(spark, duck(sf_dir), QUERIES["daily_run_rejected"], ORACLE["daily_run_rejected"], sf_dir) == (10, [])
