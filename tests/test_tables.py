from datetime import date

import pytest

from daymill import schemas, workspace
from daymill.operators import aggregate, incremental, tables, topn
from daymill.sources import sinks
from tests.helpers import daily, plan

LOG = "city string, forecast_date date, target_date date, horizon int, predicted double, actual double"


def forecasts(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


D = lambda n: date(2024, 1, n)


def test_replace_by_key(spark):
    base = daily(spark, [1.0, 2.0, 3.0])
    new = daily(spark, [20.0, 30.0, 40.0], start=D(2))
    once = tables.replace_by_key(base, new)
    assert sorted(r.pm10 for r in once.collect()) == [1.0, 20.0, 30.0, 40.0]
    twice = tables.replace_by_key(once, new)
    assert sorted(twice.collect()) == sorted(once.collect())


def test_replace_series(spark):
    base = daily(spark, [1.0, 2.0], "A").unionByName(daily(spark, [3.0, 4.0], "B"))
    got = tables.replace_series(base, daily(spark, [9.0], "A", start=date(2025, 1, 1)))
    assert sorted((r.city, r.pm10) for r in got.collect()) == [("A", 9.0), ("B", 3.0), ("B", 4.0)]


def test_upsert_keeps_actual_and_is_idempotent(spark):
    log = forecasts(spark, ("A", D(1), D(2), 1, 10.0, 7.0), ("A", D(1), D(3), 2, 11.0, None))
    new = forecasts(spark, ("A", D(1), D(9), 1, 99.0, None), ("B", D(1), D(2), 1, 5.0, None))
    once = tables.upsert_forecasts(log, new)
    rows = {(r.city, r.horizon): r for r in once.collect()}
    assert rows["A", 1].predicted == 99.0 and rows["A", 1].actual == 7.0
    assert rows["A", 1].target_date == D(2)
    assert rows["A", 2].predicted == 11.0 and rows["B", 1].predicted == 5.0
    assert sorted(tables.upsert_forecasts(once, new).collect()) == sorted(once.collect())


def test_fill_actuals(spark):
    log = forecasts(
        spark,
        ("A", D(1), D(2), 1, 1.0, 5.0),
        ("A", D(1), D(3), 2, 1.0, None),
        ("A", D(1), D(4), 3, 1.0, None),
        ("A", D(1), D(5), 4, 1.0, None),
    )
    readings = daily(spark, [50.0, 60.0, None], start=D(2))
    filled = {r.horizon: r.actual for r in tables.fill_actuals(log, readings).collect()}
    assert filled == {1: 5.0, 2: 60.0, 3: None, 4: None}
    one_day = {r.horizon: r.actual for r in tables.fill_actuals(log, readings, D(2)).collect()}
    assert one_day == {1: 5.0, 2: None, 3: None, 4: None}


def test_audit_lists_breaches(spark):
    df = spark.createDataFrame([("A", D(1), None), ("A", D(1), 1.0), (None, D(2), 2.0)], "city string, date date, v double")
    got = {(r.rule, r.column): r.breaches for r in tables.audit_contract(df, ["city", "v"], ["city", "date"]).collect()}
    assert got == {("not null", "city"): 1, ("not null", "v"): 1, ("unique", "city,date"): 1}


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], LOG)
    got = tables.audit_contract(empty, ["city"], ["city", "horizon"]).collect()
    assert [r.breaches for r in got] == [0, 0]


def test_duplicates_keep_the_last_by_order(spark):
    df = spark.createDataFrame(
        [("A", D(1), 1.0), ("A", D(1), 3.0), ("A", D(1), 2.0), ("B", D(1), None)], "city string, date date, v double"
    )
    got = aggregate.last_per_key(df, ["city", "date"], [df.v]).collect()
    assert sorted((r.city, r.v) for r in got) == [("A", 3.0), ("B", None)]


def test_backfill_dates(spark):
    marks = spark.createDataFrame([("A", D(1)), ("B", D(3)), ("C", D(9))], "city string, high_water_mark date")
    got = incremental.backfill_dates(marks, D(3)).collect()
    assert sorted(tuple(r) for r in got) == [("A", "2024-01-02"), ("A", "2024-01-03")]


def test_high_water_marks(spark):
    df = daily(spark, [1.0, 2.0], "A").unionByName(daily(spark, [1.0], "B"))
    assert aggregate.high_water_mark(df).first()[0] == D(2)
    assert aggregate.high_water_mark(df.filter("false")).first()[0] == date(2026, 1, 1)
    series = spark.createDataFrame([("A",), ("B",), ("C",)], "city string")
    marks = {r.city: r.high_water_mark for r in aggregate.high_water_mark_by(df, series).collect()}
    assert marks == {"A": D(2), "B": D(1), "C": date(2026, 1, 1)}


def stored(spark, path):
    return sinks.stored_by_month(spark, path, daily(spark, []).schema).drop("year", "month")


def test_merge_rewrites_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_by_month(daily(spark, [float(i) for i in range(60)]), path)
    untouched = sorted((tmp_path / "table" / "year=2024" / "month=2").glob("*.parquet"))
    written = sinks.merge_by_month(spark, path, daily(spark, [500.0], start=D(5)))
    assert written == 31
    assert sorted((tmp_path / "table" / "year=2024" / "month=2").glob("*.parquet")) == untouched
    rows = {r.date: r.pm10 for r in stored(spark, path).collect()}
    assert len(rows) == 60 and rows[D(5)] == 500.0 and rows[D(6)] == 5.0


def test_dynamic_overwrite_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_by_month(daily(spark, [1.0] * 60), path)
    assert sinks.write_by_month(daily(spark, [2.0] * 3), path) == 3
    assert stored(spark, path).count() == 3 + 29


def test_rows_without_a_date_are_not_lost(spark, tmp_path):
    path = str(tmp_path / "table")
    undated = daily(spark, [7.0]).selectExpr("city", "cast(null as date) date", "pm10")
    sinks.write_by_month(daily(spark, [1.0]).unionByName(undated), path)
    sinks.merge_by_month(spark, path, daily(spark, [2.0]))
    for _ in range(3):  # null keys are equal to each other: merging the same rows again changes nothing
        sinks.merge_by_month(spark, path, undated)
        assert sorted(r.pm10 for r in stored(spark, path).collect()) == [2.0, 7.0]


def test_a_merge_that_is_cut_off_is_ended_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    sinks.write_by_month(daily(spark, [1.0, 2.0]), path)
    with monkeypatch.context() as cut:
        cut.setattr(sinks, "write_partitioned", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.merge_by_month(spark, path, daily(spark, [5.0]))
    assert sorted(r.pm10 for r in stored(spark, path).collect()) == [1.0, 2.0]
    sinks.merge_by_month(spark, path, daily(spark, [9.0], start=date(2024, 6, 1)))
    assert sorted(r.pm10 for r in stored(spark, path).collect()) == [2.0, 5.0, 9.0]


def test_repeated_forecasts_count_once(spark):
    schema = "city string, forecast_date date, target_date date, horizon int, predicted double, actual double"
    day, next_day = date(2024, 1, 1), date(2024, 1, 2)
    log = spark.createDataFrame([("A", day, next_day, 1, 1.0, 9.0)], schema)
    new = spark.createDataFrame([("A", day, next_day, 1, p, None) for p in (2.0, 3.0)], schema)
    assert [(r.predicted, r.actual) for r in tables.upsert_forecasts(log, new).collect()] == [(3.0, 9.0)]


def test_rewrite_series_drops_its_old_months(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    sinks.write_by_month(daily(spark, [1.0], "A").unionByName(daily(spark, [2.0], "B", date(2024, 3, 1))), old)
    assert sinks.rewrite_series(spark, old, daily(spark, [3.0, 4.0], "B", date(2024, 5, 1)), new) == 3
    assert sorted((r.city, r.pm10) for r in stored(spark, new).collect()) == [("A", 1.0), ("B", 3.0), ("B", 4.0)]


def test_layers_as_tables(spark, tmp_path):
    from daymill.constants import WEATHER_VARIABLES
    from daymill.plans import views
    from pyspark.sql import functions as F

    readings = daily(spark, [float(i) for i in range(40)])
    for p in ("pm25", "o3", "no2", "co"):
        readings = readings.withColumn(p, F.col("pm10") + 1)
    weather = readings.select("city", "date", *[F.lit(1.0).alias(v) for v in WEATHER_VARIABLES])
    mart = views.save_layers(readings, weather, "layers_", str(tmp_path))
    assert sorted(mart.collect()) == sorted(views.ml_features(readings, weather).select(*mart.columns).collect())
    assert spark.table("layers_stg_weather").count() == 40


def test_merge_of_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_by_month(daily(spark, [1.0]), path)
    assert sinks.merge_by_month(spark, path, daily(spark, [1.0]).filter("false")) == 0
    assert sinks.write_by_month(daily(spark, [1.0]).filter("false"), path) == 0
    assert sinks.append(daily(spark, []), str(tmp_path / "other")) == 0
    assert stored(spark, path).count() == 1


def test_merge_opens_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_by_month(daily(spark, [1.0] * 60), path)
    months = sinks.touched_folders(sinks.with_folders(daily(spark, [1.0])))
    text = plan(sinks.stored_by_month(spark, path, daily(spark, []).schema, months))
    assert "PartitionFilters: []" not in text and "PartitionFilters: [" in text


def test_ensure_table_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = daily(spark, []).schema
    sinks.ensure_table(spark, path, schema)
    assert stored(spark, path).count() == 0
    sinks.merge_by_month(spark, path, daily(spark, [1.0]))
    sinks.ensure_table(spark, path, schema)
    assert stored(spark, path).count() == 1


def test_new_version_never_overwrites(spark, tmp_path):
    path = str(tmp_path / "v1")
    assert sinks.write_new(daily(spark, [1.0]), path) == 1
    with pytest.raises(Exception):
        sinks.write_new(daily(spark, [2.0]), path)


def test_latest_forecast_forms(spark):
    rows = [("Berlin", D(2), D(2 + h), h, 1.0, None) for h in range(1, 6)]
    rows += [("Berlin", D(1), D(1 + h), h, 2.0, None) for h in range(1, 8)]
    log = forecasts(spark, *rows)
    cities = schemas.cities(spark)
    plain = topn.latest_forecast(log, cities, "BERLIN").collect()
    assert [(r.forecast_date, r.horizon) for r in plain] == [(D(2), h) for h in range(1, 6)] + [(D(1), 1), (D(1), 2)]
    assert topn.latest_forecast(log, cities, "berlin", strict=True).count() == 5
    assert topn.latest_forecast(log, cities, "Atlantis").count() == 0


def test_unknown_city_is_not_served(spark):
    readings = daily(spark, [1.0], "Atlantis")
    assert topn.history(readings, schemas.cities(spark), "atlantis").count() == 0


def test_workspace_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Fake:
        class conf:
            get = staticmethod(lambda name, default: None)

        class sparkContext:
            master = "spark://head:7077"

    with pytest.raises(ValueError):
        workspace.root(Fake)


def test_stream_feeds_the_table_and_its_followers(spark, tmp_path):
    from datetime import datetime

    from daymill.streaming import daily as stream

    folder, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    hour = "city string, timestamp timestamp, temperature_2m double"
    schema = spark.createDataFrame([], hour).schema
    batches = []

    def run():
        means = stream.stream_daily_mean(stream.hour_stream(spark, folder, schema), ["temperature_2m"])
        stream.run_available(means, table, state, after=lambda rows: batches.append(rows.count()))

    def land(*rows):
        spark.createDataFrame(list(rows), hour).coalesce(1).write.mode("append").parquet(folder)

    land(("A", datetime(2024, 1, 1, 5), 1.0), ("A", datetime(2024, 1, 1, 6), 3.0), ("B", datetime(2024, 1, 1, 6), 9.0))
    run()
    land(("A", datetime(2024, 1, 1, 6), 50.0), ("A", datetime(2024, 1, 1, 7), 5.0), ("A", datetime(2024, 1, 2, 7), 7.0))
    run()
    got = sorted((r.city, r.date, r.temperature_2m) for r in spark.read.parquet(table).collect())
    assert got == [("A", D(1), 3.0), ("A", D(2), 7.0), ("B", D(1), 9.0)]
    assert batches == [2, 2]


def test_hours_correct_themselves_and_late_ones_count(spark, tmp_path):
    from datetime import datetime

    from daymill.streaming import daily as stream

    folder, hourly, table, state = (str(tmp_path / n) for n in ("in", "hourly", "out", "state"))
    schema = spark.createDataFrame([], "city string, timestamp timestamp, landed int, temperature_2m double").schema
    touched = []

    def run():
        stream.run_hours(
            stream.hour_stream(spark, folder, schema), ["temperature_2m"], hourly, table, state,
            latest="landed", after=lambda rows: touched.append(rows.count()),
        )

    def land(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folder)

    land(("A", datetime(2024, 3, 1, 5), 1, 1.0), ("A", datetime(2024, 3, 1, 6), 1, 3.0), ("B", datetime(2024, 3, 1, 6), 1, 9.0))
    run()
    land(("A", datetime(2024, 3, 1, 6), 2, 5.0), ("A", datetime(2024, 3, 1, 6), 1, 4.0), ("A", datetime(2024, 1, 1, 7), 2, 7.0))
    run()
    got = sorted((r.city, r.date, r.temperature_2m) for r in spark.read.parquet(table).collect())
    assert got == [("A", D(1), 7.0), ("A", date(2024, 3, 1), 3.0), ("B", date(2024, 3, 1), 9.0)]
    assert touched == [2, 2]
