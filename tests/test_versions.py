"""Month tables with committed versions, and what follows from their counts by city and month."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from daymill import schemas, workspace
from daymill.constants import POLLUTANTS, WEATHER_VARIABLES
from daymill.operators import topn
from daymill.plans import daily as plan
from daymill.plans import serving, views
from daymill.sources import sinks, versions
from tests.helpers import daily

SCHEMA = "city string, date date, pm10 double"


def values(spark, path):
    return sorted(r.pm10 for r in versions.read(spark, path, daily(spark, []).schema).collect())


def table(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    versions.create(spark, path)
    assert sinks.merge_by_month(spark, path, rows) == rows.count()
    return path


def opened(df):
    """Month folders of the table's files that a frame reads."""
    return {tuple(p.split("/")[-3:-1]) for p in df.inputFiles() if "/year=" in p}


@pytest.fixture
def no_markers(spark):
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    settings.set(name, "false")
    yield
    settings.unset(name)


def test_merges_without_marker_files(spark, tmp_path, no_markers):
    months = daily(spark, [1.0] * 40)
    path = table(spark, tmp_path, months)
    assert sinks.merge_by_month(spark, path, daily(spark, [5.0], start=date(2024, 2, 3))) == 9
    assert values(spark, path) == [1.0] * 39 + [5.0]
    plain = str(tmp_path / "plain")
    sinks.write_by_month(months, plain)
    assert sinks.merge_by_month(spark, plain, daily(spark, [5.0], start=date(2024, 2, 3))) == 9
    assert sorted(r.pm10 for r in spark.read.parquet(plain).collect()) == [1.0] * 39 + [5.0]


def test_a_merge_that_is_not_in_place_raises(spark, tmp_path, monkeypatch):
    plain = str(tmp_path / "plain")
    sinks.write_by_month(daily(spark, [1.0]), plain)
    monkeypatch.setattr(sinks, "finish_merge", lambda *_: 0)
    with pytest.raises(RuntimeError):
        sinks.merge_by_month(spark, plain, daily(spark, [5.0]))


def test_a_stop_after_each_step_leaves_the_state_before(spark, tmp_path, monkeypatch):
    path = table(spark, tmp_path, daily(spark, [1.0] * 40))
    before = versions.current(spark, path)
    real = versions._open
    opens = []

    def stop_before_counts(*args):
        opens.append(args)
        if len(opens) == 2:  # the first reads the touched months, the second what has been written
            raise ZeroDivisionError
        return real(*args)

    for name, stop in (("_open", stop_before_counts), ("publish", lambda *_: 1 / 0)):
        with monkeypatch.context() as cut:
            cut.setattr(versions, name, stop)
            with pytest.raises(ZeroDivisionError):
                sinks.merge_by_month(spark, path, daily(spark, [9.0]))
        assert versions.current(spark, path) == before and values(spark, path) == [1.0] * 40
    # A manifest that was cut off while it was written does not count, and the next merge goes past it.
    (tmp_path / "table" / "_manifest" / f"{before.number + 1:08d}.json").write_text('{"by": ["year"')
    assert values(spark, path) == [1.0] * 40
    sinks.merge_by_month(spark, path, daily(spark, [9.0]))
    assert versions.current(spark, path).number == before.number + 2 and values(spark, path) == [1.0] * 39 + [9.0]
    # What the stopped merges left goes with the states that nothing names any more.
    assert versions.expire(spark, path) == 2
    assert values(spark, path) == [1.0] * 39 + [9.0] and versions.expire(spark, path) == 0


def test_a_second_writer_is_refused(spark, tmp_path):
    path = table(spark, tmp_path, daily(spark, [1.0]))
    before = versions.current(spark, path)
    sinks.merge_by_month(spark, path, daily(spark, [2.0]))
    with pytest.raises(versions.PublishError):
        versions.publish(spark, path, before, before.by, {})
    assert values(spark, path) == [2.0]


def test_a_reader_keeps_its_state(spark, tmp_path):
    path = table(spark, tmp_path, daily(spark, [1.0, 2.0]))
    old = versions.read(spark, path, daily(spark, []).schema)
    sinks.merge_by_month(spark, path, daily(spark, [7.0]))
    assert sorted(r.pm10 for r in old.collect()) == [1.0, 2.0] and values(spark, path) == [2.0, 7.0]


def test_rows_without_a_day_and_folders_by_day(spark, tmp_path):
    undated = daily(spark, [7.0]).selectExpr("city", "cast(null as date) date", "pm10")
    path = table(spark, tmp_path, daily(spark, [1.0]).unionByName(undated))
    for _ in range(2):
        sinks.merge_by_month(spark, path, undated)
        assert values(spark, path) == [1.0, 7.0]
    assert None in versions.current(spark, path).folders
    days = str(tmp_path / "days")
    versions.create(spark, days, sinks.DAY)
    sinks.merge_by_month(spark, days, daily(spark, [1.0, 2.0, 3.0], start=date(2024, 12, 30)), by=sinks.DAY)
    sinks.merge_by_month(spark, days, daily(spark, [8.0], start=date(2024, 12, 31)), by=sinks.DAY)
    assert values(spark, days) == [1.0, 3.0, 8.0] and len(versions.current(spark, days).folders) == 3


def test_counts_follow_the_rows(spark, tmp_path):
    path = table(spark, tmp_path, daily(spark, [1.0] * 40).unionByName(daily(spark, [1.0] * 3, "B")))
    sinks.merge_by_month(spark, path, daily(spark, [1.0] * 5, "B", date(2024, 1, 3)))
    counts = {(r.city, r.month): (r.rows, r.first_date.day, r.last_date.day) for r in versions.read_counts(spark, path).collect()}
    assert counts == {("A", 1): (31, 1, 31), ("A", 2): (9, 1, 9), ("B", 1): (7, 1, 7)}


@pytest.fixture(scope="module")
def sparse(spark, tmp_path_factory):
    """A dense city, one that reports now and then, and one long silent, in stored tables."""
    draw, folder = random.Random(4), tmp_path_factory.mktemp("sparse")
    days = [date(2020, 1, 1) + timedelta(days=i) for i in range(1500)]
    kept = {"Dense": days, "Rare": sorted(draw.sample(days, 40)), "Silent": days[:25]}
    rows = [(c, d, *(draw.random() for _ in POLLUTANTS)) for c, held in kept.items() for d in held]
    readings = workspace.materialize(
        spark.createDataFrame(rows, "city string, date date, " + ", ".join(f"{p} double" for p in POLLUTANTS)).select(*schemas.READING.names), "r"
    )
    weather = readings.select("city", "date", *[F.lit(1.0).alias(v) for v in WEATHER_VARIABLES]).select(*schemas.WEATHER_DAY.names)
    tables = plan.Tables(*[str(folder / n) for n in ("readings", "weather", "forecasts", "rejected")])
    tables.ensure(spark)
    sinks.merge_by_month(spark, tables.readings, readings)
    sinks.merge_by_month(spark, tables.weather, workspace.materialize(weather, "w"))
    return tables, readings, weather, kept


@pytest.mark.parametrize("cities", [["Dense"], ["Rare"], ["Dense", "Rare", "Silent"]])
def test_refresh_opens_the_months_it_needs(spark, sparse, cities):
    tables, readings, weather, kept = sparse
    start = {"Dense": date(2022, 3, 10), "Rare": kept["Rare"][20], "Silent": kept["Silent"][3]}
    changed = readings.filter(" or ".join(f"(city = '{c}' and date between '{start[c]}' and '{start[c] + timedelta(days=2)}')" for c in cities))
    near, near_weather = plan.reached(spark, tables, changed)
    got = views.refresh_mart(near, near_weather, changed)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, views.refresh_mart(readings, weather, changed).collect()))
    wanted = set()
    for c in cities:
        at = [i for i, d in enumerate(kept[c]) if start[c] <= d <= start[c] + timedelta(days=2)]
        for first, last in [(kept[c][at[0]].replace(day=1), kept[c][at[-1]])]:
            before = [d for d in kept[c] if d < first][-7:]
            month_end = (last.replace(day=1) + timedelta(days=32)).replace(day=1)
            after = [d for d in kept[c] if d >= month_end][:7]
            wanted |= {(d.year, d.month) for d in kept[c] if (before or [first])[0].replace(day=1) <= d <= (after or [last])[-1] or first <= d < month_end}
    assert opened(near) == {(f"year={y}", f"month={m}") for y, m in wanted}
    assert len(opened(near)) < 50


def test_newest_rows_open_the_last_months(spark, sparse):
    tables, readings, _, kept = sparse
    cities = spark.createDataFrame([("dense",), ("RARE",), ("Silent",)], "city string")
    for city, days in (("DENSE", 30), ("rare", 7), ("silent", 100)):
        got = serving.history(spark, tables, cities, city, days)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in topn.history(readings, cities, city, days).collect()]
        name = city.capitalize()
        assert len(opened(got)) <= len({(d.year, d.month) for d in kept[name][-days:]})
    assert serving.history(spark, tables, cities, "nowhere").count() == 0
    assert serving.latest_forecast(spark, tables, cities, "dense").count() == 0


def test_pending_days_from_the_counts(spark, sparse):
    tables, _, _, kept = sparse
    cities = spark.createDataFrame([("Dense",), ("Rare",)], "city string")
    until = kept["Dense"][-1] + timedelta(days=2)
    got = sorted((r.city, r.date) for r in plan.pending_days(spark, tables, cities, until).collect())
    want = [(c, str(d)) for c in ("Dense", "Rare") for d in (kept[c][-1] + timedelta(days=i + 1) for i in range(2000)) if d <= until]
    assert got == want


def test_actuals_open_the_months_of_their_forecasts(spark, tmp_path):
    tables = plan.Tables(*[str(tmp_path / n) for n in ("readings", "weather", "forecasts", "rejected")])
    tables.ensure(spark)
    made = [date(2020, 1, 30), date(2022, 6, 15), date(2024, 3, 1)]
    log = spark.createDataFrame([("A", d, d + timedelta(days=3), 3, 1.0, None) for d in made], schemas.FORECAST)
    sinks.merge_by_month(spark, tables.forecasts, log, plan.FORECAST_KEY, "forecast_date")
    before = versions.current(spark, tables.forecasts).folders
    readings = spark.createDataFrame([("A", made[0] + timedelta(days=3), 5.0), ("A", made[2] + timedelta(days=3), 6.0)], SCHEMA)
    plan.store_actuals(spark, tables, readings)
    assert {r.forecast_date: r.actual for r in tables.read_forecasts(spark).collect()} == dict(zip(made, (5.0, None, 6.0)))
    after = versions.current(spark, tables.forecasts).folders
    assert [before[n] == after[n] for n in sorted(after)] == [False, True, False]


def test_rejects_open_only_their_days_and_count_once(spark, tmp_path):
    path = str(tmp_path / "rejected")
    rows = lambda day, n: spark.createDataFrame([("A", f"text {i}", None, day) for i in range(n)], "city string, text string, x double, landed date")
    assert plan.reject(spark, rows(date(2024, 1, 1), 3), path, "landed") == 3
    assert plan.reject(spark, rows(date(2024, 1, 2), 3), path, "landed") == 3
    assert plan.reject(spark, rows(date(2024, 1, 1), 4).union(rows(date(2024, 1, 1), 1)), path, "landed") == 1
    assert plan.reject(spark, rows(None, 1), path, "landed") == 1 and plan.reject(spark, rows(None, 1), path, "landed") == 0
    assert sorted(p.name for p in (tmp_path / "rejected").glob("part=*")) == ["part=2024-01-01", "part=2024-01-02", "part=none"]
    # The second day's files are damaged: a load of the first day does not notice.
    for f in (tmp_path / "rejected" / "part=2024-01-02").glob("*.parquet"):
        f.write_bytes(b"")
    assert plan.reject(spark, rows(date(2024, 1, 1), 5), path, "landed") == 1
