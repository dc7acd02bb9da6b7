import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daymill import schemas
from daymill.functions import calendar, text
from daymill.operators import aggregate, flights, unnest
from daymill.sources import landing, responses, sinks


def test_csv_blanks_and_padded_header(spark, tmp_path):
    path = tmp_path / "city.csv"
    path.write_text(
        "date, pm25, pm10, o3, no2, co\n"
        "2024/1/5, 46, ,  ,, 0.1\n"
        " 2024-01-06 ,1,2,3,4,x\n"
    )
    rows = landing.read_history_csv(spark, str(path), "Berlin").orderBy("date").collect()
    assert rows[0].asDict() == {
        "date": date(2024, 1, 5), "city": "Berlin", "pm25": 46.0, "pm10": None, "o3": None, "no2": None, "co": 0.1
    }
    assert rows[1].date == date(2024, 1, 6) and rows[1].co is None
    both = landing.read_history(spark, {"Berlin": str(path), "Paris": str(path)})
    assert sorted(r.city for r in both.collect()) == ["Berlin"] * 2 + ["Paris"] * 2


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,pm25,pm10,o3,no2,co\n2024-01-05,1,2,3,4,5\n")
    (tmp_path / "b.csv").write_text("date,pm10,pm25,o3,no2,co\n2024-01-05,2,1,3,4,5\n")
    with pytest.raises(Exception, match="header"):
        landing.read_history_csv(spark, str(tmp_path), "Berlin").collect()


def test_ragged_arrays(spark):
    doc = {"city": "A", "hourly": {"time": ["2024-01-15T05:00", "2024-01-15T06:00", None, "2024-01-15T07:00", "2024-01-15T08:00"],
                                   "temperature_2m": [1.0, 2.0]}}
    schema = schemas.hourly_response(["temperature_2m"]).add("city", "string")
    df = spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(doc)]))
    rows = unnest.unnest_hourly(df, ["temperature_2m"]).collect()
    assert [r.temperature_2m for r in rows] == [1.0, 2.0, None, None]
    assert rows[0].timestamp == datetime(2024, 1, 15, 5)
    assert unnest.unnest_hourly(df, ["temperature_2m"], required=["temperature_2m"]).count() == 2
    assert unnest.ragged_documents(df, ["temperature_2m"]).first().longest == 2


def test_responses_are_split_not_raised(spark):
    ok = {"status": "ok", "data": {"iaqi": {"pm10": {"v": 20}, "pm25": {"v": "-"}}, "time": {"s": "2026-04-14 10:00:00"}}}
    bodies = [json.dumps(ok), json.dumps({"status": "error", "data": "Unknown station"}), "not json",
              json.dumps({"status": "ok", "data": {"iaqi": {}, "time": {}}})]
    df = spark.createDataFrame([("Berlin", b) for b in bodies], "city string, body string")
    flat = responses.flatten_readings(df)
    good = responses.usable(flat).collect()
    assert len(good) == 1
    assert (good[0].date, good[0].pm10, good[0].pm25, good[0].o3) == (date(2026, 4, 14), 20.0, None, None)
    reasons = sorted(r.reason for r in responses.quarantined(flat).collect())
    assert reasons == ["no date", "no status", "status not ok"]


def test_layout_paths_and_pruning(spark, tmp_path):
    for day, city in ((14, "Berlin"), (15, "Berlin"), (15, "New York")):
        folder = tmp_path / "air" / "year=2026" / "month=04" / f"day={day:02d}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{city}.json").write_text(json.dumps({"hourly": {"time": ["2026-04-14T00:00"], "temperature_2m": [1.0]}}))
    root = str(tmp_path / "air")
    schema = schemas.hourly_response(["temperature_2m"])
    assert [r.date for r in landing.list_dates(spark, root).collect()] == [date(2026, 4, 14), date(2026, 4, 15)]
    got = sorted(tuple(r) for r in landing.list_objects(spark, root).collect())
    assert got == [("Berlin", date(2026, 4, 14)), ("Berlin", date(2026, 4, 15)), ("New York", date(2026, 4, 15))]
    one = landing.read_landed(spark, root, schema, date(2026, 4, 15), date(2026, 4, 15))
    assert sorted(r.city for r in one.collect()) == ["Berlin", "New York"]
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()


def test_landed_documents_round_trip(spark, tmp_path):
    rows = [(date(2026, 4, 14), "Berlin", 46.0, 20.0, 18.3, 10.6, 0.1), (date(2026, 4, 14), "Paris", None, 1.0, 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, schemas.READING)
    path = str(tmp_path / "landed")
    assert sinks.land_documents(df, path) == 2
    back = landing.read_landed(spark, path, schemas.READING).select(
        F.col("landed_date").alias("date"), *[c for c in df.columns if c != "date"]
    )
    assert sorted(back.collect(), key=lambda r: r.city) == df.collect()


def test_object_key_round_trip(spark):
    df = spark.createDataFrame([("A+B %", date(2026, 4, 3))], "city string, date date")
    key = text.object_key("weather", F.col("city"), F.col("date"))
    row = df.select(key.alias("key")).select("key", text.key_city(F.col("key")), text.key_day(F.col("key"))).first()
    assert tuple(row) == ("weather/year=2026/month=04/day=03/A+B %.json", "A+B %", date(2026, 4, 3))


def test_daily_mean_skips_nulls_and_null_keys(spark):
    rows = [("A", datetime(2024, 1, 1, 5), 1.0), ("A", datetime(2024, 1, 1, 6), None), ("A", datetime(2024, 1, 1, 7), 3.0),
            (None, datetime(2024, 1, 1), 9.0), ("A", None, 9.0)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp, temperature_2m double")
    assert [tuple(r) for r in aggregate.daily_mean(df).collect()] == [(date(2024, 1, 1), "A", 2.0)]


def test_flights(spark):
    base = dict.fromkeys(schemas.FLIGHT.names)
    make = lambda **kw: tuple({**base, **kw}[n] for n in schemas.FLIGHT.names)
    rows = [
        make(icao24="x", firstSeen=1705280400, lastSeen=1705284000, estDepartureAirport="EDDF", callsign="B"),
        make(icao24="x", firstSeen=1705280400, lastSeen=1705284000, estDepartureAirport="EDDF", callsign="A"),
        make(icao24="y", firstSeen=1705280400, lastSeen=None, estDepartureAirport="EDDF"),
    ]
    got = flights.clean_flights(spark.createDataFrame(rows, schemas.FLIGHT)).collect()
    assert len(got) == 1
    assert (got[0].callsign, got[0].duration_minutes, got[0].year, got[0].month) == ("A", 60.0, 2024, 1)
    assert got[0].firstSeen_ts == datetime(2024, 1, 15, 1)


def test_leap_year_is_not_wrapped(spark):
    df = spark.createDataFrame([(date(2024, 2, 29),), (date(2024, 12, 31),)], "date date")
    rows = df.withColumns(calendar.calendar_columns()).withColumn("doy", F.dayofyear("date")).collect()
    assert [r.doy for r in rows] == [60, 366]
    assert rows[1].day_of_year_sin > 0.017
    assert rows[0].day_of_week == 3


def test_no_hour_is_lost_with_a_missing_variable(spark):
    from daymill.operators import unnest

    schema = "city string, hourly struct<time: array<string>, a: array<double>, b: array<double>>"
    rows = [("A", (["2024-01-01T00:00", "never", "2024-01-01T02:00"], [1.0, 2.0, 3.0], None)), ("B", None), ("C", (None, [4.0], None))]
    docs = spark.createDataFrame(rows, schema)
    hours = unnest.unnest_hourly(docs, ("a", "b", "absent")).collect()
    assert [(r.city, r.a, r.b, r.absent) for r in hours] == [("A", 1.0, None, None), ("A", 3.0, None, None)]
    rejected = {(r.city, r.text, r.reason) for r in unnest.rejected_hours(docs, ("a", "b")).collect()}
    assert rejected == {("A", "never", "time not readable"), ("B", None, "no hourly data"), ("C", None, "no hourly data"), ("C", None, "no time")}
