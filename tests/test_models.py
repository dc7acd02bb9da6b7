import json
import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from daymill import schemas, workspace
from daymill.models import forest, seasonal, stacked, trees
from daymill.operators import metrics
from daymill.plans import daily as plan
from daymill.plans import lake, training
from daymill.sources import sinks
from tests.helpers import count_in_plan, daily

PAIRS = "g string, y double, p double, q double"


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=50), rng.normal(size=50)
    df = spark.createDataFrame([("a", float(a), float(b), 0.0) for a, b in zip(y, p)], PAIRS)
    row = metrics.regression_metrics(df, ["g"], "y", "p").first()
    assert row.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert row.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert row.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_constant_truth_and_single_row(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, 0.0), ("a", 1.0, 1.0, 0.0), ("b", 1.0, 2.0, 0.0), ("b", 1.0, 1.0, 0.0), ("c", 1.0, 2.0, 0.0)], PAIRS)
    r2 = {r.g: r.r2 for r in metrics.regression_metrics(df, ["g"], "y", "p").collect()}
    assert r2["a"] == 1.0 and r2["b"] == 0.0 and math.isnan(r2["c"])


def test_blend_matches_least_squares(spark):
    rng = np.random.default_rng(2)
    p, q = rng.normal(size=40), rng.normal(size=40)
    y = 3 + 2 * p - q + rng.normal(size=40) * 0.1
    df = spark.createDataFrame([("a", *map(float, r)) for r in zip(y, p, q)], PAIRS)
    w = metrics.fit_blend(df, ["g"], "p", "q", "y").first()
    want = np.linalg.lstsq(np.column_stack([np.ones(40), p, q]), y, rcond=None)[0]
    np.testing.assert_allclose([w.w0, w.w1, w.w2], want, rtol=1e-8)


def test_collinear_blend_takes_the_smallest_solution(spark):
    p = np.arange(10.0)
    df = spark.createDataFrame([("a", 4 * v + 1, v, 2 * v) for v in p.tolist()], PAIRS)
    w = metrics.fit_blend(df, ["g"], "p", "q", "y").first()
    assert (w.w0, w.w1, w.w2) == pytest.approx((1.0, 0.8, 1.6))


def test_champion_ties_and_nan(spark):
    rows = [("m", 1, 5.0), ("m", 2, 5.0), ("m", 3, float("nan")), ("n", 1, 5.0), ("n", 2, 4.0)]
    df = spark.createDataFrame(rows, "model string, run_order bigint, rmse double")
    assert {r.model: r.run_order for r in stacked.champions(df).collect()} == {"m": 1, "n": 2}


def wave(n, city_level=0.0):
    day = [date(2020, 1, 1) + timedelta(days=i) for i in range(n)]
    return [
        30 + city_level + 5 * math.sin(2 * math.pi * d.timetuple().tm_yday / 365.25) + (3 if d.weekday() < 5 else 0)
        for d in day
    ]


def test_seasonal_fit_matches_numpy_and_finds_the_week(spark):
    df = daily(spark, wave(900), start=date(2020, 1, 1)).repartition(7)
    coefficients = seasonal.fit_seasonal(df)
    scored = seasonal.predict_seasonal(df, coefficients).orderBy("date").collect()
    errors = [abs(r.pm10 - r.seasonal) for r in scored]
    assert max(errors) < 0.3
    terms = df.select("date", seasonal.basis(df.date).alias("b"), "pm10").orderBy("date").collect()
    x, y = np.array([r.b for r in terms]), np.array([r.pm10 for r in terms])
    want = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    np.testing.assert_allclose([r.seasonal for r in scored], want, atol=1e-6)


def test_seasonal_input_names(spark):
    assert seasonal.seasonal_input(daily(spark, [1.0, None])).columns == ["city", "ds", "y"]
    assert seasonal.seasonal_input(daily(spark, [1.0, None])).count() == 1


def test_trials_are_seeded_and_in_range(spark):
    a, b = (trees.draw_trials(spark, 50).collect() for _ in range(2))
    assert a == b and len(a) == 50
    assert all(100 <= r.trees <= 500 and 3 <= r.depth <= 8 for r in a)
    assert all(0.01 <= r.learning_rate <= 0.3 and 0.6 <= r.row_sample <= 1 for r in a)


def test_halving_keeps_the_better_half(spark, monkeypatch):
    """Rungs of 9, 4, 2 and 1 trials; errors are made up here, NaN among them, so that the ranks are known."""
    asked = []

    def made_up(vectors, jobs, parallelism):
        asked.append(sorted((h, t, p.trees) for h, t, p in jobs))
        rows = [(h, t, p.trees, p.learning_rate, p.depth, p.row_sample, p.column_sample,
                 float("nan") if t == 8 else abs(t - 2 * h) + 1.0 / p.trees + (5.0 if t == 2 and p.trees == 40 else 0.0)) for h, t, p in jobs]
        return spark.createDataFrame(rows, trees.RESULTS)

    monkeypatch.setattr(trees, "_errors", made_up)
    table = spark.createDataFrame([(t, 40, 0.1, 3, 1.0, 1.0) for t in range(9)], "trial bigint, trees int, learning_rate double, depth int, row_sample double, column_sample double")
    results = trees.halve_trials(spark.range(1), [1, 2], table, first_share=1 / 8)
    assert [len(a) for a in asked] == [18, 8, 4, 2] and [a[0][2] for a in asked] == [5, 10, 20, 40]
    assert [t for h, t, _ in asked[1] if h == 1] == [0, 1, 2, 3] and [t for h, t, _ in asked[1] if h == 2] == [2, 3, 4, 5]
    assert {r.rung: r.n for r in results.groupBy("rung").agg(F.count("*").alias("n")).collect()} == {0: 18, 1: 8, 2: 4, 3: 2}
    best = trees.best_params(results)
    # Trial 2 grows worse in the last rung, so its model of 20 trees is the best of horizon 1.
    assert best[1].trees == 20 and best[2].trees == 40
    first = results.filter("rung = 0 AND NOT isnan(rmse)").groupBy("horizon").agg(F.min("rmse").alias("rmse")).collect()
    lowest = {r.horizon: r.rmse for r in results.filter("NOT isnan(rmse)").groupBy("horizon").agg(F.min("rmse").alias("rmse")).collect()}
    assert all(lowest[r.horizon] <= r.rmse for r in first)
    with pytest.raises(ValueError):
        trees.halve_trials(spark.range(1), [1], table, keep=1.0)


def inputs(spark, days=1200):
    start = date(2020, 1, 1)
    readings = daily(spark, wave(days), "A", start).unionByName(daily(spark, wave(days, 40.0), "B", start))
    for p in ("pm25", "o3", "no2", "co"):
        readings = readings.withColumn(p, readings.pm10 * 0.5)
    weather = readings.select("city", "date")
    for i, v in enumerate(schemas.WEATHER_DAY.names[2:]):
        weather = weather.withColumn(v, F.lit(None if v == "snowfall" else float(i)).cast("double"))
    return readings, weather


def test_forecast_end_to_end(spark, tmp_path):
    """Fit, save, champion, daily run: sound forecasts, stable over a repeated run."""
    readings, weather = inputs(spark)
    ends = {"train_end": date(2021, 12, 31), "validation_end": date(2022, 6, 30), "meta_end": date(2022, 12, 31)}
    frame = workspace.materialize(
        training.chrono_split(training.training_frame(readings, weather), **ends), "frame"
    )
    params = {h: trees.TreeParams(trees=8, learning_rate=0.3, depth=3) for h in (1, 7)}
    forecaster = stacked.fit_stacked(frame, params)
    errors = stacked.evaluate(forecaster, frame).collect()
    assert {(r.city, r.horizon) for r in errors} == {("A", 1), ("A", 7), ("B", 1), ("B", 7)}
    naive = metrics.regression_metrics(
        training.long_targets(frame.filter("split = 'test'"), [1, 7]), ["city", "horizon"], "target", "pm10"
    )
    persistence = {(r.city, r.horizon): r.rmse for r in naive.collect()}
    assert all(r.rmse < persistence[r.city, r.horizon] for r in errors if r.horizon == 1)

    path = str(tmp_path / "the model, 100%+")
    forecaster.save(path)
    again = stacked.StackedForecaster.load(spark, path, [1, 7])
    test = frame.filter("split = 'test'")
    order = ["city", "date", "horizon"]
    first, second = (f.predict(test).select(*order, "predicted").orderBy(*order).collect() for f in (forecaster, again))
    assert first == second

    # Two stored runs in one plan: the second one leads city B. Feature rows of both splits, nulls among them.
    other = stacked.fit_stacked(frame, {h: trees.TreeParams(trees=3, depth=5, row_sample=0.7) for h in (1, 7)})
    second_path = str(tmp_path / "other")
    other.save(second_path)
    best = spark.createDataFrame(
        [("A", h, path) for h in (1, 7)] + [("B", 1, second_path), ("B", 7, path), ("C", 1, path)], "city string, horizon int, path string"
    )
    rows = workspace.materialize(test.withColumn("temperature_2m", F.when(F.dayofmonth("date") > 5, F.col("temperature_2m"))), "rows")
    got = stacked.predict_with_champions(spark, rows, best, [1, 7])
    assert count_in_plan(got, "FlatMapCoGroupsInPandas") == 1
    found = {(r.city, r.date, r.horizon): (r.tree, r.seasonal, r.predicted) for r in got.collect()}
    want = {}
    for f, led in ((forecaster, {("A", 1), ("A", 7), ("B", 7)}), (other, {("B", 1)})):
        for r in f.predict(rows).collect():
            if (r.city, r.horizon) in led:
                want[r.city, r.date, r.horizon] = (r.tree, r.seasonal, r.predicted)
    assert found.keys() == want.keys() and len(want) > 100
    keys = sorted(want)
    np.testing.assert_allclose([found[k] for k in keys], [want[k] for k in keys], rtol=1e-12)
    # Small groups: every row is dealt to one group only, and each gets the trees.
    before, forest.GROUP_ROWS = forest.GROUP_ROWS, 10
    try:
        again = stacked.predict_with_champions(spark, rows, best, [1, 7]).collect()
    finally:
        forest.GROUP_ROWS = before
    assert sorted((r.city, r.date, r.horizon, r.predicted) for r in again) == sorted((*k, v[2]) for k, v in found.items())
    with pytest.raises(ValueError):
        stacked.predict_with_champions(spark, rows, best.limit(0))


def test_rejected_rows_that_look_alike_all_stay(spark, tmp_path):
    tables = plan.Tables(*[str(tmp_path / n) for n in ("readings", "weather", "forecasts", "rejected")])
    tables.ensure(spark)
    stored = lambda kind: spark.read.parquet(f"{tables.rejected}/{kind}").collect()
    responses = spark.createDataFrame([("A", "broken"), ("A", "<html>")], "city string, body string")
    docs = spark.createDataFrame([(1,), (2,)], "landed int").select(
            F.lit("A").alias("city"), F.from_json(F.lit("{}"), schemas.hourly_response())["hourly"].alias("hourly"), "landed")
    sinks.land_documents(spark.createDataFrame([("A", "never", v, date(2024, 1, d)) for d in (1, 2) for v in (1.0, 2.0)],
                                               "city string, date string, pm10 double, landed date"), str(tmp_path / "lake"), "landed")
    for _ in range(2):
        plan.load_readings(spark, tables, responses)
        plan.load_weather(spark, tables, docs)
        lake.load_lake_readings(spark, tables, str(tmp_path / "lake"))
    assert sorted(r.body for r in stored("readings")) == ["<html>", "broken"]
    assert sorted(json.loads(r.document)["landed"] for r in stored("weather")) == [1, 2]
    assert sorted((str(r.landed_date), r.pm10) for r in stored("lake_rows")) == [
        ("2024-01-01", 1.0), ("2024-01-01", 2.0), ("2024-01-02", 1.0), ("2024-01-02", 2.0)]


def test_bootstrap_leaves_a_trace_of_unreadable_days(spark, tmp_path):
    stored, new = str(tmp_path / "readings"), str(tmp_path / "next")
    sinks.ensure_table(spark, stored, schemas.READING)
    columns = [f.name for f in schemas.READING if f.name not in ("date", "city")]
    lines = [f"{day},A," + ",".join(["4.5"] * len(columns)) for day in ("2024/1/1", "some day", "some day", "")]
    (tmp_path / "history.csv").write_text("\n".join([",".join(["date", "city", *columns]), *lines]) + "\n")
    assert lake.bootstrap(spark, stored, str(tmp_path / "history.csv"), new) == 3
    left = spark.read.parquet(f"{new}-rejected").collect()
    assert sorted((r.text or "", r.reason, r.pm10) for r in left) == [
        ("", "no day", 4.5), ("some day", "day not readable", 4.5), ("some day", "day not readable", 4.5)]
    assert spark.read.parquet(new).count() == 1


def test_daily_run_over_stored_tables(spark, tmp_path):
    tables = plan.Tables(*[str(tmp_path / n) for n in ("readings", "weather", "forecasts", "rejected")])
    tables.ensure(spark)
    body = lambda day, v: json.dumps({"status": "ok", "data": {"iaqi": {"pm10": {"v": v}}, "time": {"s": f"{day} 08:00:00"}}})
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]
    rows = [("A", body(d, 10.0 + i)) for i, d in enumerate(days)] + [("A", body(days[0], 10.0)), ("A", "broken")]
    landed = spark.createDataFrame(rows, "city string, body string")
    stored = plan.load_readings(spark, tables, landed)
    assert stored.count() == 40 and tables.read_readings(spark).count() == 40
    assert spark.read.parquet(f"{tables.rejected}/readings").count() == 1
    plan.load_readings(spark, tables, landed)
    assert tables.read_readings(spark).count() == 40

    new = spark.createDataFrame(
        [("A", days[30], days[30] + timedelta(days=h), h, 1.0 * h, None) for h in range(1, 8)], schemas.FORECAST
    )
    plan.store_forecasts(spark, tables, new)
    plan.store_actuals(spark, tables, tables.read_readings(spark))
    plan.store_forecasts(spark, tables, new.withColumn("predicted", F.col("predicted") + 100))
    log = tables.read_forecasts(spark).orderBy("horizon").collect()
    assert [r.actual for r in log] == [40.0 + h for h in range(1, 8)]
    assert [r.predicted for r in log] == [100.0 + h for h in range(1, 8)]

    document = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], **{v: [1.0, 3.0] for v in schemas.WEATHER_DAY.names[2:]}}}
    bodies = [("A", json.dumps(document)), ("B", '{"error": true}'), ("C", '{"hourly": {"time": []}}')]
    docs = spark.createDataFrame(bodies, "city string, body string").select(
        "city", F.from_json("body", schemas.hourly_response()).alias("r")
    ).select("city", "r.hourly")
    assert plan.load_weather(spark, tables, docs).count() == 1
    assert tables.read_weather(spark).first().temperature_2m == 2.0
    rejected = spark.read.parquet(f"{tables.rejected}/weather").collect()
    assert sorted((r.city, r.reason) for r in rejected) == [("B", "no hourly data"), ("C", "no times")]

    dim = spark.createDataFrame([("A",), ("Z",)], "city string")
    pending = plan.pending_days(spark, tables, dim, date(2024, 2, 11)).collect()
    assert [tuple(r) for r in pending] == [("A", "2024-02-10"), ("A", "2024-02-11")]
    assert plan.store_mart(spark, tables, str(tmp_path / "mart"), stored) == 40


def test_train_and_forecast(spark, tmp_path):
    """Two runs in the log; the champions forecast every city and horizon from its newest row."""
    from daymill.plans.forecast import forecast
    from daymill.plans.train import train

    readings, weather = inputs(spark)
    ends = (date(2021, 12, 31), date(2022, 6, 30), date(2022, 12, 31))
    ranges = {"trees": (2, 4), "learning_rate": (0.1, 0.3), "depth": (2, 3), "row_sample": (0.6, 1.0), "column_sample": (0.6, 1.0)}
    models, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    arguments = dict(trials=trees.draw_trials(spark, 2, ranges=ranges), ends=ends, horizons=[1])
    train(spark, readings, weather, models, runs, 1, **arguments)
    train(spark, readings.filter("city = 'A'"), weather, models, runs, 2, **arguments)
    log = spark.read.schema(schemas.MODEL_RUN).parquet(runs)
    assert sorted((r.model, r.run_order) for r in log.collect()) == [("pm10_a_1d", 1), ("pm10_a_1d", 2), ("pm10_b_1d", 1)]
    best = stacked.champions(log)
    assert {r.model for r in best.collect()} == {"pm10_a_1d", "pm10_b_1d"}
    latest = training.latest_features(readings, weather)
    rows = forecast(spark, latest, best, date(2023, 6, 1), [1]).collect()
    assert sorted((r.city, r.horizon, r.target_date) for r in rows) == [("A", 1, date(2023, 6, 2)), ("B", 1, date(2023, 6, 2))]
    assert all(math.isfinite(r.predicted) for r in rows)

    # The same champions in a daily run over stored tables that hold the history.
    tables = plan.Tables(*[str(tmp_path / n) for n in ("readings", "weather", "forecasts", "rejected")])
    tables.ensure(spark)
    plan.merge_by_month(spark, tables.readings, workspace.materialize(readings, "readings"))
    plan.merge_by_month(spark, tables.weather, workspace.materialize(weather.select(*schemas.WEATHER_DAY.names), "weather"))
    last = readings.selectExpr("max(date)").first()[0]
    today = last + timedelta(days=1)
    body = json.dumps({"status": "ok", "data": {"iaqi": {"pm10": {"v": 31.5}}, "time": {"s": f"{today} 08:00:00"}}})
    landed = spark.createDataFrame([("A", body)], "city string, body string")
    documents = spark.createDataFrame([], schemas.hourly_response().add("city", "string"))
    yesterday = plan.daily_run(spark, tables, landed.limit(0), documents, best, last, [1]).collect()
    assert {(r.city, r.target_date) for r in yesterday} == {("A", today), ("B", today)}
    plan.daily_run(spark, tables, landed, documents, best, today, [1])
    log = {(r.city, r.forecast_date): r.actual for r in tables.read_forecasts(spark).collect()}
    assert log == {("A", last): 31.5, ("B", last): None, ("A", today): None, ("B", today): None}


def test_same_seed_same_trees(spark):
    readings, weather = inputs(spark, 400)
    frame = training.training_frame(readings, weather, [1])
    levelled = trees.with_levels(frame, trees.city_levels(frame))
    vectors = workspace.materialize(trees.fit_inputs(levelled).transform(levelled).select("features", "target_1d"), "vectors")
    params = trees.TreeParams(trees=2, depth=2, row_sample=0.7, column_sample=0.7)
    first, second = (trees.fit_trees(vectors, 1, params, seed=7) for _ in range(2))
    assert first.toDebugString.split("\n")[1:] == second.toDebugString.split("\n")[1:]


def test_recent_months_give_the_features_of_the_whole_history(spark, tmp_path):
    tables = plan.Tables(*[str(tmp_path / n) for n in ("readings", "weather", "forecasts", "rejected")])
    tables.ensure(spark)
    rng = np.random.default_rng(3)
    end = date(2024, 6, 30)

    def city(name, days, missing, silent=0):
        values = [None if i in missing else float(rng.normal(30, 5)) for i in range(days)]
        rows = daily(spark, values, name, end - timedelta(days=days - 1 + silent))
        return rows

    frames = [
        city("dense", 300, set()),
        city("gaps", 300, set(range(270, 275)) | set(range(285, 297))),
        city("sparse", 300, set(range(150, 298))),
        city("silent", 200, set(), silent=250),
        city("young", 10, set()),
        city("edge", 300, set(range(160, 290))),
    ]
    readings = frames[0]
    for f in frames[1:]:
        readings = readings.unionByName(f)
    for p in ("pm25", "o3", "no2", "co"):
        readings = readings.withColumn(p, F.lit(None).cast("double"))
    weather = readings.select("city", "date", *[F.lit(1.0).alias(v) for v in schemas.WEATHER_DAY.names[2:]])
    plan.merge_by_month(spark, tables.readings, readings)
    plan.merge_by_month(spark, tables.weather, weather)
    cities = readings.select("city")
    got = plan.stored_latest_features(spark, tables, cities, end, history_days=40)
    want = training.latest_features(readings, weather).select(*got.columns)
    assert sorted(got.collect()) == sorted(want.collect())
    recent = training.latest_of_recent(tables.read_readings(spark, end - timedelta(days=40)))
    proven = {r.city for r in recent.filter("proven").collect()}
    assert "dense" in proven and "gaps" in proven and not proven & {"silent", "sparse"}


def test_seasonal_sums_add_up(spark):
    """A fit from sums of parts, with days removed and stored again, is the fit from the rows."""
    rng = np.random.default_rng(3)
    df = daily(spark, rng.normal(20, 5, 900).tolist()).unionByName(daily(spark, rng.normal(9, 1, 10).tolist(), "Short"))
    wrong = df.withColumn("pm10", F.when(F.dayofmonth("date") == 3, -50.0).otherwise(F.col("pm10")))
    old, new = wrong.filter("dayofmonth(date) = 3"), df.filter("dayofmonth(date) = 3")
    parts = [wrong.filter(f"dayofmonth(date) % 2 = {k}") for k in (0, 1)]
    stored = seasonal.add_sums(*map(seasonal.seasonal_sums, parts))
    sums = seasonal.add_sums(stored, seasonal.seasonal_sums(new), removed=seasonal.seasonal_sums(old))
    whole = seasonal.seasonal_sums(df)
    assert {r.city: r.rows for r in sums.collect()} == {"A": 900, "Short": 10}
    got, want = ({r.city: r.pm10 for r in seasonal.predict_seasonal(df, seasonal.solve_sums(x)).withColumn("pm10", F.col("seasonal")).groupBy("city").agg(F.collect_list("pm10").alias("pm10")).collect()} for x in (sums, whole))
    for city in want:
        np.testing.assert_allclose(sorted(got[city]), sorted(want[city]), rtol=1e-6)
    for r in seasonal.equations(whole, seasonal.solve_sums(whole)).filter("city = 'A'").collect():
        assert abs(r.with_values - r.with_fit) < 1e-6
    assert seasonal.fit_seasonal(df.filter("false")).count() == 0


@pytest.mark.parametrize("share", [1.0, 0.8])
def test_trees_are_the_same_in_any_order_and_dealing_of_rows(spark, share):
    """Rows have splits that part them alike; last digits of sums that are added up in another order must not choose among them."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, 8)).round(1)
    y = 3 * x[:, 0] + x[:, 1] * x[:, 2] + draw.normal(size=600)
    rows = [(i, Vectors.dense(v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    made = lambda part: spark.createDataFrame(part, ["id", "features", "target_1d"])
    train, new = workspace.materialize(made(rows[:400]).repartition(4, "id"), "rows"), made(rows[400:])
    other = workspace.materialize(train.repartition(7, F.rand(5)), "rows")
    params = trees.TreeParams(trees=12, depth=5, row_sample=share)
    got = [
        [r.tree_1d for r in trees.fit_trees(part, 1, params).transform(new).orderBy("id").collect()] for part in (train, other)
    ]
    np.testing.assert_allclose(got[0], got[1], rtol=1e-9)
    assert np.corrcoef(got[0], y[400:])[0, 1] > 0.8


def test_exact_grids():
    """The sum of a million values, and of their squares, is the same in any order."""
    value = np.random.default_rng(4).normal(size=1_000_000) * 37
    for powers in (1, 2):
        grid = trees._grid(float(np.abs(value).max()), len(value), powers)
        on = np.rint(value / grid) * grid
        for v in (on, on**2)[:powers]:
            assert sum(v.tolist()) == sum(sorted(v.tolist())) == sum(v[::-1].tolist())
        assert np.abs(on - value).max() <= grid / 2 < 2e-5 * np.abs(value).max()
    assert trees._grid(None, 5, 2) == trees._grid(math.inf, 5, 2) == 0.0


def _rows(spark, n, label=None):
    """Vectors with even values, few values, zeros, a constant, and a label with and without ties."""
    draw = np.random.default_rng(n)
    x = draw.normal(size=(n, 9))
    x[:, 1], x[:, 2], x[:, 3] = x[:, 1].round(), np.maximum(x[:, 2], 0), 5.0
    y = 3 * x[:, 0] + x[:, 1] * x[:, 4] + draw.normal(size=n) if label is None else np.full(n, label)
    return workspace.materialize(spark.createDataFrame([(Vectors.dense(v), float(t)) for v, t in zip(x, y)], ["features", "target_1d"]), "rows")


def _lines(model):
    return [line.split(": uid")[0] for line in model.toDebugString.split("\n")[1:]] + model.treeWeights


@pytest.mark.parametrize(
    "n, label, params",
    [
        (900, None, {"depth": 5}),
        (700, None, {"depth": 4, "row_sample": 0.7, "column_sample": 0.6}),
        (20, None, {"depth": 6, "column_sample": 0.3}),
        (50, 2.5, {"depth": 3}),
        (1, None, {"depth": 3}),
    ],
)
def test_a_task_grows_the_trees_of_mllib(spark, monkeypatch, n, label, params):
    rows, params = _rows(spark, n, label), trees.TreeParams(trees=4, **params)
    got = trees.fit_trees(rows, 1, params, seed=11)
    monkeypatch.setattr(trees, "TASK_CELLS", 0)
    want = trees.fit_trees(rows.repartition(5), 1, params, seed=11)
    assert _lines(got) == _lines(want)
    scored = [[r.tree_1d for r in m.transform(rows).orderBy("features").collect()] for m in (got, want)]
    assert scored[0] == scored[1]


def test_a_fit_takes_the_same_few_jobs_for_any_number_of_trees(spark):
    rows, context = _rows(spark, 300), spark.sparkContext
    context.setJobGroup("few-jobs", "fit")
    try:
        model = trees.fit_trees(rows, 1, trees.TreeParams(trees=40, depth=3))
        jobs = len(context.statusTracker().getJobIdsForGroup("few-jobs"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert model.getNumTrees == 40 and 0 < jobs < 20


def test_rows_that_no_tree_can_take_are_refused(spark):
    """As MLlib refuses them: no rows, values that are not numbers."""
    rows = _rows(spark, 30)
    for bad in (rows.limit(0), rows.withColumn("target_1d", F.lit(float("nan")))):
        with pytest.raises(Exception):
            trees.fit_trees(bad, 1, trees.TreeParams(trees=2, depth=2))
