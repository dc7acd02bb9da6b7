from datetime import date

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daymill.operators import incremental, series
from daymill.plans import training
from tests.helpers import START, count_in_plan, daily, values


def with_gap(before, gap, after):
    return [float(i) for i in range(before)] + [None] * gap + [100.0 + i for i in range(after)]


@pytest.mark.parametrize(
    "gap, filled, dropped", [(0, 0, 0), (1, 1, 0), (7, 7, 0), (8, 7, 8), (15, 7, 15)]
)
def test_interior_gaps(spark, gap, filled, dropped):
    cells = with_gap(15, gap, 25 - gap)
    df = daily(spark, cells)
    done = values(series.interpolate(df), "pm10")
    assert sum(v is not None for v in done) == 40 - gap + filled
    assert series.clean_series(df).count() == 40 - dropped


def test_interpolation_is_on_the_line(spark):
    got = values(series.interpolate(daily(spark, [1.0, None, None, None, 9.0])), "pm10")
    assert got == [1.0, 3.0, 5.0, 7.0, 9.0]


def test_leading_nulls_stay_and_cost_the_next_seven(spark):
    df = daily(spark, [None] * 3 + [1.0] * 17)
    assert values(series.interpolate(df), "pm10")[:3] == [None] * 3
    assert series.clean_series(df).count() == 10


@pytest.mark.parametrize("trailing, kept", [(5, 20), (10, 22)])
def test_trailing_nulls_repeat_the_last_value(spark, trailing, kept):
    df = daily(spark, [2.0] * 14 + [5.0] + [None] * trailing)
    got = values(series.clean_series(df), "pm10")
    assert len(got) == kept
    assert got[15:] == [5.0] * (kept - 15)


def test_all_null_series_vanishes(spark):
    assert series.clean_series(daily(spark, [None] * 10)).count() == 0


def test_lags_count_surviving_rows(spark):
    cells = with_gap(15, 15, 20)
    lagged = series.add_lags(series.clean_series(daily(spark, cells)), ["pm10"])
    first_after = lagged.filter("pm10 = 107.0").first()
    assert first_after.pm10_lag_7d == pytest.approx(14 + (100 - 14) / 16)
    assert first_after.pm10_lag_1d is not None


def test_rolling_means_include_or_exclude(spark):
    df = daily(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0])
    including = values(series.add_rolling_mean(df, ["pm10"]), "pm10_rolling_7d")
    excluding = values(series.add_full_rolling_mean(df), "pm10_rolling_7d")
    assert including == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0]
    assert excluding == [None] * 7 + [4.0]


def test_full_mean_needs_every_value(spark):
    df = daily(spark, [1.0, None] + [1.0] * 8)
    got = values(series.add_full_rolling_mean(df), "pm10_rolling_7d")
    assert got == [None] * 9 + [1.0]


def test_targets_drop_the_end(spark):
    got = series.add_targets(daily(spark, [float(i) for i in range(10)])).orderBy("date").collect()
    assert len(got) == 3
    assert [got[0][f"target_{h}d"] for h in range(1, 8)] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]


def test_lags_do_not_cross_cities(spark):
    both = daily(spark, [1.0, 2.0], "A").unionByName(daily(spark, [3.0, 4.0], "B"))
    lagged = series.add_lags(both, ["pm10"], (1,)).filter("city = 'B'").orderBy("date").collect()
    assert [r.pm10_lag_1d for r in lagged] == [None, 3.0]


def test_lookback_gives_the_same_features(spark):
    df = daily(spark, [float(i * i) for i in range(40)])
    build = lambda d: series.add_full_rolling_mean(series.add_lags(d, ["pm10"]))
    start = date(2024, 1, 20)
    whole = build(df).filter(f"date >= '{start}'").orderBy("date").collect()
    assert series.with_lookback(df, start, 7, build).orderBy("date").collect() == whole


def test_densify_and_missing_days_agree(spark):
    rows = [("A", date(2024, 1, 1), 1.0), ("A", date(2024, 1, 4), 2.0), ("B", date(2024, 1, 2), 3.0)]
    df = spark.createDataFrame(rows, "city string, date date, pm10 double")
    dense = incremental.densify(df)
    assert dense.count() == 5
    empty = {(r.city, r.date) for r in dense.filter("pm10 is null").collect()}
    missing = {(r.city, r.date) for r in incremental.missing_days(df.unionByName(df)).collect()}
    assert empty == missing == {("A", date(2024, 1, 2)), ("A", date(2024, 1, 3))}


series_cells = st.lists(st.one_of(st.none(), st.integers(0, 50).map(float)), min_size=1, max_size=40)
slow = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@slow
@given(cells=series_cells, max_gap=st.sampled_from([1, 3, 7]))
def test_interpolation_matches_pandas(spark, cells, max_gap):
    got = values(series.interpolate(daily(spark, cells), max_gap=max_gap), "pm10")
    want = pd.Series(cells, dtype=float).interpolate(method="linear", limit=max_gap)
    np.testing.assert_allclose(np.array(got, dtype=float), want.to_numpy(), rtol=1e-9)


@slow
@given(cells=series_cells)
def test_known_values_never_change(spark, cells):
    got = values(series.interpolate(daily(spark, cells)), "pm10")
    assert [g for g, c in zip(got, cells) if c is not None] == [c for c in cells if c is not None]


@slow
@given(cells=st.lists(st.integers(0, 50).map(float), min_size=20, max_size=40), cut=st.integers(10, 19))
def test_features_never_read_later_rows(spark, cells, cut):
    """Changing the future changes no feature of the past."""
    changed = cells[:cut] + [v + 1000 for v in cells[cut:]]
    columns = ["pm10_lag_1d", "pm10_lag_7d", "pm10_rolling_7d"]
    end = f"date < date_add(date'{START}', {cut})"
    a, b = [
        training.series_features(daily(spark, c)).filter(end).select("date", *columns).orderBy("date").collect()
        for c in (cells, changed)
    ]
    assert a == b


@slow
@given(days=st.lists(st.dates(date(2015, 1, 1), date(2030, 1, 1)), min_size=1, max_size=20))
def test_split_covers_every_row_once(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "date date")
    rows = training.chrono_split(df).collect()
    want = [
        "train" if d.year <= 2021 else "validation" if d.year == 2022 else "meta" if d.year <= 2024 else "test"
        for d in days
    ]
    assert [r.split for r in rows] == want


def test_calendar_features_do_not_cross_gaps(spark):
    df = daily(spark, [float(i) for i in range(20)]).filter("date not between '2024-01-10' and '2024-01-11'")
    rows = {r.date.day: r for r in series.add_calendar_features(df, horizons=(1, 3)).collect()}
    assert rows[12].pm10_lag_1d is None and rows[12].pm10_lag_7d == 4.0 and rows[12].pm10_rolling_7d is None
    assert rows[8].pm10_lag_1d == 6.0 and rows[8].pm10_rolling_7d == 3.0 and rows[1].pm10_lag_1d is None
    assert rows[19].pm10_rolling_7d == 14.0 and rows[9].target_1d is None and rows[9].target_3d == 11.0 and rows[20].target_1d is None
    assert count_in_plan(series.add_calendar_features(df, horizons=(1, 3)), "Exchange hashpartitioning") == 1
