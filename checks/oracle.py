"""DuckDB SQL for the registered queries, written from the definitions, not from the Spark code."""

from checks.standins import CHUNK, CITY_ROWS, PRICE_UNIT, UNIT, USER_UNIT
from daymill.constants import (
    HORIZONS,
    MODEL_FEATURES,
    POLLUTANTS,
    STAGED_WEATHER_NAMES,
    WEATHER_VARIABLES,
)

# Common table expressions, in an order in which each uses only earlier ones.
PARTS = {
    "raw": """SELECT o_orderpriority AS city, CAST(o_orderdate AS DATE) AS date, o_totalprice AS pm10,
        CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS pm25,
        CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS o3,
        CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS no2 FROM orders""",
    "r0": f"""SELECT city, date, avg(pm10) * {PRICE_UNIT} AS pm10, avg(pm25) * {PRICE_UNIT} AS pm25,
        avg(o3) * {PRICE_UNIT} AS o3, avg(no2) * {PRICE_UNIT} AS no2, max(pm10) * {PRICE_UNIT} AS co
        FROM raw GROUP BY city, date""",
    "grid": """SELECT city, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM r0 GROUP BY city""",
    "r": """SELECT g.city, g.date, pm25, CASE WHEN dayofyear(g.date) % 11 < 3
        OR dayofyear(g.date) BETWEEN 100 AND 114 THEN NULL ELSE pm10 END AS pm10, o3, no2, co
        FROM grid g LEFT JOIN r0 ON g.city = r0.city AND g.date = r0.date""",
    "w": f"""SELECT o_orderpriority AS city, CAST(l_shipdate AS DATE) AS date,
        avg(l_quantity) * {UNIT} AS temperature_2m, avg(l_discount * 100) * {UNIT} AS relative_humidity_2m,
        avg(l_tax * 100) * {UNIT} AS wind_speed_10m, max(l_tax * 100) * {UNIT} AS wind_gusts_10m,
        avg(l_quantity * 7) * {UNIT} AS wind_direction_10m, avg(l_extendedprice / 10000) * {UNIT} AS precipitation,
        min(l_discount) * {UNIT} AS snowfall, avg(l_tax) * {UNIT} AS snow_depth,
        avg(l_discount * 1000) * {UNIT} AS cloud_cover, avg(1000 + l_quantity) * {UNIT} AS surface_pressure,
        CAST(max(l_linenumber) AS DOUBLE) AS weather_code
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "h": f"""SELECT event_id, event_type AS city, ts, CAST(ts AS DATE) AS date, event_id // {CHUNK} AS part,
        value * {UNIT} AS temperature_2m, CAST(user_id AS DOUBLE) * {USER_UNIT} AS relative_humidity_2m FROM events""",
    "points": """SELECT *, row_number() OVER s AS pos, CASE WHEN pm10 IS NOT NULL THEN row_number() OVER s END AS known
        FROM r WINDOW s AS (PARTITION BY city ORDER BY date)""",
    "neighbours": """SELECT *, last_value(known IGNORE NULLS) OVER back AS b_at, last_value(pm10 IGNORE NULLS) OVER back AS b,
        first_value(known IGNORE NULLS) OVER ahead AS a_at, first_value(pm10 IGNORE NULLS) OVER ahead AS a FROM points
        WINDOW back AS (PARTITION BY city ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        ahead AS (PARTITION BY city ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "filled": """SELECT city, date, pm25, o3, no2, co, CASE WHEN pm10 IS NOT NULL THEN pm10 WHEN pos - b_at <= 7 THEN
        CASE WHEN a_at IS NULL THEN b ELSE b + (a - b) * (pos - b_at) / (a_at - b_at) END END AS pm10 FROM neighbours""",
    "clean": """SELECT * EXCLUDE damaged FROM (SELECT *, max(CASE WHEN pm10 IS NULL THEN 1 ELSE 0 END) OVER
        (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS damaged FROM filled) WHERE damaged = 0""",
    "lagged": """SELECT *, lag(pm10, 1) OVER s AS pm10_lag_1d, lag(pm10, 7) OVER s AS pm10_lag_7d,
        CASE WHEN count(pm10) OVER b7 = 7 THEN avg(pm10) OVER b7 END AS pm10_rolling_7d FROM clean
        WINDOW s AS (PARTITION BY city ORDER BY date),
        b7 AS (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "targeted": "SELECT * FROM (SELECT *, "
    + ", ".join(f"lead(pm10, {h}) OVER s AS target_{h}d" for h in HORIZONS)
    + " FROM lagged WINDOW s AS (PARTITION BY city ORDER BY date)) WHERE "
    + " AND ".join(f"target_{h}d IS NOT NULL" for h in HORIZONS),
    "p0": """SELECT city, date AS forecast_date, avg(pm10) OVER (PARTITION BY city ORDER BY date
        ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS predicted FROM r""",
    "p": """SELECT city, forecast_date, forecast_date + h AS target_date, h AS horizon, predicted
        FROM p0, (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS h) WHERE predicted IS NOT NULL""",
    "log": """SELECT p.*, r.pm10 AS actual FROM p LEFT JOIN r ON p.city = r.city AND p.target_date = r.date""",
    "dim": "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', {lat}, {lon}, {station})" for c, lat, lon, station in CITY_ROWS)
    + ") AS t(city, lat, lon, station_id)",
    "long": "SELECT *, " + "CASE WHEN date <= DATE '1998-12-31' THEN 'train' WHEN date <= DATE '1999-12-31' THEN 'validation'"
    " WHEN date <= DATE '2000-12-31' THEN 'meta' ELSE 'test' END AS split FROM ("
    + " UNION ALL ".join(
        f"SELECT city, date, pm10_lag_1d, pm10_rolling_7d, {h} AS horizon, target_{h}d AS target FROM targeted"
        for h in HORIZONS
    )
    + ")",
    "trial_means": "SELECT *, "
    + ", ".join(
        f"CASE WHEN count(pm10) OVER b{n} = {n} THEN avg(pm10) OVER b{n} END AS mean_{n}" for n in (3, 5, 7, 14)
    )
    + " FROM targeted_clean WINDOW "
    + ", ".join(
        f"b{n} AS (PARTITION BY city ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (3, 5, 7, 14)
    ),
    "trial_rows": "SELECT *, CASE WHEN date <= DATE '1998-12-31' THEN 'train' WHEN date <= DATE '1999-12-31' THEN 'validation'"
    " WHEN date <= DATE '2000-12-31' THEN 'meta' ELSE 'test' END AS split FROM ("
    + " UNION ALL ".join(
        f"SELECT city, date, {h} AS horizon, target_{h}d AS actual, {n} AS trial, mean_{n} AS predicted FROM trial_means"
        " WHERE " + " AND ".join(f"target_{k}d IS NOT NULL" for k in HORIZONS)
        for h in HORIZONS
        for n in (3, 5, 7, 14)
    )
    + ")",
}
PARTS["targeted_clean"] = (
    "SELECT *, " + ", ".join(f"lead(pm10, {h}) OVER s AS target_{h}d" for h in HORIZONS)
    + " FROM clean WINDOW s AS (PARTITION BY city ORDER BY date)"
)

# Which parts each part reads.
NEEDS = {
    "r0": ["raw"],
    "grid": ["r0"],
    "r": ["grid"],
    "points": ["r"],
    "neighbours": ["points"],
    "filled": ["neighbours"],
    "clean": ["filled"],
    "lagged": ["clean"],
    "targeted": ["lagged"],
    "p0": ["r"],
    "p": ["p0"],
    "log": ["p"],
    "long": ["targeted"],
    "targeted_clean": ["clean"],
    "trial_means": ["targeted_clean"],
    "trial_rows": ["trial_means"],
}


def sql(parts: str, body: str) -> str:
    """A query with the parts it needs in front, each after what it reads itself."""
    ordered: list[str] = []

    def add(name):
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in parts.split():
        add(name)
    ctes = ",\n".join(f"{name} AS ({PARTS[name]})" for name in ordered)
    return f"WITH {ctes}\n{body}"


def shown(columns) -> str:
    """Select list: `~` marks a double (4 places, no negative zero), `#` a whole number, `@` a day."""
    if isinstance(columns, str):
        columns = columns.split()
    forms = {
        "~": "round({0}, 4) + 0.0 AS {0}",
        "#": "CAST({0} AS BIGINT) AS {0}",
        "@": "CAST(CAST({0} AS DATE) AS VARCHAR) AS {0}",
    }
    return ", ".join(forms.get(c[0], "{0}").format(c.lstrip("~#@")) for c in columns)


def doubles(names) -> str:
    return " ".join(f"~{n}" for n in names)


READING = "city @date " + doubles(POLLUTANTS)
WEATHER = doubles(WEATHER_VARIABLES)
METRICS = """count(*) AS n, sqrt(avg((ACT - predicted) * (ACT - predicted))) AS rmse, avg(abs(ACT - predicted)) AS mae,
    CASE WHEN count(*) < 2 THEN 'NaN'::DOUBLE WHEN min(ACT) = max(ACT)
        THEN CASE WHEN sum((ACT - predicted) * (ACT - predicted)) = 0 THEN 1.0 ELSE 0.0 END
        ELSE 1 - sum((ACT - predicted) * (ACT - predicted)) / (count(*) * var_pop(ACT)) END AS r2"""


def metric(source: str, by: str = "", actual: str = "actual") -> str:
    keys = ", ".join(by.split())
    group = f" GROUP BY {keys}" if keys else ""
    return (
        f"SELECT {keys + ', ' if keys else ''}{METRICS.replace('ACT', actual)} FROM {source}"
        f" WHERE {actual} IS NOT NULL AND predicted IS NOT NULL{group}"
    )


def _windows(kinds) -> tuple[str, str]:
    exprs, names = [], []
    for p in POLLUTANTS:
        for kind in kinds:
            if kind == "rolling":
                exprs.append(
                    f"avg({p}) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
                    f" AS {p}_rolling_7d"
                )
                names.append(f"{p}_rolling_7d")
            else:
                exprs.append(f"lag({p}, {kind}) OVER (PARTITION BY city ORDER BY date) AS {p}_lag_{kind}d")
                names.append(f"{p}_lag_{kind}d")
    return ", ".join(exprs), doubles(names)


LAGS, LAG_NAMES = _windows((1, 7))
ROLLS, ROLL_NAMES = _windows(("rolling",))
STAGED = ", ".join(f"w.{raw} AS {STAGED_WEATHER_NAMES.get(raw, raw)}" for raw in WEATHER_VARIABLES)
STAGED_NAMES = doubles(STAGED_WEATHER_NAMES.get(raw, raw) for raw in WEATHER_VARIABLES)

CALENDAR = """month(date) AS month, year(date) AS year, isodow(date) - 1 AS day_of_week,
    sin(2 * pi() * dayofyear(date) / 365) AS day_of_year_sin, cos(2 * pi() * dayofyear(date) / 365) AS day_of_year_cos,
    sin(2 * pi() * (isodow(date) - 1) / 7) AS day_of_week_sin, cos(2 * pi() * (isodow(date) - 1) / 7) AS day_of_week_cos"""
CALENDAR_NAMES = "#month #year #day_of_week ~day_of_year_sin ~day_of_year_cos ~day_of_week_sin ~day_of_week_cos"
INTERACTIONS = """wind_speed_10m * cloud_cover AS wind_x_cloud, temperature_2m * relative_humidity_2m AS temp_x_humidity,
    precipitation * wind_speed_10m AS precip_x_wind, snow_depth * temperature_2m AS snow_x_temp"""
INTERACTION_NAMES = "~wind_x_cloud ~temp_x_humidity ~precip_x_wind ~snow_x_temp"
SPLIT = """CASE WHEN date <= DATE '1998-12-31' THEN 'train' WHEN date <= DATE '1999-12-31' THEN 'validation'
    WHEN date <= DATE '2000-12-31' THEN 'meta' ELSE 'test' END AS split"""

FEATURES = f"""SELECT city, date, {", ".join(POLLUTANTS)}, {LAGS}, {ROLLS} FROM r"""
MART = sql(
    "r w",
    f"SELECT {shown(READING + ' ' + LAG_NAMES + ' ' + ROLL_NAMES + ' ' + STAGED_NAMES)} FROM"
    f" (SELECT f.*, {STAGED} FROM ({FEATURES}) f LEFT JOIN w ON f.city = w.city AND f.date = w.date)",
)
REFRESH = sql(
    "r w",
    f"""SELECT {shown(READING + ' ' + LAG_NAMES + ' ' + ROLL_NAMES + ' ' + STAGED_NAMES)} FROM (SELECT f.*, {STAGED}
    FROM (SELECT * FROM (SELECT {FEATURES[7:-7]}, lo, hi,
    sum(CASE WHEN date > hi THEN 1 ELSE 0 END) OVER (PARTITION BY city ORDER BY date) AS behind
    FROM r JOIN (SELECT city AS changed_city, min(date) AS lo, max(date) AS hi FROM r0
    WHERE year(date) = 2000 AND month(date) BETWEEN 5 AND 6 GROUP BY city) ON city = changed_city)
    WHERE date >= lo AND behind <= 7) f LEFT JOIN w ON f.city = w.city AND f.date = w.date)""",
)
# The same on sparse series, whose lags reach over days without a reading.
REFRESH_SPARSE = sql("r0 w", REFRESH[REFRESH.index("\nSELECT") + 1 :].replace("FROM r JOIN", "FROM r0 JOIN").replace("FROM r WINDOW", "FROM r0 WINDOW"))
DAILY_MEAN = """SELECT date, city, avg(temperature_2m) AS temperature_2m, avg(relative_humidity_2m) AS relative_humidity_2m FROM h"""
DAILY_NAMES = "@date city ~temperature_2m ~relative_humidity_2m"
DAILY = sql("h", f"SELECT {shown(DAILY_NAMES)} FROM ({DAILY_MEAN} GROUP BY date, city)")
FLIGHTS = f"""SELECT CAST(user_id AS VARCHAR) AS icao24, epoch_us(ts) // 1000000 AS firstSeen,
    CASE WHEN event_type <> 'error' THEN event_type END AS estDepartureAirport,
    epoch_us(ts) // 1000000 + CAST(floor(value * 60) AS BIGINT) AS lastSeen, 'F' || event_id AS callsign, event_id FROM events"""
CORRECTIONS = "SELECT city, date + 1 AS date, pm25, pm10 * 2 AS pm10, o3, no2, co FROM r0 WHERE month(date) = 3"
R0_COLUMNS = "city, date, pm25, pm10, o3, no2, co"
REPLACED = sql(
    "r0",
    f"""SELECT {shown(READING)} FROM (SELECT {R0_COLUMNS} FROM r0 WHERE NOT EXISTS
    (SELECT 1 FROM ({CORRECTIONS}) n WHERE n.city = r0.city AND n.date = r0.date) UNION ALL {CORRECTIONS})""",
)
FORECAST = "city @forecast_date @target_date #horizon ~predicted ~actual"
METRIC_NAMES = "#n ~rmse ~mae ~r2"
BASELINES = """SELECT city, horizon, target, split, 'pm10_lag_1d' AS baseline, pm10_lag_1d AS predicted FROM long
    UNION ALL SELECT city, horizon, target, split, 'pm10_rolling_7d', pm10_rolling_7d FROM long"""
BLEND = """SELECT city, horizon, my - w1 * ma - w2 * mb AS w0, w1, w2 FROM (SELECT *,
    (cay * vbb - cby * cab) / (vaa * vbb - cab * cab) AS w1, (cby * vaa - cay * cab) / (vaa * vbb - cab * cab) AS w2
    FROM (SELECT city, horizon, avg(pm10_lag_1d) AS ma, avg(pm10_rolling_7d) AS mb, avg(target) AS my,
    var_pop(pm10_lag_1d) AS vaa, var_pop(pm10_rolling_7d) AS vbb, covar_pop(pm10_lag_1d, pm10_rolling_7d) AS cab,
    covar_pop(pm10_lag_1d, target) AS cay, covar_pop(pm10_rolling_7d, target) AS cby FROM long
    WHERE split = 'meta' AND pm10_lag_1d IS NOT NULL AND pm10_rolling_7d IS NOT NULL GROUP BY city, horizon))"""
TRIALS = lambda split: metric(f"(SELECT * FROM trial_rows WHERE split = '{split}')", "city horizon trial")
BEST = """SELECT *, row_number() OVER (PARTITION BY city, horizon ORDER BY rmse, trial) AS place
    FROM (SRC) WHERE rmse IS NOT NULL AND NOT isnan(rmse)"""
TARGETS = " ".join(f"~target_{h}d" for h in HORIZONS)
FRAME = f"""SELECT t.*, {SPLIT}, {", ".join(f"w.{v}" for v in WEATHER_VARIABLES)}, {INTERACTIONS}
    FROM targeted t LEFT JOIN w ON t.city = w.city AND t.date = w.date"""
FRAME = FRAME.replace("WHEN date", "WHEN t.date")
WHOLE = {"month", "year", "day_of_week"}
FEATURE_NAMES = " ".join(("#" if f in WHOLE else "~") + f for f in MODEL_FEATURES)

ORACLE = {
    "stg_air_quality": sql("r", f"SELECT {shown(READING)} FROM r"),
    "stg_weather": sql("w", f"SELECT {shown('city @date ' + STAGED_NAMES)} FROM (SELECT city, date, {STAGED} FROM w)"),
    "aq_weather_features": MART,
    "ml_features": MART,
    "mart_refresh": REFRESH,
    "merge_weather": sql(
        "r w",
        f"SELECT {shown(READING + ' ' + WEATHER)} FROM (SELECT r.*, w.* EXCLUDE (city, date) FROM r LEFT JOIN w"
        " ON r.city = w.city AND r.date = w.date)",
    ),
    "lag_features": sql("r", f"SELECT {shown(READING + ' ' + LAG_NAMES)} FROM ({FEATURES})"),
    "rolling_incl": sql("r", f"SELECT {shown(READING + ' ' + ROLL_NAMES)} FROM ({FEATURES})"),
    "rolling_excl_full": sql(
        "r",
        f"""SELECT {shown('city @date ~pm10 ~pm10_rolling_7d')} FROM (SELECT city, date, pm10,
        CASE WHEN count(pm10) OVER b = 7 THEN avg(pm10) OVER b END AS pm10_rolling_7d FROM r
        WINDOW b AS (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
    ),
    "bounded_interpolate": sql("filled", f"SELECT {shown('city @date ~pm10')} FROM filled"),
    "gap_drop": sql("clean", f"SELECT {shown('city @date ~pm10')} FROM clean"),
    "calendar_lags": sql(
        "clean",
        f"""SELECT {shown('city @date ~pm10 ~pm10_lag_1d ~pm10_lag_7d ~pm10_rolling_7d ' + TARGETS)} FROM (SELECT c.city, c.date, c.pm10,
        l1.pm10 AS pm10_lag_1d, l7.pm10 AS pm10_lag_7d, (SELECT CASE WHEN count(pm10) = 7 THEN avg(pm10) END FROM clean b
            WHERE b.city = c.city AND b.date BETWEEN c.date - 7 AND c.date - 1) AS pm10_rolling_7d, """
        + ", ".join(f"t{h}.pm10 AS target_{h}d" for h in HORIZONS)
        + " FROM clean c LEFT JOIN clean l1 ON l1.city = c.city AND l1.date = c.date - 1 LEFT JOIN clean l7 ON l7.city = c.city AND l7.date = c.date - 7 "
        + " ".join(f"LEFT JOIN clean t{h} ON t{h}.city = c.city AND t{h}.date = c.date + {h}" for h in HORIZONS)
        + ")",
    ),
    "targets": sql(
        "r",
        f"SELECT {shown('city @date ~pm10 ' + TARGETS)} FROM (SELECT city, date, pm10, "
        + ", ".join(f"lead(pm10, {h}) OVER (PARTITION BY city ORDER BY date) AS target_{h}d" for h in HORIZONS)
        + " FROM r) WHERE "
        + " AND ".join(f"target_{h}d IS NOT NULL" for h in HORIZONS),
    ),
    "latest_row": sql(
        "lagged",
        f"SELECT {shown(READING + ' ~pm10_lag_1d ~pm10_lag_7d ~pm10_rolling_7d')} FROM (SELECT *, row_number() OVER"
        " (PARTITION BY city ORDER BY date DESC) AS place FROM lagged) WHERE place = 1",
    ),
    "calendar_features": sql(
        "r", f"SELECT {shown('city @date ' + CALENDAR_NAMES)} FROM (SELECT city, date, {CALENDAR} FROM r)"
    ),
    "interaction_features": sql(
        "w", f"SELECT {shown('city @date ' + WEATHER + ' ' + INTERACTION_NAMES)} FROM (SELECT *, {INTERACTIONS} FROM w)"
    ),
    "training_frame": sql(
        "targeted w",
        f"SELECT {shown('city @date split ~pm10 ' + FEATURE_NAMES + ' ' + TARGETS)} FROM"
        f" (SELECT *, {CALENDAR} FROM ({FRAME}))",
    ),
    "chrono_split": sql(
        "targeted",
        f"SELECT {shown('city split #rows @first_date @last_date')} FROM (SELECT city, split, count(*) AS rows,"
        f" min(date) AS first_date, max(date) AS last_date FROM (SELECT *, {SPLIT} FROM targeted) GROUP BY city, split)",
    ),
    "json_doc_scan": sql(
        "h",
        f"""SELECT {shown('city @date #part #times first_time ~temperature_sum')} FROM (SELECT city, date, part,
        count(*) AS times, min(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS first_time,
        sum(temperature_2m) AS temperature_sum FROM h GROUP BY city, date, part)""",
    ),
    "hourly_unnest": sql(
        "h",
        f"""SELECT {shown('city #part timestamp ~temperature_2m ~relative_humidity_2m')} FROM (SELECT city, part,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, temperature_2m,
        CASE WHEN row_number() OVER (PARTITION BY city, date, part ORDER BY event_id DESC) > part % 3 AND part % 5 <> 1
        THEN relative_humidity_2m END AS relative_humidity_2m,
        row_number() OVER (PARTITION BY city, date, part ORDER BY event_id) AS place FROM h)
        WHERE part % 7 <> 3 OR place > 1""",
    ),
    "document_quarantine": sql(
        "h",
        f"""SELECT {shown('city @date #part text reason')} FROM (SELECT DISTINCT city, date, part,
        CASE WHEN part % 11 <> 5 THEN 'not a time' END AS text,
        CASE WHEN part % 11 <> 5 THEN 'time not readable' ELSE 'no hourly data' END AS reason FROM h
        WHERE part % 11 = 5 OR part % 7 = 3)""",
    ),
    "daily_run_readings": sql("r0", f"SELECT {shown(READING)} FROM r0 WHERE day(date) NOT IN (13, 29)"),
    "daily_run_rejected": sql(
        "r0",
        f"""SELECT {shown('city reason #rows')} FROM (SELECT city, CASE WHEN day(date) = 13 THEN 'status not ok'
        ELSE 'no date' END AS reason, 2 * count(*) AS rows FROM r0 WHERE day(date) IN (13, 29) GROUP BY 1, 2)""",
    ),
    "daily_run_weather": DAILY,
    "lake_rejected_rows": sql(
        "r0", "SELECT city, 'no date' AS reason, count(*) AS rows, round(sum(pm10), 4) AS pm10 FROM r0 WHERE dayofmonth(date) = 31 GROUP BY city"
    ),
    "lake_weather": DAILY,
    "stream_late_hours": DAILY,
    "lake_readings": sql("r0", f"SELECT {shown(READING)} FROM r0 WHERE day(date) <> 31"),
    "lake_rejected": sql(
        "r0",
        f"""SELECT {shown('city text reason #rows')} FROM (SELECT city, 'never' AS text, 'no date' AS reason, 1 AS rows
        FROM r0 WHERE day(date) = 31 GROUP BY city)""",
    ),
    "history_bootstrap": sql(
        "r0",
        f"""SELECT {shown(READING)} FROM (SELECT {R0_COLUMNS} FROM r0 WHERE city NOT IN ('5-LOW', '2-HIGH') UNION ALL
        SELECT city, date, pm25, pm10 * 2, o3, no2, co FROM r0 WHERE city IN ('5-LOW', '2-HIGH') AND year(date) >= 1996)""",
    ),
    "history_weather": sql(
        "w r0",
        f"""SELECT {shown('city @date ~temperature_2m ~relative_humidity_2m')} FROM w JOIN (SELECT city, min(date) AS a,
        max(date) AS b FROM r0 GROUP BY city) USING (city) WHERE date BETWEEN a AND b""",
    ),
    "weather_silver": sql(
        "h",
        f"""SELECT {shown('airport timestamp ~temperature_2m ~relative_humidity_2m #year #month')} FROM (SELECT city AS airport,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, year(ts) AS year, month(ts) AS month, temperature_2m, part,
        CASE WHEN row_number() OVER (PARTITION BY city, date, part ORDER BY event_id DESC) > part % 3 AND part % 5 <> 1
        THEN relative_humidity_2m END AS relative_humidity_2m,
        row_number() OVER (PARTITION BY city, date, part ORDER BY event_id) AS place FROM h)
        WHERE (part % 7 <> 3 OR place > 1) AND relative_humidity_2m IS NOT NULL""",
    ),
    "daily_run_log": sql("log", f"SELECT {shown(FORECAST)} FROM log"),
    "csv_quarantine": sql(
        "r0",
        f"""SELECT {shown('city text reason #rows')} FROM (SELECT city, CASE WHEN day(date) = 17 THEN 'some day' END AS text,
        CASE WHEN day(date) = 17 THEN 'day not readable' ELSE 'no day' END AS reason, count(*) AS rows
        FROM r0 WHERE day(date) IN (17, 23) GROUP BY ALL)""",
    ),
    "ragged_audit": sql(
        "h",
        f"""SELECT {shown('city @date #part #times #shortest #longest')} FROM (SELECT city, date, part, count(*) AS times,
        CASE WHEN part % 5 = 1 THEN 0 ELSE greatest(count(*) - part % 3, 0) END AS shortest, count(*) AS longest FROM h GROUP BY city, date, part)
        WHERE shortest <> times""",
    ),
    "daily_mean": DAILY,
    "stream_daily_mean": DAILY,
    "stream_hours": DAILY,
    "partition_pruned_scan": sql(
        "h",
        f"SELECT {shown(DAILY_NAMES)} FROM ({DAILY_MEAN} WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"
        " GROUP BY date, city)",
    ),
    "flights_silver": f"""SELECT {shown('icao24 estDepartureAirport callsign')},
        strftime(make_timestamp(firstSeen * 1000000), '%Y-%m-%d %H:%M:%S') AS firstSeen_ts,
        strftime(make_timestamp(lastSeen * 1000000), '%Y-%m-%d %H:%M:%S') AS lastSeen_ts,
        round((lastSeen - firstSeen) / 60.0, 4) + 0.0 AS duration_minutes,
        CAST(year(make_timestamp(firstSeen * 1000000)) AS BIGINT) AS year,
        CAST(month(make_timestamp(firstSeen * 1000000)) AS BIGINT) AS month
        FROM (SELECT *, row_number() OVER (PARTITION BY icao24, firstSeen ORDER BY estDepartureAirport, lastSeen, callsign) AS place FROM ({FLIGHTS})
        WHERE estDepartureAirport IS NOT NULL AND icao24 IS NOT NULL AND firstSeen IS NOT NULL AND lastSeen IS NOT NULL)
        WHERE place = 1""",
    "dedup_latest": f"""SELECT icao24, CAST(day AS VARCHAR) AS day, event_id, firstSeen, lastSeen FROM (SELECT *,
        row_number() OVER (PARTITION BY icao24, day ORDER BY firstSeen DESC, event_id DESC) AS place
        FROM (SELECT *, CAST(make_timestamp(firstSeen * 1000000) AS DATE) AS day FROM ({FLIGHTS}))) WHERE place = 1""",
    "api_response_flatten": sql("r0", f"SELECT {shown(READING)} FROM r0 WHERE day(date) NOT IN (13, 29)"),
    "quarantine_split": sql(
        "r0",
        f"""SELECT {shown('city reason #rows')} FROM (SELECT city, CASE WHEN day(date) = 13 THEN 'status not ok'
        WHEN day(date) = 29 THEN 'no date' ELSE 'usable' END AS reason, count(*) AS rows FROM r0 GROUP BY 1, 2)""",
    ),
    "csv_clean": sql("r0", f"SELECT {shown(READING)} FROM r0"),
    "parquet_concat": sql("r0", f"SELECT {shown(READING)} FROM r0"),
    "path_metadata": "SELECT DISTINCT event_type AS city, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events",
    "list_dates": "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events ORDER BY date",
    "replace_by_key": REPLACED,
    "merge_by_month": REPLACED,
    "versioned_merge": REPLACED,
    "versioned_counts": sql(
        "r0",
        f"""SELECT city, year(date) AS year, month(date) AS month, count(*) AS rows, CAST(min(date) AS VARCHAR) AS first_date,
        CAST(max(date) AS VARCHAR) AS last_date FROM ({REPLACED[REPLACED.index("(SELECT " + R0_COLUMNS) + 1:-1]}) GROUP BY ALL""",
    ),
    "mart_refresh_stored": REFRESH_SPARSE,
    "replace_series": sql(
        "r0",
        f"""SELECT {shown(READING)} FROM (SELECT {R0_COLUMNS} FROM r0 WHERE city <> '5-LOW' UNION ALL
        SELECT city, date, pm25, pm10 * 2, o3, no2, co FROM r0 WHERE city = '5-LOW' AND year(date) >= 1998)""",
    ),
    "dynamic_overwrite": sql(
        "r0",
        f"""SELECT {shown(READING)} FROM (SELECT city, date, pm25, CASE WHEN month(date) = 3 THEN pm10 * 2 ELSE pm10 END
        AS pm10, o3, no2, co FROM r0 WHERE month(date) <> 3 OR day(date) <= 10 OR NOT EXISTS (SELECT 1 FROM r0 e
        WHERE month(e.date) = 3 AND day(e.date) <= 10 AND year(e.date) = year(r0.date)))""",
    ),
    "update_actuals": sql("log", f"SELECT {shown(FORECAST)} FROM log"),
    "upsert_predictions": sql(
        "log",
        f"""SELECT {shown(FORECAST)} FROM (SELECT city, forecast_date, horizon,
        CASE WHEN min(fresh) = 0 THEN max(target_date) FILTER (fresh = 0) ELSE max(target_date) END AS target_date,
        coalesce(max(predicted) FILTER (fresh = 1), max(predicted)) AS predicted,
        CASE WHEN min(fresh) = 0 THEN max(actual) FILTER (fresh = 0) ELSE max(actual) END AS actual
        FROM (SELECT city, forecast_date, horizon, target_date, predicted, actual, 0 AS fresh FROM log
        UNION ALL SELECT city, forecast_date + 30, horizon, target_date + 31, predicted * 1.5, predicted * 0.1, 1 FROM log)
        GROUP BY city, forecast_date, horizon)""",
    ),
    "contract_audit": sql(
        "raw",
        """SELECT 'not null' AS rule, 'city' AS "column", count(*) - count(city) AS breaches FROM raw
        UNION ALL SELECT 'not null', 'date', count(*) - count(date) FROM raw
        UNION ALL SELECT 'not null', 'pm25', count(*) - count(pm25) FROM raw
        UNION ALL SELECT 'not null', 'pm10', count(*) - count(pm10) FROM raw
        UNION ALL SELECT 'unique', 'city,date', count(*) FROM
        (SELECT 1 FROM raw GROUP BY city, date HAVING count(*) > 1)""",
    ),
    "row_count_by_key": sql("raw", "SELECT city, count(*) AS rows FROM raw GROUP BY city"),
    "high_water_mark": sql(
        "raw", "SELECT CAST(coalesce(max(date), DATE '2026-01-01') AS VARCHAR) AS high_water_mark FROM raw"
    ),
    "date_bounds": sql(
        "raw",
        f"SELECT {shown('city @first_date @last_date')} FROM (SELECT city, min(date) AS first_date,"
        " max(date) AS last_date FROM raw GROUP BY city)",
    ),
    "backfill_dates": sql(
        "raw dim",
        """SELECT city, strftime(day, '%Y-%m-%d') AS date FROM (SELECT city, unnest(generate_series(mark + INTERVAL 1 DAY,
        TIMESTAMP '2001-08-10', INTERVAL 1 DAY)) AS day FROM (SELECT dim.city, coalesce(max(date), DATE '2026-01-01') AS mark
        FROM dim LEFT JOIN raw ON dim.city = raw.city GROUP BY dim.city))""",
    ),
    "missing_days": sql(
        "r0",
        """SELECT city, CAST(date AS VARCHAR) AS date FROM (SELECT city, CAST(unnest(generate_series(min(date), max(date),
        INTERVAL 1 DAY)) AS DATE) AS date FROM r0 GROUP BY city) g
        WHERE NOT EXISTS (SELECT 1 FROM r0 WHERE r0.city = g.city AND r0.date = g.date)""",
    ),
    "city_dim_join": sql(
        "r0 dim",
        f"""SELECT {shown('city @date ~pm10 ~lat ~lon #station_id')} FROM (SELECT r0.city, date, pm10,
        CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, station_id FROM r0 JOIN dim ON r0.city = dim.city)""",
    ),
    "forecast_rows": sql(
        "lagged",
        f"""SELECT {shown('city @forecast_date @target_date @seasonal_date #horizon model ~predicted')} FROM (SELECT city,
        DATE '2001-08-03' AS forecast_date, DATE '2001-08-03' + h AS target_date, date + h AS seasonal_date, h AS horizon,
        'pm10_' || lower(city) || '_' || h || 'd' AS model, pm10_rolling_7d AS predicted FROM (SELECT *, row_number() OVER
        (PARTITION BY city ORDER BY date DESC) AS place FROM lagged), (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS h)
        WHERE place = 1)""",
    ),
    "forecast_latest": sql(
        "log dim",
        f"""SELECT {shown(FORECAST)} FROM (SELECT * FROM log WHERE lower(city) = '5-low'
        AND lower(city) IN (SELECT lower(city) FROM dim) ORDER BY forecast_date DESC, horizon LIMIT 7)""",
    ),
    "history_last_n": sql(
        "r0 dim",
        f"""SELECT {shown('@date city ~pm10')} FROM (SELECT * FROM r0 WHERE lower(city) = '5-low'
        AND lower(city) IN (SELECT lower(city) FROM dim) ORDER BY date DESC LIMIT 30)""",
    ),
    "topn_per_city": sql(
        "log",
        f"""SELECT {shown(FORECAST)} FROM (SELECT *, row_number() OVER (PARTITION BY city
        ORDER BY forecast_date DESC, horizon) AS place FROM log) WHERE place <= 7""",
    ),
    "regression_metrics": sql("log", f"SELECT {shown(METRIC_NAMES)} FROM ({metric('log')})"),
    "metrics_by_horizon": sql(
        "log", f"SELECT {shown('#horizon ' + METRIC_NAMES)} FROM ({metric('log', 'horizon')}) ORDER BY horizon"
    ),
    "metrics_by_city_horizon": sql(
        "log", f"SELECT {shown('city #horizon ' + METRIC_NAMES)} FROM ({metric('log', 'city horizon')})"
    ),
    "baseline_metrics": sql(
        "long",
        f"SELECT {shown('baseline #horizon ' + METRIC_NAMES)} FROM"
        f" ({metric('(SELECT * FROM (' + BASELINES + ') WHERE split = ' + chr(39) + 'test' + chr(39) + ')', 'baseline horizon', 'target')})",
    ),
    "stack_blend_fit": sql("long", f"SELECT {shown('city #horizon ~w0 ~w1 ~w2')} FROM ({BLEND})"),
    "stack_blend_score": sql(
        "long",
        f"""SELECT {shown('city #horizon ' + METRIC_NAMES)} FROM ({metric(
        '(SELECT long.city, long.horizon, target, w0 + w1 * pm10_lag_1d + w2 * pm10_rolling_7d AS predicted FROM long JOIN ('
        + BLEND + ") b ON long.city = b.city AND long.horizon = b.horizon WHERE split = 'test')", 'city horizon', 'target')})""",
    ),
    "seasonal_means": sql(
        "r",
        f"""SELECT {shown('city kind #part ~mean #n')} FROM (SELECT city, 'weekday' AS kind, isodow(date) - 1 AS part,
        avg(pm10) AS mean, count(pm10) AS n FROM r WHERE date <= DATE '1998-12-31' GROUP BY 1, 2, 3 UNION ALL
        SELECT city, 'month', month(date), avg(pm10), count(pm10) FROM r WHERE date <= DATE '1998-12-31' GROUP BY 1, 2, 3)""",
    ),
    "trial_select": sql(
        "trial_rows",
        f"SELECT {shown('city #horizon #trial ~rmse')} FROM ({BEST.replace('SRC', TRIALS('validation'))}) WHERE place = 1",
    ),
    "champion_select": sql(
        "trial_rows",
        f"""SELECT 'pm10_' || lower(city) || '_' || horizon || 'd' AS model, {shown('#trial ~rmse ~mae ~r2')}
        FROM ({BEST.replace('SRC', TRIALS('test'))}) WHERE place = 1""",
    ),
}
# The terms of the seasonal model at a day, and their products with the values: both sides of the normal equations.
ANGLES = [(365.25, k) for k in range(1, 11)] + [(7.0, k) for k in range(1, 4)]
SEASONAL_TERMS = "[1.0, d / 365.25, " + ", ".join(f"{f}(d * (2 * pi() * {k} / {p}))" for p, k in ANGLES for f in ("sin", "cos")) + "]"
ORACLE["seasonal_equations"] = sql(
    "clean",
    f"""SELECT city, CAST(term - 1 AS BIGINT) AS term, count(*) AS rows, round(avg(x * pm10), 4) + 0.0 AS with_values,
    round(avg(x * pm10), 4) + 0.0 AS with_fit FROM (SELECT city, pm10, unnest({SEASONAL_TERMS}) AS x, unnest(range(1, 29)) AS term
    FROM (SELECT *, date_diff('day', DATE '2000-01-01', date)::DOUBLE AS d FROM clean WHERE date <= DATE '1998-12-31')) GROUP BY city, term""",
)
# What full-size forecasters must be; the rows and the error of persistence (lag 1) come from the series.
ORACLE["full_fit_checks"] = sql(
    "long",
    """SELECT city, CAST(horizon AS BIGINT) AS horizon, count(*) AS n, round(sqrt(avg((target - pm10_lag_1d) * (target - pm10_lag_1d))), 4) + 0.0 AS persistence,
    TRUE AS finite, TRUE AS repeatable, TRUE AS better FROM long WHERE split = 'test' AND target IS NOT NULL AND pm10_lag_1d IS NOT NULL
    GROUP BY city, horizon""",
)

# The stored forms give the same rows.
ORACLE |= {
    "forecast_latest_stored": ORACLE["forecast_latest"],
    "history_stored": ORACLE["history_last_n"],
    "pending_stored": ORACLE["backfill_dates"],
}
