"""Values that results depend on."""

from datetime import date

# Column names of the readings and of the weather table.
POLLUTANTS = ["pm25", "pm10", "o3", "no2", "co"]

READING_COLUMNS = ["date", "city", "pm25", "pm10", "o3", "no2", "co"]

WEATHER_VARIABLES = [
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "wind_gusts_10m",
    "wind_direction_10m",
    "precipitation",
    "snowfall",
    "snow_depth",
    "cloud_cover",
    "surface_pressure",
    "weather_code",
]

# Names of the weather columns in the staging layer.
STAGED_WEATHER_NAMES = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "humidity_pct",
    "wind_speed_10m": "wind_speed_kmh",
    "wind_gusts_10m": "wind_gusts_kmh",
    "wind_direction_10m": "wind_direction_deg",
    "precipitation": "precipitation_mm",
    "snowfall": "snowfall_cm",
    "snow_depth": "snow_depth_m",
    "cloud_cover": "cloud_cover_pct",
    "surface_pressure": "surface_pressure_hpa",
}

# The 25 model inputs.
LAG_FEATURES = ["pm10_lag_1d", "pm10_lag_7d", "pm10_rolling_7d"]
INTERACTION_FEATURES = ["wind_x_cloud", "temp_x_humidity", "precip_x_wind", "snow_x_temp"]
CALENDAR_FEATURES = [
    "month",
    "year",
    "day_of_week",
    "day_of_year_sin",
    "day_of_year_cos",
    "day_of_week_sin",
    "day_of_week_cos",
]
MODEL_FEATURES = LAG_FEATURES + WEATHER_VARIABLES + INTERACTION_FEATURES + CALENDAR_FEATURES

# Forecast horizons in days and the longest gap that is filled.
HORIZONS = [1, 2, 3, 4, 5, 6, 7]
MAX_GAP = 7

# Last day of the train, validation and meta splits.
TRAIN_END = date(2021, 12, 31)
VALIDATION_END = date(2022, 12, 31)
META_END = date(2024, 12, 31)

# Fixed value: where a back-fill starts when nothing is stored yet.
DEFAULT_HIGH_WATER_MARK = date(2026, 1, 1)

# City, latitude, longitude, station.
CITIES = [
    ("Berlin", 52.52, 13.40, 6132),
    ("London", 51.51, -0.13, 5724),
    ("Paris", 48.86, 2.35, 5722),
    ("Amsterdam", 52.37, 4.90, 5771),
]

# Hyper-parameter ranges of the tree search, and its trial count.
TRIAL_RANGES = {
    "trees": (100, 500),
    "learning_rate": (0.01, 0.3),
    "depth": (3, 8),
    "row_sample": (0.6, 1.0),
    "column_sample": (0.6, 1.0),
}
TRIAL_COUNT = 50


def target_name(horizon: int) -> str:
    return f"target_{horizon}d"
