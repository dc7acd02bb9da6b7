"""Products of weather variables used as model inputs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which two variables each interaction multiplies.
INTERACTIONS = {
    "wind_x_cloud": ("wind_speed_10m", "cloud_cover"),
    "temp_x_humidity": ("temperature_2m", "relative_humidity_2m"),
    "precip_x_wind": ("precipitation", "wind_speed_10m"),
    "snow_x_temp": ("snow_depth", "temperature_2m"),
}


def interaction_columns() -> dict[str, Column]:
    return {name: F.col(a) * F.col(b) for name, (a, b) in INTERACTIONS.items()}
