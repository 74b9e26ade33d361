"""Hourly weather per place and day, from payloads of a weather service.

The payloads arrive as a table (zipcode, ride_date, payload); fetching them is not part of
the library. A payload is the JSON text {"hourly": {"temperature_2m": [...],
"precipitation": [...], "weathercode": [...]}} with one value per hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.geo import point_latitude, point_longitude
from starloom.functions.weather import weather_category
from starloom.operators.joins import lookup

# The shape of a payload.
PAYLOAD_SCHEMA = (
    "hourly struct<temperature_2m: array<double>, precipitation: array<double>, "
    "weathercode: array<int>>"
)


def weather_requests(rides: DataFrame, locks: DataFrame, stations: DataFrame) -> DataFrame:
    """The distinct places and days to ask for: (zipcode, ride_date, lat, lon).

    Places without coordinates and rides without a start are left out.
    """
    located = stations.withColumns(
        {"lat": point_latitude("gpscoord"), "lon": point_longitude("gpscoord")}
    )
    wanted = {name: name for name in ("zipcode", "lat", "lon")}
    placed = lookup(locks, located, {"stationid": "stationid"}, wanted)
    started = lookup(
        rides.selectExpr("startlockid", "to_date(starttime) AS ride_date"),
        placed,
        {"startlockid": "lockid"},
        wanted,
    )
    return (
        started.select("zipcode", "ride_date", "lat", "lon")
        .dropna(subset=["ride_date", "lat", "lon"])
        .distinct()
    )


def hourly_weather(payloads: DataFrame) -> DataFrame:
    """(zipcode, ride_date, hour, temperature, weather_description), a row per hour of a payload.

    A day has as many hours as its payload has values, be it 23 or 25. A missing measurement
    makes the hour 'Unknown' and leaves the other hours of the day alone. What is no payload
    gives no row.
    """
    hourly = payloads.withColumn("hourly", F.from_json("payload", PAYLOAD_SCHEMA)["hourly"])
    fields = ("temperature_2m", "precipitation", "weathercode")
    present = [f"coalesce(hourly.{name}, array())" for name in fields]
    measured = hourly.selectExpr(
        "try_cast(zipcode AS int) AS zipcode",
        "ride_date",
        *[f"{value} AS {name}" for value, name in zip(present, fields)],
    ).selectExpr(
        "zipcode", "ride_date", f"posexplode(arrays_zip({', '.join(fields)})) AS (hour, at)"
    )
    category = weather_category("at.temperature_2m", "at.precipitation", "at.weathercode")
    return measured.select(
        "zipcode",
        "ride_date",
        "hour",
        F.col("at.temperature_2m").alias("temperature"),
        category.alias("weather_description"),
    )
