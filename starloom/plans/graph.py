"""Graph edges: one flat row per ride from station to station."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.functions.dates import minutes_between
from starloom.operators.joins import lookup
from starloom.plans.rides import with_user

# Columns of an edge.
EDGE_COLUMNS = [
    "rideid",
    "user_sk",
    "vehicleid",
    "start_station_id",
    "end_station_id",
    "start_district",
    "end_district",
    "ride_duration",
    "datetime",
]


def rides_between(rides: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Rides that start on a day of the closed range and take some time."""
    return (
        rides.where(f"to_date(starttime) BETWEEN date'{first_day}' AND date'{last_day}'")
        .withColumn("ride_duration", minutes_between("starttime", "endtime"))
        .where("ride_duration > 0")
    )


def _district(rides: DataFrame, stations: DataFrame, role: str, station: str) -> DataFrame:
    return lookup(
        rides, stations, {station: "stationid"}, {f"{role}_district": "district"}
    )


def ride_edges(
    rides: DataFrame,
    stations: DataFrame,
    subscriptions: DataFrame,
    users: DataFrame,
    first_day: str,
    last_day: str,
) -> DataFrame:
    """Edges where the lock numbers are taken for station numbers."""
    edges = rides_between(rides, first_day, last_day)
    for role in ("start", "end"):
        edges = edges.selectExpr("*", f"{role}lockid AS {role}_station_id")
        edges = _district(edges, stations, role, f"{role}_station_id")
    return _finish(edges, subscriptions, users).select(*EDGE_COLUMNS)


def ride_edges_via_locks(
    rides: DataFrame,
    locks: DataFrame,
    stations: DataFrame,
    subscriptions: DataFrame,
    users: DataFrame,
    first_day: str,
    last_day: str,
    limit: int | None = None,
) -> DataFrame:
    """Edges between the stations of the locks; only those with a vehicle, a user and stations.

    With a ``limit`` the first edges in the order of all columns are kept, so a repeated export
    is the same.
    """
    edges = rides_between(rides, first_day, last_day)
    for role in ("start", "end"):
        edges = lookup(
            edges, locks, {f"{role}lockid": "lockid"}, {f"{role}_station_id": "stationid"}
        )
        edges = _district(edges, stations, role, f"{role}_station_id")
    complete = _finish(edges, subscriptions, users).dropna(
        subset=["vehicleid", "user_sk", "start_station_id", "end_station_id"]
    )
    edges = complete.select(*EDGE_COLUMNS)
    return edges if limit is None else edges.orderBy(*EDGE_COLUMNS).limit(limit)


def _finish(edges: DataFrame, subscriptions: DataFrame, users: DataFrame) -> DataFrame:
    """The vehicle needs no lookup: an edge only carries its number."""
    return with_user(edges, subscriptions, users).selectExpr(
        "*", "starttime AS datetime"
    )
