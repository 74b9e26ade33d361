"""The ride star: dimensions and the ride fact.

Input columns are those of the operational tables: ``rides`` (rideid, starttime, endtime,
startlockid, endlockid, vehicleid, subscriptionid, start_lat, start_lon, end_lat, end_lon),
``locks``, ``stations``, ``vehicles``, ``bikelots``, ``bike_types``, ``users``,
``subscriptions``, ``subscription_types`` and hourly ``weather``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from starloom.functions.dates import minutes_between, period_end
from starloom.functions.geo import haversine_km
from starloom.functions.hashing import row_hash_sql
from starloom.functions.weather import UNKNOWN
from starloom.operators.joins import lookup, lookup_day, lookup_in_range
from starloom.plans.calendar import ride_date_dimension
from starloom.sources.files import rows_with_schema

# Columns of the lock dimension and its row for rides without a lock.
LOCK_SCHEMA = (
    "lock_id string, station_id string, station_nr string, street string, number string, "
    "zipcode string, district string, gps_coord string"
)
NO_LOCK = (None, None, "no lock", None, None, None, None, None)


def lock_dimension(locks: DataFrame, stations: DataFrame) -> DataFrame:
    """Every lock with its station, all text, and one row that stands for no lock."""
    known = locks.join(stations, "stationid").selectExpr(
        "cast(lockid as string) as lock_id",
        "cast(stationid as string) as station_id",
        "cast(stationnr as string) as station_nr",
        "street",
        "cast(number as string) as number",
        "cast(zipcode as string) as zipcode",
        "district",
        "gpscoord as gps_coord",
    )
    return known.union(rows_with_schema(locks.sparkSession, [NO_LOCK], LOCK_SCHEMA))


def user_dimension(
    users: DataFrame, subscriptions: DataFrame, subscription_types: DataFrame
) -> DataFrame:
    """One row per subscription of a user; the key is a hash, survives a reload and tells two
    subscriptions of the same days apart."""
    periods = (
        subscriptions.join(subscription_types, "subscriptiontypeid")
        .join(users, "userid")
        .withColumn("end_date", period_end("validfrom", "description"))
    )
    return periods.selectExpr(
        f"{row_hash_sql('userid', 'subscriptionid', 'validfrom', 'end_date')} AS user_sk",
        "userid AS user_id",
        "street",
        "number",
        "zipcode",
        "city",
        "country_code",
        "validfrom AS start_date",
        "end_date",
    )


def vehicle_dimension(bike_types: DataFrame) -> DataFrame:
    return bike_types.selectExpr("biketypeid AS vehicle_id", "biketypedescription AS type")


def weather_dimension(weather_types: DataFrame) -> DataFrame:
    return weather_types.select("weather_id", "weather_type")


def vehicle_types(vehicles: DataFrame, bikelots: DataFrame, bike_types: DataFrame) -> DataFrame:
    """Vehicles that have a lot and a type, with the type's description."""
    return (
        vehicles.join(bikelots, "bikelotid")
        .join(bike_types, "biketypeid")
        .selectExpr("vehicleid as vehicle_id", "biketypedescription as type")
    )


def vehicle_lookup(
    vehicles: DataFrame, bikelots: DataFrame, bike_types: DataFrame, vehicle_dim: DataFrame
) -> DataFrame:
    """vehicle -> lot -> type -> key in the vehicle dimension; missing hops give null."""
    typed = lookup(vehicles, bikelots, {"bikelotid": "bikelotid"}, {"biketypeid": "biketypeid"})
    described = lookup(
        typed, bike_types, {"biketypeid": "biketypeid"}, {"type": "biketypedescription"}
    )
    return lookup(described, vehicle_dim, {"type": "type"}, {"vehicle_id": "vehicle_id"}).select(
        "vehicleid", "vehicle_id"
    )


@dataclass(frozen=True)
class RideDimensions:
    """What the fact looks its keys up in."""

    locks: DataFrame
    users: DataFrame
    dates: DataFrame
    weather_types: DataFrame
    vehicles: DataFrame  # vehicleid, vehicle_id
    subscriptions: DataFrame
    weather: DataFrame  # zipcode, ride_date, hour, weather_description


def with_locks(rides: DataFrame, locks: DataFrame) -> DataFrame:
    """Rides whose two locks exist, with both keys and the zip code of the start."""
    started = lookup(
        rides,
        locks,
        {"startlockid": "try_cast(lock_id AS bigint)"},
        {"start_lock_id": "lock_id", "zipcode": "try_cast(zipcode AS int)"},
        "inner",
    )
    return lookup(
        started,
        locks,
        {"endlockid": "try_cast(lock_id AS bigint)"},
        {"end_lock_id": "lock_id"},
        "inner",
    )


def with_subscriber(rides: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Add ``userid`` by the ride's subscription."""
    return lookup(
        rides, subscriptions, {"subscriptionid": "subscriptionid"}, {"userid": "userid"}
    )


def with_period(rides: DataFrame, users: DataFrame, day: str) -> DataFrame:
    """Add ``user_sk`` by ``userid`` and the period that holds ``day``.

    Periods are closed on both ends. A day that two periods of a user share gives the ride
    once per period. Periods are listed per year, so a ride of a user with thousands of day
    tickets meets those of its year only, and a period of a year is listed twice at most; per month
    it would be listed thirteen times.
    """
    return lookup_in_range(
        rides,
        users,
        {"userid": "user_id"},
        day,
        "start_date",
        "end_date",
        {"user_sk": "user_sk"},
        start_included=True,
        bucket="year",
    )


def with_user(rides: DataFrame, subscriptions: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``user_sk``: the ride's subscription names the user, the ride's day the period."""
    return with_period(with_subscriber(rides, subscriptions), users, "to_date(starttime)")


def with_weather(rides: DataFrame, weather: DataFrame, weather_types: DataFrame) -> DataFrame:
    """Add ``weather_id`` by zip code, day and hour of the start."""
    timed = rides.selectExpr(
        "*", "to_date(starttime) AS ride_date", "hour(starttime) AS ride_hour"
    )
    measured = lookup(
        timed,
        weather,
        {"zipcode": "zipcode", "ride_date": "ride_date", "ride_hour": "hour"},
        {"weather_description": "weather_description"},
    )
    typed = measured.selectExpr(
        "*", f"coalesce(weather_description, '{UNKNOWN}') AS weather_type"
    )
    return lookup(
        typed, weather_types, {"weather_type": "weather_type"}, {"weather_id": "weather_id"}
    )


def ride_fact(rides: DataFrame, dims: RideDimensions) -> DataFrame:
    """One row per ride (and valid user period) with a duration that is not negative.

    Rides are shuffled for dimensions too large to broadcast, as a rule by subscription, vehicle and
    user. Those come last, when a ride's day is all that is left of its times, and the long
    keys that they add (of the vehicle, of the period) are added as late as can be.
    """
    measured = (
        rides.withColumn("ride_duration", minutes_between("starttime", "endtime"))
        .where("ride_duration >= 0")
        .withColumn("ride_distance", haversine_km("start_lat", "start_lon", "end_lat", "end_lon"))
        .drop("start_lat", "start_lon", "end_lat", "end_lon", "endtime")
    )
    placed = with_weather(with_locks(measured, dims.locks), dims.weather, dims.weather_types)
    known = with_subscriber(placed, dims.subscriptions)
    typed = lookup(known, dims.vehicles, {"vehicleid": "vehicleid"}, {"vehicle_id": "vehicle_id"})
    owned = with_period(typed, dims.users, "ride_date")
    dated = lookup_day(owned, dims.dates, "ride_date", "date", {"date_sk": "date_sk"})
    return dated.selectExpr(
        "rideid AS ride_id",
        "user_sk",
        "start_lock_id",
        "end_lock_id",
        "date_sk",
        "weather_id",
        "vehicle_id",
        "ride_distance",
        "ride_duration",
    )


def _as_it_is(name: str, df: DataFrame) -> DataFrame:
    return df


def ride_dimensions(
    tables: Mapping[str, DataFrame], store: Callable[[str, DataFrame], DataFrame] = _as_it_is
) -> RideDimensions:
    """All dimensions from the operational tables, and what a ride's keys are looked up in.

    ``store`` gets the name and the rows of each dimension and returns what the fact shall
    read. A warehouse writes the rows and reads them back (``stored_in``): then the sizes
    are known when the fact is planned, and only dimensions that are too large to broadcast
    cost a shuffle of the fact.
    """
    vehicle_dim = store("VehicleDim", vehicle_dimension(tables["bike_types"]))
    subscriptions = store("Subscriptions", tables["subscriptions"])
    return RideDimensions(
        locks=store("LockDim", lock_dimension(tables["locks"], tables["stations"])),
        users=store(
            "UserDim",
            user_dimension(tables["users"], subscriptions, tables["subscription_types"]),
        ),
        dates=store("DateDim", ride_date_dimension(tables["rides"])),
        weather_types=store("WeatherDim", weather_dimension(tables["weather_types"])),
        vehicles=store(
            "VehicleKeys",
            vehicle_lookup(
                tables["vehicles"], tables["bikelots"], tables["bike_types"], vehicle_dim
            ),
        ),
        subscriptions=subscriptions,
        weather=tables["weather"],
    )


def load_ride_star(
    tables: Mapping[str, DataFrame], store: Callable[[str, DataFrame], DataFrame]
) -> DataFrame:
    """Load all dimensions and then the fact; returns the stored fact."""
    return store("RidesFact", ride_fact(tables["rides"], ride_dimensions(tables, store)))
