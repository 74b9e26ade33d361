"""The ride star, weather, and graph edges over line items, orders and events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import lookup
from starloom.plans.calendar import ride_date_dimension, ride_dates
from starloom.plans.graph import ride_edges, ride_edges_via_locks
from starloom.plans.rides import (
    load_ride_star,
    ride_dimensions,
    ride_fact,
    vehicle_dimension,
    vehicle_types,
    weather_dimension,
    with_user,
)
from starloom.sinks.files import stored_in
from starloom.sources.files import scan_csv
from starloom.workloads.registry import query
from starloom.workloads.relations import EDGE_DAYS, Relations, with_relations
from starloom.workspace import new_folder

_DATES = """SELECT CAST(starttime AS DATE) AS d FROM rides
UNION SELECT CAST(endtime AS DATE) FROM rides"""


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


@query(
    "distinct_dates",
    with_relations("rides", f"SELECT CAST(d AS VARCHAR) AS ride_date FROM ({_DATES})"),
)
def distinct_dates(r: Relations) -> DataFrame:
    return _texts(ride_dates(r.rides), "ride_date")


@query(
    "ride_date_dim",
    with_relations(
        "rides",
        f"""SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk,
       CAST(d AS VARCHAR) AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month_nr,
       monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day_nr, dayname(d) AS day_name,
       isodow(d) <= 5 AS is_weekday FROM ({_DATES})""",
    ),
)
def ride_date_dim(r: Relations) -> DataFrame:
    return _texts(ride_date_dimension(r.rides), "date")


@query(
    "lock_dim",
    with_relations(
        "locks stations",
        """SELECT CAST(lockid AS VARCHAR) AS lock_id, CAST(stationid AS VARCHAR) AS station_id,
       stationnr AS station_nr, street, number, zipcode, district, gpscoord AS gps_coord
FROM locks JOIN stations USING (stationid)
UNION ALL SELECT NULL, NULL, 'no lock', NULL, NULL, NULL, NULL, NULL""",
    ),
)
def lock_dim(r: Relations) -> DataFrame:
    return r.lock_dim


@query(
    "user_dim",
    with_relations(
        "user_dim",
        """SELECT user_sk, user_id, street, number, zipcode, city, country_code,
       CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
FROM user_dim""",
    ),
)
def user_dim(r: Relations) -> DataFrame:
    return _texts(r.user_dim, "start_date", "end_date")


@query(
    "vehicle_dim",
    with_relations(
        "bike_types",
        "SELECT biketypeid AS vehicle_id, biketypedescription AS type FROM bike_types",
    ),
)
def vehicle_dim(r: Relations) -> DataFrame:
    return vehicle_dimension(r.bike_types)


@query(
    "vehicle_types",
    with_relations(
        "vehicles bikelots bike_types",
        """SELECT vehicleid AS vehicle_id, biketypedescription AS type
FROM vehicles JOIN bikelots USING (bikelotid) JOIN bike_types USING (biketypeid)""",
    ),
)
def vehicle_type_list(r: Relations) -> DataFrame:
    return vehicle_types(r.vehicles, r.bikelots, r.bike_types)


@query(
    "join_snowflake",
    with_relations(
        "vehicles bikelots bike_types",
        """SELECT vehicleid, biketypeid AS vehicle_id
FROM vehicles LEFT JOIN bikelots USING (bikelotid)""",
    ),
)
def join_snowflake(r: Relations) -> DataFrame:
    return r.vehicle_keys


@query(
    "weather_dim",
    with_relations(
        "weather weather_types",
        """SELECT t.weather_id, t.weather_type, count(w.hour) AS hours
FROM weather_types t LEFT JOIN weather w ON w.weather_description = t.weather_type
GROUP BY t.weather_id, t.weather_type""",
    ),
)
def weather_dim(r: Relations) -> DataFrame:
    """All weather types, through a CSV file with inferred types, and the hours of each."""
    folder = new_folder(r.spark, "weather-types")
    r.weather_types.write.option("header", True).csv(folder)
    types = weather_dimension(scan_csv(r.spark, folder))
    hours = r.weather.groupBy(F.col("weather_description").alias("weather_type")).agg(
        F.count("*").alias("hours")
    )
    found = lookup(types, hours, {"weather_type": "weather_type"}, {"hours": "hours"})
    return found.selectExpr("weather_id", "weather_type", "coalesce(hours, 0L) AS hours")


@query(
    "weather_requests",
    with_relations(
        "rides locks stations",
        """SELECT DISTINCT s.zipcode, CAST(CAST(r.starttime AS DATE) AS VARCHAR) AS ride_date,
       51 + (100 + s.stationid) / 1e3 AS lat, 4 + (200 + s.stationid) / 1e3 AS lon
FROM rides r JOIN locks l ON r.startlockid = l.lockid
JOIN stations s ON l.stationid = s.stationid""",
    ),
)
def weather_request_list(r: Relations) -> DataFrame:
    rounded = {c: F.round(c, 3) for c in ("lat", "lon")}
    return _texts(r.weather_requests, "ride_date").withColumns(rounded)


@query(
    "hourly_weather",
    with_relations(
        "weather",
        """SELECT zipcode, CAST(ride_date AS VARCHAR) AS ride_date, CAST(hour AS INTEGER) AS hour,
       coalesce(CAST(CAST(temperature AS BIGINT) AS VARCHAR), 'none') AS temperature,
       weather_description FROM weather""",
    ),
)
def hourly_weather_rows(r: Relations) -> DataFrame:
    degrees = F.coalesce(F.col("temperature").cast("long").cast("string"), F.lit("none"))
    return _texts(r.weather, "ride_date").withColumn("temperature", degrees)


@query(
    "join_left_multi",
    with_relations(
        "rides locks stations weather",
        """SELECT r.rideid, coalesce(w.weather_description, 'Unknown') AS weather_type
FROM rides r LEFT JOIN locks l ON r.startlockid = l.lockid
LEFT JOIN stations s ON l.stationid = s.stationid
LEFT JOIN weather w ON CAST(s.zipcode AS INTEGER) = w.zipcode
 AND CAST(r.starttime AS DATE) = w.ride_date AND hour(r.starttime) = w.hour""",
    ),
)
def join_left_multi(r: Relations) -> DataFrame:
    """Weather by zip code, day and hour."""
    placed = lookup(
        r.rides.selectExpr("rideid", "starttime", "cast(startlockid AS string) AS lock"),
        r.lock_dim,
        {"lock": "lock_id"},
        {"zipcode": "try_cast(zipcode AS int)"},
    ).selectExpr("*", "to_date(starttime) AS ride_date", "hour(starttime) AS hour")
    found = lookup(
        placed,
        r.weather,
        {"zipcode": "zipcode", "ride_date": "ride_date", "hour": "hour"},
        {"weather_type": "weather_description"},
    )
    return found.selectExpr("rideid", "coalesce(weather_type, 'Unknown') AS weather_type")


@query(
    "join_valid_between",
    with_relations(
        "rides subscriptions user_dim",
        """SELECT r.rideid, u.user_sk FROM rides r
LEFT JOIN subscriptions s ON r.subscriptionid = s.subscriptionid
LEFT JOIN user_dim u ON s.userid = u.user_id
 AND CAST(r.starttime AS DATE) BETWEEN u.start_date AND u.end_date""",
    ),
)
def join_valid_between(r: Relations) -> DataFrame:
    """A ride on a day that two periods share comes out twice."""
    rides = r.rides.select("rideid", "starttime", "subscriptionid")
    return with_user(rides, r.subscriptions, r.user_dim).select("rideid", "user_sk")


@query(
    "join_role_playing",
    with_relations(
        "rides locks stations",
        """SELECT r.rideid, a.stationid AS start_station, sa.district AS start_district,
       b.stationid AS end_station, sb.district AS end_district
FROM rides r JOIN locks a ON r.startlockid = a.lockid JOIN locks b ON r.endlockid = b.lockid
LEFT JOIN stations sa ON a.stationid = sa.stationid
LEFT JOIN stations sb ON b.stationid = sb.stationid""",
    ),
)
def join_role_playing(r: Relations) -> DataFrame:
    """The same lock and station tables for the start and the end of a ride."""
    rides = r.rides.select("rideid", "startlockid", "endlockid")
    for role in ("start", "end"):
        rides = lookup(
            rides, r.locks, {f"{role}lockid": "lockid"}, {f"{role}_station": "stationid"}, "inner"
        )
        rides = lookup(
            rides, r.stations, {f"{role}_station": "stationid"}, {f"{role}_district": "district"}
        )
    return rides.drop("startlockid", "endlockid")


_MINUTES = "round((epoch(r.endtime) - epoch(r.starttime)) / 60, 2)"
_FACT_SQL = f"""SELECT r.rideid AS ride_id, u.user_sk, CAST(a.lockid AS VARCHAR) AS start_lock_id,
       CAST(b.lockid AS VARCHAR) AS end_lock_id,
       CAST(year(r.starttime) * 10000 + month(r.starttime) * 100 + day(r.starttime) AS INTEGER)
         AS date_sk,
       t.weather_id, bl.biketypeid AS vehicle_id,
       CASE WHEN start_lat = end_lat AND start_lon = end_lon THEN 0.0 ELSE
         round(2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(end_lat - start_lat) / 2), 2)
           + cos(radians(start_lat)) * cos(radians(end_lat))
             * pow(sin(radians(end_lon - start_lon) / 2), 2)))), 3) END AS ride_distance,
       {_MINUTES} AS ride_duration
FROM rides r
JOIN locks a ON r.startlockid = a.lockid JOIN locks b ON r.endlockid = b.lockid
JOIN stations s ON a.stationid = s.stationid
LEFT JOIN subscriptions sub ON r.subscriptionid = sub.subscriptionid
LEFT JOIN user_dim u ON sub.userid = u.user_id
 AND CAST(r.starttime AS DATE) BETWEEN u.start_date AND u.end_date
LEFT JOIN weather w ON CAST(s.zipcode AS INTEGER) = w.zipcode
 AND CAST(r.starttime AS DATE) = w.ride_date AND hour(r.starttime) = w.hour
LEFT JOIN weather_types t ON coalesce(w.weather_description, 'Unknown') = t.weather_type
LEFT JOIN vehicles v ON r.vehicleid = v.vehicleid
LEFT JOIN bikelots bl ON v.bikelotid = bl.bikelotid
WHERE {_MINUTES} >= 0"""


_TABLES = (
    "rides locks stations vehicles bikelots bike_types users subscriptions "
    "subscription_types weather weather_types"
).split()
_COMPACT = ("rides", "RidesFact")
_FACT = with_relations(
    "rides locks stations subscriptions user_dim weather weather_types vehicles bikelots",
    _FACT_SQL,
)


def _rounded(fact: DataFrame) -> DataFrame:
    return fact.withColumn("ride_distance", F.round("ride_distance", 3))


def _ride_tables(
    r: Relations, store: Callable[[str, DataFrame], DataFrame]
) -> dict[str, DataFrame]:
    """All tables of the ride star, with rides stored before the weather asks for their days."""
    r.rides = store("rides", r.rides)
    tables = {name: getattr(r, name) for name in _TABLES}
    tables["weather"] = store("weather", tables["weather"])
    return tables


@query("fact_rides", _FACT)
def fact_rides(r: Relations) -> DataFrame:
    """The fact over rides, weather and dimensions that are made once and stored, so that their sizes
    are known."""
    store = stored_in(new_folder(r.spark, "ride-dimensions"), compact=_COMPACT)
    tables = _ride_tables(r, store)
    return _rounded(ride_fact(tables["rides"], ride_dimensions(tables, store)))


@query("ride_star_load", _FACT)
def ride_star_load(r: Relations) -> DataFrame:
    """Rides, weather and dimensions stored, the fact built over them and stored as well."""
    store = stored_in(new_folder(r.spark, "ride-star"), compact=_COMPACT)
    return _rounded(load_ride_star(_ride_tables(r, store), store))


_EDGE_WHERE = f"""CAST(r.starttime AS DATE) BETWEEN DATE '{EDGE_DAYS[0]}' AND DATE '{EDGE_DAYS[1]}'
  AND {_MINUTES} > 0"""
_EDGE_USER = """LEFT JOIN subscriptions sub ON r.subscriptionid = sub.subscriptionid
LEFT JOIN user_dim u ON sub.userid = u.user_id
 AND CAST(r.starttime AS DATE) BETWEEN u.start_date AND u.end_date"""
_EDGE_TIME = "strftime(r.starttime, '%Y-%m-%d %H:%M:%S') AS datetime"


@query(
    "ride_edges",
    with_relations(
        "rides stations subscriptions user_dim",
        f"""SELECT r.rideid, u.user_sk, r.vehicleid, r.startlockid AS start_station_id,
       r.endlockid AS end_station_id, a.district AS start_district, b.district AS end_district,
       {_MINUTES} AS ride_duration, {_EDGE_TIME}
FROM rides r LEFT JOIN stations a ON r.startlockid = a.stationid
LEFT JOIN stations b ON r.endlockid = b.stationid
{_EDGE_USER}
WHERE {_EDGE_WHERE}""",
    ),
)
def ride_edge_list(r: Relations) -> DataFrame:
    return ride_edges(r.rides, r.stations, r.subscriptions, r.user_dim, *EDGE_DAYS).withColumn(
        "datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")
    )


EDGES_VIA_LOCKS_SQL = with_relations(
    "rides locks stations subscriptions user_dim",
    f"""SELECT r.rideid, u.user_sk, r.vehicleid, la.stationid AS start_station_id,
       lb.stationid AS end_station_id, a.district AS start_district, b.district AS end_district,
       {_MINUTES} AS ride_duration, {_EDGE_TIME}
FROM rides r LEFT JOIN locks la ON r.startlockid = la.lockid
LEFT JOIN stations a ON la.stationid = a.stationid
LEFT JOIN locks lb ON r.endlockid = lb.lockid
LEFT JOIN stations b ON lb.stationid = b.stationid
{_EDGE_USER}
WHERE {_EDGE_WHERE} AND r.vehicleid IS NOT NULL AND u.user_sk IS NOT NULL
  AND la.stationid IS NOT NULL AND lb.stationid IS NOT NULL""",
)


def edges_via_locks(r: Relations) -> DataFrame:
    return ride_edges_via_locks(
        r.rides, r.locks, r.stations, r.subscriptions, r.user_dim, *EDGE_DAYS
    )


@query("ride_edges_via_locks", EDGES_VIA_LOCKS_SQL)
def ride_edge_list_via_locks(r: Relations) -> DataFrame:
    return edges_via_locks(r).withColumn(
        "datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")
    )
