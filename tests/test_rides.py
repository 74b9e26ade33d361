from __future__ import annotations

import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.plans.graph import ride_edges, ride_edges_via_locks
from starloom.plans.rides import (
    lock_dimension,
    load_ride_star,
    ride_dimensions,
    ride_fact,
    user_dimension,
    vehicle_lookup,
    vehicle_types,
    with_user,
)
from starloom.plans.weather import hourly_weather, weather_requests
from starloom.sinks.files import stored_in
from starloom.workloads import rides as ride_queries  # noqa: F401
from starloom.workloads.registry import QUERIES
from starloom.workloads.relations import SCHEMAS

TYPES = [(0, "DAG"), (1, "MAAND"), (2, "JAAR")]


def payload(**changes) -> str:
    hourly = {
        "temperature_2m": [float(h) for h in range(24)],
        "precipitation": [0.0] * 24,
        "weathercode": [1] * 24,
    }
    hourly.update(changes)
    return json.dumps({"hourly": hourly})


@pytest.fixture
def tables(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    rides = [
        # id, start, end, locks, vehicle, subscription, start and end point
        (1, "2024-05-01 16:00:00", "2024-05-01 16:30:30", 1, 2, 70, 500, 51.2, 4.4, 51.3, 4.5),
        (2, "2024-05-01 03:00:00", "2024-05-01 03:00:00", 1, 1, 71, 500, 51.2, 4.4, 51.2, 4.4),
        (3, "2024-05-01 10:00:00", "2024-05-01 09:00:00", 1, 2, 70, 500, 51.2, 4.4, 51.3, 4.5),
        (4, "2024-05-01 10:00:00", "2024-05-01 11:00:00", 1, 99, 70, 500, 51.2, 4.4, 51.3, 4.5),
        (5, "2024-05-31 10:00:00", "2024-05-31 10:10:00", 2, 1, 72, 500, 51.3, 4.5, 51.2, 4.4),
        (6, "2024-05-02 10:00:00", "2024-05-02 10:10:00", 2, 1, None, 999, 51.3, 4.5, None, None),
        (7, "2024-05-02 23:59:59", "2024-05-03 00:10:00", 2, 1, 70, 500, 51.3, 4.5, 51.2, 4.4),
    ]
    return {
        "rides": frame(
            rides,
            "rideid long, s string, e string, startlockid long, endlockid long, vehicleid long,"
            " subscriptionid long, start_lat double, start_lon double, end_lat double,"
            " end_lon double",
        ).selectExpr(
            "*", "to_timestamp(s) AS starttime", "to_timestamp(e) AS endtime"
        ).drop("s", "e"),
        "locks": frame([(1, 10), (2, 20)], "lockid long, stationid long"),
        "stations": frame(
            [
                (10, "S10", "Main", "1", "2000", "North", "(51.2,4.4)"),
                (20, "S20", "Side", "2", "2018", "South", "bad"),
                (1, "S1", "Lock one", "3", "2020", "West", None),
            ],
            "stationid long, stationnr string, street string, number string, zipcode string,"
            " district string, gpscoord string",
        ),
        "vehicles": frame(
            [(70, "x", 7), (71, "y", 8), (72, "z", None)],
            "vehicleid long, serialnumber string, bikelotid long",
        ),
        "bikelots": frame([(7, 1), (8, 5)], "bikelotid long, biketypeid long"),
        "bike_types": frame([(1, "city")], "biketypeid long, biketypedescription string"),
        "users": frame(
            [(900, "Main", "1", "2000", "A", "BE")],
            "userid long, street string, number string, zipcode string, city string,"
            " country_code string",
        ),
        "subscriptions": frame(
            [(500, 900, 1, "2024-05-01"), (501, 900, 2, "2024-05-31")],
            "subscriptionid long, userid long, subscriptiontypeid int, v string",
        ).selectExpr("*", "to_date(v) AS validfrom").drop("v"),
        "subscription_types": frame(TYPES, "subscriptiontypeid int, description string"),
        "weather": frame(
            [(2000, "2024-05-01", 16, "Pleasant"), (2000, "2024-05-01", 17, "Neutral")],
            "zipcode int, d string, hour int, weather_description string",
        ).selectExpr("zipcode", "to_date(d) AS ride_date", "hour", "weather_description"),
        "weather_types": frame(
            [(1, "Unknown"), (2, "Pleasant")], "weather_id int, weather_type string"
        ),
    }


def test_lock_dimension_has_a_row_for_no_lock(tables, rows):
    dimension = lock_dimension(tables["locks"], tables["stations"])
    assert {f.dataType.simpleString() for f in dimension.schema} == {"string"}
    assert rows(dimension, "lock_id", "station_nr", "zipcode") == [
        ("1", "S10", "2000"), ("2", "S20", "2018"), (None, "no lock", None),
    ]


def test_user_dimension(tables, rows):
    dimension = user_dimension(
        tables["users"], tables["subscriptions"], tables["subscription_types"]
    )
    got = rows(dimension, "user_id", "start_date", "end_date")
    assert [(user, str(start), str(end)) for user, start, end in got] == [
        (900, "2024-05-01", "2024-06-01"), (900, "2024-05-31", "2025-05-31"),
    ]
    assert dimension.select("user_sk").distinct().count() == 2


def test_vehicles(spark, tables, rows):
    parts = [tables[n] for n in ("vehicles", "bikelots", "bike_types")]
    assert rows(vehicle_types(*parts)) == [(70, "city")]
    dimension = spark.createDataFrame([(1, "city")], "vehicle_id long, type string")
    assert rows(vehicle_lookup(*parts, dimension)) == [(70, 1), (71, None), (72, None)]


def test_stored_star_equals_the_direct_one(tables, rows, tmp_path):
    stored = load_ride_star(tables, stored_in(str(tmp_path / "star")))
    direct = ride_fact(tables["rides"], ride_dimensions(tables))
    assert rows(stored) == rows(direct)
    names = {p.name for p in (tmp_path / "star").iterdir()}
    assert names == {
        "LockDim", "UserDim", "DateDim", "VehicleDim", "WeatherDim", "VehicleKeys", "Subscriptions",
        "RidesFact",
    }


def test_ride_fact(tables, rows):
    fact = ride_fact(tables["rides"], ride_dimensions(tables))
    got = rows(
        fact, "ride_id", "start_lock_id", "end_lock_id", "date_sk", "weather_id", "vehicle_id",
        "ride_duration",
    )
    assert got == sorted(
        [
            (1, "1", "2", 20240501, 2, 1, 30.5),
            (2, "1", "1", 20240501, 1, None, 0.0),
            (5, "2", "1", 20240531, 1, None, 10.0),  # on a day of two periods: twice
            (5, "2", "1", 20240531, 1, None, 10.0),
            (6, "2", "1", 20240502, 1, None, 10.0),
            (7, "2", "1", 20240502, 1, 1, 10.02),
        ],
        key=repr,
    )
    users = {r.ride_id: set() for r in fact.collect()}
    for r in fact.collect():
        users[r.ride_id].add(r.user_sk)
    assert len(users[5]) == 2 and users[6] == {None} and users[1] == users[7] != {None}
    distances = {r.ride_id: r.ride_distance for r in fact.collect()}
    assert distances[1] == pytest.approx(13.118, abs=1e-3)
    assert distances[2] == 0 and distances[6] is None


def many_rides(rides, n):
    """The first ride ``n`` times under other numbers."""
    numbers = rides.sparkSession.range(n).withColumnRenamed("id", "copy")
    first = rides.where("rideid = 1")
    return first.join(numbers).withColumn("rideid", F.col("rideid") * 1_000_000 + F.col("copy"))


def hours_of_a_day(n):
    """The payload of a day on which the clock changes."""
    return payload(temperature_2m=[1.0] * n, precipitation=[0.0] * n, weathercode=[0] * n)


def test_edges(tables, rows):
    users = user_dimension(tables["users"], tables["subscriptions"], tables["subscription_types"])
    shared = (tables["subscriptions"], users, "2024-05-01", "2024-05-02")
    direct = ride_edges(tables["rides"], tables["stations"], *shared)
    assert rows(direct, "rideid", "start_station_id", "start_district", "end_district") == [
        (1, 1, "West", None), (4, 1, "West", None), (6, 2, None, "West"), (7, 2, None, "West"),
    ]
    via = ride_edges_via_locks(tables["rides"], tables["locks"], tables["stations"], *shared)
    assert via.columns == direct.columns
    assert rows(via, "rideid", "start_station_id", "end_station_id", "start_district") == [
        (1, 10, 20, "North"), (7, 20, 10, "South"),
    ]
    assert ride_edges_via_locks(
        many_rides(tables["rides"], 10_500), tables["locks"], tables["stations"], *shared
    ).count() > 10_000
    few = ride_edges_via_locks(
        tables["rides"], tables["locks"], tables["stations"], *shared, limit=1
    )
    assert rows(few, "rideid") == [(1,)]


def test_weather_requests_need_coordinates(tables, rows):
    got = rows(weather_requests(tables["rides"], tables["locks"], tables["stations"]))
    assert [(z, str(d), lat, lon) for z, d, lat, lon in got] == [("2000", "2024-05-01", 51.2, 4.4)]


def test_hourly_weather(spark, rows):
    texts = [
        ("2000", payload()),
        ("2001", payload(temperature_2m=[16.0, None] + [3.0] * 22)),
        ("2002", payload(precipitation=[0.2] * 3)),
        ("2003", payload(temperature_2m=[1.0] * 23)),
        ("2004", payload(weathercode=[])),
        ("2005", "no json"),
        ("2006", None),
        ("2007", payload(temperature_2m=[16.0] * 30)),
        ("2008", hours_of_a_day(23)),
        ("2009", hours_of_a_day(25)),
        ("x", payload(weathercode=[9] * 24)),
    ]
    payloads = spark.createDataFrame(texts, "zipcode string, payload string").selectExpr(
        "zipcode", "date'2024-05-01' AS ride_date", "payload"
    )
    weather = hourly_weather(payloads)
    counts = dict(map(tuple, weather.groupBy("zipcode").count().collect()))
    assert counts == {
        2000: 24, 2001: 24, 2002: 24, 2003: 24, 2004: 24, 2007: 30, 2008: 23, 2009: 25, None: 24,
    }
    assert rows(weather.where("zipcode = 2004").select("weather_description").distinct()) == [
        ("Unknown",)
    ]

    def category(zipcode, hour):
        return weather.where(f"zipcode = {zipcode} AND hour = {hour}").first().weather_description

    assert [category(2000, h) for h in (14, 15)] == ["Neutral", "Pleasant"]
    assert [category(2001, h) for h in (0, 1, 2)] == ["Pleasant", "Unknown", "Neutral"]
    assert [category(2002, h) for h in (2, 3)] == ["Unpleasant", "Unknown"]
    assert rows(weather.where("zipcode IS NULL").select("weather_description").distinct()) == [
        ("Neutral",)
    ]


def test_a_user_with_thousands_of_day_tickets(spark):
    n = 4_000
    days = spark.range(n).selectExpr("id", "date_add(date'2010-01-01', cast(id AS int)) AS day")
    tickets = days.selectExpr(
        "id AS subscriptionid", "7L AS userid", "0 AS subscriptiontypeid", "day AS validfrom"
    )
    users = spark.sql("SELECT 7L AS userid, 's' AS street, '1' AS number, '2' AS zipcode, 'c' AS city, 'B' AS country_code")
    types = spark.createDataFrame([(0, "DAG")], "subscriptiontypeid int, description string")
    dimension = user_dimension(users, tickets, types)
    assert dimension.select("user_sk").distinct().count() == n
    rides = days.selectExpr(
        "id AS rideid", "cast(day AS timestamp) AS starttime", "id AS subscriptionid"
    )
    got = with_user(rides, tickets, dimension)
    # The ticket of the day and the one of the day before, which holds until then.
    assert got.groupBy("rideid").count().groupBy("count").count().orderBy("count").collect() == [
        (1, 1), (2, n - 1),
    ]


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="tables are not there")
def test_the_fact_is_not_shuffled_by_lock_vehicle_or_day(spark):
    fact = QUERIES["fact_rides"](spark, "/root/testdata/sf0.1")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    # The side of the rides is the first child of every join: whatever is shuffled below the first
    # lookup by lock, vehicle and day is listed here by its keys.
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    for key in ("endlockid", "vehicleid", "ride_date#"):
        assert not [k for k in keys if k.startswith(key)], key


@pytest.fixture
def warehouse(spark, tmp_path):
    """A folder of small given tables: a line item per order, two orders per customer."""
    made = {
        "region": ("r_regionkey = 0, r_name = 'R'", 1),
        "nation": ("n_nationkey = id, n_name = 'N', n_regionkey = 0", 2),
        "customer": ("c_custkey = id, c_name = 'c', c_nationkey = 0, c_mktsegment = 'm'", 20),
        "supplier": ("s_suppkey = id, s_nationkey = id % 2", 9),
        "part": ("p_partkey = id, p_name = 'p', p_brand = id % 3, p_type = id % 3", 10),
        "orders": (
            "o_orderkey = id, o_custkey = id div 2,"
            " o_orderdate = timestampadd(DAY, id div 2 % 5, timestamp_ntz'1997-03-01 00:00:00')",
            40,
        ),
        "lineitem": (
            "l_orderkey = id, l_partkey = id % 10, l_suppkey = id % 8, l_linenumber = 1,"
            " l_shipdate = timestamp_ntz'1997-03-09 00:00:00'",
            40,
        ),
        "events": ("event_id = id, ts = timestamp_ntz'1997-03-02 10:00:00', value = 20", 7),
    }
    for name, (columns, n) in made.items():
        given = dict(c.split(" = ", 1) for c in re.split(r", (?=\w+ = )", columns))
        fields = [f.split(" ") for f in SCHEMAS[name].split(", ")]
        rows = [f"cast({given.get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in fields]
        spark.range(n).selectExpr(*rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["fact_rides", "ride_star_load"])
def test_rides_are_made_once_and_narrow_when_shuffled(spark, warehouse, settings, rows, name):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("ride-*"))
    fact = QUERIES[name](spark, warehouse)
    (folder,) = set(shared.glob("ride-*")) - before
    assert {"rides", "weather", "UserDim"} <= {p.name for p in folder.iterdir()}
    assert [p for p in (folder / "rides").iterdir() if p.name.endswith(".zstd.parquet")]
    assert "lineitem" not in " ".join(fact.inputFiles())
    assert rows(fact, "ride_id") == sorted(((10 * i + 1,) for i in range(40)), key=repr)
    assert fact.where("user_sk IS NULL").count() == 0
    if name == "fact_rides":
        # Joins are listed from the last one down: by day, by user and period, by vehicle.
        plan = fact._jdf.queryExecution().optimizedPlan().toString()
        joins = re.split(r"Join LeftOuter", plan)
        keys = [re.search(r"\((\w+)#", join)[1] for join in joins[1:]]
        assert keys[:4] == ["ride_date", "userid", "vehicleid", "subscriptionid"], plan
        assert all("starttime" not in join.split("Join")[0].split("\n")[1] for join in joins[1:4])


def test_a_period_of_a_year_is_listed_twice_at_most(tables):
    users = user_dimension(tables["users"], tables["subscriptions"], tables["subscription_types"])
    found = with_user(tables["rides"], tables["subscriptions"], users)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "INTERVAL '1' YEAR" in plan and "INTERVAL '1' MONTH" not in plan
