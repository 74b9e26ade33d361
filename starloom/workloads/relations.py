"""The given tables, and the relations of the sales and ride warehouses derived from them.

Each derived relation is stated twice: as a DataFrame and, in ``SQL``, as a common table
expression for the twin queries.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.calendar import date_dimension
from starloom.plans.rides import (
    lock_dimension,
    user_dimension,
    vehicle_dimension,
    vehicle_lookup,
)
from starloom.plans.sales import salesrep_dimension, salesrep_increment, sales_fact
from starloom.plans.weather import hourly_weather, weather_requests
from starloom.sources.files import rows_with_schema, scan_parquet

# Explicit schemas spare a job per table to look into its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}

MONEY = "decimal(18,2)"
SECOND_LOAD = "2000-07-01 00:00:00"
CALENDAR = ("1995-01-01", "2001-12-31")
EDGE_DAYS = ("1997-03-01", "1997-03-02")
SUBSCRIPTION_TYPES = [(0, "DAG"), (1, "MAAND"), (2, "JAAR"), (3, "WEEK")]
HOURS = 24
WEATHER_TYPES = [(1, "Unknown"), (2, "Unpleasant"), (3, "Pleasant"), (4, "Neutral")]


class Relations:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.folder}/{name}.parquet"
            self._tables[name] = scan_parquet(self.spark, path, SCHEMAS[name])
        return self._tables[name]

    # sales

    @cached_property
    def sales(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_orderdate AS order_date",
            "o_custkey AS salesrep_id",
            f"cast(o_totalprice AS {MONEY}) AS amount",
        )

    @cached_property
    def salesreps_later(self) -> DataFrame:
        """The second load: everyone, and who is in debt has moved to another office."""
        return self.table("customer").selectExpr(
            "c_custkey AS salesrep_id",
            "c_name AS name",
            "if(c_acctbal < 0, 'RECOVERY', c_mktsegment) AS office",
        )

    @cached_property
    def salesreps_first(self) -> DataFrame:
        """The first load: before the people of nation 0 joined."""
        return (
            self.table("customer")
            .where("c_nationkey <> 0")
            .selectExpr("c_custkey AS salesrep_id", "c_name AS name", "c_mktsegment AS office")
        )

    @cached_property
    def salesrep_dim_first(self) -> DataFrame:
        return salesrep_dimension(self.salesreps_first)

    @cached_property
    def salesrep_dim(self) -> DataFrame:
        return salesrep_increment(self.salesrep_dim_first, self.salesreps_later, SECOND_LOAD)

    @cached_property
    def dates(self) -> DataFrame:
        return date_dimension(self.spark, *CALENDAR)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return sales_fact(self.sales, self.dates, self.salesrep_dim)

    # rides

    @cached_property
    def rides(self) -> DataFrame:
        lines, orders = self.table("lineitem"), self.table("orders")
        end_lock = "(l_suppkey + l_linenumber)"
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
            "l_orderkey * 10 + l_linenumber AS rideid",
            "timestampadd(SECOND, l_partkey * 37 % 86400, o_orderdate) AS starttime",
            "timestampadd(SECOND, l_suppkey * 61 % 86400, l_shipdate) AS endtime",
            "l_suppkey AS startlockid",
            f"{end_lock} AS endlockid",
            "l_partkey AS vehicleid",
            "o_custkey * 10000 + year(o_orderdate) AS subscriptionid",
            "51 + (l_suppkey % 97) / 1000 AS start_lat",
            "4 + (l_suppkey % 89) / 1000 AS start_lon",
            f"51 + ({end_lock} % 97) / 1000 AS end_lat",
            f"4 + ({end_lock} % 89) / 1000 AS end_lon",
        )

    @cached_property
    def locks(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS lockid", "s_nationkey AS stationid"
        )

    @cached_property
    def stations(self) -> DataFrame:
        nations, regions = self.table("nation"), self.table("region")
        return nations.join(
            regions, nations["n_regionkey"] == regions["r_regionkey"]
        ).selectExpr(
            "n_nationkey AS stationid",
            "concat('S', n_nationkey) AS stationnr",
            "n_name AS street",
            "cast(n_nationkey AS string) AS number",
            "cast(1000 + n_regionkey AS string) AS zipcode",
            "r_name AS district",
            "concat('(51.', 100 + n_nationkey, ',4.', 200 + n_nationkey, ')') AS gpscoord",
        )

    @cached_property
    def vehicles(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS vehicleid", "p_name AS serialnumber", "p_brand AS bikelotid"
        )

    @cached_property
    def bikelots(self) -> DataFrame:
        lots = self.table("part").selectExpr("p_brand AS bikelotid", "p_type")
        return lots.groupBy("bikelotid").agg(F.min("p_type").alias("biketypeid"))

    @cached_property
    def bike_types(self) -> DataFrame:
        return (
            self.table("part")
            .selectExpr("p_type AS biketypeid", "concat('type ', p_type) AS biketypedescription")
            .distinct()
        )

    @cached_property
    def vehicle_keys(self) -> DataFrame:
        return vehicle_lookup(
            self.vehicles, self.bikelots, self.bike_types, vehicle_dimension(self.bike_types)
        )

    @cached_property
    def users(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS userid",
            "c_name AS street",
            "cast(c_nationkey AS string) AS number",
            "cast(1000 + c_nationkey AS string) AS zipcode",
            "c_mktsegment AS city",
            "concat('C', c_nationkey) AS country_code",
        )

    @cached_property
    def subscriptions(self) -> DataFrame:
        """A customer renews once a year, on the day of the first order."""
        yearly = (
            self.table("orders")
            .selectExpr("o_custkey", "year(o_orderdate) AS year", "to_date(o_orderdate) AS day")
            .groupBy("o_custkey", "year")
            .agg(F.min("day").alias("validfrom"))
        )
        return yearly.selectExpr(
            "o_custkey * 10000 + year AS subscriptionid",
            "o_custkey AS userid",
            "cast((o_custkey + year) % 4 AS int) AS subscriptiontypeid",
            "validfrom",
        )

    @cached_property
    def subscription_types(self) -> DataFrame:
        return rows_with_schema(
            self.spark, SUBSCRIPTION_TYPES, "subscriptiontypeid int, description string"
        )

    @cached_property
    def user_dim(self) -> DataFrame:
        return user_dimension(self.users, self.subscriptions, self.subscription_types)

    @cached_property
    def lock_dim(self) -> DataFrame:
        return lock_dimension(self.locks, self.stations)

    @cached_property
    def weather_requests(self) -> DataFrame:
        return weather_requests(self.rides, self.locks, self.stations)

    @cached_property
    def payloads(self) -> DataFrame:
        """One payload per zip code and ride date, taken from the events of that day of month.

        The events are reduced to one row per day and hour before the 24 hours of a day are
        put into one text.
        """
        by_hour = (
            self.table("events")
            .selectExpr("dayofmonth(ts) AS day", "hour(ts) AS hour", "value")
            .groupBy("day", "hour")
            .agg(F.max("value").alias("highest"), F.count("*").alias("events"))
            .selectExpr(
                "day",
                "hour",
                "cast(floor(highest) AS double) AS degrees",
                "if(events % 4 = 0, 0.2D, 0.0D) AS rain",
                "cast(events % 6 AS int) AS code",
            )
        )

        def hours(field: str) -> str:
            at = [f"max(if(hour = {h}, {field}, NULL))" for h in range(HOURS)]
            return f"array({', '.join(at)})"

        text = (
            "to_json(named_struct('hourly', named_struct("
            f"'temperature_2m', {hours('degrees')}, 'precipitation', {hours('rain')},"
            f" 'weathercode', {hours('code')})), map('ignoreNullFields', 'false'))"
        )
        daily = by_hour.groupBy("day").agg(F.expr(f"{text} AS payload"))
        asked = self.weather_requests.select("zipcode", "ride_date").distinct()
        return asked.join(daily, F.expr("dayofmonth(ride_date) = day")).select(
            "zipcode", "ride_date", "payload"
        )

    @cached_property
    def weather(self) -> DataFrame:
        return hourly_weather(self.payloads)

    @cached_property
    def weather_types(self) -> DataFrame:
        return rows_with_schema(
            self.spark, WEATHER_TYPES, "weather_id int, weather_type string"
        )

    # transactions

    @cached_property
    def transactions(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS transaction_id",
            "user_id AS customer_id",
            "to_date(ts) AS purchase_date",
            "event_type AS product_name",
            "cast(floor(value) AS bigint) AS quantity",
        )


def _hash(*columns: str) -> str:
    fields = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in columns)
    return f"md5(concat_ws(chr(31), {fields}))"


def _calendar(bounds: str) -> str:
    return f"""
  SELECT date_diff('day', lo, d) AS date_sk,
         CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS dateInt,
         d AS CalendarDate, year(d) AS CalendarYear, monthname(d) AS CalendarMonth,
         month(d) AS MonthOfYear, dayname(d) AS CalendarDay, dayofweek(d) + 1 AS DayOfWeek,
         isodow(d) AS DayOfWeekStartMonday,
         CASE WHEN isodow(d) <= 5 THEN 'Y' ELSE 'N' END AS IsWeekDay, day(d) AS DayOfMonth,
         CASE WHEN d = last_day(d) THEN 'Y' ELSE 'N' END AS IsLastDayOfMonth,
         dayofyear(d) AS DayOfYear, week(d) AS WeekOfYearIso, quarter(d) AS QuarterOfYear
  FROM (SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
        FROM ({bounds}))"""


_VERSION_SK = _hash("salesrep_id", "strftime(scd_start, '%Y-%m-%d %H:%M:%S.%f')")
_RIDE_LOCK = "(l_suppkey + l_linenumber)"

# Common table expressions in the order of their dependencies.
SQL: dict[str, str] = {
    "sales": f"""
  SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_custkey AS salesrep_id,
         CAST(o_totalprice AS {MONEY}) AS amount FROM orders""",
    "salesreps_first": """
  SELECT c_custkey AS salesrep_id, c_name AS name, c_mktsegment AS office FROM customer
  WHERE c_nationkey <> 0""",
    "salesreps_later": """
  SELECT c_custkey AS salesrep_id, c_name AS name,
         CASE WHEN c_acctbal < 0 THEN 'RECOVERY' ELSE c_mktsegment END AS office FROM customer""",
    "versions": f"""
  SELECT a.salesrep_id, a.name, a.office, TIMESTAMP '1999-01-01 00:00:00' AS scd_start,
         CASE WHEN b.name <> a.name OR b.office <> a.office THEN TIMESTAMP '{SECOND_LOAD}'
              ELSE TIMESTAMP '2100-12-12 00:00:00' END AS scd_end,
         NOT coalesce(b.name <> a.name OR b.office <> a.office, false) AS current
  FROM salesreps_first a LEFT JOIN salesreps_later b ON a.salesrep_id = b.salesrep_id
  UNION ALL
  SELECT b.salesrep_id, b.name, b.office, TIMESTAMP '{SECOND_LOAD}',
         TIMESTAMP '2100-12-12 00:00:00', true
  FROM salesreps_later b LEFT JOIN salesreps_first a ON a.salesrep_id = b.salesrep_id
  WHERE a.salesrep_id IS NULL OR b.name <> a.name OR b.office <> a.office""",
    "salesrep_dim": f"""
  SELECT {_VERSION_SK} AS salesrep_sk, salesrep_id, name, office, scd_start, scd_end,
         {_hash("name", "office")} AS md5, current FROM versions""",
    "dates": _calendar(f"SELECT DATE '{CALENDAR[0]}' AS lo, DATE '{CALENDAR[1]}' AS hi"),
    "fact_plain": """
  SELECT s.order_id, dd.date_sk, ds.salesrep_sk, 1 AS count_mv, s.amount AS revenue_mv
  FROM sales s LEFT JOIN dates dd ON CAST(s.order_date AS DATE) = dd.CalendarDate
  LEFT JOIN salesrep_dim ds ON s.salesrep_id = ds.salesrep_id
   AND s.order_date > ds.scd_start AND s.order_date <= ds.scd_end""",
    "fact_sales": f"""
  SELECT *, {_hash("order_id", "date_sk", "salesrep_sk", "count_mv", "revenue_mv")} AS md5
  FROM fact_plain""",
    "rides": f"""
  SELECT l_orderkey * 10 + l_linenumber AS rideid,
         o_orderdate + to_seconds(l_partkey * 37 % 86400) AS starttime,
         l_shipdate + to_seconds(l_suppkey * 61 % 86400) AS endtime,
         l_suppkey AS startlockid, {_RIDE_LOCK} AS endlockid, l_partkey AS vehicleid,
         o_custkey * 10000 + year(o_orderdate) AS subscriptionid,
         51 + (l_suppkey % 97) / 1e3 AS start_lat, 4 + (l_suppkey % 89) / 1e3 AS start_lon,
         51 + ({_RIDE_LOCK} % 97) / 1e3 AS end_lat, 4 + ({_RIDE_LOCK} % 89) / 1e3 AS end_lon
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "locks": "SELECT s_suppkey AS lockid, s_nationkey AS stationid FROM supplier",
    "stations": """
  SELECT n_nationkey AS stationid, concat('S', n_nationkey) AS stationnr, n_name AS street,
         CAST(n_nationkey AS VARCHAR) AS number, CAST(1000 + n_regionkey AS VARCHAR) AS zipcode,
         r_name AS district, 51 + (100 + n_nationkey) / 1e3 AS lat,
         concat('(51.', 100 + n_nationkey, ',4.', 200 + n_nationkey, ')') AS gpscoord
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "vehicles": """
  SELECT p_partkey AS vehicleid, p_name AS serialnumber, p_brand AS bikelotid FROM part""",
    "bikelots": """
  SELECT p_brand AS bikelotid, min(p_type) AS biketypeid FROM part GROUP BY p_brand""",
    "bike_types": """
  SELECT DISTINCT p_type AS biketypeid, concat('type ', p_type) AS biketypedescription
  FROM part""",
    "users": """
  SELECT c_custkey AS userid, c_name AS street, CAST(c_nationkey AS VARCHAR) AS number,
         CAST(1000 + c_nationkey AS VARCHAR) AS zipcode, c_mktsegment AS city,
         concat('C', c_nationkey) AS country_code FROM customer""",
    "subscriptions": """
  SELECT o_custkey * 10000 + year(o_orderdate) AS subscriptionid, o_custkey AS userid,
         (o_custkey + year(o_orderdate)) % 4 AS subscriptiontypeid,
         CAST(min(o_orderdate) AS DATE) AS validfrom
  FROM orders GROUP BY o_custkey, year(o_orderdate)""",
    "periods": """
  SELECT *, CAST(CASE subscriptiontypeid WHEN 1 THEN validfrom + INTERVAL 1 MONTH
                      WHEN 2 THEN validfrom + INTERVAL 12 MONTH
                      ELSE validfrom + INTERVAL 1 DAY END AS DATE) AS end_date
  FROM subscriptions""",
    "user_dim": f"""
  SELECT {_hash("userid", "subscriptionid", "validfrom", "end_date")} AS user_sk, userid AS user_id, street,
         number, zipcode, city, country_code, validfrom AS start_date, end_date
  FROM periods JOIN users USING (userid)""",
    "payload_hours": """
  SELECT day(ts) AS day, hour(ts) AS hour, floor(max(value)) AS temperature,
         CASE WHEN count(*) % 4 = 0 THEN 0.2 ELSE 0.0 END AS rain, count(*) % 6 AS code
  FROM events GROUP BY 1, 2""",
    "asked": """
  SELECT DISTINCT s.zipcode, CAST(r.starttime AS DATE) AS ride_date
  FROM rides r JOIN locks l ON r.startlockid = l.lockid
  JOIN stations s ON l.stationid = s.stationid WHERE r.starttime IS NOT NULL""",
    "weather": """
  SELECT CAST(a.zipcode AS INTEGER) AS zipcode, a.ride_date, h.hour, p.temperature,
         CASE WHEN p.temperature IS NULL OR p.rain IS NULL OR p.code IS NULL THEN 'Unknown'
              WHEN p.rain > 0 THEN 'Unpleasant'
              WHEN p.temperature >= 15 AND p.code IN (0, 1, 2, 3) THEN 'Pleasant'
              ELSE 'Neutral' END AS weather_description
  FROM asked a
  JOIN (SELECT DISTINCT day FROM payload_hours) d ON day(a.ride_date) = d.day
  CROSS JOIN (SELECT unnest(range(0, 24)) AS hour) h
  LEFT JOIN payload_hours p ON p.day = d.day AND p.hour = h.hour""",
    "weather_types": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n in WEATHER_TYPES)
    + ") AS w(weather_id, weather_type)",
    "transactions": """
  SELECT event_id AS transaction_id, user_id AS customer_id, CAST(ts AS DATE) AS purchase_date,
         event_type AS product_name, CAST(floor(value) AS BIGINT) AS quantity FROM events""",
}

# Which other expressions one needs.
NEEDS: dict[str, tuple[str, ...]] = {
    "versions": ("salesreps_first", "salesreps_later"),
    "salesrep_dim": ("versions",),
    "fact_plain": ("sales", "dates", "salesrep_dim"),
    "fact_sales": ("fact_plain",),
    "periods": ("subscriptions",),
    "user_dim": ("periods", "users"),
    "asked": ("rides", "locks", "stations"),
    "weather": ("asked", "payload_hours"),
}


def calendar_sql(bounds: str) -> str:
    """Calendar rows for bounds given as a query for (lo, hi)."""
    return _calendar(bounds)


def with_relations(names: str, select: str) -> str:
    """``select`` after a WITH clause of the named relations and all they need."""
    wanted: set[str] = set()
    todo = names.split()
    while todo:
        name = todo.pop()
        wanted.add(name)
        todo.extend(NEEDS.get(name, ()))
    ctes = ",\n".join(f"{n} AS ({body})" for n, body in SQL.items() if n in wanted)
    return f"WITH {ctes}\n{select}"
