"""Projections, filters, joins, aggregates, sorts, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_attributes, minutes_between, period_end
from starloom.functions.geo import haversine_km, point_latitude, point_longitude
from starloom.functions.hashing import row_hash
from starloom.functions.weather import weather_category
from starloom.operators.joins import lookup
from starloom.plans import employees
from starloom.workloads.registry import query
from starloom.workloads.relations import MONEY, Relations


def staff(r: Relations) -> DataFrame:
    return r.table("customer").select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"),
        F.col("c_acctbal").cast(MONEY).alias("salary"),
    )


def _hires(r: Relations) -> DataFrame:
    return r.table("orders").select(
        F.col("o_orderkey").alias("employee_id"),
        F.col("o_totalprice").cast(MONEY).alias("salary"),
        F.to_date("o_orderdate").alias("hire_date"),
    )


def postal_codes(r: Relations) -> DataFrame:
    return r.table("customer").select(
        F.col("c_custkey").alias("emp_id"), (F.col("c_nationkey") + 1000).alias("postal_code")
    )


# aggregates


@query("employees_count_all", "SELECT count(*) AS employees FROM customer")
def employees_count_all(r: Relations) -> DataFrame:
    return employees.number_of_rows(staff(r))


@query("employees_count", "SELECT count(c_custkey) AS employees FROM customer")
def employees_count(r: Relations) -> DataFrame:
    return r.spark.sql(employees.COUNT_SQL, employees=staff(r))


@query(
    "employees_avg",
    f"SELECT round(CAST(sum(CAST(c_acctbal AS {MONEY})) AS DOUBLE) / count(*), 4)"
    " AS mean_salary FROM customer",
)
def employees_avg(r: Relations) -> DataFrame:
    return employees.mean_salary(staff(r)).select(
        F.round(F.col("mean_salary").cast("double"), 4).alias("mean_salary")
    )


@query(
    "max_by_group",
    f"""SELECT c_mktsegment AS department,
       CAST(max(CAST(c_acctbal AS {MONEY})) AS DOUBLE) AS highest_salary
FROM customer GROUP BY c_mktsegment""",
)
def max_by_group(r: Relations) -> DataFrame:
    return employees.highest_salary(staff(r)).withColumn(
        "highest_salary", F.col("highest_salary").cast("double")
    )


@query(
    "sum_by_year",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(sum(CAST(o_totalprice AS {MONEY})) AS DOUBLE) AS total_salary
FROM orders GROUP BY 1""",
)
def sum_by_year(r: Relations) -> DataFrame:
    return employees.salary_per_hire_year(_hires(r)).withColumn(
        "total_salary", F.col("total_salary").cast("double")
    )


@query(
    "count_by_code",
    """SELECT c_nationkey + 1000 AS postal_code, count(*) AS employees
FROM customer GROUP BY 1""",
)
def count_by_code(r: Relations) -> DataFrame:
    return employees.employees_per_postal_code(staff(r), postal_codes(r))


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(r: Relations) -> DataFrame:
    return r.table("orders").select("o_orderstatus", "o_orderpriority").distinct()


# projections


@query(
    "project_sql",
    "SELECT s_suppkey AS lock_id, s_nationkey AS station_id, s_name AS station_nr FROM supplier",
)
def project_sql(r: Relations) -> DataFrame:
    """SQL over a registered view, under a name that is nobody else's."""
    r.table("supplier").createOrReplaceTempView("starloom_project_source")
    return r.spark.sql(
        "SELECT s_suppkey AS lock_id, s_nationkey AS station_id, s_name AS station_nr "
        "FROM starloom_project_source"
    )


@query("project_cols", "SELECT p_partkey AS vehicle_id, p_type AS type FROM part")
def project_cols(r: Relations) -> DataFrame:
    return r.table("part").select(
        F.col("p_partkey").alias("vehicle_id"), F.col("p_type").alias("type")
    )


@query(
    "project_expr",
    """SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
       upper(o_orderstatus) AS status FROM orders""",
)
def project_expr(r: Relations) -> DataFrame:
    return r.table("orders").selectExpr(
        "o_orderkey as order_id",
        "cast(cast(o_orderdate as date) as string) as order_day",
        "upper(o_orderstatus) as status",
    )


@query(
    "qualified_star",
    """SELECT r.o_orderkey, r.o_custkey, r.o_orderstatus,
       CAST(CAST(r.o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS o_totalprice,
       CAST(CAST(r.o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, r.o_orderpriority, s.c_name
FROM orders r LEFT JOIN customer s ON r.o_custkey = s.c_custkey""",
)
def qualified_star(r: Relations) -> DataFrame:
    orders = r.table("orders").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
            "o_orderdate": F.to_date("o_orderdate").cast("string"),
        }
    )
    return (
        orders.alias("r")
        .join(r.table("customer").alias("s"), F.expr("r.o_custkey = s.c_custkey"), "left")
        .selectExpr("r.*", "s.c_name")
    )


@query(
    "with_column",
    """SELECT p_partkey, p_size, p_size * 2 AS double_size,
       CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size_class FROM part""",
)
def with_column(r: Relations) -> DataFrame:
    return (
        r.table("part")
        .select("p_partkey", "p_size")
        .withColumn("double_size", F.col("p_size") * 2)
        .withColumn("size_class", F.when(F.col("p_size") > 25, "large").otherwise("small"))
    )


@query("rename_and_drop", "SELECT n_nationkey, n_name AS name FROM nation")
def rename_and_drop(r: Relations) -> DataFrame:
    return r.table("nation").withColumnRenamed("n_name", "name").drop("n_regionkey")


@query(
    "literal_cols",
    """SELECT o_orderkey, 1 AS count_mv, true AS current, '1999-01-01 00:00:00' AS scd_start
FROM orders""",
)
def literal_cols(r: Relations) -> DataFrame:
    start = F.to_timestamp(F.lit("1999-01-01"), "yyyy-MM-dd")
    return r.table("orders").select(
        "o_orderkey",
        F.lit(1).alias("count_mv"),
        F.lit(True).alias("current"),
        start.cast("string").alias("scd_start"),
    )


# filters


@query(
    "filter_eq",
    "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'",
)
def filter_eq(r: Relations) -> DataFrame:
    return r.table("events").where(F.col("event_type") == "purchase").select("event_id", "user_id")


@query(
    "filter_ne",
    "SELECT event_id, event_type FROM events WHERE lower(trim(event_type)) <> 'view'",
)
def filter_ne(r: Relations) -> DataFrame:
    return (
        r.table("events")
        .where(F.lower(F.trim("event_type")) != "view")
        .select("event_id", "event_type")
    )


@query(
    "filter_range",
    """SELECT o_orderkey FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
)
def filter_range(r: Relations) -> DataFrame:
    day = F.to_date("o_orderdate")
    return (
        r.table("orders")
        .where((day >= F.lit("1997-01-01")) & (day <= F.lit("1997-12-31")))
        .select("o_orderkey")
    )


@query(
    "filter_numeric",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_discount > 0",
)
def filter_numeric(r: Relations) -> DataFrame:
    return (
        r.table("lineitem")
        .where(F.col("l_discount") > 0)
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query(
    "filter_not_null",
    """SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
WHERE quality IS NOT NULL AND source IS NOT NULL""",
)
def filter_not_null(r: Relations) -> DataFrame:
    return (
        r.table("documents")
        .join(r.table("labels"), "doc_id", "left")
        .where(F.col("quality").isNotNull() & F.col("source").isNotNull())
        .select("doc_id", "quality")
    )


@query(
    "filter_or_null",
    """SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id)
WHERE quality IS NULL OR quality <> toxic""",
)
def filter_or_null(r: Relations) -> DataFrame:
    return (
        r.table("documents")
        .join(r.table("labels"), "doc_id", "left")
        .where(F.col("quality").isNull() | (F.col("quality") != F.col("toxic")))
        .select("doc_id", "lang")
    )


@query(
    "in_list",
    """SELECT o_orderkey, dayname(o_orderdate) NOT IN ('Saturday', 'Sunday') AS is_weekday
FROM orders""",
)
def in_list(r: Relations) -> DataFrame:
    day_name = F.date_format("o_orderdate", "EEEE")
    return r.table("orders").select(
        "o_orderkey", (~day_name.isin("Saturday", "Sunday")).alias("is_weekday")
    )


# joins


@query(
    "join_inner",
    """SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def join_inner(r: Relations) -> DataFrame:
    return (
        r.table("customer")
        .join(r.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name")
    )


@query(
    "join_inner_chain",
    """SELECT s_suppkey, n_name, r_name FROM supplier
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def join_inner_chain(r: Relations) -> DataFrame:
    return r.spark.sql(
        "SELECT s_suppkey, n_name, r_name FROM {supplier} "
        "JOIN {nation} ON s_nationkey = n_nationkey "
        "JOIN {region} ON n_regionkey = r_regionkey",
        **{name: r.table(name) for name in ("supplier", "nation", "region")},
    )


@query(
    "join_inner_expr",
    """SELECT l_orderkey, l_linenumber, l_suppkey, s_name FROM lineitem
JOIN supplier ON l_suppkey + l_linenumber = s_suppkey""",
)
def join_inner_expr(r: Relations) -> DataFrame:
    """Lines whose shifted supplier number does not exist are dropped."""
    lines = r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        (F.col("l_suppkey") + F.col("l_linenumber")).alias("other"),
    )
    return lookup(
        lines, r.table("supplier"), {"other": "s_suppkey"}, {"s_name": "s_name"}, "inner"
    ).drop("other")


@query(
    "join_left",
    """SELECT l_orderkey, l_linenumber, s_name FROM lineitem
LEFT JOIN supplier ON l_suppkey + l_linenumber = s_suppkey""",
)
def join_left(r: Relations) -> DataFrame:
    lines = r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_suppkey") + F.col("l_linenumber")).alias("other"),
    )
    return lookup(
        lines, r.table("supplier"), {"other": "s_suppkey"}, {"s_name": "s_name"}
    ).drop("other")


@query(
    "join_left_using",
    """SELECT doc_id, lang, coalesce(CAST(quality AS VARCHAR), 'none') AS quality
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def join_left_using(r: Relations) -> DataFrame:
    quality = F.coalesce(F.col("quality").cast("string"), F.lit("none"))
    return (
        r.table("documents")
        .join(r.table("labels"), on="doc_id", how="left")
        .select("doc_id", "lang", quality.alias("quality"))
    )


# sorts, limits, set operations


@query(
    "sort_one",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
ORDER BY o_orderdate""",
)
def sort_one(r: Relations) -> DataFrame:
    return (
        r.table("orders")
        .orderBy("o_orderdate")
        .select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"))
    )


@query(
    "sort_multi",
    "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey",
)
def sort_multi(r: Relations) -> DataFrame:
    return (
        r.table("orders")
        .sort("o_custkey", "o_orderdate", "o_orderkey")
        .select("o_custkey", "o_orderkey")
    )


@query(
    "limit_n",
    "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 5000",
)
def limit_n(r: Relations) -> DataFrame:
    return (
        r.table("lineitem")
        .select("l_orderkey", "l_linenumber")
        .orderBy("l_orderkey", "l_linenumber")
        .limit(5000)
    )


@query(
    "union_distinct",
    """SELECT o_custkey AS key FROM orders UNION SELECT c_custkey FROM customer
WHERE c_acctbal < 0""",
)
def union_distinct(r: Relations) -> DataFrame:
    return r.spark.sql(
        "SELECT o_custkey AS key FROM {orders} "
        "UNION SELECT c_custkey FROM {customer} WHERE c_acctbal < 0",
        orders=r.table("orders"),
        customer=r.table("customer"),
    )


@query(
    "union_all",
    """SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name FROM supplier
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name FROM customer""",
)
def union_all(r: Relations) -> DataFrame:
    suppliers = r.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("name")
    )
    customers = r.table("customer").select(F.col("c_custkey").cast("string"), "c_name")
    return suppliers.union(customers)


# scalar functions


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS y, CAST(quarter(d) AS INTEGER) AS q,
       CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dom,
       CAST(dayofyear(d) AS INTEGER) AS doy, CAST(week(d) AS INTEGER) AS week,
       CAST(dayofweek(d) + 1 AS INTEGER) AS dow, CAST(isodow(d) AS INTEGER) AS iso_dow,
       monthname(d) AS month_name, dayname(d) AS day_name,
       CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_int,
       CASE WHEN d = last_day(d) THEN 'Y' ELSE 'N' END AS month_end
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def date_parts(r: Relations) -> DataFrame:
    return (
        r.table("orders")
        .selectExpr("o_orderkey", "to_date(o_orderdate) AS day")
        .selectExpr("o_orderkey", *calendar_attributes("day"))
        .select(
            "o_orderkey",
            F.col("CalendarYear").alias("y"),
            F.col("QuarterOfYear").alias("q"),
            F.col("MonthOfYear").alias("m"),
            F.col("DayOfMonth").alias("dom"),
            F.col("DayOfYear").alias("doy"),
            F.col("WeekOfYearIso").alias("week"),
            F.col("DayOfWeek").alias("dow"),
            F.col("DayOfWeekStartMonday").alias("iso_dow"),
            F.col("CalendarMonth").alias("month_name"),
            F.col("CalendarDay").alias("day_name"),
            F.col("dateInt").alias("date_int"),
            F.col("IsLastDayOfMonth").alias("month_end"),
        )
    )


@query(
    "subscription_ends",
    """SELECT o_orderkey, CAST(CAST(CASE o_orderpriority
         WHEN '1-URGENT' THEN o_orderdate + INTERVAL 1 DAY
         WHEN '2-HIGH' THEN o_orderdate + INTERVAL 1 MONTH
         WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL 12 MONTH
         ELSE o_orderdate + INTERVAL 1 DAY END AS DATE) AS VARCHAR) AS end_date FROM orders""",
)
def subscription_ends(r: Relations) -> DataFrame:
    period = (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'DAG' WHEN '2-HIGH' THEN 'MAAND' "
        "WHEN '3-MEDIUM' THEN 'JAAR' ELSE 'WEEK' END"
    )
    end = period_end("to_date(o_orderdate)", period)
    return r.table("orders").select("o_orderkey", end.cast("string").alias("end_date"))


@query(
    "ride_durations",
    """SELECT event_id, round((epoch(date_trunc('second', TIMESTAMP '2024-02-01'))
       - epoch(date_trunc('second', ts))) / 60, 2) AS minutes, CAST(hour(ts) AS INTEGER) AS hour
FROM events""",
)
def ride_durations(r: Relations) -> DataFrame:
    minutes = minutes_between("ts", "timestamp_ntz'2024-02-01 00:00:00'")
    return r.table("events").select(
        "event_id", minutes.alias("minutes"), F.hour("ts").alias("hour")
    )


@query(
    "json_fields",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def json_fields(r: Relations) -> DataFrame:
    return r.table("events").select("event_id", F.json_tuple("props", "k").alias("k"))


@query(
    "row_hashes",
    f"""SELECT o_orderkey, md5(concat_ws(chr(31), CAST(o_orderkey AS VARCHAR), o_orderstatus,
       CAST(CAST(o_totalprice AS {MONEY}) AS VARCHAR), o_orderpriority)) AS md5 FROM orders""",
)
def row_hashes(r: Relations) -> DataFrame:
    amount = f"cast(o_totalprice AS {MONEY})"
    return r.table("orders").select(
        "o_orderkey",
        row_hash("o_orderkey", "o_orderstatus", amount, "o_orderpriority").alias("md5"),
    )


@query(
    "split_points",
    """SELECT p_partkey, 51 + (p_partkey % 1000) / 1e3 AS lat, 4 + (p_size % 100) / 1e2 AS lon
FROM part""",
)
def split_points(r: Relations) -> DataFrame:
    """Points written as text and read back as two numbers."""
    point = F.format_string(
        "(51.%03d,4.%02d)", F.col("p_partkey") % 1000, F.col("p_size") % 100
    )
    return (
        r.table("part")
        .withColumn("point", point)
        .select(
            "p_partkey",
            F.round(point_latitude("point"), 3).alias("lat"),
            F.round(point_longitude("point"), 2).alias("lon"),
        )
    )


@query(
    "haversine_km",
    """SELECT l_orderkey, l_linenumber, CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 0.0 ELSE
       round(2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(lat2 - lat1) / 2), 2)
       + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))), 3)
       END AS km
FROM (SELECT l_orderkey, l_linenumber, 51 + (l_suppkey % 97) / 1e3 AS lat1,
             4 + (l_suppkey % 89) / 1e3 AS lon1, 51 + (l_partkey % 97) / 1e3 AS lat2,
             4 + (l_partkey % 89) / 1e3 AS lon2 FROM lineitem)""",
)
def haversine(r: Relations) -> DataFrame:
    def point(key: str) -> tuple[str, str]:
        return f"(51 + ({key} % 97) / 1000)", f"(4 + ({key} % 89) / 1000)"

    km = haversine_km(*point("l_suppkey"), *point("l_partkey"))
    return r.table("lineitem").select("l_orderkey", "l_linenumber", F.round(km, 3).alias("km"))


@query(
    "weather_categories",
    """SELECT event_id, CASE WHEN value IS NULL THEN 'Unknown' WHEN event_type = 'error'
       THEN 'Unpleasant' WHEN value >= 15 AND user_id % 6 IN (0, 1, 2, 3) THEN 'Pleasant'
       ELSE 'Neutral' END AS category FROM events""",
)
def weather_categories(r: Relations) -> DataFrame:
    category = weather_category("value", "if(event_type = 'error', 0.4, 0.0)", "user_id % 6")
    return r.table("events").select("event_id", category.alias("category"))


@query(
    "tumbling_windows",
    """SELECT strftime(time_bucket(INTERVAL 10 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       event_type AS key, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS count
FROM events GROUP BY 1, 2""",
)
def tumbling_windows(r: Relations) -> DataFrame:
    return (
        r.table("events")
        .groupBy(F.window("ts", "10 seconds"), F.col("event_type").alias("key"))
        .agg(F.sum(F.floor("value").cast("long")).alias("count"))
        .select(F.col("window.start").cast("string").alias("window_start"), "key", "count")
    )
