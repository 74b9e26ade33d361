"""The sales star over orders and customers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash
from starloom.operators.joins import detect_changes, lookup_day
from starloom.operators.scd2 import scd2_initial
from starloom.operators.timeline import lookup_as_of
from starloom.plans.calendar import date_dimension_over
from starloom.plans.sales import (
    REP_KEY,
    REP_SURROGATE,
    REP_TRACKED,
    fact_by_month,
    revenue_by_office,
    revenue_by_weekday,
    revenue_by_weekday_of,
    sales_fact,
    sales_fact_increment,
    salesrep_rebuild,
)
from starloom.sinks.files import stored_in, write_partitioned
from starloom.sources.files import scan_parquet
from starloom.workloads.registry import query
from starloom.workloads.relations import SECOND_LOAD, Relations, calendar_sql, with_relations
from starloom.workspace import new_folder

_INTS = (
    "CalendarYear MonthOfYear DayOfWeek DayOfWeekStartMonday DayOfMonth DayOfYear "
    "WeekOfYearIso QuarterOfYear"
).split()


def _moment(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _sql_moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


@query(
    "dim_date",
    f"""WITH dates AS ({calendar_sql(
        "SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi "
        "FROM orders")})
SELECT date_sk, CAST(dateInt AS INTEGER) AS dateInt, CAST(CalendarDate AS VARCHAR) AS CalendarDate,
       CalendarMonth, CalendarDay, IsWeekDay, IsLastDayOfMonth,
       {", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in _INTS)} FROM dates""",
)
def dim_date(r: Relations) -> DataFrame:
    """The calendar of all order dates."""
    dates = date_dimension_over(r.table("orders"), "o_orderdate")
    return dates.withColumn("CalendarDate", F.col("CalendarDate").cast("string"))


_VERSION_COLUMNS = "salesrep_sk salesrep_id name office scd_start scd_end md5 current".split()


def _versions(df: DataFrame) -> DataFrame:
    times = ("scd_start", "scd_end")
    return df.select(*[_moment(c) if c in times else F.col(c) for c in _VERSION_COLUMNS])


_VERSIONS_SQL = f"""SELECT salesrep_sk, salesrep_id, name, office, {_sql_moment("scd_start")},
       {_sql_moment("scd_end")}, md5, current FROM salesrep_dim"""


@query(
    "scd2_initial",
    with_relations(
        "salesrep_dim salesreps_later",
        """SELECT md5(concat_ws(chr(31), CAST(salesrep_id AS VARCHAR),
              '1999-01-01 00:00:00.000000')) AS salesrep_sk, salesrep_id, name, office,
       '1999-01-01 00:00:00' AS scd_start, '2100-12-12 00:00:00' AS scd_end,
       md5(concat_ws(chr(31), name, office)) AS md5, true AS current FROM salesreps_later""",
    ),
)
def scd2_initial_load(r: Relations) -> DataFrame:
    return _versions(
        scd2_initial(r.salesreps_later, REP_KEY, REP_TRACKED, REP_SURROGATE)
    )


@query("scd2_incremental", with_relations("salesrep_dim", _VERSIONS_SQL))
def scd2_incremental(r: Relations) -> DataFrame:
    return _versions(r.salesrep_dim)


@query(
    "detect_changes",
    with_relations(
        "salesreps_first salesreps_later",
        """SELECT b.salesrep_id, b.name, b.office, a.office AS old_office
FROM salesreps_later b LEFT JOIN salesreps_first a ON a.salesrep_id = b.salesrep_id
WHERE a.salesrep_id IS NULL OR a.name <> b.name OR a.office <> b.office""",
    ),
)
def detected_changes(r: Relations) -> DataFrame:
    source = r.salesreps_later.withColumn("md5", row_hash(*REP_TRACKED))
    open_versions = r.salesrep_dim_first.where("current")
    return detect_changes(source, open_versions, "salesrep_id", "md5").select(
        "salesrep_id", "name", "office", F.col("dwh_office").alias("old_office")
    )


def _fact(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue_mv", F.col("revenue_mv").cast("double"))


_FACT_SQL = """SELECT order_id, date_sk, salesrep_sk, count_mv,
       CAST(revenue_mv AS DOUBLE) AS revenue_mv, md5 FROM """


@query("fact_sales", with_relations("fact_sales", _FACT_SQL + "fact_sales"))
def fact_sales(r: Relations) -> DataFrame:
    return _fact(r.fact_sales)


@query("fact_sales_as_of", with_relations("fact_sales", _FACT_SQL + "fact_sales"))
def fact_sales_as_of(r: Relations) -> DataFrame:
    """The fact for representatives with long histories."""
    return _fact(sales_fact(r.sales, r.dates, r.salesrep_dim, long_histories=True))


_REP_CHANGES = (
    ("c_acctbal < 0", "'LATE'", "2000-01-01 00:00:00"),
    ("c_nationkey = 3", "'MOVED'", SECOND_LOAD),
    ("true", "c_mktsegment", "2001-01-01 00:00:00"),
    ("true", "CASE WHEN c_acctbal > 5000 THEN 'HQ' ELSE c_mktsegment END", "2001-06-01 00:00:00"),
)
_REP_CHANGES_SQL = " UNION ALL ".join(
    f"SELECT c_custkey, c_name, {office}, TIMESTAMP '{moment}' FROM customer WHERE {which}"
    for which, office, moment in _REP_CHANGES
)


@query(
    "scd2_rebuild",
    with_relations(
        "salesrep_dim",
        f"""SELECT md5(concat_ws(chr(31), CAST(salesrep_id AS VARCHAR),
         strftime(begins, '%Y-%m-%d %H:%M:%S.%f'))) AS salesrep_sk, salesrep_id, name, office,
       strftime(begins, '%Y-%m-%d %H:%M:%S') AS scd_start,
       coalesce(strftime(until, '%Y-%m-%d %H:%M:%S'), '2100-12-12 00:00:00') AS scd_end,
       md5(concat_ws(chr(31), name, office)) AS md5, until IS NULL AS current
FROM (SELECT *, lead(begins) OVER (PARTITION BY salesrep_id ORDER BY begins) AS until FROM (
  SELECT *, lag(office) OVER (PARTITION BY salesrep_id ORDER BY begins) AS before FROM (SELECT * FROM (
    SELECT salesrep_id, name, office, scd_start AS begins, 0 AS change FROM salesrep_dim
    UNION ALL SELECT *, 1 FROM ({_REP_CHANGES_SQL}))
  QUALIFY row_number() OVER (PARTITION BY salesrep_id, begins ORDER BY change DESC) = 1))
  WHERE before IS NULL OR office <> before)""",
    ),
)
def scd2_rebuild(r: Relations) -> DataFrame:
    """A load with up to four changes per representative, some dated before the open version, one at
    its start, the last one often no change at all."""
    several = [
        r.table("customer")
        .where(which)
        .selectExpr("c_custkey AS salesrep_id", "c_name AS name", f"{office} AS office",
                    f"timestamp'{moment}' AS changed_at")
        for which, office, moment in _REP_CHANGES
    ]
    return _versions(salesrep_rebuild(r.salesrep_dim, reduce(DataFrame.unionByName, several)))


@query(
    "join_scd2",
    with_relations(
        "sales salesrep_dim",
        """SELECT s.order_id, d.salesrep_sk, d.office FROM sales s
LEFT JOIN salesrep_dim d ON s.salesrep_id = d.salesrep_id
 AND s.order_date > d.scd_start AND s.order_date <= d.scd_end""",
    ),
)
def join_scd2(r: Relations) -> DataFrame:
    """The version of the representative at order time."""
    return lookup_as_of(
        r.sales,
        r.salesrep_dim,
        {"salesrep_id": "salesrep_id"},
        "order_date",
        "scd_start",
        "scd_end",
        {"salesrep_sk": "salesrep_sk", "office": "office"},
        start_included=False,
    ).select("order_id", "salesrep_sk", "office")


@query(
    "join_date_key",
    with_relations(
        "sales dates",
        """SELECT order_id, date_sk FROM sales
LEFT JOIN dates ON CAST(order_date AS DATE) = CalendarDate""",
    ),
)
def join_date_key(r: Relations) -> DataFrame:
    dated = r.sales.select("order_id", F.to_date("order_date").alias("order_day"))
    return lookup_day(
        dated, r.dates, "order_day", "CalendarDate", {"date_sk": "date_sk"}
    ).drop("order_day")


def _first_fact(r: Relations) -> DataFrame:
    """What an earlier run left: the orders before 2001, with the first load's versions."""
    earlier = r.sales.where(F.col("order_date") < F.lit("2001-01-01").cast("date"))
    return sales_fact(earlier, r.dates, r.salesrep_dim_first)


@query("fact_sales_merge", with_relations("fact_sales", _FACT_SQL + "fact_sales"))
def fact_sales_merge(r: Relations) -> DataFrame:
    """An earlier fact brought up to date must equal the fact built afresh."""
    return _fact(sales_fact_increment(_first_fact(r), r.fact_sales))


@query(
    "revenue_by_weekday",
    with_relations(
        "fact_plain",
        """SELECT CAST(dd.DayOfWeek AS INTEGER) AS DayOfWeek,
       CAST(sum(fs.revenue_mv) AS DOUBLE) AS revenue
FROM fact_plain fs JOIN dates dd ON dd.date_sk = fs.date_sk GROUP BY 1""",
    ),
)
def weekday_revenue(r: Relations) -> DataFrame:
    return revenue_by_weekday(r.fact_sales, r.dates).withColumn(
        "revenue", F.col("revenue").cast("double")
    )


@query(
    "revenue_by_office",
    with_relations(
        "fact_plain",
        """SELECT ds.office, CAST(sum(fs.revenue_mv) AS DOUBLE) AS revenue
FROM fact_plain fs JOIN salesrep_dim ds ON ds.salesrep_sk = fs.salesrep_sk GROUP BY 1""",
    ),
)
def office_revenue(r: Relations) -> DataFrame:
    return revenue_by_office(r.fact_sales, r.salesrep_dim).withColumn(
        "revenue", F.col("revenue").cast("double")
    )


@query(
    "revenue_by_weekday_of_quarter",
    with_relations(
        "fact_plain",
        """SELECT CAST(dd.DayOfWeek AS INTEGER) AS DayOfWeek,
       CAST(sum(fs.revenue_mv) AS DOUBLE) AS revenue
FROM fact_plain fs JOIN dates dd ON dd.date_sk = fs.date_sk
WHERE dd.CalendarYear = 1997 AND dd.QuarterOfYear = 2 GROUP BY 1""",
    ),
)
def weekday_revenue_of_quarter(r: Relations) -> DataFrame:
    """The report of one quarter over a fact stored by month: other months are not read."""
    folder = new_folder(r.spark, "sales-star")
    fact = fact_by_month(r.fact_sales, r.dates)
    write_partitioned(fact, f"{folder}/fact", ["month_sk"])
    quarter = stored_in(folder)("dates", r.dates).where("CalendarYear = 1997 AND QuarterOfYear = 2")
    return revenue_by_weekday_of(
        scan_parquet(r.spark, f"{folder}/fact", fact.schema), quarter
    ).withColumn("revenue", F.col("revenue").cast("double"))
