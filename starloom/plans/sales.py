"""The sales star: sales representatives as a type 2 dimension, the sales fact, two reports.

Input: ``sales`` (order_id, order_date, salesrep_id, amount), ``salesreps`` (salesrep_id,
name, office).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash_sql
from starloom.operators.joins import lookup, lookup_day, lookup_in_range
from starloom.operators.merge import merge
from starloom.operators.scd2 import FIRST_START, scd2_apply, scd2_initial
from starloom.operators.timeline import lookup_as_of, rebuild_versions

REP_KEY = "salesrep_id"
REP_SURROGATE = "salesrep_sk"
REP_TRACKED = ("name", "office")


def salesrep_dimension(salesreps: DataFrame, start: str = FIRST_START) -> DataFrame:
    """First load of the dimension."""
    return scd2_initial(salesreps, REP_KEY, REP_TRACKED, REP_SURROGATE, start)


def salesrep_increment(dimension: DataFrame, salesreps: DataFrame, run_at: str) -> DataFrame:
    """The dimension after a later load."""
    return scd2_apply(dimension, salesreps, REP_KEY, REP_TRACKED, REP_SURROGATE, run_at)


def salesrep_rebuild(dimension: DataFrame, changes: DataFrame) -> DataFrame:
    """The dimension after a load of changes (salesrep_id, name, office, changed_at), of which a
    representative may have several, in any order and dated before what is there."""
    return rebuild_versions(
        dimension, changes, REP_KEY, REP_TRACKED, REP_SURROGATE, "changed_at"
    )


def sales_fact(
    sales: DataFrame, dates: DataFrame, salesreps: DataFrame, long_histories: bool = False
) -> DataFrame:
    """One row per order with the date key and the key of the representative's version.

    A version holds after its start and up to and including its end. Orders without a
    calendar day or a version keep a null key.

    With ``long_histories`` orders and versions are merged in time, so that a representative
    may have any number of versions; otherwise an order meets all versions of its representative,
    and a dimension that can be broadcast spares the orders a shuffle.
    """
    of_version = (lookup_as_of if long_histories else lookup_in_range)(
        sales,
        salesreps,
        {REP_KEY: REP_KEY},
        "order_date",
        "scd_start",
        "scd_end",
        {REP_SURROGATE: REP_SURROGATE},
        start_included=False,
    )
    with_rep = lookup_day(
        of_version.selectExpr("*", "to_date(order_date) AS order_day"),
        dates,
        "order_day",
        "CalendarDate",
        {"date_sk": "date_sk"},
    )
    measures = ["1", "amount"]
    return with_rep.selectExpr(
        "order_id",
        "date_sk",
        REP_SURROGATE,
        "1 AS count_mv",
        "amount AS revenue_mv",
        f"{row_hash_sql('order_id', 'date_sk', REP_SURROGATE, *measures)} AS md5",
    )


def sales_fact_increment(fact: DataFrame, fresh: DataFrame, marked: bool = False) -> DataFrame:
    """Upsert by order: rows whose hash changed are replaced, new orders are added."""
    return merge(
        fact, fresh, ["order_id"], when="source.md5 <> target.md5", marked=marked
    )


def revenue_by_weekday(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue per day of the week. Facts are summed per date before they meet the calendar."""
    per_date = fact.groupBy("date_sk").agg(F.sum("revenue_mv").alias("revenue_mv"))
    return (
        per_date.join(dates, "date_sk")
        .groupBy("DayOfWeek")
        .agg(F.sum("revenue_mv").alias("revenue"))
    )


def revenue_by_office(fact: DataFrame, salesreps: DataFrame) -> DataFrame:
    """Revenue per office. Facts are summed per version first: a version with very many
    orders is one row by the time it is joined."""
    per_rep = fact.groupBy(REP_SURROGATE).agg(F.sum("revenue_mv").alias("revenue_mv"))
    return (
        per_rep.join(salesreps, REP_SURROGATE)
        .groupBy("office")
        .agg(F.sum("revenue_mv").alias("revenue"))
    )


def fact_by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The fact with ``month_sk`` (yyyymm) of its day, to be stored by it; null without a day."""
    return lookup(
        fact, dates, {"date_sk": "date_sk"}, {"month_sk": "CalendarYear * 100 + MonthOfYear"}
    )


def revenue_by_weekday_of(stored_fact: DataFrame, some_dates: DataFrame) -> DataFrame:
    """``revenue_by_weekday`` for some days of a fact that is stored by ``month_sk``.

    The days are given as a calendar with any filter. Its months are known before the fact is
    scanned, which then reads the folders of these months only.
    """
    days = some_dates.selectExpr(
        "date_sk", "DayOfWeek", "CalendarYear * 100 + MonthOfYear AS month_sk"
    )
    return (
        stored_fact.join(days, ["month_sk", "date_sk"])
        .groupBy("DayOfWeek")
        .agg(F.sum("revenue_mv").alias("revenue"))
    )
