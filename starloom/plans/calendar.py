"""Calendar dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.functions.dates import calendar_attributes, date_int
from starloom.sources.files import days_between, generate_dates


def _dimension(days: DataFrame) -> DataFrame:
    """``date_sk`` counts the days from 0; being computed per row it needs no ordering."""
    return days.selectExpr(
        "cast(datediff(day, first_day) AS bigint) AS date_sk", *calendar_attributes("day")
    )


def date_dimension(spark: SparkSession, begin: str, end: str) -> DataFrame:
    """The calendar from ``begin`` to ``end``, both included."""
    return _dimension(generate_dates(spark, begin, end))


def date_dimension_over(df: DataFrame, day: str) -> DataFrame:
    """The calendar from the first to the last value of a date or timestamp column."""
    bounds = df.selectExpr(f"min(to_date({day})) AS lowest", f"max(to_date({day})) AS highest")
    return _dimension(days_between(bounds, "lowest", "highest"))


def ride_dates(rides: DataFrame) -> DataFrame:
    """Distinct start and end dates in one pass over the rides."""
    return (
        rides.selectExpr("explode(array(to_date(starttime), to_date(endtime))) AS ride_date")
        .where("ride_date IS NOT NULL")
        .distinct()
    )


def ride_date_dimension(rides: DataFrame) -> DataFrame:
    """One row per date on which a ride starts or ends; the key is the integer yyyymmdd."""
    return ride_dates(rides).selectExpr(
        f"{date_int('ride_date')} AS date_sk",
        "ride_date AS date",
        "year(ride_date) AS year",
        "quarter(ride_date) AS quarter",
        "month(ride_date) AS month_nr",
        "date_format(ride_date, 'MMMM') AS month_name",
        "dayofmonth(ride_date) AS day_nr",
        "date_format(ride_date, 'EEEE') AS day_name",
        "dayofweek(ride_date) NOT IN (1, 7) AS is_weekday",
    )
