from __future__ import annotations

from starloom.plans.calendar import (
    date_dimension,
    date_dimension_over,
    ride_date_dimension,
    ride_dates,
)


def test_fifteen_years(spark):
    dates = date_dimension(spark, "2009-01-01", "2023-12-31")
    assert len(dates.columns) == 15
    assert dates.count() == 5478
    first = dates.orderBy("CalendarDate").first()
    assert (first.date_sk, first.dateInt, first.CalendarDay) == (0, 20090101, "Thursday")
    assert (first.DayOfWeek, first.DayOfWeekStartMonday, first.IsWeekDay) == (5, 4, "Y")
    assert (first.WeekOfYearIso, first.QuarterOfYear, first.IsLastDayOfMonth) == (1, 1, "N")
    assert dates.select("date_sk").distinct().count() == 5478
    weekend = dates.where("IsWeekDay = 'N'").select("CalendarDay").distinct().collect()
    assert {row[0] for row in weekend} == {"Saturday", "Sunday"}


def test_key_follows_the_date(spark):
    dates = date_dimension(spark, "2009-01-01", "2009-03-01")
    assert dates.where("date_sk <> datediff(CalendarDate, date'2009-01-01')").count() == 0


def test_bounds_from_data(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp'2024-02-28 10:00:00', timestamp'2024-03-01 00:00:00',"
        " NULL)) AS at"
    )
    dates = date_dimension_over(df, "at").orderBy("date_sk").collect()
    assert [str(row.CalendarDate) for row in dates] == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_ride_dates(spark, rows):
    rides = spark.sql(
        "SELECT * FROM VALUES (timestamp'2024-03-01 23:50:00', timestamp'2024-03-02 00:10:00'),"
        " (timestamp'2024-03-01 08:00:00', NULL), (timestamp'2024-03-02 08:00:00',"
        " timestamp'2024-03-02 09:00:00') AS r(starttime, endtime)"
    )
    assert [str(r[0]) for r in rows(ride_dates(rides))] == ["2024-03-01", "2024-03-02"]
    dimension = ride_date_dimension(rides)
    assert rows(dimension, "date_sk", "day_name", "is_weekday") == [
        (20240301, "Friday", True),
        (20240302, "Saturday", False),
    ]
