"""Calendar attributes, durations and subscription periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Subscription type -> end of the period, from its start.
PERIOD_ENDS = {
    "DAG": "date_add({start}, 1)",
    "MAAND": "add_months({start}, 1)",
    "JAAR": "add_months({start}, 12)",
}
DEFAULT_PERIOD_END = "date_add({start}, 1)"


def date_int(day: str) -> str:
    """A date as the integer yyyymmdd."""
    return f"year({day}) * 10000 + month({day}) * 100 + dayofmonth({day})"


def calendar_attributes(day: str) -> list[str]:
    """The attribute columns of a calendar dimension, named."""
    return [
        f"{date_int(day)} AS dateInt",
        f"{day} AS CalendarDate",
        f"year({day}) AS CalendarYear",
        f"date_format({day}, 'MMMM') AS CalendarMonth",
        f"month({day}) AS MonthOfYear",
        f"date_format({day}, 'EEEE') AS CalendarDay",
        f"dayofweek({day}) AS DayOfWeek",
        f"weekday({day}) + 1 AS DayOfWeekStartMonday",
        f"if(dayofweek({day}) IN (1, 7), 'N', 'Y') AS IsWeekDay",
        f"dayofmonth({day}) AS DayOfMonth",
        f"if({day} = last_day({day}), 'Y', 'N') AS IsLastDayOfMonth",
        f"dayofyear({day}) AS DayOfYear",
        f"weekofyear({day}) AS WeekOfYearIso",
        f"quarter({day}) AS QuarterOfYear",
    ]


def minutes_between(start: str, end: str) -> Column:
    """Whole-second difference in minutes, two decimals; negative if the end comes first."""
    return F.expr(f"round((unix_timestamp({end}) - unix_timestamp({start})) / 60, 2)")


def period_end(start: str, period: str) -> Column:
    """Last day of a subscription that starts on ``start``."""
    branches = " ".join(
        f"WHEN '{name}' THEN {end.format(start=start)}" for name, end in PERIOD_ENDS.items()
    )
    fallback = DEFAULT_PERIOD_END.format(start=start)
    return F.expr(f"CASE {period} {branches} ELSE {fallback} END")
