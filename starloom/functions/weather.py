"""Weather categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category names, clear-sky codes and the lowest pleasant temperature.
UNKNOWN = "Unknown"
UNPLEASANT = "Unpleasant"
PLEASANT = "Pleasant"
NEUTRAL = "Neutral"
CLEAR_SKY_CODES = (0, 1, 2, 3)
PLEASANT_FROM_DEGREES = 15


def weather_category(temperature: str, precipitation: str, code: str) -> Column:
    """Category of one hour; any missing measurement makes it unknown."""
    return F.expr(
        f"CASE WHEN {temperature} IS NULL OR {precipitation} IS NULL OR {code} IS NULL"
        f" THEN '{UNKNOWN}'"
        f" WHEN {precipitation} > 0 THEN '{UNPLEASANT}'"
        f" WHEN {temperature} >= {PLEASANT_FROM_DEGREES} AND {code} IN {CLEAR_SKY_CODES}"
        f" THEN '{PLEASANT}' ELSE '{NEUTRAL}' END"
    )
