"""Points and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0088
_POINT = r"^\\s*\\(\\s*([^,()\\s]+)\\s*,\\s*([^,()\\s]+)\\s*\\)\\s*$"


def point_latitude(text: str) -> Column:
    """Latitude of a point written ``(lat,lon)``; null if the text is not such a point."""
    return F.expr(f"try_cast(regexp_extract({text}, '{_POINT}', 1) AS double)")


def point_longitude(text: str) -> Column:
    """Longitude of a point written ``(lat,lon)``; null if the text is not such a point."""
    return F.expr(f"try_cast(regexp_extract({text}, '{_POINT}', 2) AS double)")


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in kilometres, 0 for equal points, null without coordinates."""
    half_chord = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return F.expr(
        f"CASE WHEN {lat1} = {lat2} AND {lon1} = {lon2} THEN 0D "
        f"WHEN {lat1} + {lon1} + {lat2} + {lon2} IS NOT NULL "
        f"THEN 2 * {EARTH_RADIUS_KM}D * asin(least(1D, sqrt({half_chord}))) END"
    )
