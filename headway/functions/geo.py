"""Positions: distance, arrival status, delay (OP-P14..P16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import as_col

# Mean earth radius in metres, arrival radius in metres.
EARTH_RADIUS_M = 6371000.0
ARRIVAL_RADIUS_M = 100.0


def haversine_m(
    lon1: Column | str, lat1: Column | str, lon2: Column | str, lat2: Column | str
) -> Column:
    """OP-P14: great-circle metres; NULL if any coordinate is."""
    x1, y1, x2, y2 = (F.radians(as_col(c)) for c in (lon1, lat1, lon2, lat2))
    h = F.pow(F.sin((y2 - y1) / 2), 2) + F.cos(y1) * F.cos(y2) * F.pow(F.sin((x2 - x1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(h))


def arrival_status(distance: Column | str, radius: float = ARRIVAL_RADIUS_M) -> Column:
    """OP-P15: ``arrived`` within the radius (inclusive), else ``on_way``."""
    return F.when(as_col(distance) <= radius, "arrived").otherwise("on_way")


def delay_seconds(status: Column | str, actual: Column | str, scheduled: Column | str) -> Column:
    """OP-P16: whole seconds behind schedule for arrived rows."""
    late = F.unix_seconds(as_col(actual)) - F.unix_seconds(as_col(scheduled))
    return F.when(as_col(status) == "arrived", late)
