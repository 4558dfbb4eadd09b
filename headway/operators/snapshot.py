"""What runs on a service date (OP-U1, OP-N6, OP-A2, OP-C4)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.clock import runs_on

from .skew import one_per_key

ADDED, REMOVED = 1, 2  # exception types of the feed standard


def calendar_on_date(calendar: DataFrame, service_date: dt.date) -> DataFrame:
    return calendar.filter(runs_on(service_date))


def calendar_dates_on_date(calendar_dates: DataFrame, service_date: dt.date) -> DataFrame:
    """OP-P20: exceptions of the date."""
    return calendar_dates.filter(F.col("date") == F.lit(service_date))


def services_on_date(
    calendar: DataFrame,
    calendar_dates: DataFrame,
    service_date: dt.date,
    mode: str = "reference",
) -> DataFrame:
    """OP-U1: distinct ``service_id`` running on the date.

    ``mode="reference"`` takes every exception of the date as an addition;
    ``mode="gtfs"`` honours its type: 1 adds the service, 2 removes it.
    """
    regular = calendar_on_date(calendar, service_date).select("service_id")
    exceptions = calendar_dates_on_date(calendar_dates, service_date)
    if mode == "gtfs":
        removed = exceptions.filter(F.col("exception_type") == REMOVED).select("service_id")
        regular = regular.join(one_per_key(removed, ["service_id"]), "service_id", "left_anti")
        exceptions = exceptions.filter(F.col("exception_type") == ADDED)
    elif mode != "reference":
        raise ValueError(f"unknown mode {mode!r}")
    return regular.union(exceptions.select("service_id")).distinct()


def semi(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``.

    The right side is reduced to its keys before it is shuffled: most of the
    cascade goes from a large table to the few keys it mentions.
    """
    return left.join(one_per_key(right, [key]), key, "left_semi").select(*left.columns)


def service_snapshot(
    tables: Mapping[str, DataFrame], service_date: dt.date, mode: str = "reference"
) -> dict[str, DataFrame]:
    """OP-C4: the eight tables cut to a service date; ``tables`` holds open rows.

    ``trips`` feeds four of the others. Write it first and cascade from the
    written table (``plans.daily_snapshot``) to compute it once.
    """
    calendar, exceptions = tables["calendar"], tables["calendar_dates"]
    services = services_on_date(calendar, exceptions, service_date, mode)
    return {
        "calendar": calendar_on_date(calendar, service_date),
        "calendar_dates": calendar_dates_on_date(exceptions, service_date),
        **cascade(tables, semi(tables["trips"], services, "service_id")),
    }


def cascade(tables: Mapping[str, DataFrame], trips: DataFrame) -> dict[str, DataFrame]:
    """OP-N6: what the given trips use, duplicates dropped."""
    stop_times = semi(tables["stop_times"], trips, "trip_id").distinct()
    routes = semi(tables["routes"], trips, "route_id").distinct()
    return {
        "trips": trips,
        "stop_times": stop_times,
        "routes": routes,
        "shapes": semi(tables["shapes"], trips, "shape_id").distinct(),
        "agency": semi(tables["agency"], routes, "agency_id").distinct(),
        "stops": semi(tables["stops"], stop_times, "stop_id").distinct(),
    }
