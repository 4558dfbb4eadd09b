"""Trip monitor: vehicle positions against the schedule (OP-C6, OP-N1..N3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.clock import hms_to_seconds, service_midnight
from headway.functions.depots import depot_borough
from headway.functions.geo import ARRIVAL_RADIUS_M, arrival_status, delay_seconds, haversine_m

from .asof import asof_lookup, interval_index
from .latest import latest_per_key

MONITOR_COLUMNS = (
    "gtfs_version",
    "entity_id",
    "vp_trip_id",
    "route_id",
    "vp_start_date",
    "latitude",
    "longitude",
    "vehicle_timestamp",
    "header_timestamp",
    "stop_id",
    "stop_name",
    "stop_lat",
    "stop_lon",
    "scheduled_arrival",
    "distance",
    "status",
    "delay_seconds",
    "borough",
)
OBSERVATION = ("entity_id", "vp_trip_id", "vehicle_timestamp")


def schedule_with_stops(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """OP-N1: arrival times with the place of their stop."""
    places = stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
    times = stop_times.select("trip_id", "arrival_time", "stop_sequence", "stop_id")
    # Stop ids are numbers in the warehouse and text in live messages.
    kind = stops.schema["stop_id"].dataType
    times = times.withColumn("stop_id", F.col("stop_id").try_cast(kind))
    return times.join(places, "stop_id", "inner")


def schedule_index(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Schedule in the shape the monitor looks up; serves every service date.

    Build it once per schedule version and keep it (``streaming.static``).
    """
    rows = schedule_with_stops(stop_times, stops).withColumn(
        "offset_s", hms_to_seconds("arrival_time")
    )
    return interval_index(
        rows.drop("arrival_time"), ["trip_id"], "offset_s", ["stop_sequence", "stop_id"]
    )


def trip_monitor(
    pings: DataFrame,
    index: DataFrame,
    tz: str,
    anchor: str = "midnight",
    radius: float = ARRIVAL_RADIUS_M,
    one_per_observation: bool = True,
    by: Sequence[tuple[str, str]] = (("vp_trip_id", "trip_id"),),
) -> DataFrame:
    """OP-C6: each position with the stop last due on its trip, distance,
    status, delay and borough.

    Positions before the first stop of their trip are dropped. A position that
    repeats (entity, trip, time) is given once; that needs a shuffle of the
    result and does not run in a streaming plan, hence the flag. ``by`` pairs
    columns of positions and index that have to agree.
    """
    midnight = service_midnight(F.try_to_date("vp_start_date", "yyyyMMdd"), tz, anchor)
    timed = pings.withColumn("__midnight", midnight).withColumn(
        "__elapsed", F.unix_seconds("vehicle_timestamp") - F.col("__midnight")
    )
    due = asof_lookup(timed, index, by, "__elapsed", "__due")
    rows = (
        due.withColumn("scheduled_arrival", F.timestamp_seconds(F.col("__midnight") + F.col("__due")))
        .withColumn("distance", haversine_m("longitude", "latitude", "stop_lon", "stop_lat"))
        .withColumn("status", arrival_status("distance", radius))
        .withColumn(
            "delay_seconds", delay_seconds("status", "vehicle_timestamp", "scheduled_arrival")
        )
    )
    if one_per_observation:
        rows = latest_per_key(
            rows, OBSERVATION, ["scheduled_arrival", "stop_sequence", "stop_id"]
        )
    return rows.withColumn("borough", depot_borough("vp_trip_id")).select(*MONITOR_COLUMNS)
