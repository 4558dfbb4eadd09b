"""Matching against the schedule that was valid at the time (OP-C3 with OP-C6, OP-N1).

Validity is a second axis next to the time of day. It is cut at the change points of a key,
the instants at which any of its rows begins or ends, into elementary segments in which nothing
changes. Within a segment the schedule of a trip is an ordinary one, so the as-of lookup works on
(trip, segment) as it does on trips alone, and a position meets one segment however many versions
its trip has had. Change points are the instants of loads, so a key has no more of
them than there were loads; rows are spread over the segments they span, never paired with each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.clock import hms_to_seconds

from .asof import asof_join, interval_index
from .monitor import trip_monitor
from .skew import one_per_key

START, END = "start_dt_scd", "end_dt_scd"


def change_points(dim: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` and ``points``: the instants, ascending, at which rows of the key begin or end."""
    marks = dim.select(*by, F.explode(F.array(START, END)).alias("__p")).filter("__p IS NOT NULL")
    return one_per_key(marks, by, F.sort_array(F.collect_set("__p")).alias("points"))


def cut(dim: DataFrame, by: Sequence[str], points: DataFrame) -> DataFrame:
    """Rows cut at the change points of their key, with ``segment``: the last point at or before the piece.

    ``points`` may be those of another table; pieces before its first point have no segment and
    rows of keys it does not know are dropped. Rows that are valid at no instant are dropped too.

    The join is a sort-merge join whatever Spark takes the sizes for: it would judge ``points`` by the compressed size of
    the files they come from, and collect a row per key on the driver to send it out.
    """
    start, end = F.col(START), F.col(END)
    ever = start.isNotNull() & (end.isNull() | (start < end))
    inside = F.filter("points", lambda p: (p > F.col(START)) & (F.col(END).isNull() | (p < F.col(END))))
    pieces = (
        dim.filter(ever)
        .join(points.hint("merge"), list(by))
        .withColumn("__inside", inside)
        .withColumn("__from", F.concat(F.array(start), F.col("__inside")))
        .withColumn("__to", F.concat(F.col("__inside"), F.array(end)))
        .withColumn("__piece", F.explode(F.arrays_zip("__from", "__to")))
        .withColumns({START: F.col("__piece.__from"), END: F.col("__piece.__to")})
    )
    segment = F.array_max(F.filter("points", lambda p: p <= F.col(START)))
    return pieces.withColumn("segment", segment).select(*dim.columns, "segment")


def valid_join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of two versioned tables that share the key and were valid together, with the time
    they were. Both have the validity columns; other columns must not clash, except for ``by``."""
    points = change_points(right, by)
    sides = cut(right, by, points).drop(START, END, "is_current")
    met = cut(left, by, points).join(sides, [*by, "segment"])
    return met.drop("segment")


@dataclass(frozen=True)
class VersionedSchedule:
    """Lookup index by (trip, segment), and the segments of each trip."""

    index: DataFrame
    segments: DataFrame  # trip_id, segment


def schedule_versions(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """OP-N1 over all versions: arrival times with the place their stop had meanwhile.

    Write it before building the index, which reads it twice.
    """
    kind = stops.schema["stop_id"].dataType
    times = stop_times.select(
        "trip_id", "arrival_time", "stop_sequence", F.col("stop_id").try_cast(kind).alias("stop_id"), START, END
    )
    return valid_join(times, stops.select("stop_id", "stop_name", "stop_lat", "stop_lon", START, END), ["stop_id"])


def versioned_schedule(versions: DataFrame) -> VersionedSchedule:
    """``schedule_versions`` in the shape the monitor looks up. Serves all dates and versions."""
    points = change_points(versions, ["trip_id"])
    rows = cut(versions, ["trip_id"], points).withColumn("offset_s", hms_to_seconds("arrival_time"))
    index = interval_index(
        rows.drop("arrival_time", START, END), ["trip_id", "segment"], "offset_s", ["stop_sequence", "stop_id"]
    )
    return VersionedSchedule(index, points.select("trip_id", F.explode("points").alias("segment")))


def versioned_monitor(
    pings: DataFrame, schedule: VersionedSchedule, tz: str, at: str = "vehicle_timestamp", bucket_width: int = 86400, **options
) -> DataFrame:
    """OP-C6 for any day: each position against the schedule valid at ``at``.

    Positions of trips that had no schedule then are dropped, as are those before the first
    stop. A replay of old positions gives what the monitor gave, or would have given, at the time.
    """
    asked = pings.withColumn("trip_id", F.col("vp_trip_id"))
    known = asof_join(asked, schedule.segments, ["trip_id"], at, "segment", bucket_width=bucket_width).drop("trip_id")
    return trip_monitor(known, schedule.index, tz, by=(("vp_trip_id", "trip_id"), ("segment", "segment")), **options)
