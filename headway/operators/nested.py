"""Live messages: parse and flatten (OP-S8, OP-J1..J5, OP-P8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.clock import epoch_to_ts


def decode(df: DataFrame) -> DataFrame:
    """OP-S8: message bytes to text, the topic kept if there is one."""
    topic = ["topic"] if "topic" in df.columns else []
    return df.select(F.col("value").cast("string").alias("json_str"), *topic)


def parse_envelope(df: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """OP-J1: ``header`` and ``entity`` of each message; broken text gives NULLs."""
    return df.select(F.from_json("json_str", schema).alias("m"), *keep).select("m.*", *keep)


def _entities(df: DataFrame) -> DataFrame:
    """One row per entity, and one with a NULL entity for a message without any.

    The flatteners drop that row again. A plain ``explode`` of a column makes
    the optimizer test the array before it, and the test, pushed down through
    the parsing, parses each message twice more.
    """
    return df.select("header", F.explode_outer("entity").alias("e"))


def flatten_vehicle_positions(df: DataFrame, header_time: bool = False) -> DataFrame:
    """OP-J2/J3: one row per vehicle that is on a trip."""
    e = _entities(df).filter("e.vehicle.trip.tripId IS NOT NULL")
    columns = [
        F.col("header.gtfsRealtimeVersion").alias("gtfs_version"),
        F.col("e.id").alias("entity_id"),
        F.col("e.vehicle.trip.tripId").alias("vp_trip_id"),
        F.col("e.vehicle.trip.routeId").alias("route_id"),
        F.col("e.vehicle.trip.startDate").alias("vp_start_date"),
        F.col("e.vehicle.position.latitude").alias("latitude"),
        F.col("e.vehicle.position.longitude").alias("longitude"),
        epoch_to_ts(F.col("e.vehicle.timestamp")).alias("vehicle_timestamp"),
    ]
    if header_time:
        columns.append(epoch_to_ts(F.col("header.timestamp")).alias("header_timestamp"))
    return e.select(columns)


def flatten_trip_updates(df: DataFrame) -> DataFrame:
    """OP-J4: one row per stop of each updated trip; times stay text."""
    s = _entities(df).select("header", "e", F.explode("e.tripUpdate.stopTimeUpdate").alias("s"))
    return s.select(
        F.col("header.gtfsRealtimeVersion").alias("gtfs_version"),
        F.col("header.incrementality").alias("incrementality"),
        F.col("header.timestamp").alias("header_timestamp"),
        F.col("e.id").alias("entity_id"),
        F.col("e.tripUpdate.trip.tripId").alias("trip_id"),
        F.col("e.tripUpdate.trip.routeId").alias("route_id"),
        F.col("e.tripUpdate.trip.directionId").alias("direction_id"),
        F.col("e.tripUpdate.trip.startDate").alias("start_date"),
        F.col("e.tripUpdate.vehicle.id").alias("vehicle_id"),
        F.col("s.stopSequence").alias("stop_sequence"),
        F.col("s.stopId").alias("stop_id"),
        F.col("s.arrival.time").alias("arrival_time"),
        F.col("s.departure.time").alias("departure_time"),
        F.col("e.tripUpdate.timestamp").alias("trip_timestamp"),
        F.col("e.tripUpdate.delay").alias("delay"),
    )


def flatten_alerts(df: DataFrame, outer: bool = False) -> DataFrame:
    """OP-J5: one row per period, informed entity, header text and description.

    An alert with one of these lists missing or empty gives no row;
    ``outer=True`` keeps it with NULLs instead.
    """

    def unnest(rows: DataFrame, path: str, name: str) -> DataFrame:
        if outer:
            return rows.withColumn(name, F.explode_outer(path))
        return rows.withColumn(name, F.explode(path)).filter(F.col(name).isNotNull())

    rows = unnest(_entities(df), "e.alert.activePeriod", "period")
    rows = unnest(rows, "e.alert.informedEntity", "informed")
    rows = unnest(rows, "e.alert.headerText.translation", "head")
    rows = unnest(rows, "e.alert.descriptionText.translation", "body")
    return rows.select(
        F.col("header.gtfsRealtimeVersion").alias("gtfsRealtimeVersion"),
        F.col("header.timestamp").alias("timestamp"),
        F.col("e.id").alias("id"),
        F.col("period.start").alias("activePeriod_start"),
        F.col("period.end").alias("activePeriod_end"),
        F.col("informed.agencyId").alias("agencyId"),
        F.col("informed.routeId").alias("routeId"),
        F.col("head.text").alias("header_text"),
        F.col("head.language").alias("header_language"),
        F.col("body.text").alias("description_text"),
        F.col("body.language").alias("description_language"),
    )
