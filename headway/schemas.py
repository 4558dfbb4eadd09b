"""Tables and live messages: columns, types, keys (OP-K11)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from .functions.cleaning import SCD_COLUMNS


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class TableSpec:
    """One table of a schedule feed.

    ``text_schema`` is what the file holds once cast; columns in ``dates`` come
    as yyyyMMdd numbers and end up as dates.
    """

    name: str
    columns: str
    key: tuple[str, ...]
    tracked: tuple[str, ...]
    dates: tuple[str, ...] = ()

    @property
    def text_schema(self) -> T.StructType:
        """Types right after casting."""
        pairs = (c.split() for c in self.columns.split(","))
        return T.StructType([T.StructField(n, TYPES[t]) for n, t in pairs])

    @property
    def schema(self) -> T.StructType:
        """Types after cleaning, without the version columns."""
        return T.StructType(
            [
                T.StructField(f.name, T.DateType() if f.name in self.dates else f.dataType)
                for f in self.text_schema.fields
            ]
        )

    @property
    def warehouse_schema(self) -> T.StructType:
        return (
            self.schema.add("start_dt_scd", "timestamp")
            .add("end_dt_scd", "timestamp")
            .add("is_current", "boolean")
        )

    @property
    def sort_key(self) -> tuple[str, ...]:
        """Storage order of the serving table."""
        return (*self.key, SCD_COLUMNS[0])


AGENCY = TableSpec(
    "agency",
    "agency_id string, agency_name string, agency_url string, agency_timezone string, "
    "agency_lang string, agency_phone string",
    key=("agency_id",),
    tracked=("agency_name", "agency_url", "agency_timezone", "agency_lang", "agency_phone"),
)
CALENDAR = TableSpec(
    "calendar",
    "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, "
    "saturday int, sunday int, start_date int, end_date int",
    key=("service_id",),
    tracked=(
        "monday",
        "tuesday",
        "wednesday",
        "thursday",
        "friday",
        "saturday",
        "sunday",
        "start_date",
        "end_date",
    ),
    dates=("start_date", "end_date"),
)
CALENDAR_DATES = TableSpec(
    "calendar_dates",
    "service_id string, date int, exception_type int",
    key=("service_id", "date"),
    tracked=("exception_type",),
    dates=("date",),
)
ROUTES = TableSpec(
    "routes",
    "route_id string, agency_id string, route_short_name string, route_long_name string, "
    "route_desc string, route_type int, route_color string, route_text_color string",
    key=("route_id",),
    tracked=(
        "agency_id",
        "route_short_name",
        "route_long_name",
        "route_desc",
        "route_type",
        "route_color",
        "route_text_color",
    ),
)
SHAPES = TableSpec(
    "shapes",
    "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int",
    key=("shape_id", "shape_pt_sequence"),
    tracked=("shape_pt_lat", "shape_pt_lon"),
)
STOPS = TableSpec(
    "stops",
    "stop_id int, stop_name string, stop_desc string, stop_lat double, stop_lon double, "
    "zone_id string, stop_url string, location_type int, parent_station string",
    key=("stop_id",),
    tracked=(
        "stop_name",
        "stop_desc",
        "stop_lat",
        "stop_lon",
        "zone_id",
        "stop_url",
        "location_type",
        "parent_station",
    ),
)
STOP_TIMES = TableSpec(
    "stop_times",
    "trip_id string, arrival_time string, departure_time string, stop_id int, "
    "stop_sequence int, pickup_type int, drop_off_type int, timepoint int",
    key=("trip_id", "stop_sequence"),
    tracked=(
        "arrival_time",
        "departure_time",
        "stop_id",
        "pickup_type",
        "drop_off_type",
        "timepoint",
    ),
)
TRIPS = TableSpec(
    "trips",
    "route_id string, service_id string, trip_id string, trip_headsign string, "
    "direction_id int, block_id int, shape_id string",
    key=("trip_id",),
    tracked=(
        "route_id",
        "service_id",
        "trip_headsign",
        "direction_id",
        "block_id",
        "shape_id",
    ),
)

TABLES = {
    t.name: t
    for t in (AGENCY, CALENDAR, CALENDAR_DATES, ROUTES, SHAPES, STOPS, STOP_TIMES, TRIPS)
}

# Live messages, as DDL: one JSON text holds a header and all entities of a poll.
VEHICLE_POSITIONS = (
    "header struct<gtfsRealtimeVersion: string, timestamp: string>, "
    "entity array<struct<id: string, vehicle: struct<"
    "trip: struct<tripId: string, routeId: string, startDate: string>, "
    "position: struct<latitude: double, longitude: double>, timestamp: string>>>"
)
TRIP_UPDATES = (
    "header struct<gtfsRealtimeVersion: string, incrementality: string, timestamp: string>, "
    "entity array<struct<id: string, tripUpdate: struct<"
    "trip: struct<tripId: string, routeId: string, directionId: int, startDate: string>, "
    "vehicle: struct<id: string>, "
    "stopTimeUpdate: array<struct<stopSequence: int, stopId: string, "
    "arrival: struct<time: string>, departure: struct<time: string>>>, "
    "timestamp: string, delay: int>>>"
)
ALERTS = (
    "header struct<gtfsRealtimeVersion: string, timestamp: string>, "
    "entity array<struct<id: string, alert: struct<"
    "activePeriod: array<struct<start: string, end: string>>, "
    "informedEntity: array<struct<agencyId: string, routeId: string>>, "
    "headerText: struct<translation: array<struct<text: string, language: string>>>, "
    "descriptionText: struct<translation: array<struct<text: string, language: string>>>>>>"
)
VERSIONS = "feed_url string, version_date string"
FEED_METRICS = "timestamp timestamp, feed string, metric string, value bigint"
STOP_BOROUGHS = "stop_id string, borough string"
