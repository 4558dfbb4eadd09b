"""Warehouse to the serving store for one service date (OP-C4 -> OP-K2 -> OP-W2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from headway.operators.latest import latest_per_key
from headway.operators.snapshot import (
    calendar_dates_on_date,
    calendar_on_date,
    cascade,
    semi,
    services_on_date,
)
from headway.schemas import TABLES
from headway.sinks.tables import VersionedTable, append_serving, service_day

from . import side_by_side
from .daily_load import warehouse_table


def open_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {name: warehouse_table(spark, warehouse, name).read_open() for name in TABLES}


def write_snapshot(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    serving: str,
    service_date: dt.date,
    mode: str = "reference",
) -> None:
    """Write the eight tables of a date. Trips and stop times are written first
    and the rest cascades from what was written, so each is computed once."""
    serving = serving.rstrip("/")

    def write(name: str, df: DataFrame) -> DataFrame:
        append_serving(df, f"{serving}/{name}", service_date)
        return spark.read.schema(df.schema).parquet(service_day(f"{serving}/{name}", service_date))

    calendar, exceptions = tables["calendar"], tables["calendar_dates"]
    services = services_on_date(calendar, exceptions, service_date, mode)
    trips = write("trips", semi(tables["trips"], services, "service_id"))
    stop_times = write("stop_times", cascade(tables, trips)["stop_times"])
    rest = {
        **cascade(tables, trips),
        "stops": semi(tables["stops"], stop_times, "stop_id").distinct(),
        "calendar": calendar_on_date(calendar, service_date),
        "calendar_dates": calendar_dates_on_date(exceptions, service_date),
    }
    names = ("routes", "shapes", "agency", "stops", "calendar", "calendar_dates")
    side_by_side(partial(write, name, rest[name]) for name in names)


def compact_serving(
    spark: SparkSession, serving: str, published: str, service_date: dt.date
) -> None:
    """OP-W2 in steps: what is published and the rows of one more date, cut to
    the newest version of every key. Dates already published are not read."""

    def compact(name: str) -> None:
        spec = TABLES[name]
        day = spark.read.parquet(service_day(f"{serving.rstrip('/')}/{name}", service_date))
        target = VersionedTable(spark, f"{published.rstrip('/')}/{name}")
        rows = day if target.version() is None else target.read().unionByName(day)
        target.replace(latest_per_key(rows, spec.key, ["start_dt_scd"]), spec.sort_key)
        target.drop_old()

    side_by_side(partial(compact, name) for name in TABLES)
