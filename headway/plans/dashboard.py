"""Dashboard tables from stored monitor rows and alerts (OP-M1..M7)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import metrics
from headway.operators.monitor import MONITOR_COLUMNS
from headway.session import filesystem
from headway.sinks.tables import VersionedTable

from . import side_by_side


def dashboard_tables(monitor: DataFrame, alerts: DataFrame | None = None) -> dict[str, DataFrame]:
    out = {
        "live_vehicles": metrics.live_vehicles(monitor),
        "otp_by_route": metrics.on_time_performance(monitor, ["route_id"]),
        "avg_delay_by_hour": metrics.average_delay(monitor, ["route_id"], "1 hour"),
        "borough_routes": metrics.borough_route_performance(monitor),
        "active_vehicles": metrics.active_vehicles(monitor),
        "arrival_rate": metrics.arrival_rate(monitor),
    }
    return out if alerts is None else out | {"alert_counts": metrics.alert_counts(alerts)}


def refresh_parts(spark: SparkSession, monitor: str, parts: str) -> list[int]:
    """Partial figures for each group of batch folders that has changed since they were made.

    A group's folder changes its time when a batch is added or done again. Its figures lie under that time, read
    before they were made, so a change meanwhile makes them stale once more; they replace the group's old ones.
    Groups that are over are read once.
    """
    monitor, parts = monitor.rstrip("/"), parts.rstrip("/")

    def folders(path: str, prefix: str) -> dict[int, int]:
        fs, found = filesystem(spark, path)
        if not fs.exists(found):
            return {}
        there = [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(found)]
        return {int(name.removeprefix(prefix)): at for name, at in there if name.startswith(prefix)}

    made = []
    for group, changed in sorted(folders(monitor, "batches=").items()):
        have = folders(f"{parts}/batches={group}", "asof=")
        fs, done = filesystem(spark, f"{parts}/batches={group}/asof={changed}/_SUCCESS")
        if changed in have and fs.exists(done):
            continue
        rows = spark.read.parquet(f"{monitor}/batches={group}").select(*MONITOR_COLUMNS)
        metrics.partial_figures(rows).coalesce(1).write.mode("overwrite").parquet(f"{parts}/batches={group}/asof={changed}")
        for old in have:
            if old != changed:
                fs.delete(filesystem(spark, f"{parts}/batches={group}/asof={old}")[1], True)
        made.append(group)
    return made


def figures_of_parts(spark: SparkSession, parts: str) -> dict[str, DataFrame]:
    """OP-M2, M3, M5, M7 from partial figures alone. Of a group that is being replaced the newest ones count."""
    rows = spark.read.option("basePath", parts).parquet(parts)
    newest = rows.groupBy("batches").agg(F.max("asof").alias("asof"))
    rows = rows.join(newest, ["batches", "asof"]).select(*metrics.PART_KEYS, *metrics.SUMS)
    return {
        "otp_by_route": metrics.on_time_performance_of(rows, ["route_id"]),
        "avg_delay_by_hour": metrics.average_delay_of(rows, ["route_id"], "1 hour"),
        "borough_routes": metrics.borough_route_performance_of(rows),
        "arrival_rate": metrics.arrival_rate_of(rows),
    }


def publish_dashboard(
    spark: SparkSession, monitor: str, output: str, alerts: str | None = None, parts: str | None = None
) -> None:
    """Replace every table below ``output``; readers see the old one or the new one.

    With ``parts``, figures that are sums are kept there per group of batches, and a run only reads the groups
    that have changed for them.
    """
    # A flow's folder also has the columns of its batch folders, which are no part of a row.
    rows = spark.read.parquet(monitor).select(*MONITOR_COLUMNS)
    tables = dashboard_tables(rows, spark.read.parquet(alerts).select("id", "routeId") if alerts else None)
    if parts:
        refresh_parts(spark, monitor, parts)
        tables |= figures_of_parts(spark, parts)

    def put(name: str) -> None:
        target = VersionedTable(spark, f"{output.rstrip('/')}/{name}")
        target.replace(tables[name])
        target.drop_old()

    side_by_side(partial(put, name) for name in tables)
