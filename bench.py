"""Wall time of the headline queries, warm, median of three.

Prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from headway.demos import QUERIES, live
from headway.operators import nested
from headway.schemas import ALERTS, TRIP_UPDATES, VEHICLE_POSITIONS
from headway.session import ensure_shared, scratch_path, tune

# Streams and file round trips write as they go; the rest end in a no-op write.
HEADLINE = (
    "clean_typed",
    "haversine",
    "depot_borough",
    "spatial_borough",
    "flatten_vehicle_positions",
    "flatten_trip_updates",
    "flatten_alerts",
    "asof_join",
    "trip_monitor",
    "live_vehicles",
    "borough_route_perf",
    "alert_counts",
    "feed_change_gate",
    "feed_metrics",
    "scd2_merge",
    "latest_per_key",
    "services_on_date",
    "semi_cascade",
    "service_snapshot_counts",
    "schedule_with_stops",
    "sorted_layout",
    "stream_vehicle_positions",
    "stream_trip_monitor",
    "stream_feed_gate",
    "versioned_monitor",
    "scd2_from_log",
    "services_in_range",
    "active_vehicles_rollup",
    "dashboard_delta",
)


# Parsing and flattening alone, over messages landed before as many files: the tables are one row group each, and
# building the JSON texts is not what these measure.
MESSAGES = {
    "flatten_vehicle_positions": (live.vehicle_messages, VEHICLE_POSITIONS, nested.flatten_vehicle_positions),
    "flatten_trip_updates": (live.trip_update_messages, TRIP_UPDATES, nested.flatten_trip_updates),
    "flatten_alerts": (live.alert_messages, ALERTS, nested.flatten_alerts),
}


def landed(spark: SparkSession, sf_dir: str, name: str, files: int) -> DataFrame:
    """Not timed: the messages of a query as files, and the query over them."""
    build, schema, flatten = MESSAGES[name]
    path = scratch_path(spark, name)
    build(spark, sf_dir).repartition(files).write.parquet(path)
    return flatten(nested.parse_envelope(nested.decode(spark.read.parquet(path)), schema))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(ensure_shared(spark))
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        ready = landed(spark, sf_dir, name, 4 * int(cpus)) if name in MESSAGES else None
        for _ in range(4):
            start = time.perf_counter()
            (QUERIES[name](spark, sf_dir) if ready is None else ready).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm median of 3, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cores": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
