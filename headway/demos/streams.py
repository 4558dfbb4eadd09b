"""The live feeds as streams: messages landed as files, taken up to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.operators.monitor import MONITOR_COLUMNS
from headway.session import scratch_path
from headway.sources.messages import directory_messages
from headway.streaming import flows, replay, windows
from headway.streaming.gate import gate_sink
from headway.streaming.static import Refreshed

from . import live
from .registry import demo, instant, table, wall


# Messages of a landed file, which is read by one task: compressed text cannot be split.
PER_FILE = 100_000


def land(messages, path: str) -> None:
    """As compressed texts: messages repeat their field names, and plain they are many times the tables."""
    messages.write.mode("append").partitionBy("topic").options(compression="snappy", maxRecordsPerFile=PER_FILE).text(path)


def landed(spark, messages) -> str:
    path = scratch_path(spark, "landing")
    land(messages, path)
    return path


def finished(query) -> None:
    query.awaitTermination()


def run_files(spark, stream):
    """Run a stream into batch folders and give what was written."""
    out = scratch_path(spark, "stream")
    finished(
        flows.start_append(stream, flows.batch_files(out), scratch_path(spark, "ckpt"), trigger=None)
    )
    return spark.read.parquet(out).select(*stream.columns)


@demo("stream_vehicle_positions", live.SQL_POSITIONS)
def _stream_vehicle_positions(spark, sf_dir):
    source = directory_messages(spark, landed(spark, live.vehicle_messages(spark, sf_dir)))
    out = run_files(spark, flows.vehicle_position_stream(source))
    return out.withColumn("vehicle_timestamp", wall("vehicle_timestamp"))


@demo("stream_trip_updates", live.SQL_UPDATES)
def _stream_trip_updates(spark, sf_dir):
    source = directory_messages(spark, landed(spark, live.trip_update_messages(spark, sf_dir)))
    return run_files(spark, flows.trip_update_stream(source))


@demo("stream_alerts", live.SQL_ALERTS)
def _stream_alerts(spark, sf_dir):
    source = directory_messages(spark, landed(spark, live.alert_messages(spark, sf_dir)))
    return run_files(spark, flows.alert_stream(source))


@demo("stream_trip_monitor", f"WITH {live.SQL_MONITOR} SELECT * FROM monitor")
def _stream_trip_monitor(spark, sf_dir):
    messages = live.vehicle_messages(spark, sf_dir, views=False)
    source = directory_messages(spark, landed(spark, messages))
    out = scratch_path(spark, "monitor")
    index = Refreshed(lambda: live.schedule(spark, sf_dir))
    finished(
        flows.trip_monitor_stream(
            source, index, flows.batch_files(out), scratch_path(spark, "ckpt"), "UTC", trigger=None
        )
    )
    return live.comparable(spark.read.parquet(out).select(*MONITOR_COLUMNS))


@demo(
    "stream_dedup_positions",
    "SELECT DISTINCT entity_id, vehicle_timestamp FROM (" + live.SQL_POSITIONS + ")",
)
def _stream_dedup_positions(spark, sf_dir):
    """Every message landed twice, as by a poll that finds nothing new."""
    messages = live.vehicle_messages(spark, sf_dir)
    source = directory_messages(spark, landed(spark, messages.union(messages)))
    stream = flows.dedup_positions(flows.vehicle_position_stream(source))
    out = run_files(spark, stream.select("entity_id", "vehicle_timestamp"))
    return out.withColumn("vehicle_timestamp", wall("vehicle_timestamp"))


def json_texts(rows):
    """Orders as JSON texts the SQL can write as well."""
    pairs = [F.concat(F.lit(f'"{c}":'), F.col(c).cast("string")) for c in ("o_orderkey", "o_custkey")]
    return rows.select(
        F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}")).alias("value"),
        F.when(F.col("o_orderstatus") == "F", "gtfs-alerts").otherwise("gtfs-trip-updates").alias("topic"),
    )


@demo(
    "stream_raw_archive",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'gtfs-alerts' ELSE 'gtfs-trip-updates' END AS topic,
              '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || '}' AS value
       FROM orders
       UNION ALL SELECT 'gtfs-vehicle-positions', props FROM events""",
)
def _stream_raw_archive(spark, sf_dir):
    """Three topics into one archive, every text as it came."""
    events = table(spark, sf_dir, "events").select(F.col("props").alias("value"), F.lit("gtfs-vehicle-positions").alias("topic"))
    source = directory_messages(spark, landed(spark, json_texts(table(spark, sf_dir, "orders")).union(events)))
    out = scratch_path(spark, "archive")
    finished(flows.archive_raw(source, out, scratch_path(spark, "ckpt"), trigger=None))
    return spark.read.parquet(out).select(F.col("topic").cast("string").alias("topic"), "value")


@demo(
    "stream_feed_gate",
    f"WITH {live.SQL_GATE} SELECT feed, seq, header_ts, previous_ts FROM gated",
)
def _stream_feed_gate(spark, sf_dir):
    path = scratch_path(spark, "landing")
    live.feed_messages(spark, sf_dir).write.parquet(path)
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema).parquet(path)
    out, state = scratch_path(spark, "gated"), scratch_path(spark, "state")
    sink = gate_sink(state, flows.batch_files(out), bucket_width=1000)
    finished(flows.start_append(source, sink, scratch_path(spark, "ckpt"), trigger=None))
    return spark.read.parquet(out).select("feed", "seq", "header_ts", "previous_ts")


@demo(
    "stream_feed_metrics",
    f"""WITH {live.SQL_GATE}
        SELECT to_timestamp(header_ts) AT TIME ZONE 'UTC' AS timestamp, feed,
               'update_interval_sec' AS metric, header_ts - previous_ts AS value
        FROM gated WHERE previous_ts IS NOT NULL
        UNION ALL
        SELECT to_timestamp(header_ts) AT TIME ZONE 'UTC', feed, 'payload_size_bytes', strlen(props) FROM gated""",
)
def _stream_feed_metrics(spark, sf_dir):
    """Gate and metrics from the same batches."""
    path = scratch_path(spark, "landing")
    live.feed_messages(spark, sf_dir).write.parquet(path)
    source = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    out, metrics, state = (scratch_path(spark, n) for n in ("gated", "metrics", "state"))
    sinks = flows.batch_files(out), flows.batch_files(metrics)
    finished(flows.gated_stream(source, state, *sinks, scratch_path(spark, "ckpt"), trigger=None))
    rows = spark.read.parquet(metrics).select("timestamp", "feed", "metric", "value")
    return rows.withColumn("timestamp", wall("timestamp"))


# --- windows and late rows: every tenth event of the first half of the month comes last ---
LANDINGS = ("event_id % 10 > 0 AND day(ts) <= 15", "event_id % 10 > 0 AND day(ts) > 15", "event_id % 10 = 0")
# The watermark of a landing is the greatest time of those before, less two minutes.
SQL_LANDED = f"""
landed AS (SELECT *, CASE WHEN event_id % 10 = 0 THEN 2 WHEN day(vehicle_timestamp) > 15 THEN 1 ELSE 0 END AS landing,
                  time_bucket(INTERVAL '5 minutes', vehicle_timestamp) AS window_start
           FROM (SELECT event_id, entity_id, vehicle_timestamp FROM ({live.SQL_POSITIONS.replace("SELECT '2.0'", "SELECT event_id, '2.0'")}))),
tops AS (SELECT landing + 1 AS landing, max(max(vehicle_timestamp)) OVER (ORDER BY landing) - INTERVAL 2 MINUTE AS watermark
         FROM landed GROUP BY landing),
parted AS (SELECT l.*, t.watermark, coalesce(l.window_start + INTERVAL 5 MINUTE <= t.watermark, FALSE) AS late
           FROM landed l LEFT JOIN tops t USING (landing)),
last AS (SELECT max(watermark) AS watermark FROM tops)
"""


def windowed(spark, sf_dir):
    """Three landings, each taken by a restart of both flows: folders of windows and of late rows."""
    folder, on_time, late, state, out = (scratch_path(spark, n) for n in ("landing", "on-time", "late", "high-water", "windows"))
    checks = scratch_path(spark, "ckpt"), scratch_path(spark, "ckpt")
    for where in LANDINGS:
        land(live.vehicle_messages(spark, sf_dir, where=where), folder)
        rows = flows.vehicle_position_stream(directory_messages(spark, folder))
        split = windows.late_split(state, windows.landed_batches(on_time), flows.batch_files(late), "5 minutes")
        finished(flows.start_append(rows, split, checks[0], trigger=None))
        stream = windows.active_vehicles_stream(windows.on_time_stream(spark, on_time, rows.schema))
        finished(flows.start_append(stream, flows.batch_files(out), checks[1], trigger=None))
    return out, late


@demo(
    "stream_active_vehicles",
    f"""WITH {SQL_LANDED} SELECT window_start, count(DISTINCT entity_id) AS active_vehicles, count(*) AS positions
        FROM parted, last WHERE NOT late AND window_start + INTERVAL 5 MINUTE <= last.watermark GROUP BY window_start""",
)
def _stream_active_vehicles(spark, sf_dir):
    out, _ = windowed(spark, sf_dir)
    rows = spark.read.parquet(out).select("window_start", "active_vehicles", "positions")
    return rows.withColumn("window_start", wall("window_start"))


@demo(
    "stream_late_rows",
    f"""WITH {SQL_LANDED} SELECT entity_id, vehicle_timestamp, watermark,
        CAST(epoch(watermark) - epoch(window_start + INTERVAL 5 MINUTE) AS DOUBLE) AS late_by FROM parted WHERE late""",
)
def _stream_late_rows(spark, sf_dir):
    _, late = windowed(spark, sf_dir)
    rows = spark.read.parquet(late).select("entity_id", "vehicle_timestamp", "watermark", "late_by")
    return rows.withColumns({c: wall(c) for c in ("vehicle_timestamp", "watermark")})


@demo("stream_trip_monitor_plan", f"WITH {live.SQL_MONITOR} SELECT * FROM monitor")
def _stream_trip_monitor_plan(spark, sf_dir):
    """Every message landed twice."""
    messages = live.vehicle_messages(spark, sf_dir, views=False)
    source = directory_messages(spark, landed(spark, messages.union(messages)))
    out = scratch_path(spark, "monitor")
    index = live.schedule(spark, sf_dir)
    finished(flows.trip_monitor_files(source, index, out, scratch_path(spark, "ckpt"), "UTC", trigger=None))
    return live.comparable(spark.read.parquet(out).select(*MONITOR_COLUMNS))


@demo("archive_replay", live.SQL_POSITIONS)
def _archive_replay(spark, sf_dir):
    """Live up to an offset that differs by partition, then lost; the archive up to the twentieth, then live again from the start."""
    rows = live.vehicle_messages(spark, sf_dir, keep=["event_id", "ts"])
    offset = F.floor(F.col("event_id") / 4)
    messages = rows.select("value", "topic", (F.col("event_id") % 4).cast("int").alias("partition"), offset.alias("offset"), instant("ts").alias("timestamp"))
    landing, archive, marks, out = (scratch_path(spark, n) for n in ("landing", "archive", "marks", "positions"))
    cut = F.col("offset") < F.col("partition") * 500
    messages.filter(cut).write.parquet(f"{landing}/1")
    messages.filter(~cut).write.parquet(f"{landing}/2")
    schema = messages.schema
    read = lambda path: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    positions = flows.vehicle_position_stream
    lost, again = (replay.live_after(marks, positions, flows.batch_files(f"{out}/{n}"), n) for n in ("lost", "live"))
    finished(flows.start_append(read(f"{landing}/1"), lost, scratch_path(spark, "ckpt"), trigger=None))
    kept = read(landing).filter(F.day("timestamp") <= 20)
    finished(flows.archive_raw(kept, archive, scratch_path(spark, "ckpt"), F.to_date("timestamp"), trigger=None))
    replay.replay(spark, archive, marks, positions, flows.batch_files(f"{out}/replay"), range_size=max(1000, rows.count() // 10))
    finished(flows.start_append(read(landing), again, scratch_path(spark, "ckpt"), trigger=None))
    columns = positions(messages.select("value", "topic")).columns
    parts = [spark.read.parquet(f"{out}/{n}").select(*columns) for n in ("lost", "replay", "live")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("vehicle_timestamp", wall("vehicle_timestamp"))
