"""The live feeds as streams (OP-T1..T7, OP-T11, OP-K4, OP-K6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.feeds import feed_metrics
from headway.operators.monitor import OBSERVATION, trip_monitor
from headway.operators.nested import (
    decode,
    flatten_alerts,
    flatten_trip_updates,
    flatten_vehicle_positions,
    parse_envelope,
)
from headway.schemas import ALERTS, TRIP_UPDATES, VEHICLE_POSITIONS
from headway.sinks.tables import write_jdbc
from headway.session import filesystem
from headway.sources.jdbc import JdbcConf
from headway.sources.messages import SEQ_PER_SECOND

from .gate import gate_sink
from .static import Refreshed

Sink = Callable[[DataFrame, int], None]

# Lateness of vehicle times, pause between micro-batches.
WATERMARK = "2 minutes"
TRIGGER = "30 seconds"


def batch_files(path: str, group: int = 1000) -> Sink:
    """OP-K4: a folder per micro-batch, below one per ``group`` batches.

    A batch run again replaces its folder. The flow rewrites nothing: folding the folders of
    a group that is over (``compact_batches``) is up to a job of its own, at a quiet time.
    """
    path = path.rstrip("/")

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batches={batch_id // group}/batch_id={batch_id}")

    return write


def compact_batches(spark: SparkSession, path: str, number: int) -> None:
    """Rewrite a finished group of batch folders as one.

    The new folder takes the place of the old one by renaming. If that was interrupted,
    the next call first puts back what is there. Not for groups with batches to come, nor while they are read:
    between two renames a reader finds nothing.
    """
    group, new, old = f"{path}/batches={number}", f"{path}/_new-{number}", f"{path}/_old-{number}"
    fs, there = filesystem(spark, group)
    aside, fresh = (filesystem(spark, p)[1] for p in (old, new))
    if fs.exists(aside) and not fs.exists(there):
        fs.rename(aside, there)
    if not fs.exists(there) or len(fs.listStatus(there)) < 2:
        return
    rows = spark.read.option("basePath", path).parquet(f"{group}/*")
    columns = [c for c in rows.columns if c not in ("batches", "batch_id")]
    rows.select(*columns).hint("rebalance").write.mode("overwrite").parquet(f"{new}/batch_id={-1 - number}")
    fs.rename(there, aside)
    fs.rename(fresh, there)
    fs.delete(aside, True)


def batch_jdbc(conf: JdbcConf, table: str, num_partitions: int | None = None) -> Sink:
    """To a database, ``batch_id`` added so that a repeated batch can be told apart."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_jdbc(
            df.withColumn("batch_id", F.lit(batch_id)), conf, table, num_partitions=num_partitions
        )

    return write


def start_append(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """OP-K4/T2/T3: append micro-batches to ``sink``.

    ``trigger=None`` takes what is there and ends. A failed write fails the
    query, so its batch is done again from the checkpoint.
    """
    writer = df.writeStream.outputMode("append").foreachBatch(sink)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    pace = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.trigger(**pace).start()


def vehicle_position_stream(
    messages: DataFrame, header_time: bool = False, watermark: str = WATERMARK
) -> DataFrame:
    """OP-T4/T1: flat vehicle positions."""
    parsed = parse_envelope(decode(messages), VEHICLE_POSITIONS)
    return flatten_vehicle_positions(parsed, header_time).withWatermark(
        "vehicle_timestamp", watermark
    )


def trip_update_stream(messages: DataFrame) -> DataFrame:
    """OP-T5: flat stop updates."""
    return flatten_trip_updates(parse_envelope(decode(messages), TRIP_UPDATES))


def alert_stream(messages: DataFrame, outer: bool = False) -> DataFrame:
    """OP-T6: flat alerts."""
    return flatten_alerts(parse_envelope(decode(messages), ALERTS), outer)


def dedup_positions(positions: DataFrame) -> DataFrame:
    """Drop positions a later poll repeats, within the watermark (opt-in)."""
    return positions.dropDuplicatesWithinWatermark(["entity_id", "vehicle_timestamp"])


def monitor_sink(index: Refreshed, sink: Sink, tz: str, **options) -> Sink:
    """OP-T7: micro-batches of positions through the trip monitor."""

    def write(df: DataFrame, batch_id: int) -> None:
        sink(trip_monitor(df, index.get(), tz, **options), batch_id)

    return write


def trip_monitor_stream(
    messages: DataFrame,
    index: Refreshed,
    sink: Sink,
    checkpoint: str,
    tz: str,
    trigger: str | None = TRIGGER,
    **options,
) -> StreamingQuery:
    """OP-T7: live messages to monitor rows; the schedule may change meanwhile."""
    positions = vehicle_position_stream(messages, header_time=True)
    return start_append(
        positions, monitor_sink(index, sink, tz, **options), checkpoint, trigger, "trip_monitor"
    )


def trip_monitor_files(
    messages: DataFrame,
    index: DataFrame,
    path: str,
    checkpoint: str,
    tz: str,
    trigger: str | None = TRIGGER,
    **options,
) -> StreamingQuery:
    """OP-T7/N2 within the streaming plan: positions meet the index as a stream meets a table, repeated ones
    are dropped by the state store, and the file sink's log makes the rows exactly once.

    Cheaper than ``trip_monitor_stream`` where the schedule stays the same while the flow runs: it is read
    when the flow starts. Rows behind the watermark are dropped.
    """
    positions = vehicle_position_stream(messages, header_time=True)
    rows = trip_monitor(positions, index, tz, one_per_observation=False, **options)
    pace = {"processingTime": trigger} if trigger else {"availableNow": True}
    return (
        rows.dropDuplicatesWithinWatermark(list(OBSERVATION))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .queryName("trip_monitor_files")
        .trigger(**pace)
        .start()
    )


def gated_stream(
    messages: DataFrame,
    state: str,
    sink: Sink,
    metrics: Sink,
    checkpoint: str,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """OP-T8/T9/K10: messages (feed, seq, header_ts, json_str) that change their feed, and
    what they say about it, from the same batch. Both sinks replace a batch done again."""

    def both(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            sink(df, batch_id)
            metrics(feed_metrics(df, F.timestamp_seconds("header_ts")), batch_id)
        finally:
            df.unpersist()

    gate = gate_sink(state, both, bucket_width=SEQ_PER_SECOND * 3600)
    return start_append(messages, gate, checkpoint, trigger, "gate")


def archive_raw(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    day: Column | None = None,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """OP-K6/T11: every message unchanged under ``topic=…/day=…``, exactly once, with its
    partition, offset and time if the source gives them (``replay`` needs these)."""
    at = day if day is not None else F.to_date(F.current_timestamp())
    origin = [c for c in ("partition", "offset", "timestamp") if c in messages.columns]
    rows = messages.select(F.col("value").cast("string").alias("value"), "topic", *origin, at.alias("day"))
    pace = {"processingTime": trigger} if trigger else {"availableNow": True}
    return (
        rows.writeStream.format("parquet")
        .partitionBy("topic", "day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**pace)
        .start()
    )
