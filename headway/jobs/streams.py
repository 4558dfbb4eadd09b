"""Live feeds: flat tables, raw archive, trip monitor, quarantine, figures per window.

Messages come from Kafka (``--servers``) or from a folder of text files laid
out as ``topic=<name>`` (``--directory``). Figures per window take two flows: ``split`` parts positions
into ``on-time`` and ``late`` below its output, ``windows`` reads the former as its ``--directory``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from headway.functions.cleaning import current
from headway.operators.asof import lookup_layout
from headway.operators.monitor import schedule_index
from headway.operators.nested import decode
from headway.operators.quarantine import judge_messages, quarantined
from headway.schemas import ALERTS as ALERT_MESSAGES
from headway.schemas import TRIP_UPDATES, VEHICLE_POSITIONS
from headway.session import builder
from headway.sinks.tables import VersionedTable
from headway.sources.messages import TOPICS, directory_messages, feed_messages, kafka_messages
from headway.streaming import flows, windows
from headway.streaming.static import Refreshed

UPDATES, POSITIONS, ALERTS = TOPICS


def published_index(spark: SparkSession, published: str) -> Refreshed:
    """Schedule of the published tables, loaded anew when one of them is replaced."""
    times, stops = (VersionedTable(spark, f"{published}/{n}") for n in ("stop_times", "stops"))
    seen: list[int] = []

    def versions() -> tuple[int, ...]:
        seen[:] = (times.version(), stops.version())
        return tuple(seen)

    def load() -> DataFrame:
        # Those just asked for: a table replaced since then comes with the next batch.
        index = schedule_index(current(times.read(seen[0])), current(stops.read(seen[1])))
        return lookup_layout(index, ["trip_id"])

    return Refreshed(load, versions)


def quarantine_stream(messages: DataFrame) -> DataFrame:
    """What is wrong with the messages of the three feeds, and their texts."""
    schemas = {UPDATES: TRIP_UPDATES, POSITIONS: VEHICLE_POSITIONS, ALERTS: ALERT_MESSAGES}
    decoded = decode(messages)
    parts = [quarantined(judge_messages(decoded.filter(decoded["topic"] == t), s)) for t, s in schemas.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("flow", choices=["positions", "updates", "alerts", "archive", "monitor", "gate", "quarantine", "split", "windows"])
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers")
    source.add_argument("--directory")
    p.add_argument("--output", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--published", help="published tables, for the monitor")
    p.add_argument("--metrics", help="folder of feed metrics, for the gate")
    p.add_argument("--dedup", action="store_true", help="drop positions that a later poll repeats")
    p.add_argument("--archive-to", help="move read files of --directory there")
    p.add_argument("--in-plan", action="store_true", help="the monitor without micro-batch functions; the schedule is that of the start")
    p.add_argument("--every", default="5 minutes", help="length of the windows")
    p.add_argument("--tz", default="America/New_York", help="zone of the schedule")
    p.add_argument("--trigger", default=flows.TRIGGER, help="pause between batches, or 'once'")
    a = p.parse_args(argv)
    spark = builder(a.flow).getOrCreate()
    trigger = None if a.trigger == "once" else a.trigger
    if a.flow == "windows":
        schema = flows.vehicle_position_stream(spark.createDataFrame([], "value string, topic string")).schema
        rows = windows.active_vehicles_stream(windows.on_time_stream(spark, a.directory, schema), a.every)
        flows.start_append(rows, flows.batch_files(a.output), a.checkpoint, trigger).awaitTermination()
        return
    topics = {"positions": [POSITIONS], "monitor": [POSITIONS], "split": [POSITIONS], "updates": [UPDATES], "alerts": [ALERTS]}
    if a.servers:
        messages = kafka_messages(spark, a.servers, topics.get(a.flow, TOPICS))
    else:
        one = a.flow == "gate"  # it needs to know which message came first
        messages = directory_messages(spark, a.directory, whole_file=one, archive_to=a.archive_to)
        messages = messages.filter(messages["topic"].isin(*topics.get(a.flow, TOPICS)))
    sink = flows.batch_files(a.output)
    if a.flow == "archive":
        query = flows.archive_raw(messages, a.output, a.checkpoint, trigger=trigger)
    elif a.flow == "gate":
        metrics = flows.batch_files(a.metrics or f"{a.output}-metrics")
        state = f"{a.output}-state"
        query = flows.gated_stream(feed_messages(messages), state, sink, metrics, a.checkpoint, trigger)
    elif a.flow == "quarantine":
        query = flows.start_append(quarantine_stream(messages), sink, a.checkpoint, trigger)
    elif a.flow == "split":
        positions = flows.vehicle_position_stream(messages)
        parts = windows.landed_batches(f"{a.output}/on-time"), flows.batch_files(f"{a.output}/late")
        split = windows.late_split(f"{a.output}-state", *parts, a.every)
        query = flows.start_append(positions, split, a.checkpoint, trigger)
    elif a.flow == "monitor" and a.in_plan:
        index = published_index(spark, a.published).get()
        query = flows.trip_monitor_files(messages, index, a.output, a.checkpoint, a.tz, trigger)
    elif a.flow == "monitor":
        index = published_index(spark, a.published)
        query = flows.trip_monitor_stream(messages, index, sink, a.checkpoint, a.tz, trigger)
    else:
        flat = {
            "positions": flows.vehicle_position_stream,
            "updates": flows.trip_update_stream,
            "alerts": flows.alert_stream,
        }[a.flow](messages)
        if a.flow == "positions" and a.dedup:
            flat = flows.dedup_positions(flat)
        query = flows.start_append(flat, sink, a.checkpoint, trigger)
    query.awaitTermination()


if __name__ == "__main__":
    main()
