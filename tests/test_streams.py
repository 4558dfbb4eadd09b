"""Streams: restart, retry, refresh (OP-T1..T11)."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import plan_of, tuples
from pyspark.sql import functions as F

from headway.demos.streams import landed
from headway.operators.feeds import changed_messages
from headway.operators.monitor import MONITOR_COLUMNS, schedule_index
from headway.plans import dashboard
from headway.sinks.tables import VersionedTable
from headway.sources.messages import directory_messages
from headway.streaming import flows, replay, windows
from headway.streaming.gate import gate_sink
from headway.streaming.static import Refreshed

SCHEMA = "feed string, seq int, header_ts bigint"


def drain(df, sink, checkpoint):
    flows.start_append(df, sink, checkpoint, trigger=None).awaitTermination()


def test_nothing_is_processed_twice(spark, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for run in (1, 2, 2):
        spark.range(run * 10).selectExpr("'m' AS value", "'t' AS topic").write.mode("append").partitionBy("topic").text(str(tmp_path / "in"))
        drain(directory_messages(spark, str(tmp_path / "in")), flows.batch_files(out), ck)
    drain(directory_messages(spark, str(tmp_path / "in")), flows.batch_files(out), ck)
    assert spark.read.parquet(out).count() == 50


def test_landed_messages_are_compressed(spark):
    """Plain, the messages are many times the tables they come from."""
    texts = spark.range(20_000).select(F.to_json(F.struct("id", F.lit("2.0").alias("gtfsRealtimeVersion"))).alias("value"), F.lit("t").alias("topic"))
    path = landed(spark, texts)
    size = sum(f.stat().st_size for f in Path(path).rglob("part-*"))
    assert 3 * size < sum(len(r.value) for r in texts.collect())
    assert spark.read.text(path).select("value", "topic").exceptAll(texts).isEmpty() and spark.read.text(path).count() == 20_000


def test_a_failed_batch_is_done_again(spark, tmp_path):
    """The write fails after part of the work; the next start repeats the batch."""
    spark.range(10).selectExpr("'m' AS value", "'t' AS topic").write.partitionBy("topic").text(str(tmp_path / "in"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    write = flows.batch_files(out)

    def fails(df, batch_id):
        write(df.limit(3), batch_id)
        raise RuntimeError("lost the executor")

    with pytest.raises(Exception, match="lost the executor"):
        drain(directory_messages(spark, str(tmp_path / "in")), fails, ck)
    drain(directory_messages(spark, str(tmp_path / "in")), write, ck)
    assert spark.read.parquet(out).count() == 10


def test_gate_remembers_across_batches_and_restarts(spark, tmp_path):
    out, ck, state = (str(tmp_path / n) for n in ("out", "ck", "state"))
    days = [
        [("f", 1, 10), ("f", 2, 10), ("g", 1, 5)],
        [("f", 3, 10), ("f", 4, 20), ("h", 1, None)],
        [("f", 5, 10), ("g", 2, 5), ("f", 6, 10), ("h", 2, 1)],
    ]
    write = gate_sink(state, flows.batch_files(out), bucket_width=2)
    for day in days:
        spark.createDataFrame(day, SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        drain(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), write, ck)
    want = changed_messages(spark.createDataFrame(sum(days, []), SCHEMA))
    got = spark.read.parquet(out).select("feed", "seq", "header_ts", "previous_ts")
    assert tuples(got) == tuples(want)
    # A batch done again gives the same rows.
    write(spark.createDataFrame(days[1], SCHEMA), 1)
    again = spark.read.parquet(out).select("feed", "seq", "header_ts", "previous_ts")
    assert tuples(again) == tuples(want)
    # A state that is not there is named.
    with pytest.raises(FileNotFoundError, match="batch 7 needs the feed state of batch 6"):
        write(spark.createDataFrame(days[1], SCHEMA), 7)


def test_static_side_is_refreshed(spark):
    state = {"version": 0}
    side = Refreshed(lambda: spark.range(state["version"]), lambda: state["version"])
    first = side.get()
    assert side.get() is first and first.is_cached
    state["version"] = 3
    assert side.get().count() == 3 and not first.is_cached
    once = Refreshed(lambda: spark.range(1))
    assert once.get() is once.get()


def test_batch_folders_are_folded_and_replays_replace(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = flows.batch_files(out, group=5)
    for batch in range(20):
        for _ in range(2):  # every batch is done twice
            sink(spark.range(batch * 10, batch * 10 + 10), batch)
    rows = spark.read.parquet(out)
    assert rows.count() == 200 and rows.select("id").distinct().count() == 200
    for number in range(3):  # a job of its own, for groups that are over
        flows.compact_batches(spark, out, number)
    assert spark.read.parquet(out).count() == 200
    folders = [p for p in (tmp_path / "out").rglob("batch_id=*")]
    assert len(folders) == 3 + 5
    # Interrupted between the renames: the next call goes on from what is there.
    (tmp_path / "out/batches=3").rename(tmp_path / "out/_old-3")
    flows.compact_batches(spark, out, 3)
    assert spark.read.parquet(out).count() == 200


def test_gate_keeps_states_as_long_as_checkpoints(spark, tmp_path, conf):
    conf({"spark.sql.streaming.minBatchesToRetain": "1"})
    seen = []
    sink = gate_sink(str(tmp_path / "state"), lambda df, i: seen.extend(r.seq for r in df.collect()))
    for i in range(6):
        sink(spark.createDataFrame([("f", i, i // 2)], "feed string, seq bigint, header_ts bigint"), i)
    assert seen == [0, 2, 4]
    assert sorted(p.name for p in (tmp_path / "state").iterdir() if not p.name.startswith(".")) == ["batch-4", "batch-5"]


def test_poison_message_does_not_stop_the_monitor(spark, tmp_path):
    def message(stamp, date):
        vehicle = {"trip": {"tripId": "EN_1", "routeId": "R", "startDate": date}, "position": {"latitude": 40.0, "longitude": -74.0}, "timestamp": stamp}
        return json.dumps({"header": {"gtfsRealtimeVersion": "2.0", "timestamp": stamp}, "entity": [{"id": "b", "vehicle": vehicle}]})

    folder = tmp_path / "in/topic=gtfs-vehicle-positions"
    folder.mkdir(parents=True)
    texts = [message("1752581580", "20250715"), message("1752566400000000", "20250715"), message("-99999999999999999999", "99999999"), "{", message("1752581590", "00000000")]
    (folder / "m.txt").write_text("\n".join(texts))
    stops = spark.createDataFrame([(1, "One", 40.0, -74.0)], "stop_id int, stop_name string, stop_lat double, stop_lon double")
    times = spark.createDataFrame([("EN_1", "08:00:00", 1, 1), ("EN_1", "700000:00:00", 2, 1)], "trip_id string, arrival_time string, stop_sequence int, stop_id int")
    index = Refreshed(lambda: schedule_index(times, stops))
    query = flows.trip_monitor_stream(
        directory_messages(spark, str(tmp_path / "in")), index, flows.batch_files(str(tmp_path / "out")), str(tmp_path / "ck"), "America/New_York", trigger=None
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


# --- windows and late rows ---
POSITION = "entity_id string, vehicle_timestamp timestamp"


def position_rows(spark, *pairs):
    rows = spark.createDataFrame([(v, s) for v, s in pairs], "entity_id string, s bigint")
    return rows.select("entity_id", F.timestamp_seconds("s").alias("vehicle_timestamp"))


def test_windows_and_late_rows_survive_restarts(spark, tmp_path):
    """Every batch is a restart of both flows; one batch of the first is done twice."""
    t = {n: str(tmp_path / n) for n in ("in", "on", "late", "state", "out", "ck1", "ck2")}
    batches = [
        [("a", 0), ("a", 10), ("b", 299), (None, 20)],
        [("c", 301), ("a", 700), ("x", None)],
        [("d", 100), ("d", 299), ("e", 400), ("f", 560), ("a", 710)],  # watermark 580: the first window is over
        [("g", 5), ("h", 1000), ("h", 1001)],
        [("i", 599), ("j", 600), ("z", 2000)],  # watermark 881
    ]
    split = windows.late_split(t["state"], windows.landed_batches(t["on"]), flows.batch_files(t["late"]), "5 minutes")
    for rows in batches:
        position_rows(spark, *rows).write.mode("append").parquet(t["in"])
        source = spark.readStream.schema(POSITION).parquet(t["in"]).withWatermark("vehicle_timestamp", "2 minutes")
        drain(source, split, t["ck1"])
        stream = windows.active_vehicles_stream(windows.on_time_stream(spark, t["on"], source.schema))
        drain(stream, flows.batch_files(t["out"]), t["ck2"])
    split(position_rows(spark, *batches[2]), 2)  # done again after a failure
    seconds = F.unix_seconds("vehicle_timestamp")
    late = tuples(spark.read.parquet(t["late"]).select("entity_id", seconds, "late_by", F.unix_seconds("watermark")))
    assert late == [("d", 100, 280.0, 580), ("d", 299, 280.0, 580), ("g", 5, 290.0, 590), ("i", 599, 281.0, 881)]
    done = tuples(spark.read.parquet(t["out"]).select(F.unix_seconds("window_start"), "active_vehicles", "positions"))
    # Windows that end at 1880 or before: a, b and one without a name; c, e, f; a, j; h.
    assert done == [(0, 2, 4), (300, 3, 3), (600, 2, 3), (900, 1, 2)]


def test_the_aggregation_drops_nothing_itself(spark, tmp_path):
    rows = position_rows(spark, *[("v", s) for s in range(0, 5000, 7)])
    rows.repartition(9).write.parquet(str(tmp_path / "on/batch=0"))
    query = flows.start_append(
        windows.active_vehicles_stream(windows.on_time_stream(spark, str(tmp_path / "on"), rows.schema)),
        flows.batch_files(str(tmp_path / "out")), str(tmp_path / "ck"), trigger=None,
    )
    query.awaitTermination()
    dropped = [op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in json.loads(p.json)["stateOperators"]]
    assert dropped and not any(dropped)


def test_arrival_rate_on_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([("arrived", 5), ("on_way", 100), ("arrived", 299), ("on_way", 301), ("arrived", 9000)], "status string, s bigint")
    rows.select("status", F.timestamp_seconds("s").alias("vehicle_timestamp")).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("status string, vehicle_timestamp timestamp").parquet(str(tmp_path / "in"))
    drain(windows.arrival_rate_stream(source.withWatermark("vehicle_timestamp", "2 minutes")), flows.batch_files(str(tmp_path / "out")), str(tmp_path / "ck"))
    got = tuples(spark.read.parquet(str(tmp_path / "out")).select(F.unix_seconds("window_start"), "positions", F.round("arrival_rate", 3)))
    assert got == [(0, 3, 0.667), (300, 1, 0.0)]


# --- replay from the archive ---
RAW = "value string, topic string, partition int, offset bigint, timestamp timestamp"


def raw_messages(spark):
    """Three partitions of two topics; offsets have gaps, and some messages were archived twice."""
    rows = [(f"{t}{p}-{o}", t, p, o) for t, p, n in (("a", 0, 40), ("a", 1, 7), ("b", 0, 25)) for o in range(n) if o % 11]
    return rows, spark.createDataFrame([(*r, None) for r in rows], RAW)


def upper(df):
    return df.select(F.upper("value").alias("said"))


@pytest.mark.parametrize("cut", [(0, 0, 0), (13, 7, 2), (40, 0, 24), (40, 7, 25)])
def test_replay_and_live_give_everything_once(spark, tmp_path, cut):
    t = {n: str(tmp_path / n) for n in ("in1", "in2", "archive", "marks", "out", "ck1", "ck2")}
    rows, df = raw_messages(spark)
    at = dict(zip((("a", 0), ("a", 1), ("b", 0)), cut, strict=True))
    before = F.lit(False)
    for (topic, partition), o in at.items():
        before = before | ((F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("offset") < o))
    df.filter(before).write.parquet(f"{t['in1']}/x")
    df.write.parquet(f"{t['in2']}/x")
    # The archive has no more than the first 30 offsets, some twice.
    df.filter("offset < 30").unionByName(df.filter("offset % 5 = 0 AND offset < 30")).write.parquet(t["archive"])
    read = lambda path: spark.readStream.schema(RAW).option("recursiveFileLookup", "true").parquet(path)
    drain(read(t["in1"]), replay.live_after(t["marks"], upper, flows.batch_files(f"{t['out']}/first"), "first"), t["ck1"])

    put, calls = flows.batch_files(f"{t['out']}/replay"), []

    def fails_once(rows, number):
        put(rows, number)
        calls.append(number)
        if calls == [0, 1]:
            raise RuntimeError("lost the driver")

    def run():
        return replay.replay(spark, t["archive"], t["marks"], upper, fails_once, range_size=9)

    if sum(cut) < 60:
        with pytest.raises(RuntimeError):
            run()
    run()
    done = len(calls)
    run()  # nothing is left
    assert len(calls) == done
    again = replay.live_after(t["marks"], upper, flows.batch_files(f"{t['out']}/live"), "live")
    drain(read(t["in2"]), again, t["ck2"])
    again(spark.read.schema(RAW).parquet(f"{t['in2']}/x"), 0)  # done again after a failure
    said = []
    for part in ("first", "replay", "live"):
        if (tmp_path / "out" / part).exists():
            said += [r.said for r in spark.read.parquet(f"{t['out']}/{part}").collect()]
    assert sorted(said) == sorted(r[0].upper() for r in rows)
    assert json.loads(replay.starting_offsets(spark, t["marks"])) == {"a": {"0": 40, "1": 7}, "b": {"0": 25}}


def test_no_task_of_a_replay_reads_a_partition(spark, tmp_path, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    rows, df = raw_messages(spark)
    df.write.parquet(str(tmp_path / "archive"))
    plans = []

    def put(batch, number):
        plans.append(plan_of(batch))
        flows.batch_files(str(tmp_path / "out"))(batch, number)

    assert replay.replay(spark, str(tmp_path / "archive"), str(tmp_path / "marks"), upper, put, range_size=30) == 2
    assert "BroadcastHashJoin" in plans[1] and not any("SortMergeJoin" in p for p in plans)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_archive_keeps_where_messages_came_from(spark, tmp_path):
    raw_messages(spark)[1].write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(RAW).parquet(str(tmp_path / "in"))
    flows.archive_raw(source, str(tmp_path / "archive"), str(tmp_path / "ck"), F.lit("2024-01-01").cast("date"), trigger=None).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "archive"))
    assert set(kept.columns) == {"value", "topic", "partition", "offset", "timestamp", "day"}
    assert kept.filter("topic = 'a' AND partition = 1").count() == 6


def test_monitor_in_the_plan_gives_rows_once(spark, tmp_path):
    """Polls repeat positions; the flow is stopped and started again."""
    times = spark.createDataFrame([("EN_1", "08:00:00", 1, 1)], "trip_id string, arrival_time string, stop_sequence int, stop_id int")
    stops = spark.createDataFrame([(1, "One", 40.0, -74.0)], "stop_id int, stop_name string, stop_lat double, stop_lon double")
    index = schedule_index(times, stops)
    start = 1752581580
    for n, polls in enumerate([[0, 0, 20], [20, 40], [40, 60, 60]]):
        texts = []
        for s in polls:
            vehicle = {"trip": {"tripId": "EN_1", "routeId": "R", "startDate": "20250715"}, "position": {"latitude": 40.0, "longitude": -74.0}, "timestamp": str(start + s)}
            texts.append(json.dumps({"header": {"timestamp": str(start + s)}, "entity": [{"id": "b", "vehicle": vehicle}]}))
        folder = tmp_path / "in/topic=gtfs-vehicle-positions"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{n}.txt").write_text("\n".join(texts))
        flows.trip_monitor_files(directory_messages(spark, str(tmp_path / "in")), index, str(tmp_path / "out"), str(tmp_path / "ck"), "America/New_York", trigger=None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select(F.unix_seconds("vehicle_timestamp") - start, "stop_name", "status")
    assert tuples(got) == [(0, "One", "arrived"), (20, "One", "arrived"), (40, "One", "arrived"), (60, "One", "arrived")]


# --- dashboard sums per group of batches ---
def monitor_rows(spark, *rows):
    df = spark.createDataFrame(list(rows), "borough string, route_id string, s bigint, status string, delay_seconds bigint")
    known = df.withColumn("vehicle_timestamp", F.timestamp_seconds("s"))
    return known.select(*[F.col(c) if c in known.columns else F.lit("x").alias(c) for c in MONITOR_COLUMNS])


def test_only_changed_groups_are_read(spark, tmp_path):
    out, parts = str(tmp_path / "out"), str(tmp_path / "parts")
    sink = flows.batch_files(out, group=10)
    one = monitor_rows(spark, ("A", "r", 0, "arrived", 10), ("A", "r", 400, "arrived", 900), ("A", "q", 0, "on_way", None))
    two = monitor_rows(spark, ("A", "r", 10, "arrived", None), ("B", "q", 7200, "arrived", 3))
    sink(one, 1)
    sink(two, 11)
    assert dashboard.refresh_parts(spark, out, parts) == [0, 1] and dashboard.refresh_parts(spark, out, parts) == []
    sink(one.limit(0), 1)  # corrected: nothing of it is left
    sink(one, 2)
    sink(two, 21)
    assert dashboard.refresh_parts(spark, out, parts) == [0, 2]
    rows = one.unionByName(two).unionByName(two).cache()
    kept = dashboard.figures_of_parts(spark, parts)
    want = dashboard.dashboard_tables(rows)
    for name, table in kept.items():
        assert tuples(table) == tuples(want[name].select(*table.columns)), name
    dashboard.publish_dashboard(spark, out, str(tmp_path / "dash"), parts=parts)
    assert tuples(VersionedTable(spark, str(tmp_path / "dash/otp_by_route")).read()) == tuples(want["otp_by_route"])
