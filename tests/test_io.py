"""Sources, sinks, whole jobs."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import re

import pytest
from conftest import plan_of, tuples
from pyspark.sql import functions as F

from headway import session
from headway.jobs import boroughs, dashboard, load, replay, snapshot, streams
from headway.operators.monitor import MONITOR_COLUMNS
from headway.operators.snapshot import service_snapshot
from headway.plans.daily_load import needs_load, warehouse_table
from headway.schemas import STOPS, TABLES, VERSIONS
from headway.sinks import tables
from headway.sources.feed_files import FeedFiles, read_feed_table
from headway.sources.jdbc import JdbcConf
from headway.sources.messages import directory_messages
from headway.sources.versions import VersionState, read_versions
from headway.streaming import flows


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


# --- OP-S1..S3 ---
def test_feed_scan(spark, tmp_path):
    put(tmp_path / "queens_2025-07-01/stops.csv", "stop_id,stop_name,zone_id\n1,a,NaN\n2,\"b, c\",\n3,\"say \"\"x\"\"\",z\n")
    put(tmp_path / "bronx_2025-08-01/stops.txt", "\ufeffstop_name,stop_id\nd,4\nNA,5\n")
    put(tmp_path / "bronx_2025-08-01/stop_times.txt", "trip_id\nt\n")
    put(tmp_path / "empty_2025-08-01/stops.csv", "")
    df = read_feed_table(spark, str(tmp_path), "stops", provenance=True)
    rows = tuples(df.select("stop_id", "stop_name", "zone_id", "feed_region", "feed_version"))
    july, august = dt.date(2025, 7, 1), dt.date(2025, 8, 1)
    assert rows == [
        ("1", "a", None, "queens", july),
        ("2", "b, c", None, "queens", july),
        ("3", 'say "x"', "z", "queens", july),
        ("4", "d", None, "bronx", august),
        ("5", None, None, "bronx", august),
    ]
    missing = read_feed_table(spark, str(tmp_path), "agency")
    assert missing.isEmpty() and missing.columns == [f.name for f in TABLES["agency"].text_schema]
    assert read_feed_table(spark, str(tmp_path / "nowhere"), STOPS).isEmpty()


def test_unreadable_file_fails_or_counts_as_empty(spark, tmp_path):
    put(tmp_path / "a_2025-07-01/stops.csv.gz", b"this is no gzip")
    put(tmp_path / "b_2025-07-01/stops.csv", "stop_id\n1\n")
    put(tmp_path / "c_2025-07-01/stops.csv.gz", gzip.compress(b"stop_name,stop_id\nx,2\n"))
    with pytest.raises(OSError, match="a_2025"):
        read_feed_table(spark, str(tmp_path), "stops")
    files = FeedFiles(spark, str(tmp_path))
    rows = read_feed_table(spark, files, "stops", on_unreadable="empty")
    assert tuples(rows.select("stop_id")) == [("1",), ("2",)]
    assert [f.rsplit("/", 2)[1] for f in files.unreadable] == ["a_2025-07-01"]


def test_damage_inside_a_file_fails(spark, tmp_path):
    whole = gzip.compress(b"stop_id\n" + b"".join(b"%d\n" % (i * i) for i in range(60000)))
    put(tmp_path / "a_2025-07-01/stops.csv.gz", whole[: len(whole) // 2])
    with pytest.raises(Exception, match="(?i)end of|eof|FAILED_READ_FILE"):
        read_feed_table(spark, str(tmp_path), "stops", on_unreadable="empty").count()


def test_parts_of_a_folder_have_their_own_headers(spark, tmp_path):
    put(tmp_path / "x_2025-07-01/agency.csv/a.csv", "agency_id,agency_name\nN1,one\n")
    put(tmp_path / "x_2025-07-01/agency.csv/b.csv", "agency_name,agency_id\ntwo,N2\n")
    assert tuples(read_feed_table(spark, str(tmp_path), "agency").select("agency_id", "agency_name")) == [("N1", "one"), ("N2", "two")]


def test_feed_written_by_spark_and_line_breaks(spark, tmp_path):
    parts = spark.range(0, 100, 1, 4).selectExpr("id AS stop_id", "concat('s', id) AS stop_name")
    parts.write.csv(f"{tmp_path}/x_2025-07-01/stops.csv", header=True)
    assert read_feed_table(spark, str(tmp_path), "stops").count() == 100
    put(tmp_path / "y_2025-07-01/agency.csv", 'agency_id,agency_name\n1,"two\nlines"\n')
    assert read_feed_table(spark, str(tmp_path), "agency", multi_line=True).first().agency_name == "two\nlines"


# --- OP-S9 ---
@pytest.mark.parametrize("text,n", [('{"f": "2024-01-01",\n "g": "x"}', 2), ("", 0), ("{broken", 0), (None, 0)])
def test_versions(spark, tmp_path, text, n):
    if text is not None:
        put(tmp_path / "versions.json", text)
    state = read_versions(spark, str(tmp_path / "versions.json"))
    assert state.columns == ["feed_url", "version_date"] and state.count() == n


def test_load_is_skipped_until_a_version_is_new(spark, tmp_path):
    t = {n: str(tmp_path / n) for n in ("land", "staging", "warehouse", "state")}
    args = [x for n, k in (("landing", "land"), ("staging", "staging"), ("warehouse", "warehouse"), ("state", "state")) for x in (f"--{n}", t[k])]
    feed_day(tmp_path / "land/q_2025-07-01", 3)
    runs = []
    for day in ("14", "15", "16"):
        if day == "16":
            feed_day(tmp_path / "land/q_2025-07-02", 4)
        load.main([*args, "--run-ts", f"2025-07-{day} 03:55:00 UTC", "--tables", "routes"])
        runs.append(warehouse_table(spark, t["warehouse"], "routes").version())
    assert runs == [0, 0, 1]
    state = VersionState(spark, t["state"])
    assert tuples(state.read()) == [("q", "2025-07-02")]
    state.commit(state.read().unionByName(spark.createDataFrame([("r", "2025-01-01")], VERSIONS)))
    assert state.read().count() == 2 and state.table.version() == 2


def test_needs_load(spark):
    a = spark.createDataFrame([("f", "2024-01-01")], VERSIONS)
    assert needs_load(a, a.limit(0)) and not needs_load(a, a)


# --- OP-S4, OP-K5: settings only; a database is not part of these tests ---
def test_jdbc_options():
    conf = JdbcConf("jdbc:x", {"user": "u"})
    assert conf.read_options("t") == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    write = conf.write_options("t")
    assert write["batchsize"] == "10000" and write["isolationLevel"] == "NONE"


# --- sinks ---
def test_spread_sets_the_partitions(spark):
    df = spark.range(100)
    assert tables.spread(df, 50).rdd.getNumPartitions() == 50
    assert "REBALANCE" in plan_of(tables.spread(df))


def test_staging_overwrites(spark, tmp_path):
    path = str(tmp_path / "s")
    for n in (5, 3):
        tables.write_staging(spark.range(n), path)
    assert spark.read.parquet(path).count() == 3


def test_serving_by_date(spark, tmp_path):
    path, d1, d2 = str(tmp_path / "t"), dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    for day, n in [(d1, 5), (d2, 4), (d1, 2), (d2, 0)]:
        tables.append_serving(spark.range(n), path, day)
    assert tuples(spark.read.parquet(path).groupBy("service_date").count()) == [(d1, 2)]
    filtered = spark.read.parquet(path).filter(F.col("service_date") == F.lit(d1))
    assert re.search(r"PartitionFilters: \[isnotnull\(service_date", plan_of(filtered))


def test_sorted_layout_splits_a_hot_key(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 60000, 1, 8).selectExpr("IF(id % 3 = 0, id, -1) AS k", "id AS v", "uuid() AS pad")
        tables.sorted_layout(df, ["k", "v"]).write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(str(tmp_path / "t")).select("k", "v", F.input_file_name().alias("f"))
    assert files.filter("k = -1").select("f").distinct().count() > 1
    assert files.count() == 60000


def test_versioned_table(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"))
    assert t.version() is None
    with pytest.raises(FileNotFoundError):
        t.read()
    t.replace(spark.range(10))
    reader = t.read()
    t.replace(t.read().filter("id < 4"))
    assert (t.version(), t.read().count(), reader.count()) == (1, 4, 10)
    for n in (3, 2):
        t.replace(spark.range(n))
    t.drop_old()
    assert sorted(p.name for p in (tmp_path / "t").glob("version-*")) == ["version-2", "version-3"]
    assert t.read(2).count() == 3
    t.drop_old(keep=1)
    assert t.read().count() == 2


def test_preview(spark):
    assert tables.preview(spark.range(9)).count() == 3


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one != two and one.startswith(shared)


# --- whole days, through the command lines ---
def feed_day(folder, route_type, with_trip2=True):
    put(folder / "agency.txt", "agency_id,agency_name\nA,Agency\n")
    put(folder / "calendar.txt", "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nS,1,1,1,1,1,0,0,20250101,20251231\n")
    put(folder / "calendar_dates.txt", "service_id,date,exception_type\nX,20250715,1\n")
    put(folder / "routes.txt", f"route_id,agency_id,route_type\nR,A,{route_type}\n")
    put(folder / "shapes.txt", "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\nH,40.0,-74.0,1\nH,40.1,-74.0,2\n")
    put(folder / "stops.txt", "stop_id,stop_name,stop_lat,stop_lon\n1,One,40.0,-74.0\n2,Two,40.01,-74.0\n3,Off,41.0,-74.0\n")
    more = "EN_2,08:30:00,08:30:00,2,1\n" if with_trip2 else ""
    put(folder / "stop_times.txt", f"trip_id,arrival_time,departure_time,stop_id,stop_sequence\nEN_1,08:00:00,08:00:00,1,1\nEN_1,08:10:00,08:10:00,2,2\n{more}")
    put(folder / "trips.txt", "route_id,service_id,trip_id,shape_id\nR,S,EN_1,H\nR,X,EN_2,H\nR,Z,EN_3,H\n")


def test_two_days_end_to_end(spark, tmp_path):
    t = {n: str(tmp_path / n) for n in ("land1", "land2", "staging", "warehouse", "serving", "published", "msgs", "out", "ckpt")}
    feed_day(tmp_path / "land1/q_2025-07-01", 3)
    feed_day(tmp_path / "land2/q_2025-07-02", 4, with_trip2=False)
    for n, day in [(1, "2025-07-14"), (2, "2025-07-15")]:
        load.main(["--landing", t[f"land{n}"], "--staging", t["staging"], "--warehouse", t["warehouse"], "--run-ts", f"{day} 03:55:00 UTC"])
    routes = warehouse_table(spark, t["warehouse"], "routes").read()
    assert tuples(routes.select("route_type", "is_current")) == [(3, False), (4, True)]
    times = warehouse_table(spark, t["warehouse"], "stop_times").read()
    assert times.filter("is_current").count() == 3  # vanished keys stay open

    args = ["--warehouse", t["warehouse"], "--serving", t["serving"], "--published", t["published"]]
    for day in ("2025-07-14", "2025-07-15", "2025-07-15"):
        snapshot.main([*args, "--service-date", day])
    trips = spark.read.parquet(f"{t['serving']}/trips")
    assert tuples(trips.select("trip_id", F.col("service_date").cast("string"))) == [
        ("EN_1", "2025-07-14"), ("EN_1", "2025-07-15"), ("EN_2", "2025-07-15"),
    ]
    published = tables.VersionedTable(spark, f"{t['published']}/stop_times")
    assert published.read().count() == 3
    lazy = service_snapshot(snapshot.open_tables(spark, t["warehouse"]), dt.date(2025, 7, 15))
    for name in TABLES:
        day = spark.read.parquet(tables.service_day(f"{t['serving']}/{name}", dt.date(2025, 7, 15)))
        assert tuples(day) == tuples(lazy[name]), name

    entity = {"id": "bus", "vehicle": {"trip": {"tripId": "EN_1", "routeId": "R", "startDate": "20250715"}, "position": {"latitude": 40.0101, "longitude": -74.0}, "timestamp": "1752581580"}}
    message = json.dumps({"header": {"gtfsRealtimeVersion": "2.0", "timestamp": "1752581600"}, "entity": [entity]})
    put(tmp_path / "msgs/topic=gtfs-vehicle-positions/m1.txt", message)
    for flow in ("monitor", "positions", "archive"):
        streams.main([flow, "--directory", t["msgs"], "--output", f"{t['out']}/{flow}", "--checkpoint", f"{t['ckpt']}/{flow}", "--published", t["published"], "--trigger", "once"])
    more = ["--published", t["published"], "--trigger", "once", "--in-plan"]
    streams.main(["monitor", "--directory", t["msgs"], "--output", f"{t['out']}/plan", "--checkpoint", f"{t['ckpt']}/plan", *more])
    assert tuples(spark.read.parquet(f"{t['out']}/plan")) == tuples(spark.read.parquet(f"{t['out']}/monitor").select(*MONITOR_COLUMNS))
    row = spark.read.parquet(f"{t['out']}/monitor").first()
    assert (row.stop_name, row.status, row.delay_seconds, row.borough) == ("Two", "arrived", 180, "Brooklyn")
    assert spark.read.parquet(f"{t['out']}/positions").count() == 1

    # What the monitor wrote, and the stops, to lookup and dashboard tables.
    square = {"name": "Brooklyn", "rings": [[{"x": x, "y": y} for x, y in ((-75, 39.9), (-73, 39.9), (-73, 40.005), (-75, 40.005))]]}
    put(tmp_path / "outlines.json", json.dumps(square))
    boroughs.main(["--polygons", str(tmp_path / "outlines.json"), "--published", t["published"]])
    lookup = tables.VersionedTable(spark, f"{t['published']}/stop_boroughs").read()
    assert tuples(lookup) == [("1", "Brooklyn"), ("2", "Unknown")] and lookup.columns == ["stop_id", "borough"]
    dashboard.main(["--monitor", f"{t['out']}/monitor", "--output", f"{t['out']}/dashboard", "--parts", f"{t['out']}/parts"])
    live = tables.VersionedTable(spark, f"{t['out']}/dashboard/live_vehicles").read()
    assert tuple(live.columns) == MONITOR_COLUMNS
    otp = tables.VersionedTable(spark, f"{t['out']}/dashboard/otp_by_route").read()
    assert tuples(otp) == [("R", 1, 1.0)]
    streams.main(["gate", "--directory", t["msgs"], "--output", f"{t['out']}/gate", "--checkpoint", f"{t['ckpt']}/gate", "--trigger", "once"])
    assert spark.read.parquet(f"{t['out']}/gate").select("feed", "json_str").first() == ("gtfs-vehicle-positions", message)
    sizes = spark.read.parquet(f"{t['out']}/gate-metrics")
    assert tuples(sizes.select("metric", "value")) == [("payload_size_bytes", len(message))]
    assert spark.read.parquet(f"{t['out']}/archive").first().value == message


def position_message(stamp):
    entity = {"id": "bus", "vehicle": {"trip": {"tripId": "EN_1", "routeId": "R", "startDate": "20250715"}, "position": {"latitude": 40.0, "longitude": -74.0}, "timestamp": stamp}}
    return json.dumps({"header": {"gtfsRealtimeVersion": "2.0", "timestamp": stamp}, "entity": [entity]})


def test_windows_quarantine_and_replay_by_command_line(spark, tmp_path, capsys):
    t = {n: str(tmp_path / n) for n in ("msgs", "out", "ckpt", "archive", "marks")}
    texts = [position_message("1752581580"), "{", position_message("1752589999")]
    put(tmp_path / "msgs/topic=gtfs-vehicle-positions/m1.txt", "\n".join(texts))
    for flow, source in (("split", t["msgs"]), ("quarantine", t["msgs"]), ("windows", f"{t['out']}/split/on-time")):
        streams.main([flow, "--directory", source, "--output", f"{t['out']}/{flow}", "--checkpoint", f"{t['ckpt']}/{flow}", "--trigger", "once"])
    closed = spark.read.parquet(f"{t['out']}/windows").select(F.unix_seconds("window_start"), "active_vehicles", "positions")
    assert tuples(closed) == [(1752581400, 1, 1)]
    wrong = spark.read.parquet(f"{t['out']}/quarantine").select("json_str", "topic", "reason")
    assert tuples(wrong) == [("{", "gtfs-vehicle-positions", "not_json")]

    rows = spark.createDataFrame([(x, 0, o) for o, x in enumerate(texts)], "value string, partition int, offset bigint")
    rows.selectExpr("*", "'gtfs-vehicle-positions' AS topic", "date'2025-07-15' AS day").write.partitionBy("topic", "day").parquet(t["archive"])
    for _ in range(2):
        replay.main(["positions", "--archive", t["archive"], "--topic", "gtfs-vehicle-positions", "--marks", t["marks"], "--output", f"{t['out']}/replay", "--range", "2"])
        assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"gtfs-vehicle-positions": {"0": 3}}
        assert spark.read.parquet(f"{t['out']}/replay").count() == 2


# --- OP-K7 ---
def test_processed_files_are_archived(spark, tmp_path):
    old = tmp_path / "old"
    for n in (1, 2, 3):
        put(tmp_path / f"in/topic=t/m{n}.txt", f"message {n}")
        source = directory_messages(spark, str(tmp_path / "in"), archive_to=str(old))
        query = flows.start_append(source, flows.batch_files(str(tmp_path / "out")), str(tmp_path / "ck"), None)
        query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert list(old.rglob("m1.txt"))
