"""Messages, feeds, monitor, metrics."""

from __future__ import annotations

import datetime as dt
import json
import random

from conftest import plan_of, tuples
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators import feeds, metrics, nested
from headway.operators.monitor import MONITOR_COLUMNS, schedule_index, trip_monitor
from headway.schemas import ALERTS, TRIP_UPDATES, VEHICLE_POSITIONS

NEW_YORK = "America/New_York"


def messages(spark, *texts, topic="t"):
    rows = [(bytearray(x if isinstance(x, str) else json.dumps(x), "utf8"), topic) for x in texts]
    return nested.decode(spark.createDataFrame(rows, "value binary, topic string"))


def vehicle(id_="v1", trip="t1", at="1700000000", **more):
    return {
        "id": id_,
        "vehicle": {
            "trip": {"tripId": trip, "routeId": "r", "startDate": "20231114"},
            "position": {"latitude": 40.7, "longitude": -74.0},
            "timestamp": at,
            **more,
        },
    }


def envelope(*entities, at="1700000060"):
    return {"header": {"gtfsRealtimeVersion": "2.0", "timestamp": at}, "entity": list(entities)}


# --- OP-J1..J3 ---
def test_vehicle_messages_of_all_kinds(spark):
    df = messages(
        spark,
        envelope(vehicle("ok"), vehicle("no_trip", trip=None), vehicle("late", at="soon")),
        "bad{",
        {"header": {"timestamp": "1"}},
        envelope(),
        envelope(vehicle("odd", position={"latitude": "north"})),
        {"entity": [vehicle("headless")]},
        {"entity": [None, {"id": "empty"}]},
    )
    parsed = nested.parse_envelope(df, VEHICLE_POSITIONS, keep=["topic"])
    assert parsed.columns == ["header", "entity", "topic"] and parsed.count() == 7
    out = nested.flatten_vehicle_positions(parsed, header_time=True)
    rows = {r.entity_id: r for r in out.collect()}
    assert sorted(rows) == ["headless", "late", "odd", "ok"]
    assert rows["ok"].vehicle_timestamp == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert rows["ok"].header_timestamp == dt.datetime(2023, 11, 14, 22, 14, 20)
    assert rows["late"].vehicle_timestamp is None
    assert rows["odd"].latitude is None
    assert rows["headless"].gtfs_version is None
    assert nested.flatten_vehicle_positions(parsed).columns == [
        "gtfs_version", "entity_id", "vp_trip_id", "route_id", "vp_start_date", "latitude", "longitude", "vehicle_timestamp",
    ]


def test_each_message_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([("bad{",)], "value string").write.parquet(str(tmp_path / "m"))
    df = nested.decode(spark.read.parquet(str(tmp_path / "m")))
    for flat, schema in [
        (nested.flatten_vehicle_positions, VEHICLE_POSITIONS),
        (nested.flatten_trip_updates, TRIP_UPDATES),
        (nested.flatten_alerts, ALERTS),
    ]:
        assert plan_of(flat(nested.parse_envelope(df, schema))).count("from_json(") == 1


# --- OP-J4 ---
def test_trip_updates(spark):
    def update(id_, stops):
        return {"id": id_, "tripUpdate": {"trip": {"tripId": "t", "directionId": 1}, "vehicle": {"id": "v"}, "stopTimeUpdate": stops, "delay": 5}}

    stops = [{"stopSequence": 1, "stopId": "s1", "arrival": {"time": "10"}}, {"stopSequence": 2, "departure": {"time": "20"}}]
    df = messages(spark, envelope(update("a", stops), update("b", []), update("c", None)), "bad{")
    out = nested.flatten_trip_updates(nested.parse_envelope(df, TRIP_UPDATES))
    assert len(out.columns) == 15
    rows = tuples(out.select("entity_id", "direction_id", "stop_sequence", "stop_id", "arrival_time", "departure_time", "delay"))
    assert rows == [("a", 1, 1, "s1", "10", None, 5), ("a", 1, 2, None, None, "20", 5)]


# --- OP-J5 ---
def alert(id_, periods=1, informed=1, heads=1, bodies=1):
    def texts(n):
        return None if n is None else {"translation": [{"text": f"x{i}", "language": "en"} for i in range(n)]}

    return {
        "id": id_,
        "alert": {
            "activePeriod": None if periods is None else [{"start": str(i), "end": "9"} for i in range(periods)],
            "informedEntity": None if informed is None else [{"agencyId": "g", "routeId": f"r{i}"} for i in range(informed)],
            "headerText": texts(heads),
            "descriptionText": texts(bodies),
        },
    }


def test_alerts_multiply_and_vanish(spark):
    df = messages(
        spark,
        envelope(alert("full", 2, 3, 2, 2), alert("no_period", periods=0), alert("no_informed", informed=None), alert("no_body", bodies=None), alert("no_head", heads=0)),
    )
    parsed = nested.parse_envelope(df, ALERTS)
    flat = nested.flatten_alerts(parsed)
    assert len(flat.columns) == 11
    assert tuples(flat.groupBy("id").count()) == [("full", 24)]
    outer = nested.flatten_alerts(parsed, outer=True)
    assert dict(tuples(outer.groupBy("id").count())) == {"full": 24, "no_period": 1, "no_informed": 1, "no_body": 1, "no_head": 1}
    counts = dict(tuples(metrics.alert_counts(flat)))
    assert counts == {"r0": 1, "r1": 1, "r2": 1}


# --- OP-T8, OP-T9 ---
def gate(data):
    """What the poll loop lets through, message by message."""
    last, out = {}, []
    for feed, seq, ts in sorted(data, key=lambda r: r[1]):
        if ts is not None and last.get(feed) != ts:
            out.append((feed, seq, ts, last.get(feed)))
            last[feed] = ts
    return sorted(out, key=repr)


feed_rows = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from([None, 1, 2, 3])), max_size=60)


@settings(max_examples=6, deadline=None)
@given(feed_rows, st.sampled_from([1, 4, 1000]), st.integers(0, 60))
def test_gate_and_gate_in_two_parts(spark, data, width, cut):
    rows = [(f, i, ts) for i, (f, ts) in enumerate(data)]
    make = lambda r: spark.createDataFrame(r, "feed string, seq int, header_ts bigint")
    whole = feeds.changed_messages(make(rows), bucket_width=width)
    assert tuples(whole) == gate(rows)
    first, second = rows[:cut], rows[cut:]
    last = {}
    for f, _, ts in first:
        if ts is not None:
            last[f] = ts
    prior = spark.createDataFrame(list(last.items()), "feed string, header_ts bigint")
    parts = tuples(feeds.changed_messages(make(first), bucket_width=width)) + tuples(
        feeds.changed_messages(make(second), bucket_width=width, prior=prior)
    )
    assert sorted(parts, key=repr) == gate(rows)


def test_header_epoch_and_metrics(spark):
    texts = [envelope(at="100"), envelope(at="100"), envelope(at="160"), envelope(at="100"), {"entity": []}, "bad{", envelope(at="x")]
    raw = spark.createDataFrame([("f", i, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)], "feed string, seq int, json_str string")
    changed = feeds.changed_messages(feeds.with_header_epoch(raw))
    assert [r[:2] for r in tuples(changed.select("seq", "header_ts"))] == [(0, 100), (2, 160), (3, 100)]
    out = tuples(feeds.feed_metrics(changed, F.timestamp_seconds("header_ts")).select("metric", "value"))
    size = len(json.dumps(texts[0]))
    assert out == sorted([("update_interval_sec", 60), ("update_interval_sec", -60)] + [("payload_size_bytes", size)] * 3, key=repr)


def test_gate_is_not_one_task_per_feed(spark):
    df = spark.range(1000).selectExpr("'f' AS feed", "id AS seq", "id div 3 AS header_ts")
    assert "__bucket" in plan_of(feeds.changed_messages(df, bucket_width=10)).split("Window [lag")[1].split("\n")[0]


# --- OP-N8 ---
def test_feed_versions(spark):
    schema = "feed_url string, version_date string"
    incoming = spark.createDataFrame([("same", "2024-01-01 x"), ("new", "2024-01-01"), ("moved", "2024-02-01")], schema)
    stored = spark.createDataFrame([("same", "2024-01-01"), ("moved", "2024-01-01"), ("old", "2023-01-01")], schema)
    assert [r[0] for r in tuples(feeds.changed_feeds(incoming, stored))] == ["moved", "new"]
    state = feeds.next_versions(incoming, stored)
    assert tuples(state) == [("moved", "2024-02-01"), ("new", "2024-01-01"), ("old", "2023-01-01"), ("same", "2024-01-01")]
    assert feeds.changed_feeds(incoming, state).isEmpty()


# --- OP-C6 ---
PINGS = (
    "gtfs_version string, entity_id string, vp_trip_id string, route_id string, vp_start_date string, "
    "latitude double, longitude double, vehicle_timestamp timestamp, header_timestamp timestamp"
)


def local(spark, text):
    """Epoch of a New York clock time."""
    return spark.sql(f"SELECT CAST('{text} {NEW_YORK}' AS timestamp) AS t").first().t


def pings(spark, *rows):
    return spark.createDataFrame(
        [("2.0", e, trip, "r", day, lat, lon, at, at) for e, trip, day, at, lat, lon in rows], PINGS
    )


def index(spark, *rows):
    times = spark.createDataFrame(list(rows), "trip_id string, arrival_time string, stop_sequence int, stop_id int")
    stops = spark.createDataFrame([(i, f"s{i}", 40.0, -74.0) for i in range(1, 6)], "stop_id int, stop_name string, stop_lat double, stop_lon double")
    return schedule_index(times, stops)


def test_monitor(spark):
    radius = 0.0008993216  # degrees of latitude, a little under 100 m
    at = lambda t: local(spark, f"2025-07-15 {t}")
    idx = index(
        spark,
        ("EN_1", "08:00:00", 1, 1),
        ("EN_1", "08:10:00", 2, 2),
        ("EN_1", "08:10:00", 3, 3),  # two stops at one time
        ("EN_1", "25:01:00", 4, 4),
        ("EN_1", None, 5, 5),
        ("EN_1", "8:20", 6, 5),
        ("EN_1", "08:15:00", 7, 99),  # a stop nobody knows
    )
    out = trip_monitor(
        pings(
            spark,
            ("early", "EN_1", "20250715", at("07:59:59"), 40.0, -74.0),
            ("equal", "EN_1", "20250715", at("08:00:00"), 40.0, -74.0),
            ("tie", "EN_1", "20250715", at("08:16:00"), 40.0 + radius, -74.0),
            ("far", "EN_1", "20250715", at("08:16:00"), 40.1, -74.0),
            ("nowhere", "EN_1", "20250715", at("08:16:00"), None, -74.0),
            ("night", "EN_1", "20250715", local(spark, "2025-07-16 01:01:30"), 40.0, -74.0),
            ("next_week", "EN_1", "20250715", local(spark, "2025-07-22 01:00:00"), 40.0, -74.0),
            ("no_trip", "EN_2", "20250715", at("08:16:00"), 40.0, -74.0),
            ("no_day", "EN_1", "2025071", at("08:16:00"), 40.0, -74.0),
            ("no_time", "EN_1", "20250715", None, 40.0, -74.0),
        ),
        idx,
        NEW_YORK,
    )
    assert out.columns == list(MONITOR_COLUMNS)
    rows = {r.entity_id: (r.stop_id, r.status, r.delay_seconds, r.borough) for r in out.collect()}
    assert rows == {
        "equal": (1, "arrived", 0, "Brooklyn"),
        "tie": (3, "arrived", 360, "Brooklyn"),
        "far": (3, "on_way", None, "Brooklyn"),
        "nowhere": (3, "on_way", None, "Brooklyn"),
        "night": (4, "arrived", 30, "Brooklyn"),
        "next_week": (4, "arrived", 6 * 86400 - 60, "Brooklyn"),
    }


def test_monitor_gives_a_repeated_position_once(spark):
    at = local(spark, "2025-07-15 08:00:00")
    same = ("v", "EN_1", "20250715", at, 40.0, -74.0)
    out = trip_monitor(pings(spark, same, same, same), index(spark, ("EN_1", "07:00:00", 1, 1)), NEW_YORK)
    assert out.count() == 1
    several = trip_monitor(
        pings(spark, same, same), index(spark, ("EN_1", "07:00:00", 1, 1)), NEW_YORK, one_per_observation=False
    )
    assert several.count() == 2


def test_monitor_anchor(spark):
    at = local(spark, "2025-03-09 09:30:00")
    day = pings(spark, ("v", "EN_1", "20250309", at, 40.0, -74.0))
    idx = index(spark, ("EN_1", "08:00:00", 1, 1))
    assert trip_monitor(day, idx, NEW_YORK).first().delay_seconds == 1800
    assert trip_monitor(day, idx, NEW_YORK, anchor="noon").first().delay_seconds == 5400


def test_monitor_on_random_trips(spark):
    """Against brute force, with one trip holding a third of everything."""
    rng = random.Random(3)
    trip = lambda i: "hot_" if i % 3 == 0 else f"t{rng.randrange(30)}_"
    sched = [(trip(i), f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", i, rng.randrange(1, 6), s) for i in range(900) for s in [rng.randrange(60 * 3600)]]
    obs = [(f"v{i}", trip(i), rng.randrange(-3600, 70 * 3600)) for i in range(1500)]
    base = local(spark, "2025-07-15 00:00:00")
    df = pings(spark, *[(e, t, "20250715", base + dt.timedelta(seconds=s), 40.0, -74.0) for e, t, s in obs])
    out = trip_monitor(df, index(spark, *[r[:4] for r in sched]), NEW_YORK)
    want = {}
    for e, t, s in obs:
        hits = [(off, seq, stop) for tr, _, seq, stop, off in sched if tr == t and off <= s]
        if hits:
            off, _, stop = max(hits)
            want[e] = (stop, base + dt.timedelta(seconds=off))
    assert {r.entity_id: (r.stop_id, r.scheduled_arrival) for r in out.collect()} == want


def test_monitor_stays_in_the_jvm(spark):
    out = trip_monitor(pings(spark), index(spark, ("t", "07:00:00", 1, 1)), NEW_YORK)
    plan = plan_of(out)
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# --- OP-M1..M7 ---
def test_metrics(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 8, m)
    df = spark.createDataFrame(
        [
            ("v1", "r1", "B", t(0), "arrived", 100),
            ("v1", "r1", "B", t(6), "arrived", 500),
            ("v2", "r2", "B", t(1), "arrived", 300),
            ("v3", "r1", "B", t(2), "on_way", None),
        ],
        "entity_id string, route_id string, borough string, vehicle_timestamp timestamp, status string, delay_seconds bigint",
    )
    assert tuples(metrics.on_time_performance(df, ["route_id"])) == [("r1", 2, 0.5), ("r2", 1, 1.0)]
    assert tuples(metrics.average_delay(df, ["route_id"])) == [("r1", 2, 300.0), ("r2", 1, 300.0)]
    assert tuples(metrics.average_delay(df, ["route_id"], "5 minutes").select("window_start", "avg_delay").filter("route_id = 'r1'")) == [(t(0), 100.0), (t(5), 500.0)]
    assert [r.worst_rank for r in metrics.borough_route_performance(df).collect()] == [1, 1]
    assert tuples(metrics.active_vehicles(df)) == [(t(0), 3), (t(5), 1)]
    assert [r[1] for r in tuples(metrics.arrival_rate(df))] == [3, 1]
    assert {r.entity_id: r.vehicle_timestamp for r in metrics.live_vehicles(df).collect()} == {"v1": t(6), "v2": t(1), "v3": t(2)}
