"""Polygons of all sizes; distinct counts that merge; broken messages."""

from __future__ import annotations

import datetime as dt
import json
import math
import random

from conftest import plan_of, tuples
from pyspark.sql import functions as F

from headway.demos import versions
from headway.operators import metrics, nested, quarantine, rollup
from headway.operators.cover import points_in_cover, polygon_cover
from headway.operators.spatial import point_in_polygon
from headway.schemas import ALERTS, TRIP_UPDATES, VEHICLE_POSITIONS

SHAPES = "name string, rings array<array<struct<x double, y double>>>"


def star(x, y, r, n, rough, rnd):
    return [(x + r * (1 - rough * rnd.random()) * math.cos(2 * math.pi * i / n), y + r * (1 - rough * rnd.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]


# --- cover ---
def test_cover_agrees_with_the_grid(spark):
    rnd = random.Random(2)
    shapes = [(f"s{i}", [star(rnd.uniform(-1, 1), rnd.uniform(-1, 1), 10 ** rnd.uniform(-2, 0.3), rnd.choice([3, 9, 200]), 0.7, rnd)]) for i in range(12)]
    shapes.append(("hole", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)], [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)]]))
    shapes += [("empty", []), ("none", None), ("dot", [[(0.5, 0.5)]]), ("far", [[(1e300, 0.0), (0.0, 1.0), (0.0, 0.0)]])]
    points = [(i, rnd.uniform(-2, 2), rnd.uniform(-2, 2)) for i in range(800)]
    points += [(900, 0.5, 0.1), (901, 0.5, 0.5), (902, 0.0, 0.5), (903, 0.25, 0.5), (904, 1.0, 1.0), (905, None, 0.0), (906, float("nan"), 0.0), (907, 0.5, 0.1)]
    at = spark.createDataFrame(points, "id int, px double, py double")
    known = spark.createDataFrame(shapes, SHAPES)
    got = points_in_cover(at, polygon_cover(known), "px", "py").select("id", "name")
    near = spark.createDataFrame(shapes[:-1], SHAPES)  # the grid would have to span the last one
    want = point_in_polygon(at, near, "px", "py", cell=0.3).select("id", "name")
    assert tuples(got) == tuples(want) and got.filter("name IS NOT NULL").count() > 300
    assert sorted(n for i, n in tuples(got) if i in (900, 907) and n == "hole") == ["hole"] * 2


def test_cells_follow_the_outline(spark):
    rnd = random.Random(3)
    shapes = [("huge", [[(-5.0, -5.0), (5.0, -5.0), (5.0, 5.0), (-5.0, 5.0)]]), ("tiny", [star(0.1, 0.1, 1e-4, 40, 0.5, rnd)]), ("coast", [star(0.0, 0.0, 8.0, 3000, 0.05, rnd)])]
    cells = polygon_cover(spark.createDataFrame(shapes, SHAPES)).cache()
    count = dict(tuples(cells.groupBy("name").count()))
    assert count["huge"] <= 9 and count["tiny"] < 400 and count["coast"] < 12_000
    assert cells.filter("inside AND edges IS NOT NULL").count() == 0
    assert cells.select("level").distinct().count() < 20
    points = spark.createDataFrame([(i, rnd.uniform(-9, 9), rnd.uniform(-9, 9)) for i in range(3000)], "id int, x double, y double")
    plan = plan_of(points_in_cover(points, cells, "x", "y"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_few_points_meet_edges_and_large_cells_are_sent(spark, conf):
    rnd = random.Random(5)
    stars = [(f"s{i}", [star(rnd.random(), rnd.random(), 10 ** rnd.uniform(-2, -1), 24, 0.5, rnd)]) for i in range(40)]
    cells = polygon_cover(spark.createDataFrame([("all", [star(0.5, 0.5, 9.0, 24, 0.5, rnd)]), *stars], SHAPES)).cache()
    points = spark.createDataFrame([(i, rnd.random(), rnd.random()) for i in range(3000)], "id int, px double, py double").cache()
    size = F.pow(F.lit(2.0), -F.col("level"))
    met = points.join(cells, (F.floor(F.col("px") / size) == F.col("x")) & (F.floor(F.col("py") / size) == F.col("y")))
    found = points_in_cover(points, cells, "px", "py")
    assert met.filter("NOT inside").count() < 0.5 * found.filter("name IS NOT NULL").count()
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    found = points_in_cover(points, cells, "px", "py")
    assert found.filter("name = 'all'").count() == 3000 and "BroadcastHashJoin" in plan_of(found)


def test_hits_are_not_moved_once_found(spark, conf):
    """Rows of the result stay where a point met a cell, and most cells at an outline need no list of edges."""
    rnd = random.Random(6)
    stars = [(f"s{i}", [star(rnd.random(), rnd.random(), 10 ** rnd.uniform(-2, -1), 24, 0.5, rnd)]) for i in range(40)]
    stars.append(("all", [star(0.5, 0.5, 9.0, 24, 0.5, rnd), star(0.5, 0.5, 0.2, 9, 0.5, rnd)]))
    known = spark.createDataFrame(stars, SHAPES)
    cells = polygon_cover(known).cache()
    assert cells.filter("odd IS NOT NULL").count() > 0.5 * cells.filter("NOT inside").count()
    places = [(i, rnd.uniform(-0.2, 1.2), rnd.uniform(-0.2, 1.2)) for i in range(2000)] + [(i, 0.3, 0.4) for i in range(2000, 2100)]
    places += [(3000 + i, p["x"], p["y"]) for i, p in enumerate(q for r in known.collect() for ring in r.rings for q in ring)]
    places += [(9000, None, 0.5), (9001, 0.5, float("nan")), (9002, float("inf"), 0.5), (9003, 50.0, 50.0)]
    points = spark.createDataFrame(places, "id int, px double, py double")
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    found = points_in_cover(points, cells, "px", "py")
    above, joins = [], 0
    for line in plan_of(found).splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        above = [(d, n) for d, n in above if d < depth]
        if "Join [__level" in line and "Inner" in line:
            joins += 1
            assert not any("Exchange" in n for _, n in above)
        above.append((depth, line))
    assert joins
    want = point_in_polygon(points.filter("id < 9000"), known, "px", "py", cell=0.3).select("id", "name")
    odd = [(i, None) for i in range(9000, 9004)]
    assert tuples(found.select("id", "name")) == sorted(tuples(want) + odd, key=repr)


# --- distinct counts ---
def test_distinct_counts_merge(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, "hot", *map(str, range(90_000, 90_300))]), rnd.choice("ab"), 60 * rnd.randrange(3000)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "entity_id string, side string, s int").withColumn("vehicle_timestamp", F.timestamp_seconds("s"))
    first = df.filter("s < 9000")
    ids = rollup.id_dictionary(first, "entity_id", parts=7)
    more = rollup.id_dictionary(df, "entity_id", ids, parts=7).cache()
    n = df.select("entity_id").na.drop().distinct().count()
    assert sorted(r.number for r in more.collect()) == list(range(1, n + 1))
    assert ids.join(more, ["entity_id", "number"]).count() == ids.count() < n
    assert rollup.id_dictionary(df.limit(0), "entity_id").count() == 0
    loads = [rollup.distinct_cells(df.filter(c), more, "entity_id", ["side"]) for c in ("s % 7 = 0", "s % 7 <> 0")]
    cells = rollup.merged_cells(loads[0].unionByName(loads[1]), ["side"], rollup.CELL)
    for every in ("5 minutes", "1 hour", "1 day"):
        got = rollup.distinct_counts(rollup.merged_cells(cells, ["side"], every))
        want = metrics.active_vehicles(df, every, ["side"]).filter("active_vehicles > 0")
        assert tuples(got.select("window_start", "side", "active_vehicles")) == tuples(want.select("window_start", "side", "active_vehicles"))
    assert rollup.distinct_counts(rollup.merged_cells(cells)).collect()[0][0] == n
    assert rollup.distinct_counts(rollup.merged_cells(cells.limit(0))).collect()[0][0] == 0


def test_many_ids_use_several_bitmaps(spark):
    df = spark.range(70_000).select(F.col("id").cast("string").alias("entity_id"), F.timestamp_seconds(F.lit(5)).alias("vehicle_timestamp"))
    cells = rollup.distinct_cells(df, rollup.id_dictionary(df, "entity_id"), "entity_id").cache()
    assert cells.count() == 3 and rollup.distinct_counts(cells).collect()[0].active_vehicles == 70_000


# --- broken messages ---
def judged(spark, schema, *texts):
    rows = [(i, t if t is None or isinstance(t, str) else json.dumps(t), "topic") for i, t in enumerate(texts)]
    return quarantine.judge_messages(spark.createDataFrame(rows, "id int, json_str string, topic string"), schema)


def test_reasons_and_typed_columns(spark):
    head = {"gtfsRealtimeVersion": "2.0", "timestamp": "1700000060"}
    car = {"id": "v", "vehicle": {"trip": {"tripId": "t"}, "position": {"latitude": 40.7, "longitude": -74}, "timestamp": 1700000000}}
    odd = json.loads(json.dumps(car))
    odd["vehicle"]["position"] = {"latitude": "north", "longitude": "-74.5"}
    texts = [
        {"header": head, "entity": [car]}, None, "  ", "{", "5", "[1]", {"header": None, "entity": []}, {"x": 1},
        {"header": head, "entity": [car, odd, None]}, {"header": head, "entity": {}}, {"header": 3, "entity": [4]}, {"header": head, "entity": []},
    ]
    out = judged(spark, VEHICLE_POSITIONS, *texts).cache()
    got = {r.id: (r.reason, r.fields, r.usable) for r in out.collect()}
    assert got[0] == (None, [], True) and got[11] == (None, [], True)
    assert [got[i] for i in (1, 2)] == [("empty", [], False)] * 2
    assert got[3] == ("not_json", [], False) and got[4] == got[5] == ("not_an_object", [], False)
    assert got[6] == ("missing", ["header"], False) and got[7] == ("missing", ["header", "entity"], False)
    assert got[8] == ("bad_fields", ["entity[].vehicle.position.latitude"], True)
    assert got[9] == ("bad_fields", ["entity"], True)
    assert got[10] == ("bad_fields", ["header", "entity[]"], True)
    rows = tuples(nested.flatten_vehicle_positions(quarantine.typed_messages(out, VEHICLE_POSITIONS)).select("entity_id", "latitude", "longitude"))
    assert rows == [("v", 40.7, -74.0), ("v", 40.7, -74.0), ("v", None, -74.5)]
    table = quarantine.quarantined(out)
    assert table.count() == 10 and table.columns == ["id", "json_str", "topic", "reason", "fields", "usable"]


def test_drift_names_unknown_fields_once(spark):
    head = {"gtfsRealtimeVersion": "2.0", "timestamp": 5, "source": "x"}
    update = {"trip": {"tripId": "t", "directionId": "up"}, "stopTimeUpdate": [{"stopSequence": 1, "platform": {"name": "A"}}]}
    texts = [
        {"header": head, "entity": [{"id": "a", "tripUpdate": {"trip": {"tripId": "t"}, "stopTimeUpdate": [{"platform": {"name": "A"}}]}}]},
        {"header": head, "entity": [{"id": 7, "tripUpdate": {"delay": 3}}], "extra": [{"deep": 1}]},
        {"header": head, "entity": [{"id": "b", "tripUpdate": update}]}, "{", {"entity": []},
    ]
    got = tuples(quarantine.message_drift(judged(spark, TRIP_UPDATES, *texts), TRIP_UPDATES))
    assert got == sorted([
        ("topic", "extra", "unknown", "array<struct<deep:bigint>>", None),
        ("topic", "header.source", "unknown", "string", None),
        ("topic", "entity[].tripUpdate.stopTimeUpdate[].platform", "unknown", "struct<name:string>", None),
        ("topic", "entity[].tripUpdate.trip.directionId", "bad_fields", None, 1),
        ("topic", "header", "missing", None, 1),
    ], key=repr)
    assert quarantine.message_drift(judged(spark, ALERTS, "{"), ALERTS).count() == 0


def test_messages_are_judged_once(spark):
    """What is right is not asked for again, path by path, and drift is one pass."""
    head = {"gtfsRealtimeVersion": "2.0", "timestamp": 5}
    out = judged(spark, VEHICLE_POSITIONS, {"header": head, "entity": []}, {"header": head, "entity": [{"vehicle": 3}]}, {"header": 1, "entity": []})
    assert "schemaofvariant" not in plan_of(out).lower().replace("_", "")
    got = quarantine.message_drift(out, VEHICLE_POSITIONS)
    assert "parsejson" not in plan_of(got).lower().replace("_", "")
    assert tuples(got) == [("topic", "entity[].vehicle", "bad_fields", None, 1), ("topic", "header", "bad_fields", None, 1)]


# --- vehicles of cells ---
def test_cells_parse_messages_once(spark, tmp_path, monkeypatch):
    rows = [(i, dt.datetime(2024, 1, 1 + i % 30, i % 24), i % 7, "error" if i % 9 == 0 else "click", 1.0, "{}") for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    plans = []
    for name in ("id_dictionary", "distinct_cells"):
        real = getattr(rollup, name)
        monkeypatch.setattr(rollup, name, lambda part, *more, real=real: plans.append(plan_of(part)) or real(part, *more))
    cells = versions.vehicle_cells(spark, str(tmp_path))
    assert len(plans) == 4 and not any("from_json" in p for p in plans)
    assert rollup.distinct_counts(rollup.merged_cells(cells)).collect()[0][0] == 7
