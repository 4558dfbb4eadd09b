"""Schedules of any day, histories from logs, service days."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import plan_of, tuples
from pyspark.sql import functions as F

from headway.operators import asof, history, scd2, service_days, snapshot, versioned

DAY0 = dt.datetime(2024, 1, 1)
TIMES = "trip_id string, arrival_time string, stop_sequence int, stop_id string, start_dt_scd timestamp, end_dt_scd timestamp"
STOPS = "stop_id int, stop_name string, stop_lat double, stop_lon double, start_dt_scd timestamp, end_dt_scd timestamp"
PINGS = (
    "gtfs_version string, entity_id string, vp_trip_id string, route_id string, vp_start_date string, latitude double, "
    "longitude double, vehicle_timestamp timestamp, header_timestamp timestamp"
)


def at(hours):
    return None if hours is None else DAY0 + dt.timedelta(hours=hours)


def ping(name, trip, when):
    return ("2.0", name, trip, "r", when.strftime("%Y%m%d"), 40.0, -74.0, when, when)


def valid(row, when):
    return row[-2] <= when and (row[-1] is None or when < row[-1])


def plain_monitor(times, stops, pings):
    out = set()
    for p in pings:
        when = p[7]
        second = when.hour * 3600 + when.minute * 60 + when.second
        best = max(
            ((int(t[1][:2]) * 3600 + int(t[1][3:5]) * 60, t[2], s[1]) for t in times for s in stops
             if t[1] != "bad" and None is not t[0] == p[2] and str(s[0]) == t[3] and valid(t, when) and valid(s, when)
             and int(t[1][:2]) * 3600 + int(t[1][3:5]) * 60 <= second),
            default=None,
        )
        if best:
            out.add((p[1], best[2]))
    return sorted(out)


def versioned_rows(spark, times, stops, pings, **options):
    versions = versioned.schedule_versions(spark.createDataFrame(times, TIMES), spark.createDataFrame(stops, STOPS))
    schedule = versioned.versioned_schedule(versions)
    return schedule, versioned.versioned_monitor(spark.createDataFrame(pings, PINGS), schedule, "UTC", **options)


def test_positions_meet_the_schedule_of_their_time(spark):
    r = random.Random(3)
    times, stops = [], []
    for s in range(8):
        cuts = sorted(r.sample(range(0, 200), 3))
        for i, (a, b) in enumerate(zip([-1000, *cuts], [*cuts, None], strict=True)):
            if r.randrange(6):
                stops.append((s, f"{s}.{i}", 40.0, -74.0, at(a), at(b)))
    for i in range(120):
        a = r.randrange(-50, 200)
        end = r.choice([None, a, a - 5, a + r.randrange(1, 90), a + r.randrange(1, 90)])
        times.append((f"t{r.randrange(4)}", f"{r.randrange(24):02}:{r.randrange(60):02}:00", i, str(r.choice([*range(9), "x"])), at(a), at(end)))
    times += [(None, "01:00:00", 500, "1", at(0), None), ("t1", "01:00:00", 501, None, at(0), None), ("t1", "bad", 502, "1", at(0), None)]
    pings = [ping(f"v{i}", f"t{r.randrange(5)}", at(r.randrange(-60, 260)) + dt.timedelta(minutes=r.randrange(60))) for i in range(300)]
    pings += [ping("null", None, at(5))]
    _, out = versioned_rows(spark, times, stops, pings)
    got = sorted((x.entity_id, x.stop_name) for x in out.collect())
    want = plain_monitor(times, stops, pings)
    assert got == want and len(want) > 100


def test_a_thousand_versions_of_one_trip_make_no_pairs(spark):
    """Every hour the second of three stops is another one; each position meets one row."""
    hours = 1000
    times = [("hot", "00:00:00", 1, "1", at(0), None), ("hot", "20:00:00", 9, "2", at(0), None)]
    times += [("hot", "00:00:00", 2 + i % 3, str(3 + i % 5), at(i), at(i + 1)) for i in range(hours)]
    stops = [(s, f"s{s}", 40.0, -74.0, at(-9), None) for s in range(9)]
    pings = [ping(f"v{i}", "hot", at(i % hours) + dt.timedelta(minutes=i % 60)) for i in range(5000)]
    schedule, out = versioned_rows(spark, times, stops, pings, one_per_observation=False)
    assert schedule.index.select("segment").distinct().count() == hours + 1
    assert schedule.index.count() < 4 * 24 * (hours + 1)  # three stops at most, by hour of the day
    known = out.collect()
    assert len(known) == len(pings)  # before any is taken out
    assert all(x.stop_name == (f"s{3 + int(x.entity_id[1:]) % hours % 5}" if x.vehicle_timestamp.hour < 20 else "s2") for x in known)


def test_change_points_of_many_keys_are_not_sent(spark, tmp_path):
    """The files are a fraction of what the rows take, so Spark would collect and send a row per key."""
    rows = spark.range(200_000).select(
        F.col("id").alias("k"), F.timestamp_seconds(F.lit(0)).alias("start_dt_scd"),
        F.when(F.col("id") % 2 == 0, F.timestamp_seconds(F.lit(86400))).alias("end_dt_scd"),
    )
    rows.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    points = versioned.change_points(dim, ["k"])
    cut = versioned.cut(dim, ["k"], points)
    assert "Broadcast" not in plan_of(cut)
    cut = cut.cache()
    assert cut.count() == 200_000 and cut.filter("segment = start_dt_scd").count() == 200_000
    assert tuples(cut.filter("k < 2").select("k", "end_dt_scd")) == [(0, at(24 - 24 * 19723)), (1, None)]


def test_index_and_lookup_agree_on_buckets(spark):
    right = spark.createDataFrame([("a", 5, "x")], "k string, at int, v string")
    left = spark.createDataFrame([("a", 9)], "j string, t int")
    index = asof.interval_index(right, ["k"], "at", width=10, horizon=100)
    assert asof.asof_lookup(left, asof.lookup_layout(index, ["k"]), [("j", "k")], "t", "due", width=10, horizon=100).count() == 1
    with pytest.raises(ValueError, match="no buckets of width 3600"):
        asof.asof_lookup(left, index, [("j", "k")], "t", "due")


# --- history from a log ---
LOG = "k string, a string, b int, at timestamp, seq int, gone boolean"


def some_log(r, n, keys=6, span=400):
    rows = []
    for i in range(n):
        k = r.choice([None, "hot", "hot", *map(str, range(keys))])
        rows.append((k, r.choice([None, "x", "y"]), r.randrange(2), at(r.randrange(span)), i, r.random() < 0.1))
    return rows


def plain_history(rows):
    by = {}
    for row in sorted(rows, key=lambda x: x[4]):
        by.setdefault(row[0], {})[row[3]] = None if row[5] else (row[1], row[2])
    out = []
    for k, seen in by.items():
        last, start = "none", None
        for when in [*sorted(seen), None]:
            now = seen[when] if when else "end"
            if now != last:
                if last not in ("none", None):
                    out.append((k, *last, start, when, when is None))
                last, start = now, when
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [3600, 50 * 3600, history.MONTH])
def test_history_from_a_log(spark, width):
    r = random.Random(width)
    rows = some_log(r, 600)
    r.shuffle(rows)
    log = spark.createDataFrame(rows, LOG).repartition(5)
    got = history.scd2_from_log(log, ["k"], ["a", "b"], "at", ["seq"], gone=F.col("gone"), bucket_width=width)
    assert tuples(got) == plain_history(rows)


def test_log_equals_merges_in_order(spark):
    """Loads name some keys each; merged one after another, or derived from the log in any order."""
    r = random.Random(8)
    loads = [[(str(k), r.choice("xy"), r.randrange(2), at(24 * d), d, False) for k in range(9) if r.randrange(3)] for d in range(5)]
    schema = "k string, a string, b int, start_dt_scd timestamp, end_dt_scd timestamp, is_current boolean"
    dim = spark.createDataFrame([], schema)
    for load in loads:
        stage = spark.createDataFrame([(k, a, b, t, None, True) for k, a, b, t, _, _ in load], schema)
        dim = spark.createDataFrame(scd2.scd2_merge(dim, stage, ["k"], ["a", "b"]).collect(), schema)
    rows = [x for load in loads for x in load]
    r.shuffle(rows)
    assert tuples(history.scd2_from_log(spark.createDataFrame(rows, LOG), ["k"], ["a", "b"], "at")) == tuples(dim)


def test_late_loads_split_intervals(spark):
    r = random.Random(9)
    rows = some_log(r, 300)
    late = [x for x in rows if x[0] in ("hot", None, "2") and x[4] % 3 == 0] + [("new", "x", 1, at(3), 999, False)]
    early = [x for x in rows if x not in late]
    options = {"tiebreak": ["seq"], "gone": F.col("gone")}
    first = spark.createDataFrame(early, LOG)
    old = history.scd2_from_log(first, ["k"], ["a", "b"], "at", **options)
    new = history.scd2_with_late(old, first, spark.createDataFrame(late, LOG), ["k"], ["a", "b"], "at", **options)
    assert tuples(new) == plain_history(early + late)
    assert tuples(history.scd2_with_late(old, first, first.limit(0), ["k"], ["a", "b"], "at", **options)) == tuples(old)
    # One late load within an interval: before, between, after.
    one = spark.createDataFrame([("k", "x", 1, at(0), 0, False), ("k", "x", 1, at(10), 1, False)], LOG)
    split = spark.createDataFrame([("k", "y", 1, at(5), 2, False)], LOG)
    got = history.scd2_with_late(history.scd2_from_log(one, ["k"], ["a", "b"], "at"), one, split, ["k"], ["a", "b"], "at")
    assert tuples(got) == [("k", "x", 1, at(0), at(5), False), ("k", "x", 1, at(10), None, True), ("k", "y", 1, at(5), at(10), False)]


def test_a_hot_key_is_not_one_window(spark):
    log = spark.createDataFrame(some_log(random.Random(1), 50), LOG)
    plan = plan_of(history.scd2_from_log(log, ["k"], ["a", "b"], "at", ["seq"]))
    windows = [x for x in plan.split("\n") if "Window [lag" in x]
    assert windows and all("__bucket" in x for x in windows)
    # One state per key and load leaves each map task, however often the load repeats it.
    assert "partial_max_by" in plan


# --- service days ---
WEEK = ", ".join(f"{d} int" for d in service_days.WEEKDAYS)


def service_tables(spark, r, n=40):
    base = dt.date(2023, 12, 20)
    day = lambda x: base + dt.timedelta(days=x)
    calendar, dates = [], []
    for s in [*(str(i) for i in range(n)), None]:
        for _ in range(r.randrange(3)):
            a = r.randrange(-300, 300)
            calendar.append((s, *[r.choice([0, 1, 1, None]) for _ in range(7)], day(a), day(a + r.randrange(-3, 300))))
        for _ in range(r.randrange(12)):
            dates.append((s, day(r.randrange(-200, 300)), r.choice([1, 2])))
    dates += [("0", None, 1), ("only", day(5), 1)]
    return (
        spark.createDataFrame(calendar, f"service_id string, {WEEK}, start_date date, end_date date"),
        spark.createDataFrame(dates, "service_id string, date date, exception_type int"),
    )


@pytest.mark.parametrize("mode", ["reference", "gtfs"])
def test_service_days(spark, mode):
    calendar, dates = service_tables(spark, random.Random(len(mode)))
    first, last = dt.date(2023, 11, 1), dt.date(2024, 2, 7)
    days = service_days.service_days(calendar, dates, dt.date(2023, 6, 1), dt.date(2025, 1, 1), mode).cache()
    got = tuples(service_days.services_in_range(days, first, last))
    want = []
    cal, exc = calendar.collect(), dates.collect()
    for d in (first + dt.timedelta(days=i) for i in range((last - first).days + 1)):
        regular = {c.service_id for c in cal if c[1 + d.weekday()] == 1 and c.start_date <= d <= c.end_date}
        today = [x for x in exc if x.date == d]
        if mode == "gtfs":
            regular -= {x.service_id for x in today if x.exception_type == 2}
            today = [x for x in today if x.exception_type == 1]
        want += [(s, d) for s in regular | {x.service_id for x in today}]
    assert got == sorted(want, key=repr) and len(want) > 300
    for d in (first, dt.date(2024, 2, 1)):
        one = tuples(service_days.running_on(days, d))
        assert one == sorted([(s,) for s, x in want if x == d], key=repr)
        assert mode == "gtfs" and any(s is None for s, in one) or one == tuples(snapshot.services_on_date(calendar, dates, d, mode))
    counts = {s: sum(x == s for x, _ in want) for s, _ in want}
    assert tuples(service_days.active_days(days, first, last)) == sorted(counts.items(), key=repr)
    trips = spark.createDataFrame([(i, str(i % 7)) for i in range(50)], "trip_id int, service_id string")
    per_day = {d: sum(str(i % 7) == s for s, x in want if x == d for i in range(50)) for _, d in want}
    assert dict(tuples(service_days.trips_per_day(days, trips, first, last))) == {d: n for d, n in per_day.items() if n}
    with pytest.raises(ValueError, match="unknown mode"):
        service_days.service_days(calendar, dates, first, last, "other")


def test_a_range_is_one_scan(spark, tmp_path):
    calendar, dates = service_tables(spark, random.Random(1))
    path = str(tmp_path / "days")
    service_days.service_days(calendar, dates, dt.date(2020, 1, 1), dt.date(2030, 1, 1)).write.parquet(path)
    plan = plan_of(service_days.services_in_range(spark.read.parquet(path), dt.date(2024, 1, 1), dt.date(2024, 3, 1)))
    assert "Exchange" not in plan and "GreaterThanOrEqual(word" in plan


