"""Schedules of any day, histories from logs, service days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from headway.functions.depots import depot_borough
from headway.operators import cover, history, rollup, service_days, versioned
from headway.plans.dashboard import figures_of_parts, refresh_parts
from headway.session import scratch_path
from headway.streaming.flows import batch_files

from .live import SQL_MONITOR, SQL_OTP, SQL_PINGS, SQL_POSITIONS, comparable, monitor, positions, stops_of
from .registry import demo, instant, lat, lon, sql_borough, sql_haversine, sql_lat, sql_lon, sql_trip_id, table, trip_id, wall

SCD = ["start_dt_scd", "end_dt_scd"]


# --- monitor against the schedule of the time: a view is a stop time for some days around it, and
# every part is a stop that was renamed and moved on a day of its own ---
def schedule_tables(spark, sf_dir):
    part, views = table(spark, sf_dir, "part"), table(spark, sf_dir, "events").filter("event_type = 'view'")
    k, day = F.col("event_id"), F.date_trunc("day", instant("ts"))
    start = F.date_sub(day.cast("date"), (k % 30).cast("int")).cast("timestamp")
    until = F.date_add(start.cast("date"), (k % 40 + 10).cast("int")).cast("timestamp")
    stop_times = views.select(
        trip_id(F.col("user_id")).alias("trip_id"),
        F.date_format("ts", "HH:mm:ss").alias("arrival_time"),
        k.alias("stop_sequence"),
        (k % stops_of(part)).alias("stop_id"),
        start.alias("start_dt_scd"),
        F.when(k % 5 > 0, until).alias("end_dt_scd"),
    )
    p = F.col("p_partkey")
    moved = F.date_add(F.lit("2024-01-05").cast("date"), (p % 20).cast("int")).cast("timestamp")
    begin = F.lit("2000-01-01").cast("timestamp")
    version = lambda n, start, end: F.struct(n.alias("n"), start.alias("start_dt_scd"), end.alias("end_dt_scd"))
    none = F.lit(None).cast("timestamp")
    stops = part.select(
        p.alias("stop_id"), "p_name", F.inline(F.array(version(F.lit(0), begin, moved), version(F.lit(1), moved, none)))
    ).select(
        "stop_id",
        F.concat("p_name", F.when(F.col("n") == 1, " (moved)").otherwise("")).alias("stop_name"),
        (lat(F.col("stop_id")) + F.col("n") / F.lit(1000.0)).alias("stop_lat"),
        lon(F.col("stop_id")).alias("stop_lon"),
        *SCD,
    )
    return stop_times, stops


@demo(
    "versioned_monitor",
    f"""WITH pings AS ({SQL_PINGS}),
    sched AS (SELECT {sql_trip_id("user_id")} AS trip_id, epoch(date_trunc('second', ts) - date_trunc('day', ts)) AS off, event_id,
                     event_id % (SELECT max(p_partkey) + 1 FROM part) AS stop_id,
                     date_trunc('day', ts) - to_days(CAST(event_id % 30 AS INT)) AS s0,
                     CASE WHEN event_id % 5 > 0 THEN date_trunc('day', ts) - to_days(CAST(event_id % 30 AS INT))
                          + to_days(CAST(event_id % 40 + 10 AS INT)) END AS s1
              FROM events WHERE event_type = 'view'),
    moved AS (SELECT *, TIMESTAMP '2024-01-05' + to_days(CAST(p_partkey % 20 AS INT)) AS cut FROM part),
    places AS (
      SELECT p_partkey AS stop_id, p_name AS stop_name, {sql_lat("p_partkey")} AS stop_lat, {sql_lon("p_partkey")} AS stop_lon,
             TIMESTAMP '2000-01-01' AS l0, cut AS l1 FROM moved
      UNION ALL SELECT p_partkey, p_name || ' (moved)', {sql_lat("p_partkey")} + 1 / 1000e0, {sql_lon("p_partkey")}, cut, NULL FROM moved),
    ranked AS (
      SELECT p.*, s.off, s.event_id, l.*, row_number() OVER (
               PARTITION BY entity_id, vp_trip_id, vehicle_timestamp ORDER BY s.off DESC, s.event_id DESC) AS rn
      FROM pings p JOIN sched s ON s.trip_id = p.vp_trip_id
           AND s.off <= epoch(p.vehicle_timestamp - date_trunc('day', p.vehicle_timestamp))
           AND s0 <= p.vehicle_timestamp AND (s1 IS NULL OR p.vehicle_timestamp < s1)
      JOIN places l ON l.stop_id = s.stop_id AND l0 <= p.vehicle_timestamp AND (l1 IS NULL OR p.vehicle_timestamp < l1)),
    measured AS (
      SELECT *, date_trunc('day', vehicle_timestamp) + to_seconds(CAST(off AS BIGINT)) AS scheduled_arrival,
             {sql_haversine("longitude", "latitude", "stop_lon", "stop_lat")} AS d
      FROM ranked WHERE rn = 1)
    SELECT gtfs_version, entity_id, vp_trip_id, route_id, vp_start_date, latitude, longitude,
           vehicle_timestamp, vehicle_timestamp AS header_timestamp, stop_id, stop_name, stop_lat, stop_lon,
           scheduled_arrival, round(d, 3) AS distance, CASE WHEN d <= 100 THEN 'arrived' ELSE 'on_way' END AS status,
           CASE WHEN d <= 100 THEN CAST(epoch(vehicle_timestamp) - epoch(scheduled_arrival) AS BIGINT) END AS delay_seconds,
           {sql_borough("vp_trip_id")} AS borough
    FROM measured""",
)
def _versioned_monitor(spark, sf_dir):
    path = scratch_path(spark, "schedule-versions")
    versioned.schedule_versions(*schedule_tables(spark, sf_dir)).write.parquet(path)
    schedule = versioned.versioned_schedule(spark.read.parquet(path))
    pings = positions(spark, sf_dir, header_time=True, views=False)
    return comparable(versioned.versioned_monitor(pings, schedule, "UTC"))


@demo(
    "schedule_versions",
    f"""WITH t AS (SELECT {sql_trip_id("user_id")} AS trip_id, strftime(ts, '%H:%M:%S') AS arrival_time, event_id AS stop_sequence,
             event_id % (SELECT max(p_partkey) + 1 FROM part) AS stop_id,
             date_trunc('day', ts) - to_days(CAST(event_id % 30 AS INT)) AS s0,
             CASE WHEN event_id % 5 > 0 THEN date_trunc('day', ts) - to_days(CAST(event_id % 30 AS INT))
                  + to_days(CAST(event_id % 40 + 10 AS INT)) END AS s1
           FROM events WHERE event_type = 'view'),
    moved AS (SELECT p_partkey AS stop_id, p_name, TIMESTAMP '2024-01-05' + to_days(CAST(p_partkey % 20 AS INT)) AS cut FROM part),
    l AS (SELECT stop_id, p_name AS stop_name, TIMESTAMP '2000-01-01' AS l0, cut AS l1 FROM moved
          UNION ALL SELECT stop_id, p_name || ' (moved)', cut, NULL FROM moved)
    SELECT trip_id, arrival_time, stop_sequence, stop_id, stop_name, greatest(s0, l0) AS start_dt_scd,
           CASE WHEN s1 IS NULL THEN l1 WHEN l1 IS NULL THEN s1 ELSE least(s1, l1) END AS end_dt_scd
    FROM t JOIN l USING (stop_id)
    WHERE (s1 IS NULL OR l0 < s1) AND (l1 IS NULL OR s0 < l1)""",
)
def _schedule_versions(spark, sf_dir):
    rows = versioned.schedule_versions(*schedule_tables(spark, sf_dir)).drop("stop_lat", "stop_lon")
    return rows.withColumns({c: wall(c) for c in SCD})


# --- history of the parts from the log of their lines ---
def line_log(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.nullif(F.col("l_partkey") % 500, F.lit(7)).alias("part"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").alias("at"),
        F.col("l_orderkey").alias("seq"),
        F.col("l_linenumber").alias("line"),
    )


SQL_HISTORY = """
line AS (SELECT nullif(l_partkey % 500, 7) AS part, nullif(l_returnflag, 'N') AS flag, l_linestatus AS status,
                l_shipdate AS seen_at, l_orderkey AS seq, l_linenumber AS line FROM lineitem WHERE l_shipdate IS NOT NULL),
seen AS (SELECT * FROM line QUALIFY row_number() OVER (
           PARTITION BY part, seen_at ORDER BY seq DESC, line DESC, flag DESC NULLS LAST, status DESC NULLS LAST) = 1),
change AS (SELECT * FROM seen WINDOW w AS (PARTITION BY part ORDER BY seen_at) QUALIFY row_number() OVER w = 1
             OR flag IS DISTINCT FROM lag(flag) OVER w OR status IS DISTINCT FROM lag(status) OVER w),
history AS (SELECT part, flag, status, seen_at AS start_dt_scd, lead(seen_at) OVER (PARTITION BY part ORDER BY seen_at) AS end_dt_scd FROM change)
SELECT *, end_dt_scd IS NULL AS is_current FROM history
"""
KEYS, TRACKED, TIE = ["part"], ["flag", "status"], ["seq", "line"]


def walled(df):
    return df.withColumns({c: wall(c) for c in SCD})


@demo("scd2_from_log", f"WITH {SQL_HISTORY}")
def _scd2_from_log(spark, sf_dir):
    return walled(history.scd2_from_log(line_log(spark, sf_dir), KEYS, TRACKED, "at", TIE))


@demo("scd2_with_late", f"WITH {SQL_HISTORY}")
def _scd2_with_late(spark, sf_dir):
    """The loads of every seventh order come last, from all over the years."""
    log = line_log(spark, sf_dir)
    first, late = log.filter("seq % 7 <> 0 AND part % 3 = 0 OR part % 3 <> 0 OR part IS NULL"), log.filter("seq % 7 = 0 AND part % 3 = 0")
    path = scratch_path(spark, "history")
    history.scd2_from_log(first, KEYS, TRACKED, "at", TIE).write.parquet(path)
    return walled(history.scd2_with_late(spark.read.parquet(path), first, late, KEYS, TRACKED, "at", tiebreak=TIE))


# --- service days: customers are services; bits of their key are their weekdays ---
FIRST, LAST = dt.date(1996, 2, 10), dt.date(1996, 4, 9)
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def service_tables(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    service, day = F.col("o_custkey").alias("service_id"), F.to_date("o_orderdate")
    calendar = orders.groupBy("o_custkey").agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))
    flags = [F.shiftright("o_custkey", k).bitwiseAND(F.lit(1)).cast("int").alias(name) for k, name in enumerate(WEEKDAYS)]
    exceptions = orders.select(service, day.alias("date"), F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("exception_type"))
    return calendar.select(service, *flags, "start_date", "end_date"), exceptions


SQL_SERVICES = f"""
calendar AS (SELECT o_custkey AS service_id, CAST(min(o_orderdate) AS DATE) AS start_date, CAST(max(o_orderdate) AS DATE) AS end_date
             FROM orders GROUP BY o_custkey),
calendar_dates AS (SELECT o_custkey AS service_id, CAST(o_orderdate AS DATE) AS date,
                          CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS exception_type FROM orders
                   WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'),
day AS (SELECT CAST(unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY)) AS DATE) AS date),
regular AS (SELECT service_id, date FROM calendar JOIN day ON date BETWEEN start_date AND end_date
            WHERE (service_id >> CAST(isodow(date) - 1 AS INT)) & 1 = 1)
"""
SQL_RUNS = f"{SQL_SERVICES}, runs AS (SELECT service_id, date FROM regular UNION SELECT service_id, date FROM calendar_dates)"
SQL_RUNS_GTFS = f"""{SQL_SERVICES}, runs AS (
    (SELECT service_id, date FROM regular EXCEPT SELECT service_id, date FROM calendar_dates WHERE exception_type = 2)
    UNION SELECT service_id, date FROM calendar_dates WHERE exception_type = 1)"""


def bitmaps(spark, sf_dir, mode="reference"):
    """For all years, as the daily job would keep them."""
    return service_days.service_days(*service_tables(spark, sf_dir), dt.date(1990, 1, 1), dt.date(2030, 12, 31), mode)


@demo("services_in_range", f"WITH {SQL_RUNS} SELECT service_id, date FROM runs")
def _services_in_range(spark, sf_dir):
    return service_days.services_in_range(bitmaps(spark, sf_dir), FIRST, LAST)


@demo("services_in_range_gtfs", f"WITH {SQL_RUNS_GTFS} SELECT service_id, date FROM runs")
def _services_in_range_gtfs(spark, sf_dir):
    return service_days.services_in_range(bitmaps(spark, sf_dir, "gtfs"), FIRST, LAST)


@demo("service_active_days", f"WITH {SQL_RUNS_GTFS} SELECT service_id, count(*) AS n_days FROM runs GROUP BY service_id")
def _service_active_days(spark, sf_dir):
    return service_days.active_days(bitmaps(spark, sf_dir, "gtfs"), FIRST, LAST)


@demo(
    "trips_per_day",
    f"WITH {SQL_RUNS} SELECT date, count(*) AS trips FROM runs JOIN orders ON o_custkey = service_id GROUP BY date",
)
def _trips_per_day(spark, sf_dir):
    trips = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("service_id"))
    return service_days.trips_per_day(bitmaps(spark, sf_dir), trips, FIRST, LAST)


# --- distinct vehicles of hours, days and boroughs from cells of five minutes ---
def vehicle_cells(spark, sf_dir):
    """The vehicles of the first half of the month get their numbers first, the others later; so do their cells.

    Positions are written first: every step would build and parse all messages anew.
    """
    rows = positions(spark, sf_dir).select("entity_id", "vehicle_timestamp", depot_borough("vp_trip_id").alias("borough"))
    rows.write.parquet(whole := scratch_path(spark, "positions"))
    rows = spark.read.parquet(whole)
    early, late = rows.filter(F.day("vehicle_timestamp") <= 15), rows.filter(F.day("vehicle_timestamp") > 15)
    ids, cells = scratch_path(spark, "ids"), scratch_path(spark, "cells")
    rollup.id_dictionary(early, "entity_id").write.parquet(f"{ids}/1")
    rollup.id_dictionary(late, "entity_id", spark.read.parquet(f"{ids}/1")).write.parquet(f"{ids}/2")
    for part in (early, late):
        rollup.distinct_cells(part, spark.read.parquet(f"{ids}/2"), "entity_id", ["borough"]).write.mode("append").parquet(cells)
    return spark.read.parquet(cells)


SQL_VEHICLES = f"rows AS (SELECT *, {sql_borough('vp_trip_id')} AS borough FROM ({SQL_POSITIONS}))"


@demo(
    "active_vehicles_rollup",
    f"""WITH {SQL_VEHICLES} SELECT date_trunc('hour', vehicle_timestamp) AS window_start, borough,
        count(DISTINCT entity_id) AS active_vehicles FROM rows GROUP BY ALL""",
)
def _active_vehicles_rollup(spark, sf_dir):
    hours = rollup.merged_cells(vehicle_cells(spark, sf_dir), ["borough"], "1 hour")
    return rollup.distinct_counts(hours).withColumn("window_start", wall("window_start"))


@demo(
    "active_vehicles_by_day",
    f"""WITH {SQL_VEHICLES} SELECT date_trunc('day', vehicle_timestamp) AS window_start,
        count(DISTINCT entity_id) AS active_vehicles FROM rows GROUP BY ALL""",
)
def _active_vehicles_by_day(spark, sf_dir):
    """From hours that were merged before."""
    hours = rollup.merged_cells(vehicle_cells(spark, sf_dir), ["borough"], "1 hour")
    days = rollup.merged_cells(hours, [], "1 day")
    return rollup.distinct_counts(days).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "active_vehicles")


# --- polygons from a hundred thousandth of a degree to ten: a star around the place of each part ---
POINTS = 24


def star_radius(k):
    return F.when(k == 0, 10.0).when(k < 3, 0.5).when(k < 20, 0.01).otherwise(0.00002 + (k % 7) / F.lit(100000.0))


SQL_STARS = f"""
star AS (SELECT p_partkey AS name, {sql_lon("p_partkey")} AS x, {sql_lat("p_partkey")} AS y,
                CASE WHEN p_partkey = 0 THEN 10.0e0 WHEN p_partkey < 3 THEN 0.5e0 WHEN p_partkey < 20 THEN 0.01e0
                     ELSE 0.00002e0 + (p_partkey % 7) / 100000e0 END AS r FROM part),
corner AS (SELECT name, i, x + r * (1 + i % 2) / 2e0 * cos(radians(i * {360 // POINTS}e0)) AS x,
                  y + r * (1 + i % 2) / 2e0 * sin(radians(i * {360 // POINTS}e0)) AS y FROM star, range({POINTS}) t(i)),
edge AS (SELECT a.name, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM corner a JOIN corner b ON a.name = b.name AND b.i = (a.i + 1) % {POINTS})
"""


@demo(
    "spatial_mixed",
    f"""WITH {SQL_STARS}, p AS (SELECT event_id, {sql_lon("event_id")} AS x, {sql_lat("event_id")} AS y FROM events),
    near AS (SELECT event_id, name, p.x, p.y FROM p JOIN star s ON p.x BETWEEN s.x - r AND s.x + r AND p.y BETWEEN s.y - r AND s.y + r),
    hits AS (SELECT event_id, name FROM near JOIN edge USING (name)
             WHERE (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
             GROUP BY event_id, name HAVING count(*) % 2 = 1)
    SELECT event_id, name FROM p LEFT JOIN hits USING (event_id)""",
)
def _spatial_mixed(spark, sf_dir):
    k = F.col("p_partkey")
    corner = lambda i: F.struct(
        (lon(k) + star_radius(k) * (1 + i % 2) / F.lit(2.0) * F.cos(F.radians(i * F.lit(360.0 / POINTS)))).alias("x"),
        (lat(k) + star_radius(k) * (1 + i % 2) / F.lit(2.0) * F.sin(F.radians(i * F.lit(360.0 / POINTS)))).alias("y"),
    )
    rings = F.array(F.transform(F.sequence(F.lit(0), F.lit(POINTS - 1)), corner))
    # Few bytes of parts are long work: they are dealt out before it.
    stars = table(spark, sf_dir, "part").select(k).repartition(k).select(k.alias("name"), rings.alias("rings"))
    e = F.col("event_id")
    points = table(spark, sf_dir, "events").select(e, lon(e).alias("x"), lat(e).alias("y"))
    return cover.points_in_cover(points, cover.polygon_cover(stars), "x", "y").select("event_id", "name")


# --- dashboard figures kept by groups of batches: a batch is done again, another group comes later ---
def kept_figures(spark, sf_dir):
    rows = monitor(spark, sf_dir).withColumn("day", F.day("vehicle_timestamp"))
    rows.write.parquet(whole := scratch_path(spark, "monitor-rows"))
    rows = spark.read.parquet(whole)
    out, parts = scratch_path(spark, "monitor"), scratch_path(spark, "parts")
    sink = batch_files(out, group=10)
    for number in range(3):  # groups 0 to 2; the second batch lacks what comes late
        some = rows.filter((F.floor(F.col("day") / 10) == number) & (F.lit(number != 1) | (F.minute("vehicle_timestamp") < 30)))
        sink(some.drop("day"), number * 10 + 1)
    refresh_parts(spark, out, parts)
    sink(rows.filter("floor(day / 10) = 1").drop("day"), 11)  # done again
    sink(rows.filter("floor(day / 10) = 3").drop("day"), 31)
    refresh_parts(spark, out, parts)
    return figures_of_parts(spark, parts)


@demo(
    "dashboard_delta",
    f"""WITH {SQL_MONITOR}, per_route AS (
        SELECT borough, route_id, count(*) AS arrivals, avg(delay_seconds) AS d, {SQL_OTP}
        FROM monitor WHERE status = 'arrived' GROUP BY borough, route_id)
        SELECT borough, route_id, arrivals, round(d, 6) AS avg_delay, otp,
               CAST(rank() OVER (PARTITION BY borough ORDER BY d DESC) AS INT) AS worst_rank FROM per_route""",
)
def _dashboard_delta(spark, sf_dir):
    out = kept_figures(spark, sf_dir)["borough_routes"]
    return out.withColumns({c: F.round(c, 6) for c in ("avg_delay", "otp")})


@demo(
    "dashboard_delta_hours",
    f"""WITH {SQL_MONITOR} SELECT route_id, date_trunc('hour', vehicle_timestamp) AS window_start,
        count(*) AS arrivals, round(avg(delay_seconds), 6) AS avg_delay
        FROM monitor WHERE status = 'arrived' GROUP BY ALL""",
)
def _dashboard_delta_hours(spark, sf_dir):
    out = kept_figures(spark, sf_dir)["avg_delay_by_hour"]
    return out.withColumns({"avg_delay": F.round("avg_delay", 6), "window_start": wall("window_start")})
