"""Live messages, as-of matching, the trip monitor and its figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions.clock import epoch_to_ts
from headway.operators import feeds, metrics, nested, quarantine
from headway.operators.asof import asof_join
from headway.operators.monitor import schedule_index, trip_monitor
from headway.schemas import ALERTS, TRIP_UPDATES, VEHICLE_POSITIONS

from .registry import (
    demo,
    instant,
    lat,
    lon,
    sql_borough,
    sql_haversine,
    sql_lat,
    sql_lon,
    sql_trip_id,
    table,
    trip_id,
    wall,
)

# --- messages built from table rows; none of it gathers rows into arrays ---
def vehicle_messages(spark, sf_dir, views=True, where="true", keep=()):
    """One message per event: a vehicle on a trip and one on none. Errors become
    broken text. Where views are the schedule, they are not vehicles as well."""
    e, k = table(spark, sf_dir, "events").filter(where), F.col("event_id")
    epoch = F.unix_seconds(instant("ts")).cast("string")

    def entity(name, trip):
        return F.struct(
            name.alias("id"),
            F.struct(
                F.struct(
                    trip.alias("tripId"),
                    (F.col("user_id") % 10).cast("string").alias("routeId"),
                    F.date_format("ts", "yyyyMMdd").alias("startDate"),
                ).alias("trip"),
                F.struct(lat(k).alias("latitude"), lon(k).alias("longitude")).alias("position"),
                epoch.alias("timestamp"),
            ).alias("vehicle"),
        )

    message = F.struct(
        F.struct(F.lit("2.0").alias("gtfsRealtimeVersion"), epoch.alias("timestamp")).alias("header"),
        F.array(
            entity(F.col("user_id").cast("string"), trip_id(F.col("user_id"))),
            entity(F.lit("depot"), F.lit(None).cast("string")),
        ).alias("entity"),
    )
    text = F.when(F.col("event_type") == "error", "bad{").otherwise(F.to_json(message))
    return (e if views else e.filter("event_type <> 'view'")).select(
        text.alias("value"), F.lit("gtfs-vehicle-positions").alias("topic"), *keep
    )


SQL_POSITIONS = f"""
SELECT '2.0' AS gtfs_version, CAST(user_id AS VARCHAR) AS entity_id,
       {sql_trip_id("user_id")} AS vp_trip_id, CAST(user_id % 10 AS VARCHAR) AS route_id,
       strftime(ts, '%Y%m%d') AS vp_start_date, {sql_lat("event_id")} AS latitude,
       {sql_lon("event_id")} AS longitude, date_trunc('second', ts) AS vehicle_timestamp
FROM events WHERE event_type <> 'error'
"""
SQL_PINGS = f"{SQL_POSITIONS} AND event_type <> 'view'"


def trip_update_messages(spark, sf_dir):
    """One message per line: receipt and shipping as its two stops; none for flag N."""
    day = F.unix_seconds(instant("l_shipdate"))

    def stop(n):
        return F.struct(
            (F.col("l_linenumber") * 2 + n).alias("stopSequence"),
            (F.col("l_partkey") + n).cast("string").alias("stopId"),
            F.struct((day + n * 60).cast("string").alias("time")).alias("arrival"),
            F.struct((day + n * 60 + 30).cast("string").alias("time")).alias("departure"),
        )

    update = F.struct(
        F.struct(
            F.col("l_orderkey").cast("string").alias("tripId"),
            F.col("l_suppkey").cast("string").alias("routeId"),
            (F.col("l_linenumber") % 2).alias("directionId"),
            F.date_format("l_shipdate", "yyyyMMdd").alias("startDate"),
        ).alias("trip"),
        F.struct(F.col("l_suppkey").cast("string").alias("id")).alias("vehicle"),
        F.when(F.col("l_returnflag") != "N", F.array(stop(0), stop(1))).alias("stopTimeUpdate"),
        day.cast("string").alias("timestamp"),
        F.col("l_quantity").cast("int").alias("delay"),
    )
    message = F.struct(
        F.struct(
            F.lit("2.0").alias("gtfsRealtimeVersion"),
            F.lit("FULL_DATASET").alias("incrementality"),
            day.cast("string").alias("timestamp"),
        ).alias("header"),
        F.array(
            F.struct(F.col("l_linestatus").alias("id"), update.alias("tripUpdate"))
        ).alias("entity"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.to_json(message).alias("value"), F.lit("gtfs-trip-updates").alias("topic")
    )


SQL_UPDATES = """
SELECT '2.0' AS gtfs_version, 'FULL_DATASET' AS incrementality,
       CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS header_timestamp,
       l_linestatus AS entity_id, CAST(l_orderkey AS VARCHAR) AS trip_id,
       CAST(l_suppkey AS VARCHAR) AS route_id, l_linenumber % 2 AS direction_id,
       strftime(l_shipdate, '%Y%m%d') AS start_date, CAST(l_suppkey AS VARCHAR) AS vehicle_id,
       CAST(l_linenumber * 2 + n AS INT) AS stop_sequence, CAST(l_partkey + n AS VARCHAR) AS stop_id,
       CAST(CAST(epoch(l_shipdate) AS BIGINT) + n * 60 AS VARCHAR) AS arrival_time,
       CAST(CAST(epoch(l_shipdate) AS BIGINT) + n * 60 + 30 AS VARCHAR) AS departure_time,
       CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS trip_timestamp,
       CAST(l_quantity AS INT) AS delay
FROM lineitem, (VALUES (0), (1)) AS s(n) WHERE l_returnflag <> 'N'
"""


def alert_messages(spark, sf_dir):
    """One message per order: two periods, two informed entities, two languages.
    Low priority has an empty description list, unspecified priority none."""
    day = F.unix_seconds(instant("o_orderdate"))

    def period(n):
        return F.struct(
            (day + n * 86400).cast("string").alias("start"),
            (day + n * 86400 + 3600).cast("string").alias("end"),
        )

    def informed(route):
        return F.struct(F.col("o_orderstatus").alias("agencyId"), route.cast("string").alias("routeId"))

    def translations(*pairs):
        return F.array(
            *[F.struct(t.alias("text"), F.lit(lang).alias("language")) for t, lang in pairs]
        )

    body = translations((F.col("o_orderpriority"), "en"))
    body = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.slice(body, 1, 0))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", None)
        .otherwise(body)
    )
    title = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))
    alert = F.struct(
        F.array(period(0), period(1)).alias("activePeriod"),
        F.array(informed(F.col("o_custkey") % 10), informed(F.col("o_custkey") % 10 + 10)).alias(
            "informedEntity"
        ),
        F.struct(translations((title, "en"), (F.upper(title), "es")).alias("translation")).alias(
            "headerText"
        ),
        F.struct(body.alias("translation")).alias("descriptionText"),
    )
    message = F.struct(
        F.struct(
            F.lit("2.0").alias("gtfsRealtimeVersion"), day.cast("string").alias("timestamp")
        ).alias("header"),
        F.array(
            F.struct(F.col("o_orderkey").cast("string").alias("id"), alert.alias("alert"))
        ).alias("entity"),
    )
    return table(spark, sf_dir, "orders").select(
        F.to_json(message).alias("value"), F.lit("gtfs-alerts").alias("topic")
    )


SQL_ALERTS = """
SELECT '2.0' AS "gtfsRealtimeVersion", CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS timestamp,
       CAST(o_orderkey AS VARCHAR) AS id,
       CAST(CAST(epoch(o_orderdate) AS BIGINT) + n * 86400 AS VARCHAR) AS "activePeriod_start",
       CAST(CAST(epoch(o_orderdate) AS BIGINT) + n * 86400 + 3600 AS VARCHAR) AS "activePeriod_end",
       o_orderstatus AS "agencyId", CAST(o_custkey % 10 + m AS VARCHAR) AS "routeId",
       CASE l WHEN 'en' THEN 'Order ' ELSE 'ORDER ' END || CAST(o_orderkey AS VARCHAR) AS header_text,
       l AS header_language, o_orderpriority AS description_text, 'en' AS description_language
FROM orders, (VALUES (0), (1)) AS p(n), (VALUES (0), (10)) AS i(m), (VALUES ('en'), ('es')) AS h(l)
WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
"""


@demo(
    "parse_envelope",
    """SELECT CASE WHEN event_type = 'error' THEN NULL ELSE '2.0' END AS gtfs_version,
       CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS header_timestamp,
       CASE WHEN event_type = 'error' THEN NULL ELSE 2 END AS entities
       FROM events""",
)
def _parse_envelope(spark, sf_dir):
    rows = nested.parse_envelope(nested.decode(vehicle_messages(spark, sf_dir)), VEHICLE_POSITIONS)
    return rows.select(
        F.col("header.gtfsRealtimeVersion").alias("gtfs_version"),
        wall(epoch_to_ts(F.col("header.timestamp"))).alias("header_timestamp"),
        F.size("entity").alias("entities"),
    ).withColumn("entities", F.when(F.col("entities") >= 0, F.col("entities")))


def positions(spark, sf_dir, header_time=False, views=True):
    messages = nested.decode(vehicle_messages(spark, sf_dir, views))
    parsed = nested.parse_envelope(messages, VEHICLE_POSITIONS)
    return nested.flatten_vehicle_positions(parsed, header_time)


@demo("flatten_vehicle_positions", SQL_POSITIONS)
def _flatten_vehicle_positions(spark, sf_dir):
    return positions(spark, sf_dir).withColumn("vehicle_timestamp", wall("vehicle_timestamp"))


@demo("flatten_trip_updates", SQL_UPDATES)
def _flatten_trip_updates(spark, sf_dir):
    messages = nested.decode(trip_update_messages(spark, sf_dir))
    return nested.flatten_trip_updates(nested.parse_envelope(messages, TRIP_UPDATES))


def flat_alerts(spark, sf_dir, outer=False):
    messages = nested.decode(alert_messages(spark, sf_dir))
    return nested.flatten_alerts(nested.parse_envelope(messages, ALERTS), outer)


@demo("flatten_alerts", SQL_ALERTS)
def _flatten_alerts(spark, sf_dir):
    return flat_alerts(spark, sf_dir)


@demo(
    "flatten_alerts_outer",
    SQL_ALERTS.replace("WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')", "")
    .replace(
        "o_orderpriority AS description_text",
        "CASE WHEN o_orderpriority < '4' THEN o_orderpriority END AS description_text",
    )
    .replace(
        "'en' AS description_language",
        "CASE WHEN o_orderpriority < '4' THEN 'en' END AS description_language",
    ),
)
def _flatten_alerts_outer(spark, sf_dir):
    return flat_alerts(spark, sf_dir, outer=True)


# --- as-of: a purchase and the view of the same user before it ---
@demo(
    "asof_join",
    """SELECT p.event_id, p.user_id, p.ts, v.event_id AS view_id, v.ts AS view_ts
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') v
       ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def _asof_join(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    bought = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = e.filter("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts")
    )
    return asof_join(bought, views, ["user_id"], "ts", "view_ts", ["view_id"])


@demo(
    "asof_join_left",
    """SELECT p.event_id, p.user_id, p.ts, v.event_id AS view_id, v.ts AS view_ts
       FROM (SELECT * FROM events WHERE event_type <> 'view') p
       ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
       ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def _asof_join_left(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    others = e.filter("event_type <> 'view'").select("event_id", "user_id", "ts")
    views = e.filter("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts")
    )
    return asof_join(others, views, ["user_id"], "ts", "view_ts", ["view_id"], how="left")


def stops_of(part):
    """Number of stops: every part is one, whatever the scale."""
    return part.agg(F.greatest(F.lit(1), F.max("p_partkey") + 1)).scalar()


# --- monitor: views make the schedule (time of day), other events the positions ---
def schedule(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    stop_times = (
        table(spark, sf_dir, "events")
        .filter("event_type = 'view'")
        .select(
            trip_id(F.col("user_id")).alias("trip_id"),
            F.date_format("ts", "HH:mm:ss").alias("arrival_time"),
            F.col("event_id").alias("stop_sequence"),
            (F.col("event_id") % stops_of(part)).alias("stop_id"),
        )
    )
    k = F.col("p_partkey")
    stops = part.select(
        k.alias("stop_id"),
        F.col("p_name").alias("stop_name"),
        lat(k).alias("stop_lat"),
        lon(k).alias("stop_lon"),
    )
    return schedule_index(stop_times, stops)


def monitor(spark, sf_dir):
    pings = positions(spark, sf_dir, header_time=True, views=False)
    return trip_monitor(pings, schedule(spark, sf_dir), "UTC")


MONITOR_TIMES = ("vehicle_timestamp", "header_timestamp", "scheduled_arrival")


def comparable(df):
    times = {c: wall(c) for c in MONITOR_TIMES if c in df.columns}
    return df.withColumns(times).withColumn("distance", F.round("distance", 3))


SQL_MONITOR = f"""
pings AS ({SQL_PINGS}),
sched AS (SELECT {sql_trip_id("user_id")} AS trip_id, epoch(date_trunc('second', ts) - date_trunc('day', ts)) AS off,
                 event_id, event_id % (SELECT max(p_partkey) + 1 FROM part) AS stop_id
          FROM events WHERE event_type = 'view'),
places AS (SELECT p_partkey AS stop_id, p_name AS stop_name, {sql_lat("p_partkey")} AS stop_lat,
                  {sql_lon("p_partkey")} AS stop_lon FROM part),
ranked AS (
  SELECT p.*, s.off, s.event_id, l.*, row_number() OVER (
           PARTITION BY entity_id, vp_trip_id, vehicle_timestamp ORDER BY s.off DESC, s.event_id DESC) AS rn
  FROM pings p JOIN sched s ON s.trip_id = p.vp_trip_id
       AND s.off <= epoch(p.vehicle_timestamp - date_trunc('day', p.vehicle_timestamp))
  JOIN places l ON l.stop_id = s.stop_id),
measured AS (
  SELECT *, date_trunc('day', vehicle_timestamp) + to_seconds(CAST(off AS BIGINT)) AS scheduled_arrival,
         {sql_haversine("longitude", "latitude", "stop_lon", "stop_lat")} AS d
  FROM ranked WHERE rn = 1),
monitor AS (
  SELECT gtfs_version, entity_id, vp_trip_id, route_id, vp_start_date, latitude, longitude,
         vehicle_timestamp, vehicle_timestamp AS header_timestamp, stop_id, stop_name, stop_lat, stop_lon,
         scheduled_arrival, round(d, 3) AS distance,
         CASE WHEN d <= 100 THEN 'arrived' ELSE 'on_way' END AS status,
         CASE WHEN d <= 100 THEN CAST(epoch(vehicle_timestamp) - epoch(scheduled_arrival) AS BIGINT) END
           AS delay_seconds,
         {sql_borough("vp_trip_id")} AS borough
  FROM measured)
"""


@demo("trip_monitor", f"WITH {SQL_MONITOR} SELECT * FROM monitor")
def _trip_monitor(spark, sf_dir):
    return comparable(monitor(spark, sf_dir))


@demo(
    "live_vehicles",
    f"""WITH {SQL_MONITOR}, newest AS (SELECT *, row_number() OVER (
          PARTITION BY entity_id ORDER BY vehicle_timestamp DESC) AS rn FROM monitor)
        SELECT * EXCLUDE (rn) FROM newest WHERE rn = 1""",
)
def _live_vehicles(spark, sf_dir):
    return comparable(metrics.live_vehicles(monitor(spark, sf_dir)))


SQL_OTP = "round(avg(CASE WHEN delay_seconds <= 300 THEN 1.0 ELSE 0.0 END), 6) AS otp"


@demo(
    "otp_by_route",
    f"WITH {SQL_MONITOR} SELECT route_id, count(*) AS arrivals, {SQL_OTP} FROM monitor "
    "WHERE status = 'arrived' GROUP BY route_id",
)
def _otp_by_route(spark, sf_dir):
    out = metrics.on_time_performance(monitor(spark, sf_dir), ["route_id"])
    return out.withColumn("otp", F.round("otp", 6))


@demo(
    "avg_delay",
    f"""WITH {SQL_MONITOR} SELECT route_id, date_trunc('hour', vehicle_timestamp) AS window_start,
        count(*) AS arrivals, round(avg(delay_seconds), 6) AS avg_delay
        FROM monitor WHERE status = 'arrived' GROUP BY ALL""",
)
def _avg_delay(spark, sf_dir):
    out = metrics.average_delay(monitor(spark, sf_dir), ["route_id"], "1 hour")
    return out.withColumns(
        {"avg_delay": F.round("avg_delay", 6), "window_start": wall("window_start")}
    )


@demo(
    "alert_counts",
    f'SELECT "routeId", count(DISTINCT id) AS alerts FROM ({SQL_ALERTS}) GROUP BY "routeId"',
)
def _alert_counts(spark, sf_dir):
    return metrics.alert_counts(flat_alerts(spark, sf_dir))


@demo(
    "borough_route_perf",
    f"""WITH {SQL_MONITOR}, per_route AS (
        SELECT borough, route_id, count(*) AS arrivals, avg(delay_seconds) AS d, {SQL_OTP}
        FROM monitor WHERE status = 'arrived' GROUP BY borough, route_id)
        SELECT borough, route_id, arrivals, round(d, 6) AS avg_delay, otp,
               CAST(rank() OVER (PARTITION BY borough ORDER BY d DESC) AS INT) AS worst_rank FROM per_route""",
)
def _borough_route_perf(spark, sf_dir):
    out = metrics.borough_route_performance(monitor(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_delay", "otp")})


@demo(
    "active_vehicles",
    f"""SELECT time_bucket(INTERVAL '5 minutes', vehicle_timestamp) AS window_start,
        count(DISTINCT entity_id) AS active_vehicles FROM ({SQL_POSITIONS}) GROUP BY ALL""",
)
def _active_vehicles(spark, sf_dir):
    out = metrics.active_vehicles(positions(spark, sf_dir))
    return out.withColumn("window_start", wall("window_start"))


@demo(
    "arrival_rate",
    f"""WITH {SQL_MONITOR} SELECT time_bucket(INTERVAL '5 minutes', vehicle_timestamp) AS window_start,
        count(*) AS positions,
        round(avg(CASE WHEN status = 'arrived' THEN 1.0 ELSE 0.0 END), 6) AS arrival_rate
        FROM monitor GROUP BY ALL""",
)
def _arrival_rate(spark, sf_dir):
    out = metrics.arrival_rate(monitor(spark, sf_dir))
    return out.withColumns(
        {"arrival_rate": F.round("arrival_rate", 6), "window_start": wall("window_start")}
    )


# --- change gate: an event type is a feed, the quarter of the day its header time ---
def feed_messages(spark, sf_dir):
    header = F.floor(F.unix_seconds(instant("ts")) / 21600) * 21600
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feed"),
        F.col("event_id").alias("seq"),
        F.when(F.col("props") != '{"k": 7}', header).alias("header_ts"),
        F.col("props").alias("json_str"),
    )


SQL_GATE = """
timed AS (SELECT event_type AS feed, event_id AS seq, props,
                 CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 AS header_ts
          FROM events WHERE props <> '{"k": 7}'),
gated AS (SELECT *, lag(header_ts) OVER (PARTITION BY feed ORDER BY seq) AS previous_ts FROM timed
          QUALIFY header_ts IS DISTINCT FROM previous_ts)
"""


@demo("feed_change_gate", f"WITH {SQL_GATE} SELECT feed, seq, header_ts, previous_ts FROM gated")
def _feed_change_gate(spark, sf_dir):
    changed = feeds.changed_messages(feed_messages(spark, sf_dir), bucket_width=1000)
    return changed.select("feed", "seq", "header_ts", "previous_ts")


@demo(
    "feed_metrics",
    f"""WITH {SQL_GATE}
        SELECT to_timestamp(header_ts) AT TIME ZONE 'UTC' AS timestamp, feed,
               'update_interval_sec' AS metric, header_ts - previous_ts AS value
        FROM gated WHERE previous_ts IS NOT NULL
        UNION ALL
        SELECT to_timestamp(header_ts) AT TIME ZONE 'UTC', feed, 'payload_size_bytes', strlen(props) FROM gated""",
)
def _feed_metrics(spark, sf_dir):
    changed = feeds.changed_messages(feed_messages(spark, sf_dir), bucket_width=1000)
    out = feeds.feed_metrics(changed, F.timestamp_seconds("header_ts"))
    return out.withColumn("timestamp", wall("timestamp"))


# --- broken and drifting messages: what is wrong with one follows from the number of its event ---
SPOILT = "event_id % 11"


def doubtful_messages(spark, sf_dir):
    rows, text, n = vehicle_messages(spark, sf_dir, keep=["event_id"]), F.col("value"), F.expr(SPOILT)
    spoilt = (
        F.when(n == 0, F.concat(F.lit("["), text, F.lit("]")))
        .when(n == 1, F.regexp_replace(text, '"header":', '"headers":'))
        .when(n == 2, F.regexp_replace(text, '"latitude":', '"latitude":"north","was":'))
        .when(n == 3, F.regexp_replace(text, "^\\{", '{"feed":{"name":"x","tags":[1]},'))
        .when(n == 4, F.regexp_replace(text, '"trip":\\{', '"trip":5,"was":{'))
        .when(n == 5, F.regexp_replace(text, '"entity":', '"entity":7,"entities":'))
        .otherwise(text)
    )
    text = F.when(F.col("value") == "bad{", F.when(n == 6, " ").otherwise(text)).otherwise(spoilt)
    return rows.select("event_id", "topic", text.alias("json_str"))


SQL_DOUBTFUL = f"""
doubtful AS (
  SELECT *, CASE WHEN event_type = 'error' THEN CASE WHEN {SPOILT} = 6 THEN 'empty' ELSE 'not_json' END
            ELSE CASE {SPOILT} WHEN 0 THEN 'not_an_object' WHEN 1 THEN 'missing' WHEN 2 THEN 'bad_fields' WHEN 4 THEN 'bad_fields'
                      WHEN 5 THEN 'bad_fields' END END AS reason,
         CASE WHEN event_type <> 'error' THEN CASE {SPOILT} WHEN 1 THEN 'header' WHEN 2 THEN 'entity[].vehicle.position.latitude'
              WHEN 4 THEN 'entity[].vehicle.trip' WHEN 5 THEN 'entity' END END AS field
  FROM events)
"""


@demo(
    "message_quarantine",
    f"""WITH {SQL_DOUBTFUL} SELECT event_id, reason, coalesce(field, '') AS fields, reason = 'bad_fields' AS usable
        FROM doubtful WHERE reason IS NOT NULL""",
)
def _message_quarantine(spark, sf_dir):
    judged = quarantine.judge_messages(doubtful_messages(spark, sf_dir), VEHICLE_POSITIONS)
    return quarantine.quarantined(judged).select("event_id", "reason", F.array_join("fields", ",").alias("fields"), "usable")


@demo(
    "message_drift",
    f"""WITH {SQL_DOUBTFUL}, topics AS (SELECT 'gtfs-vehicle-positions' AS topic)
        SELECT topic, 'feed' AS path, 'unknown' AS kind, 'struct<name:string,tags:array<bigint>>' AS seen, CAST(NULL AS BIGINT) AS messages
        FROM topics WHERE EXISTS (SELECT 1 FROM events WHERE event_type <> 'error' AND {SPOILT} = 3)
        UNION ALL SELECT topic, field, reason, NULL, count(*) FROM doubtful, topics WHERE field IS NOT NULL GROUP BY ALL""",
)
def _message_drift(spark, sf_dir):
    return quarantine.message_drift(quarantine.judge_messages(doubtful_messages(spark, sf_dir), VEHICLE_POSITIONS), VEHICLE_POSITIONS)


@demo(
    "typed_messages",
    f"""WITH p AS ({SQL_POSITIONS.replace("SELECT '2.0'", "SELECT event_id, '2.0'")})
        SELECT * EXCLUDE (event_id) REPLACE (CASE WHEN {SPOILT} <> 2 THEN latitude END AS latitude) FROM p WHERE {SPOILT} NOT IN (0, 1, 4, 5)""",
)
def _typed_messages(spark, sf_dir):
    judged = quarantine.judge_messages(doubtful_messages(spark, sf_dir), VEHICLE_POSITIONS)
    out = nested.flatten_vehicle_positions(quarantine.typed_messages(judged, VEHICLE_POSITIONS))
    return out.withColumn("vehicle_timestamp", wall("vehicle_timestamp"))
