"""Cleaning, typing, times, geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import cleaning, clock, depots, geo
from headway.operators.spatial import stop_boroughs
from headway.operators.staging import clean_typed, prepare_staging
from headway.schemas import TableSpec
from headway.session import scratch_path
from headway.sources.feed_files import read_feed_table

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

ORDER_TEXT = TableSpec(
    "order_text",
    "order_id bigint, customer_id bigint, status string, price double, ordered int, "
    "priority string",
    key=("order_id",),
    tracked=("status", "price"),
    dates=("ordered",),
)


def order_text(spark, sf_dir):
    """Orders as a dirty text feed: blanks, ``.0``, ``NaN``, short dates, every row twice."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(
            F.lit("  "), k.cast("string"), F.when(k % 3 == 0, ".0").otherwise(""), F.lit(" ")
        ).alias("order_id"),
        F.when(k % 5 == 0, "NaN").otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")).alias("status"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.when(k % 7 == 0, "2025071")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
        .alias("ordered"),
        F.when(k % 4 == 0, "NaN").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
    ).drop("copy")


SQL_ORDER_CLEAN = """
SELECT DISTINCT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       o_orderstatus AS status, o_totalprice AS price,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ordered,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS priority
FROM orders
"""


@demo("clean_typed", SQL_ORDER_CLEAN)
def _clean_typed(spark, sf_dir):
    return clean_typed(order_text(spark, sf_dir), ORDER_TEXT)


@demo(
    "prepare_staging",
    f"""
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS start_dt_scd,
       CAST(NULL AS TIMESTAMP) AS end_dt_scd, TRUE AS is_current
FROM ({SQL_ORDER_CLEAN})
""",
)
def _prepare_staging(spark, sf_dir):
    run_ts = F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows = prepare_staging(order_text(spark, sf_dir), ORDER_TEXT, run_ts)
    return rows.withColumns({c: wall(c) for c in ("start_dt_scd", "end_dt_scd")})


@demo(
    "int_to_date",
    """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ordered
FROM orders
""",
)
def _int_to_date(spark, sf_dir):
    d = F.col("o_orderdate")
    number = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    dirty = F.when(F.col("o_orderkey") % 9 == 0, 99999999).otherwise(number)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), cleaning.yyyymmdd_to_date(dirty).alias("ordered")
    )


@demo(
    "nan_to_null",
    """
SELECT c_custkey AS customer_id,
       CASE WHEN c_nationkey < 5 THEN NULL ELSE c_mktsegment END AS segment,
       CASE WHEN c_nationkey >= 20 THEN NULL ELSE c_acctbal END AS balance
FROM customer
""",
)
def _nan_to_null(spark, sf_dir):
    n = F.col("c_nationkey")
    dirty = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.when(n < 5, "NaN").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(n >= 20, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("balance"),
    )
    return cleaning.nan_text_to_null(dirty, nan_to_null=True)


@demo(
    "epoch_to_timestamp",
    """
SELECT event_id, CASE WHEN event_type = 'error' OR event_id % 11 < 4 THEN NULL ELSE date_trunc('second', ts) END AS at
FROM events
""",
)
def _epoch_to_timestamp(spark, sf_dir):
    """With words, microseconds, more digits than a number holds, and blanks among them."""
    seconds, kind = F.unix_seconds(instant("ts")).cast("string"), F.col("event_id") % 11
    text = (
        F.when(F.col("event_type") == "error", F.col("event_type"))
        .when(kind == 0, F.concat(seconds, F.lit("000000")))
        .when(kind == 1, F.concat(seconds, seconds, seconds))
        .when(kind == 2, F.lit("  "))
        .when(kind == 3, F.concat(F.lit("-"), seconds, F.lit("00")))
        .otherwise(seconds)
    )
    return table(spark, sf_dir, "events").select(
        "event_id", wall(clock.epoch_to_ts(text)).alias("at")
    )


@demo(
    "hms_seconds",
    """
SELECT l_orderkey, l_linenumber, l_suppkey,
       CASE WHEN l_returnflag = 'N' OR l_orderkey % 11 < 5 THEN NULL
            ELSE CAST(l_quantity AS BIGINT) * 3600 + l_linenumber * 60 + l_suppkey % 60 END AS seconds
FROM lineitem
""",
)
def _hms_seconds(spark, sf_dir):
    two = "%02d"
    text = F.format_string(
        f"{two}:{two}:{two}",
        F.col("l_quantity").cast("bigint"),
        F.col("l_linenumber").cast("bigint"),
        F.col("l_suppkey") % 60,
    )
    kind = F.col("l_orderkey") % 11
    dirty = (
        F.when(F.col("l_returnflag") == "N", "7:05")
        .when(kind == 0, F.concat(F.lit("7000"), text))
        .when(kind == 1, F.concat(F.lit("-"), text))
        .when(kind == 2, "01:60:00")
        .when(kind == 3, "")
        .when(kind == 4, F.concat(F.lit("9999999999"), text))
        .otherwise(text)
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        clock.hms_to_seconds(dirty).cast("bigint").alias("seconds"),
    )


@demo(
    "scheduled_arrival",
    """
SELECT o_orderkey AS order_id,
       CAST(epoch(timezone('America/New_York', o_orderdate)) AS BIGINT) + o_custkey % 100000 AS midnight_epoch,
       CAST(epoch(timezone('America/New_York', o_orderdate + INTERVAL 12 HOUR)) AS BIGINT) - 43200
         + o_custkey % 100000 AS noon_epoch
FROM orders
""",
)
def _scheduled_arrival(spark, sf_dir):
    day, offset = F.to_date("o_orderdate"), F.col("o_custkey") % 100000

    def at(anchor):
        return F.unix_seconds(clock.scheduled_ts(day, offset, "America/New_York", anchor))

    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        at("midnight").alias("midnight_epoch"),
        at("noon").alias("noon_epoch"),
    )


@demo(
    "haversine",
    f"""
SELECT event_id,
       round({sql_haversine(sql_lon("event_id"), sql_lat("event_id"), sql_lon("user_id"), sql_lat("user_id"))}, 3)
         AS meters
FROM events
""",
)
def _haversine(spark, sf_dir):
    e, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(geo.haversine_m(lon(e), lat(e), lon(u), lat(u)), 3).alias("meters")
    )


@demo(
    "depot_borough",
    f"""
SELECT o_orderkey AS order_id, t AS trip_id, {sql_borough("t")} AS borough
FROM (SELECT o_orderkey,
             CASE o_orderstatus
               WHEN 'F' THEN {sql_trip_id("o_orderkey")}
               WHEN 'O' THEN CAST(o_custkey AS VARCHAR) || '-JKPC5-JK_C5-Weekday-03'
               ELSE 'CSg_C5-' || o_orderpriority END AS t
      FROM orders)
""",
)
def _depot_borough(spark, sf_dir):
    status = F.col("o_orderstatus")
    trip = (
        F.when(status == "F", trip_id(F.col("o_orderkey")))
        .when(
            status == "O",
            F.concat(F.col("o_custkey").cast("string"), F.lit("-JKPC5-JK_C5-Weekday-03")),
        )
        .otherwise(F.concat(F.lit("CSg_C5-"), "o_orderpriority"))
    )
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), trip.alias("trip_id")
    )
    return rows.withColumn("borough", depots.depot_borough("trip_id"))


@demo(
    "patch_rows",
    """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
""",
)
def _patch_rows(spark, sf_dir):
    return cleaning.patch(
        table(spark, sf_dir, "customer"),
        F.col("c_mktsegment") == "MACHINERY",
        {"c_acctbal": F.col("c_acctbal") + 1, "c_mktsegment": F.lit(None)},
    )


# Outlines in the box of the made-up coordinates: an L shape, a square with a
# hole, two plain ones, one nothing falls in. No corner lies on a coordinate.
POLYGONS = {
    "L": [[(-74.00005, 40.69995), (-73.99955, 40.69995), (-73.99955, 40.70025),
           (-73.99975, 40.70025), (-73.99975, 40.70075), (-74.00005, 40.70075)]],
    "ring": [[(-73.99945, 40.69995), (-73.99845, 40.69995), (-73.99845, 40.70095), (-73.99945, 40.70095)],
             [(-73.99915, 40.70025), (-73.99875, 40.70025), (-73.99875, 40.70065), (-73.99915, 40.70065)]],
    "slope": [[(-74.00005, 40.70105), (-73.99935, 40.70105), (-73.99965, 40.70185)]],
    "block": [[(-73.99885, 40.70115), (-73.99815, 40.70115), (-73.99815, 40.70195), (-73.99885, 40.70195)]],
    "away": [[(-73.5, 40.5), (-73.4, 40.5), (-73.4, 40.6)]],
}


def sql_edges() -> str:
    rows = []
    for name, rings in POLYGONS.items():
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                rows.append(f"('{name}', {x1}e0, {y1}e0, {x2}e0, {y2}e0)")
    return "(VALUES " + ", ".join(rows) + ") AS e(name, x1, y1, x2, y2)"


@demo(
    "spatial_borough",
    f"""
WITH p AS (SELECT CAST(event_id AS VARCHAR) AS stop_id, {sql_lon("event_id")} AS x,
                  {sql_lat("event_id")} AS y FROM events),
hits AS (SELECT stop_id, name FROM p, {sql_edges()}
         WHERE (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
         GROUP BY stop_id, name HAVING count(*) % 2 = 1)
SELECT p.stop_id, coalesce(hits.name, 'Unknown') AS borough
FROM p LEFT JOIN hits ON hits.stop_id = p.stop_id
""",
)
def _spatial_borough(spark, sf_dir):
    k = F.col("event_id")
    stops = table(spark, sf_dir, "events").select(
        k.alias("stop_id"), lon(k).alias("stop_lon"), lat(k).alias("stop_lat")
    )
    shapes = spark.createDataFrame(
        list(POLYGONS.items()), "name string, rings array<array<struct<x double, y double>>>"
    )
    return stop_boroughs(stops, shapes, cell=0.0005)


PART_FEED = TableSpec(
    "stops",
    "stop_id bigint, stop_name string, stop_desc string, zone_id string",
    key=("stop_id",),
    tracked=("stop_name",),
)


def part_feed(spark, sf_dir) -> str:
    """Parts as a stops table in two region folders whose headers differ."""
    base = scratch_path(spark, "feed")
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("stop_id"),
        F.col("p_name").alias("stop_name"),
        F.col("p_type").alias("stop_desc"),
        F.col("p_size").cast("string").alias("zone_id"),
    )
    small = F.col("zone_id").cast("int") <= 25
    p.filter(small).write.csv(f"{base}/north_2024-01-15/stops.csv", header=True)
    p.filter(~small).select("stop_desc", "stop_name", "stop_id").write.csv(
        f"{base}/south_2024-02-01/stops.txt", header=True
    )
    return base


SQL_FEED = """
SELECT CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name, p_type AS stop_desc,
       CASE WHEN p_size <= 25 THEN CAST(p_size AS VARCHAR) END AS zone_id
"""


@demo("feed_scan", SQL_FEED + "FROM part")
def _feed_scan(spark, sf_dir):
    return read_feed_table(spark, part_feed(spark, sf_dir), PART_FEED)


@demo(
    "feed_provenance",
    SQL_FEED
    + """, CASE WHEN p_size <= 25 THEN 'north' ELSE 'south' END AS feed_region,
       CASE WHEN p_size <= 25 THEN DATE '2024-01-15' ELSE DATE '2024-02-01' END AS feed_version
FROM part""",
)
def _feed_provenance(spark, sf_dir):
    return read_feed_table(spark, part_feed(spark, sf_dir), PART_FEED, provenance=True)


@demo("feed_scan_mixed", SQL_FEED.replace("CASE WHEN p_size <= 25 THEN CAST(p_size AS VARCHAR) END", "CAST(p_size AS VARCHAR)") + "FROM part")
def _feed_scan_mixed(spark, sf_dir):
    """One folder table whose parts differ in the order of their columns."""
    base = f"{scratch_path(spark, 'feed')}/north_2024-01-15/stops.csv"
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("stop_id"),
        F.col("p_name").alias("stop_name"),
        F.col("p_type").alias("stop_desc"),
        F.col("p_size").cast("string").alias("zone_id"),
    )
    orders = (p.columns, p.columns[::-1], [*p.columns[2:], *p.columns[:2]])
    for i, names in enumerate(orders):
        p.filter(F.col("stop_id") % len(orders) == i).select(*names).write.mode("append").csv(base, header=True)
    return read_feed_table(spark, base.rsplit("/", 2)[0], PART_FEED)
