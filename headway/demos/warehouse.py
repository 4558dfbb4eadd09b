"""Versions, snapshots, layouts, feed state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from headway.functions import cleaning
from headway.operators import feeds, scd2, snapshot
from headway.operators.latest import latest_per_key
from headway.operators.monitor import schedule_with_stops
from headway.plans.daily_snapshot import write_snapshot
from headway.session import scratch_path
from headway.sinks.tables import ScdTable, VersionedTable, append_serving, service_day, sorted_layout
from headway.sources.versions import VersionState

from .live import stops_of
from .registry import demo, instant, lat, lon, sql_lat, sql_lon, table, wall

# --- versioned table: lines shipped before a date, merged with those since ---
KEYS = ["order_id", "line"]
TRACKED = ["flag", "status"]
SCD = ["start_dt_scd", "end_dt_scd", "is_current"]
SQL_DIM = """
line AS (SELECT l_orderkey AS order_id, nullif(l_linenumber, 7) AS line,
                nullif(l_returnflag, 'N') AS flag, l_linestatus AS status, l_shipdate
         FROM lineitem),
dim AS (SELECT order_id, line, flag, status, l_shipdate AS start_dt_scd,
               CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN TIMESTAMP '1996-01-01' END AS end_dt_scd,
               l_shipdate >= TIMESTAMP '1996-01-01' AS is_current
        FROM line WHERE l_shipdate < TIMESTAMP '1998-06-15'),
stage AS (SELECT order_id, line, flag, status, TIMESTAMP '1998-06-15' AS start_dt_scd,
                 CAST(NULL AS TIMESTAMP) AS end_dt_scd, TRUE AS is_current
          FROM line WHERE l_shipdate >= TIMESTAMP '1998-06-15'),
judged AS (SELECT d.*, EXISTS (SELECT 1 FROM stage s WHERE s.order_id = d.order_id AND s.line = d.line
                  AND (s.flag IS DISTINCT FROM d.flag OR s.status IS DISTINCT FROM d.status)) AS changed
           FROM dim d),
merged AS (SELECT order_id, line, flag, status, start_dt_scd,
                  CASE WHEN is_current AND changed THEN TIMESTAMP '1998-06-15' ELSE end_dt_scd END AS end_dt_scd,
                  is_current AND NOT changed AS is_current
           FROM judged
           UNION ALL
           SELECT s.* FROM stage s WHERE NOT EXISTS (
             SELECT 1 FROM judged j WHERE j.order_id = s.order_id AND j.line = s.line
             AND j.is_current AND NOT j.changed))
"""


def dim_and_stage(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("line"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.col("l_linestatus").alias("status"),
        instant("l_shipdate").alias("start_dt_scd"),
    )
    cut, closed = (F.lit(d).cast("timestamp") for d in ("1998-06-15", "1996-01-01"))
    start = F.col("start_dt_scd")
    dim = line.filter(start < cut).withColumns(
        {"end_dt_scd": F.when(start < closed, closed), "is_current": start >= closed}
    )
    stage = line.filter(start >= cut).drop("start_dt_scd")
    return dim, cleaning.with_scd_columns(stage, cut)


def clocked(df):
    return df.withColumns({c: wall(c) for c in SCD[:2] if c in df.columns})


@demo("scd2_merge", f"WITH {SQL_DIM} SELECT * FROM merged")
def _scd2_merge(spark, sf_dir):
    dim, stage = dim_and_stage(spark, sf_dir)
    return clocked(scd2.scd2_merge(dim, stage, KEYS, TRACKED))


@demo(
    "scd2_stored",
    f"""WITH {SQL_DIM}, newest AS (SELECT *, row_number() OVER (PARTITION BY order_id, line
          ORDER BY start_dt_scd DESC, flag DESC NULLS LAST, status DESC) AS rn
        FROM (SELECT order_id, line, flag, status, l_shipdate AS start_dt_scd FROM line
              WHERE l_shipdate < TIMESTAMP '1998-06-15' AND order_id IS NOT NULL AND line IS NOT NULL)),
    a AS (SELECT order_id, line, flag, status, start_dt_scd FROM newest WHERE rn = 1),
    b AS (SELECT order_id, line, flag, CASE WHEN order_id % 10 = 0 THEN 'X' ELSE status END AS status,
                 TIMESTAMP '1998-06-16' AS start_dt_scd FROM a),
    c AS (SELECT order_id, line, flag, CASE WHEN order_id % 10 = 0 THEN 'X' ELSE status END AS status,
                 TIMESTAMP '1998-06-17' AS start_dt_scd FROM a WHERE order_id % 10 = 0
          UNION ALL SELECT -order_id - 1, line, flag, status, TIMESTAMP '1998-06-17' FROM a WHERE order_id % 7 = 0)
    SELECT a.order_id, a.line, a.flag, a.status, a.start_dt_scd,
           CASE WHEN b.status IS DISTINCT FROM a.status THEN TIMESTAMP '1998-06-16' END AS end_dt_scd,
           b.status IS NOT DISTINCT FROM a.status AS is_current
    FROM a JOIN b ON a.order_id = b.order_id AND a.line = b.line
    UNION ALL SELECT b.order_id, b.line, b.flag, b.status, b.start_dt_scd, CAST(NULL AS TIMESTAMP), TRUE
    FROM b JOIN a ON a.order_id = b.order_id AND a.line = b.line WHERE b.status IS DISTINCT FROM a.status
    UNION ALL SELECT *, CAST(NULL AS TIMESTAMP), TRUE FROM c WHERE order_id < 0""",
)
def _scd2_stored(spark, sf_dir):
    """Three merges through the store: the first with repeated keys, the second with changes
    to a tenth of the orders, the third with nothing but new keys."""
    dim, _ = dim_and_stage(spark, sf_dir)
    first = dim.filter("order_id IS NOT NULL AND line IS NOT NULL").select(*KEYS, *TRACKED, "start_dt_scd")
    stage = first.withColumns({"end_dt_scd": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})
    store = ScdTable(spark, scratch_path(spark, "dimension"), stage.schema)
    store.merge(stage, KEYS, TRACKED, KEYS, dedup_stage=True)
    status = F.when(F.col("order_id") % 10 == 0, "X").otherwise(F.col("status"))
    opened = store.read_open()
    second = opened.withColumns({"status": status, "start_dt_scd": F.lit("1998-06-16").cast("timestamp")})
    start = F.lit("1998-06-17").cast("timestamp")
    third = second.withColumn("start_dt_scd", start)
    new = opened.filter("order_id % 7 = 0").withColumns({"order_id": -F.col("order_id") - 1, "start_dt_scd": start})
    store.merge(second, KEYS, TRACKED, KEYS)
    store.merge(third.filter("order_id % 10 = 0").unionByName(new), KEYS, TRACKED, KEYS)
    return clocked(store.read())


@demo(
    "changed_rows",
    f"WITH {SQL_DIM} SELECT order_id, line, flag, status, start_dt_scd, end_dt_scd, is_current "
    "FROM judged WHERE is_current AND changed",
)
def _changed_rows(spark, sf_dir):
    dim, stage = dim_and_stage(spark, sf_dir)
    return clocked(scd2.changed_rows(dim, stage, KEYS, TRACKED))


@demo(
    "scd2_as_of",
    f"""WITH {SQL_DIM} SELECT * FROM merged WHERE start_dt_scd <= TIMESTAMP '1997-07-01'
        AND (end_dt_scd IS NULL OR end_dt_scd > TIMESTAMP '1997-07-01')""",
)
def _scd2_as_of(spark, sf_dir):
    dim, stage = dim_and_stage(spark, sf_dir)
    merged = scd2.scd2_merge(dim, stage, KEYS, TRACKED)
    return clocked(scd2.as_of(merged, F.lit("1997-07-01").cast("timestamp")))


@demo(
    "current_rows",
    f"WITH {SQL_DIM} SELECT order_id, line, status FROM dim WHERE is_current",
)
def _current_rows(spark, sf_dir):
    dim, _ = dim_and_stage(spark, sf_dir)
    return cleaning.current(dim).select("order_id", "line", "status")


@demo(
    "scd_columns",
    """SELECT *, TIMESTAMP '2024-01-01' AS start_dt_scd, CAST(NULL AS TIMESTAMP) AS end_dt_scd,
       TRUE AS is_current FROM customer""",
)
def _scd_columns(spark, sf_dir):
    run_ts = F.lit("2024-01-01").cast("timestamp")
    return clocked(cleaning.with_scd_columns(table(spark, sf_dir, "customer"), run_ts))


# --- newest per key ---
LINE = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)


def sql_latest(keys: str, order: str) -> str:
    return (
        f"SELECT {LINE} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"
    )


SQL_LATEST = sql_latest(
    "l_orderkey, l_linenumber",
    "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
    "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC",
)


@demo("latest_per_key", SQL_LATEST)
def _latest_per_key(spark, sf_dir):
    return latest_per_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@demo(
    "latest_per_key_3col",
    sql_latest(
        "l_orderkey, l_linenumber, l_returnflag",
        "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, "
        "l_extendedprice DESC, l_discount DESC, l_tax DESC, l_linestatus DESC",
    ),
)
def _latest_per_key_3col(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_returnflag"]
    return latest_per_key(table(spark, sf_dir, "lineitem"), keys, ["l_shipdate"])


@demo("replace_table", SQL_LATEST)
def _replace_table(spark, sf_dir):
    target = VersionedTable(spark, scratch_path(spark, "lines"))
    target.replace(table(spark, sf_dir, "lineitem"))
    newest = latest_per_key(target.read(), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    target.replace(newest, ["l_orderkey", "l_linenumber"])
    return target.read()


@demo("sorted_layout", f"SELECT {LINE} FROM lineitem")
def _sorted_layout(spark, sf_dir):
    path = scratch_path(spark, "sorted")
    sorted_layout(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).write.parquet(path)
    return spark.read.parquet(path)


# --- service of a date: customers as services and routes, orders as trips ---
DAY = dt.date(1998, 6, 15)  # a Monday
SQL_TABLES = """
agency AS (SELECT n_nationkey AS agency_id, n_name AS agency_name FROM nation),
routes AS (SELECT c_custkey AS route_id, c_nationkey AS agency_id, c_name AS route_long_name FROM customer),
trips AS (SELECT o_orderkey AS trip_id, o_custkey AS route_id, o_custkey AS service_id,
                 o_orderkey % (SELECT max(p_partkey) + 1 FROM part) AS shape_id FROM orders),
shapes AS (SELECT p_partkey AS shape_id, p_size AS shape_pt_sequence FROM part),
stop_times AS (SELECT l_orderkey AS trip_id, l_linenumber AS stop_sequence, l_partkey AS stop_id FROM lineitem),
stops AS (SELECT p_partkey AS stop_id, p_name AS stop_name FROM part),
calendar AS (SELECT o_custkey AS service_id, CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS monday,
                    CAST(min(o_orderdate) AS DATE) AS start_date, CAST(max(o_orderdate) AS DATE) AS end_date
             FROM orders GROUP BY o_custkey),
calendar_dates AS (SELECT o_custkey AS service_id, CAST(o_orderdate AS DATE) AS date,
                          CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS exception_type FROM orders),
regular AS (SELECT service_id FROM calendar
            WHERE monday = 1 AND DATE '1998-06-15' BETWEEN start_date AND end_date),
services AS (SELECT service_id FROM regular
             UNION SELECT service_id FROM calendar_dates WHERE date = DATE '1998-06-15'),
t_trips AS (SELECT * FROM trips WHERE service_id IN (SELECT service_id FROM services)),
t_stop_times AS (SELECT DISTINCT * FROM stop_times WHERE trip_id IN (SELECT trip_id FROM t_trips)),
t_routes AS (SELECT DISTINCT * FROM routes WHERE route_id IN (SELECT route_id FROM t_trips)),
t_shapes AS (SELECT DISTINCT * FROM shapes WHERE shape_id IN (SELECT shape_id FROM t_trips)),
t_agency AS (SELECT DISTINCT * FROM agency WHERE agency_id IN (SELECT agency_id FROM t_routes)),
t_stops AS (SELECT DISTINCT * FROM stops WHERE stop_id IN (SELECT stop_id FROM t_stop_times))
"""


def feed_tables(spark, sf_dir):
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    service, day = F.col("o_custkey").alias("service_id"), F.to_date("o_orderdate")
    runs = F.when(F.col("o_custkey") % 3 == 0, 1).otherwise(0)
    calendar = orders.groupBy("o_custkey").agg(
        F.min(day).alias("start_date"), F.max(day).alias("end_date")
    )
    return {
        "agency": table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("agency_id"), F.col("n_name").alias("agency_name")
        ),
        "routes": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("route_id"),
            F.col("c_nationkey").alias("agency_id"),
            F.col("c_name").alias("route_long_name"),
        ),
        "trips": orders.select(
            F.col("o_orderkey").alias("trip_id"),
            F.col("o_custkey").alias("route_id"),
            service,
            (F.col("o_orderkey") % stops_of(part)).alias("shape_id"),
        ),
        "shapes": part.select(
            F.col("p_partkey").alias("shape_id"), F.col("p_size").alias("shape_pt_sequence")
        ),
        "stop_times": table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("trip_id"),
            F.col("l_linenumber").alias("stop_sequence"),
            F.col("l_partkey").alias("stop_id"),
        ),
        "stops": part.select(F.col("p_partkey").alias("stop_id"), F.col("p_name").alias("stop_name")),
        "calendar": calendar.select(service, runs.alias("monday"), "start_date", "end_date"),
        "calendar_dates": orders.select(
            service,
            day.alias("date"),
            F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("exception_type"),
        ),
    }


@demo("services_on_date", f"WITH {SQL_TABLES} SELECT service_id FROM services")
def _services_on_date(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return snapshot.services_on_date(t["calendar"], t["calendar_dates"], DAY)


@demo(
    "services_on_date_gtfs",
    f"""WITH {SQL_TABLES},
    today AS (SELECT * FROM calendar_dates WHERE date = DATE '1998-06-15')
    SELECT service_id FROM regular
    WHERE service_id NOT IN (SELECT service_id FROM today WHERE exception_type = 2)
    UNION SELECT service_id FROM today WHERE exception_type = 1""",
)
def _services_on_date_gtfs(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return snapshot.services_on_date(t["calendar"], t["calendar_dates"], DAY, mode="gtfs")


@demo("semi_cascade", f"WITH {SQL_TABLES} SELECT * FROM t_stop_times")
def _semi_cascade(spark, sf_dir):
    return snapshot.service_snapshot(feed_tables(spark, sf_dir), DAY)["stop_times"]


def _written(name):
    def query(spark, sf_dir):
        """Through the written snapshot, as the daily job does it."""
        serving = scratch_path(spark, "serving")
        write_snapshot(spark, feed_tables(spark, sf_dir), serving, DAY)
        return spark.read.parquet(service_day(f"{serving}/{name}", DAY))

    return query


for _name in ("agency", "routes", "trips", "shapes", "stop_times", "stops"):
    demo(f"snapshot_{_name}", f"WITH {SQL_TABLES} SELECT * FROM t_{_name}")(_written(_name))
demo(
    "snapshot_calendar",
    f"WITH {SQL_TABLES} SELECT * FROM calendar WHERE monday = 1 AND DATE '1998-06-15' BETWEEN start_date AND end_date",
)(_written("calendar"))
demo(
    "snapshot_calendar_dates",
    f"WITH {SQL_TABLES} SELECT * FROM calendar_dates WHERE date = DATE '1998-06-15'",
)(_written("calendar_dates"))

NAMES = ("agency", "routes", "trips", "shapes", "stop_times", "stops")


@demo(
    "service_snapshot_counts",
    f"WITH {SQL_TABLES} "
    + " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM t_{n}" for n in NAMES),
)
def _service_snapshot_counts(spark, sf_dir):
    """Through the written snapshot, as the daily job does it."""
    serving = scratch_path(spark, "serving")
    write_snapshot(spark, feed_tables(spark, sf_dir), serving, DAY)
    counts = None
    for name in NAMES:
        rows = spark.read.parquet(f"{serving}/{name}")
        n = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counts = n if counts is None else counts.unionByName(n)
    return counts


@demo(
    "snapshot_partitioned",
    f"WITH {SQL_TABLES} SELECT *, DATE '1998-06-15' AS service_date FROM t_trips",
)
def _snapshot_partitioned(spark, sf_dir):
    """Written twice: the second run replaces the first."""
    path = scratch_path(spark, "trips")
    trips = snapshot.service_snapshot(feed_tables(spark, sf_dir), DAY)["trips"]
    append_serving(trips, path, DAY)
    append_serving(trips, path, DAY)
    return spark.read.parquet(path)


@demo(
    "schedule_with_stops",
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, strftime(l_shipdate, '%H:%M:%S') AS arrival_time,
       l_linenumber AS stop_sequence, p_partkey AS stop_id, p_name AS stop_name,
       {sql_lat("p_partkey")} AS stop_lat, {sql_lon("p_partkey")} AS stop_lon
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def _schedule_with_stops(spark, sf_dir):
    k = F.col("p_partkey")
    stop_times = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.date_format("l_shipdate", "HH:mm:ss").alias("arrival_time"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.col("l_partkey").cast("string").alias("stop_id"),
    )
    stops = table(spark, sf_dir, "part").select(
        k.alias("stop_id"),
        F.col("p_name").alias("stop_name"),
        lat(k).alias("stop_lat"),
        lon(k).alias("stop_lon"),
    )
    return schedule_with_stops(stop_times, stops)


# --- feed state: a customer is a feed, the day of an order its version ---
SQL_VERSIONS = """
incoming AS (SELECT CAST(o_custkey AS VARCHAR) AS feed_url, strftime(max(o_orderdate), '%Y-%m-%d') AS version_date
             FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
stored AS (SELECT CAST(o_custkey AS VARCHAR) AS feed_url, strftime(max(o_orderdate), '%Y-%m-%d') AS version_date
           FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_custkey)
"""


def feed_versions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    feed = F.col("o_custkey").cast("string").alias("feed_url")

    def newest(rows, fmt):
        return rows.groupBy(feed).agg(F.date_format(F.max("o_orderdate"), fmt).alias("version_date"))

    incoming = newest(orders.filter("o_orderstatus = 'O'"), "yyyy-MM-dd HH:mm")
    return incoming, newest(orders.filter("o_orderpriority <> '5-LOW'"), "yyyy-MM-dd")


@demo(
    "feed_version_gate",
    f"""WITH {SQL_VERSIONS} SELECT i.feed_url, i.version_date
        FROM incoming i LEFT JOIN stored s ON s.feed_url = i.feed_url
        WHERE i.version_date IS DISTINCT FROM s.version_date""",
)
def _feed_version_gate(spark, sf_dir):
    return feeds.changed_feeds(*feed_versions(spark, sf_dir))


@demo(
    "feed_next_versions",
    f"""WITH {SQL_VERSIONS} SELECT * FROM incoming UNION ALL
        SELECT * FROM stored WHERE feed_url NOT IN (SELECT feed_url FROM incoming)""",
)
def _feed_next_versions(spark, sf_dir):
    return feeds.next_versions(*feed_versions(spark, sf_dir))


@demo(
    "version_state_roundtrip",
    f"""WITH {SQL_VERSIONS} SELECT feed_url, version_date FROM incoming UNION ALL
        SELECT feed_url, version_date FROM stored WHERE feed_url NOT IN (SELECT feed_url FROM incoming)""",
)
def _version_state_roundtrip(spark, sf_dir):
    """Committed twice through the stored state: what was known, then what a load found."""
    incoming, stored = feed_versions(spark, sf_dir)
    state = VersionState(spark, scratch_path(spark, "versions"))
    state.commit(feeds.next_versions(stored, state.read()))
    state.commit(feeds.next_versions(incoming, state.read()))
    return state.read()
