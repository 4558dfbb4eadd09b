"""Where demos register, and the column roles they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def demo(name: str, sql: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wall(c: Column | str) -> Column:
    """Instant back to a clock time without zone, as the tables have it."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def instant(c: str) -> Column:
    return F.col(c).cast("timestamp")


# Coordinates made from a key: about 100,000 different ones each way, within some
# 200 m, so that both statuses occur.
def lat(k: Column) -> Column:
    return F.lit(40.7) + (k * 7919 % 100003) / F.lit(50001500.0)


def lon(k: Column) -> Column:
    return F.lit(-74.0) + (k * 104729 % 100019) / F.lit(50009500.0)


def sql_lat(k: str) -> str:
    return f"(40.7e0 + ({k} * 7919 % 100003) / 50001500e0)"


def sql_lon(k: str) -> str:
    return f"(-74.0e0 + ({k} * 104729 % 100019) / 50009500e0)"


CODES = ("EN", "QVH", "JK", "CS", "CH", "GH", "ZZ")


def trip_id(k: Column) -> Column:
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (k % len(CODES) + 1).cast("int"))
    return F.concat(code, F.lit("_C5-Weekday-"), k.cast("string"))


def sql_trip_id(k: str) -> str:
    codes = ", ".join(f"'{c}'" for c in CODES)
    return f"(list_extract([{codes}], CAST({k} % {len(CODES)} AS INT) + 1) || '_C5-Weekday-' || CAST({k} AS VARCHAR))"


def sql_borough(trip: str) -> str:
    code = f"regexp_extract({trip}, '^(?:[0-9]+-)?([A-Z]{{2,3}})(?:PC5-[A-Z]{{2,3}})?_.*', 1)"
    return (
        f"CASE {code} WHEN 'EN' THEN 'Brooklyn' WHEN 'JK' THEN 'Brooklyn' "
        "WHEN 'QVH' THEN 'Manhattan' WHEN 'CS' THEN 'Queens' WHEN 'CH' THEN 'Staten Island' "
        "WHEN 'GH' THEN 'Bronx' ELSE 'Unknown' END"
    )


def sql_haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"12742000e0 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))"
    )
