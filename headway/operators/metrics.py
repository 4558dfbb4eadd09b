"""Dashboard figures over monitor rows and alerts (OP-M1..M7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .latest import latest_per_key


def _by_window(by: Sequence[str], every: str | None, ts: str) -> list:
    return [*by, F.window(ts, every)["start"].alias("window_start")] if every else list(by)


def live_vehicles(df: DataFrame, vehicle: str = "entity_id", ts: str = "vehicle_timestamp"):
    """OP-M1: newest row of every vehicle."""
    return latest_per_key(df, [vehicle], [ts])


def on_time_performance(df: DataFrame, by: Sequence[str], threshold_s: int = 300) -> DataFrame:
    """OP-M2: share of arrivals at most ``threshold_s`` late."""
    on_time = (F.col("delay_seconds") <= threshold_s).cast("int")
    return (
        df.filter("status = 'arrived'")
        .groupBy(*by)
        .agg(F.count("*").alias("arrivals"), F.avg(on_time).alias("otp"))
    )


def average_delay(
    df: DataFrame, by: Sequence[str], every: str | None = None, ts: str = "vehicle_timestamp"
) -> DataFrame:
    """OP-M3: mean delay of arrivals, optionally per time window."""
    return (
        df.filter("status = 'arrived'")
        .groupBy(*_by_window(by, every, ts))
        .agg(F.count("*").alias("arrivals"), F.avg("delay_seconds").alias("avg_delay"))
    )


def alert_counts(alerts: DataFrame, by: Sequence[str] = ("routeId",)) -> DataFrame:
    """OP-M4: distinct alerts; flat alert rows repeat each alert."""
    return alerts.groupBy(*by).agg(F.countDistinct("id").alias("alerts"))


def borough_route_performance(df: DataFrame, threshold_s: int = 300) -> DataFrame:
    """OP-M5: routes of each borough, worst mean delay first."""
    on_time = (F.col("delay_seconds") <= threshold_s).cast("int")
    per_route = (
        df.filter("status = 'arrived'")
        .groupBy("borough", "route_id")
        .agg(
            F.count("*").alias("arrivals"),
            F.avg("delay_seconds").alias("avg_delay"),
            F.avg(on_time).alias("otp"),
        )
    )
    worst = Window.partitionBy("borough").orderBy(F.col("avg_delay").desc())
    return per_route.withColumn("worst_rank", F.rank().over(worst))


def active_vehicles(
    df: DataFrame,
    every: str = "5 minutes",
    by: Sequence[str] = (),
    vehicle: str = "entity_id",
    ts: str = "vehicle_timestamp",
) -> DataFrame:
    """OP-M6: distinct vehicles per time window."""
    return df.groupBy(*_by_window(by, every, ts)).agg(
        F.countDistinct(vehicle).alias("active_vehicles")
    )


def arrival_rate(
    df: DataFrame,
    every: str = "5 minutes",
    by: Sequence[str] = (),
    ts: str = "vehicle_timestamp",
) -> DataFrame:
    """OP-M7: share of positions with status ``arrived`` per time window."""
    arrived = (F.col("status") == "arrived").cast("int")
    return df.groupBy(*_by_window(by, every, ts)).agg(
        F.count("*").alias("positions"), F.avg(arrived).alias("arrival_rate")
    )


# --- the same figures from sums that were kept ---
PART_KEYS = ("borough", "route_id", "window_start")
SUMS = ("positions", "arrivals", "timed", "on_time", "delay_sum")


def partial_figures(
    df: DataFrame, every: str = "5 minutes", threshold_s: int = 300, ts: str = "vehicle_timestamp"
) -> DataFrame:
    """Sums per borough, route and time window from which OP-M2, M3, M5 and M7 follow.

    Sums of several loads are put together by adding them; all are whole numbers, so taking
    a load out and putting it in again changes nothing.
    """
    arrived = F.col("status") == "arrived"
    delay = F.when(arrived, F.col("delay_seconds"))
    return df.groupBy("borough", "route_id", *_by_window([], every, ts)).agg(
        F.count(F.lit(1)).alias("positions"),
        F.count_if(arrived).alias("arrivals"),
        F.count(delay).alias("timed"),
        F.count_if(delay <= threshold_s).alias("on_time"),
        F.coalesce(F.sum(delay), F.lit(0)).alias("delay_sum"),
    )


def _added(parts: DataFrame, by: Sequence) -> DataFrame:
    return parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS])


def _share(of: str, count: str = "timed") -> Column:
    return F.when(F.col(count) > 0, F.col(of) / F.col(count))


def on_time_performance_of(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """OP-M2 from partial figures."""
    return _added(parts, by).filter("arrivals > 0").select(*by, "arrivals", _share("on_time").alias("otp"))


def average_delay_of(parts: DataFrame, by: Sequence[str], every: str | None = None) -> DataFrame:
    """OP-M3 from partial figures; ``every`` is a multiple of their windows."""
    rows = _added(parts, _by_window(by, every, "window_start")).filter("arrivals > 0")
    return rows.select(*by, *(["window_start"] if every else []), "arrivals", _share("delay_sum").alias("avg_delay"))


def borough_route_performance_of(parts: DataFrame) -> DataFrame:
    """OP-M5 from partial figures."""
    rows = _added(parts, ["borough", "route_id"]).filter("arrivals > 0").select(
        "borough", "route_id", "arrivals", _share("delay_sum").alias("avg_delay"), _share("on_time").alias("otp")
    )
    worst = Window.partitionBy("borough").orderBy(F.col("avg_delay").desc())
    return rows.withColumn("worst_rank", F.rank().over(worst))


def arrival_rate_of(parts: DataFrame, every: str = "5 minutes", by: Sequence[str] = ()) -> DataFrame:
    """OP-M7 from partial figures."""
    rows = _added(parts, _by_window(by, every, "window_start"))
    return rows.select(*by, "window_start", "positions", _share("arrivals", "positions").alias("arrival_rate"))
