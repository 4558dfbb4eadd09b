"""Boroughs of the published stops (OP-N7 -> OP-P21 -> OP-K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.functions.cleaning import current
from headway.operators.spatial import stop_boroughs
from headway.sinks.tables import VersionedTable

RINGS = "array<array<struct<x: double, y: double>>>"


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """A table of named outlines: Parquet, or JSON lines for a path that ends in ``.json``."""
    reader = spark.read.schema(f"name string, rings {RINGS}")
    return reader.json(path) if path.rstrip("/").endswith(".json") else reader.parquet(path)


def publish_stop_boroughs(spark: SparkSession, polygons: str, published: str, cell: float = 0.05) -> DataFrame:
    """Replace the lookup table ``stop_boroughs`` next to the published tables."""
    base = published.rstrip("/")
    stops = current(VersionedTable(spark, f"{base}/stops").read())
    target = VersionedTable(spark, f"{base}/stop_boroughs")
    out = target.replace(stop_boroughs(stops, read_polygons(spark, polygons), cell=cell), ["stop_id"])
    target.drop_old()
    return out
