"""Reducing one side of a join to its keys without giving up skew handling.

Adaptive execution splits a hot key of a sort-merge join only where both
inputs come straight from a shuffle made for that join. An aggregation by the
join keys shares its shuffle with the join, so the other side could not be
split. The helpers here give the reduced side a shuffle of its own. It moves
one row per key, little against the side that may be hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.cleaning import as_columns


def one_per_key(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``df`` aggregated by ``keys``, partly before its shuffle, for a join on ``keys``.

    Grouping by a hash as well makes the rows lie by hash and keys, which does
    not serve the join.
    """
    by = [F.xxhash64(*as_columns(keys)).alias("__hash"), *as_columns(keys)]
    out = df.groupBy(*by).agg(*aggregates) if aggregates else df.select(*by).distinct()
    return out.drop("__hash")


def own_shuffle(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that already lie by ``keys``, moved off that layout."""
    return df.repartition(F.xxhash64(*as_columns(keys)))
