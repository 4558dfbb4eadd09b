"""One row per key: the newest version (OP-W1..W3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.functions.cleaning import as_columns


def total_order(df: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> list[Column]:
    """``order`` descending, then every remaining column, so that no tie is left."""
    rest = [c for c in df.columns if c not in order and c not in keys]
    return [c.desc() for c in as_columns([*order, *rest])]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """OP-W2/W3: the row with the greatest ``order`` of every key.

    ``row_number() = 1`` is planned with a group limit on both sides of the
    shuffle, so a key sends one row per map task however many it has.
    """
    w = Window.partitionBy(*as_columns(keys)).orderBy(*total_order(df, order, keys))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
