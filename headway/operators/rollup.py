"""Exact distinct counts that merge (OP-M6, OP-M4).

A distinct count of a day cannot be had from those of its hours. Here ids get dense numbers from a
dictionary, and a cell (a time window, and what else the rows are cut by) keeps the numbers it has seen as bitmaps of
32,768 bits, one row per cell and bitmap in use. Cells are merged by OR, so that an hour, a day or a
borough is counted from its cells without reading a row again, and a late row is one more OR.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.functions.cleaning import as_columns

from .skew import one_per_key

CELL = "5 minutes"
NUMBERING = 1024


def id_dictionary(rows: DataFrame, of: str, known: DataFrame | None = None, parts: int = NUMBERING) -> DataFrame:
    """``of`` and ``number``, dense from 1, as bitmaps begin there: ids of ``known`` keep theirs, new ones follow.

    Ids are numbered within ``parts`` hash parts side by side; what comes before a part is summed
    over one row per part. NULL is no id.
    """
    fresh = one_per_key(rows.filter(F.col(of).isNotNull()), [of]).select(of)
    first = F.lit(1)
    if known is not None:
        fresh = fresh.join(known.select(of), of, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(1))).scalar()
    fresh = fresh.withColumn("__part", F.pmod(F.xxhash64(of), F.lit(parts)))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(of))
    # One row per part, whatever the number of ids.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = fresh.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    number = (F.col("__place") - 1 + F.col("__before") + first).cast("bigint")
    out = fresh.withColumn("__place", place).join(offsets, "__part").select(of, number.alias("number"))
    return out if known is None else known.select(of, "number").unionByName(out)


def distinct_cells(
    rows: DataFrame, dictionary: DataFrame, of: str, by: Sequence[str] = (), every: str = CELL, ts: str = "vehicle_timestamp"
) -> DataFrame:
    """``window_start``, ``by``, ``bucket`` and ``seen``: the numbers of ids in each cell as bitmaps.

    Repeated ids of a cell become one row before the dictionary is met, so a busy cell is not one task's.
    """
    window = F.window(ts, every)["start"].alias("window_start")
    once = rows.filter(F.col(of).isNotNull()).select(window, *as_columns(by), of).distinct()
    n = F.col("number")
    return (
        once.join(dictionary, of)
        .groupBy("window_start", *as_columns(by), F.bitmap_bucket_number(n).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("seen"))
    )


def merged_cells(cells: DataFrame, by: Sequence[str] = (), every: str | None = None) -> DataFrame:
    """Cells of longer windows or fewer columns; without ``every`` the time is merged away. Also puts
    cells of several loads together. Window lengths have to be multiples of the cells'."""
    window = [F.window("window_start", every)["start"].alias("window_start")] if every else []
    return cells.groupBy(*window, *as_columns(by), "bucket").agg(F.bitmap_or_agg("seen").alias("seen"))


def distinct_counts(cells: DataFrame, name: str = "active_vehicles") -> DataFrame:
    """How many ids each cell has seen."""
    keys = [c for c in cells.columns if c not in ("bucket", "seen")]
    total = F.sum(F.bitmap_count("seen")).alias(name)
    return cells.groupBy(*as_columns(keys)).agg(total) if keys else cells.agg(F.coalesce(total, F.lit(0)).alias(name))
