"""Slowly changing dimensions, type 2 (OP-N4, OP-N5, OP-C2, OP-C3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.cleaning import any_distinct, as_columns, current

from .latest import latest_per_key
from .skew import one_per_key, own_shuffle


def _has_key(keys: Sequence[str]) -> Column:
    """Rows that can meet another row. The others go around the joins: they would
    all be sent to the partition of NULL."""
    return reduce(and_, (F.col(k).isNotNull() for k in keys))


def _judged(
    dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Open rows with a key, ``__seen`` (key is staged), ``__changed`` and ``__start``.

    The staged side is first reduced to one row per key: a row differs from
    some staged row of its key exactly if it differs from the least or the
    greatest of them. The reduction happens before the shuffle, and the join
    cannot multiply rows however often a key repeats on either side.
    """
    values = F.struct(*as_columns(tracked))
    staged = one_per_key(
        stage,
        keys,
        F.min(values).alias("__lo"),
        F.max(values).alias("__hi"),
        F.struct(F.min("start_dt_scd").alias("start")).alias("__staged"),
    )
    own = {c: F.col(c) for c in tracked}
    differs = any_distinct(own, {c: F.col(f"__lo.{c}") for c in tracked}) | any_distinct(
        own, {c: F.col(f"__hi.{c}") for c in tracked}
    )
    seen = F.col("__staged").isNotNull()
    return (
        current(dim)
        .filter(_has_key(keys))
        .join(staged, list(keys), "left")
        .withColumns({"__seen": seen, "__changed": seen & differs, "__start": F.col("__staged.start")})
    )


def changed_rows(
    dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """OP-N4: open rows whose key is staged with another value in a tracked column."""
    return _judged(dim, stage, keys, tracked).filter("__changed").select(*dim.columns)


def new_rows(
    dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """OP-N5: staged rows to insert: no open row is left for their key once the
    changed ones are closed. A NULL key equals nothing, so it is always new."""
    # An aggregate, not a filter and distinct: pushed into the join, the filter
    # would make the tracked columns join keys and cost another shuffle. It
    # carries the start so that it needs the columns the merge itself needs and
    # Spark shuffles the open rows once for both.
    stays = F.when(F.col("__seen") & ~F.col("__changed"), F.struct("start_dt_scd"))
    kept = (
        _judged(dim, stage, keys, tracked)
        .groupBy(*as_columns(keys))
        .agg(F.max(stays).alias("__stays"))
        .filter(F.col("__stays").isNotNull())
        .select(*keys)
    )
    keyed = stage.filter(_has_key(keys))
    fresh = keyed.join(own_shuffle(kept, keys), list(keys), "left_anti").select(*stage.columns)
    return fresh.unionByName(stage.filter(~_has_key(keys)))


def scd2_merge_open(
    opened: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    *,
    close_missing: bool = False,
    run_ts: Column | None = None,
    dedup_stage: bool = False,
) -> DataFrame:
    """A merge on the open rows alone: those that stay, those it closes, and the
    new ones. Rows closed before play no part, so a store can leave them be."""
    if close_missing and run_ts is None:
        raise ValueError("close_missing needs run_ts")
    if dedup_stage:
        stage = latest_per_key(stage, keys, ["start_dt_scd"])
    closes, end, no_key = F.col("__changed"), F.col("__start"), opened.filter(~_has_key(keys))
    if close_missing:
        gone = run_ts.cast("timestamp")
        closes, end = closes | ~F.col("__seen"), F.coalesce(end, gone)
        no_key = no_key.withColumns({"end_dt_scd": gone, "is_current": F.lit(False)})
    judged = _judged(opened, stage, keys, tracked).withColumns(
        {"end_dt_scd": F.when(closes, end), "is_current": ~closes}
    )
    added = new_rows(opened, stage, keys, tracked).withColumns(
        {"end_dt_scd": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
    )
    columns = opened.columns
    return (
        judged.select(*columns)
        .unionByName(no_key.select(*columns))
        .unionByName(added.select(*columns))
    )


def scd2_merge(
    dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str], **options
) -> DataFrame:
    """OP-C2: the whole table after a merge.

    Changed open rows are closed at the staged start, new and changed rows are
    added, everything else stays. ``close_missing`` also closes open rows whose
    key is not staged, at ``run_ts``. ``dedup_stage`` keeps one staged row per
    key; without it repeated staged keys give several open rows.
    """
    history = dim.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    return history.unionByName(scd2_merge_open(current(dim), stage, keys, tracked, **options))


def as_of(dim: DataFrame, ts: Column) -> DataFrame:
    """OP-C3: the rows valid at an instant."""
    return dim.filter(
        (F.col("start_dt_scd") <= ts)
        & (F.col("end_dt_scd").isNull() | (F.col("end_dt_scd") > ts))
    )
