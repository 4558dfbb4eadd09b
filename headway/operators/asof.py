"""As-of joins: the latest right row at or before each left row (OP-N3).

Two shapes:

* ``asof_join`` for two large sides on any time axis. The instants of both
  sides are merged per key, answered by a running ``last``, and joined back to
  the left rows. Linear, no pairs.
* ``interval_index`` + ``asof_lookup`` for a large or streaming left side and
  a right side on a bounded axis, such as offsets within a service day: every
  right row becomes the interval it is the answer for, and the lookup is an
  equi-join on (key, bucket). Stateless, so it works in a streaming plan; it
  broadcasts when Spark sees the index is small, and otherwise a hot key is
  spread over buckets and split further by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.functions.cleaning import as_columns

from .ordered import axis_bucket, carried


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_at: str,
    right_at: str,
    tiebreak: Sequence[str] = (),
    bucket_width: int = 3600,
    how: str = "inner",
) -> DataFrame:
    """Join each left row to the right row of the same key with the greatest
    ``right_at <= left_at``.

    Ties on ``right_at`` go to the greatest ``tiebreak``, then to the greatest
    of the other right columns. Both time columns must have one type. Right
    columns must not clash with left ones, except for ``by``.

    Copies cannot pile up: rows of one key and instant become one row before
    the shuffle, on either side. A hot key is cut into time buckets of
    ``bucket_width`` seconds (or units of a numeric axis). The left rows
    themselves only meet an equality join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join type {how!r}")
    payload = [c for c in right.columns if c not in by]
    rest = [c for c in payload if c != right_at and c not in tiebreak]

    def bucketed(df: DataFrame) -> DataFrame:
        usable = reduce(and_, (F.col(c).isNotNull() for c in [*by, "__at"]))
        return df.filter(usable).withColumn("__bucket", axis_bucket(df, "__at", bucket_width))

    asked = bucketed(left.select(*by, F.col(left_at).alias("__at")).distinct())
    rank = F.struct(*as_columns([*tiebreak, *rest]))
    known = bucketed(
        right.withColumn("__at", F.col(right_at))
        .groupBy(*by, "__at")
        .agg(F.max_by(F.struct(*as_columns(payload)), rank).alias("__r"))
    )
    marks = (
        known.groupBy(*by, "__bucket")
        .agg(F.max_by("__r", "__at").alias("last"))
        .withColumn("wanted", F.lit(False))
        .unionByName(
            asked.select(*by, "__bucket").distinct().withColumn("wanted", F.lit(True)),
            allowMissingColumns=True,
        )
    )
    rows = (
        asked.withColumn("__asked", F.lit(True))
        .unionByName(known.withColumn("__asked", F.lit(False)), allowMissingColumns=True)
        .unionByName(
            carried(marks, by, "__bucket")
            .withColumnRenamed("carry", "__r")
            .withColumn("__asked", F.lit(False)),
            allowMissingColumns=True,
        )
    )
    # A carried row has no instant and sorts in front of its bucket. At one
    # instant the answer comes before the question: equal times match.
    running = (
        Window.partitionBy(*as_columns([*by, "__bucket"]))
        .orderBy(F.col("__at").asc_nulls_first(), "__asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        rows.withColumn("__m", F.last("__r", ignorenulls=True).over(running))
        .filter(F.col("__asked") & F.col("__m").isNotNull())
        .select(*[F.col(k).alias(f"__k_{k}") for k in by], "__at", "__m")
    )
    on = reduce(and_, (F.col(k) == F.col(f"__k_{k}") for k in by), F.col(left_at) == F.col("__at"))
    return left.join(answers, on, how).select(
        *left.columns, *[F.col(f"__m.{c}").alias(c) for c in payload]
    )


def _bucket_name(width: int, horizon: int) -> str:
    """The name says how the buckets were cut, so that a lookup cut otherwise finds none."""
    return f"__bucket_{width}_{horizon}"


def _clamped(value: Column, width: int, horizon: int) -> Column:
    """Bucket of an axis value: -1 below zero, one last bucket past the horizon."""
    last = horizon // width
    return F.greatest(F.lit(-1), F.least(F.lit(last), F.floor(value / width))).cast("int")


def interval_index(
    right: DataFrame,
    by: Sequence[str],
    at: str,
    tiebreak: Sequence[str] = (),
    width: int = 3600,
    horizon: int = 48 * 3600,
) -> DataFrame:
    """Right side of ``asof_lookup``: one row per interval and bucket it touches.

    ``at`` is a whole number. Of rows with equal (by, at) the greatest by
    ``tiebreak`` stays, so a key has at most one row per value of the axis. A
    row is valid from its ``at`` to the next one of its key. Rows per key are
    bounded by its distinct values plus the number of buckets; values outside
    ``[0, horizon)`` share one bucket at either end, so none is lost.
    """
    payload = [c for c in right.columns if c not in by and c != at]
    rank = [*tiebreak, *[c for c in payload if c not in tiebreak]]
    best = (
        right.filter(F.col(at).isNotNull())
        .groupBy(*by, at)
        .agg(
            F.max_by(F.struct(*as_columns(payload)), F.struct(*as_columns(rank))).alias("__p")
        )
    )
    w = Window.partitionBy(*as_columns(by)).orderBy(at)
    until = F.lead(F.col(at)).over(w)
    first = _clamped(F.col(at), width, horizon)
    last = F.coalesce(
        _clamped(F.col("__until") - 1, width, horizon), F.lit(horizon // width)
    )
    return (
        best.withColumn("__until", until)
        .withColumn("__bucket", F.explode(F.sequence(first, last)))
        .select(*by, F.col("__bucket").alias(_bucket_name(width, horizon)), F.col(at).alias("__from"), "__until", "__p.*")
    )


def lookup_layout(index: DataFrame, by: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """An index laid out for many lookups: keep it, and only the left side of
    each lookup is shuffled, if it is not broadcast anyway."""
    keys = [*(c for c in index.columns if c.startswith("__bucket_")), *by]
    given = [num_partitions] if num_partitions else []
    return index.repartition(*given, *as_columns(keys)).sortWithinPartitions(*keys)


def asof_lookup(
    left: DataFrame,
    index: DataFrame,
    by: Sequence[tuple[str, str]],
    at: str,
    right_at: str,
    width: int = 3600,
    horizon: int = 48 * 3600,
) -> DataFrame:
    """Join left rows to an ``interval_index``; another width or horizon than the index was
    built with is an error.

    ``by`` pairs left and index key columns; the index keys are dropped. Left
    rows without an earlier right row are dropped. ``right_at`` names the
    output column with the matched axis value.
    """
    bucket = _bucket_name(width, horizon)
    if bucket not in index.columns:
        raise ValueError(f"the index has no buckets of width {width} up to {horizon}: {index.columns}")
    probe = left.withColumn("__probe", _clamped(F.col(at), width, horizon))
    keys = {r: f"__k_{r}" for _, r in by}
    side = index.withColumnsRenamed(keys)
    on = (F.col("__probe") == F.col(bucket)) & (F.col("__from") <= F.col(at))
    on = on & (F.col("__until").isNull() | (F.col(at) < F.col("__until")))
    for l, r in by:
        on = on & (F.col(l) == F.col(keys[r]))
    return (
        probe.join(side, on, "inner")
        .withColumnRenamed("__from", right_at)
        .drop("__probe", bucket, "__until", *keys.values())
    )
