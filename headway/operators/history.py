"""Type 2 history from a log of loads, in whatever order they came (OP-C2).

A merge only looks at open rows, so it is right only if loads come in order. Here the history is
derived from the log itself: of each key the observations by instant, equal neighbours made one
(islands), each island valid until the next one starts (gaps). Both look at a neighbour that may lie far
away, and one key may hold a third of the log, so neither is a window over a key: the time axis is cut into
buckets, and what a bucket needs from before or after it is one row per bucket (``ordered``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.functions.cleaning import as_columns

from .ordered import axis_bucket, carried
from .skew import one_per_key

START, END, CURRENT = "start_dt_scd", "end_dt_scd", "is_current"
MONTH = 30 * 86400


def _states(
    log: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: str, tiebreak: Sequence[str], gone: Column | None
) -> DataFrame:
    """One row per key and instant: ``__v`` (what was seen) and its bucket."""
    known = log.filter(F.col(at).isNotNull()).withColumn("__gone", F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False))
    value = F.struct(*as_columns(tracked), "__gone")
    rank = F.struct(*as_columns([*tiebreak, *tracked]), "__gone")
    return known.groupBy(*keys, F.col(at).cast("timestamp").alias("__at")).agg(F.max_by(value, rank).alias("__v"))


def _with_before(rows: DataFrame, keys: Sequence[str], value: Column, order: Column) -> DataFrame:
    """``__before``: the value of the row before by ``order`` (of the key), NULL for the first.

    Rows have ``__bucket``, ascending with ``order``.
    """
    own = F.struct(value.alias("v"))
    marks = rows.groupBy(*keys, "__bucket").agg(F.max_by(own, order).alias("last")).withColumn("wanted", F.lit(True))
    carry = carried(marks, keys, "__bucket").select(*keys, "__bucket", F.col("carry").alias("__carry"))
    # A carried row has no instant and stands in front of its bucket.
    both = rows.withColumns({"__own": own, "__order": order}).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*as_columns(keys), "__bucket").orderBy(F.col("__order").asc_nulls_first())
    before = F.lag(F.coalesce("__carry", "__own")).over(w)
    return both.withColumn("__before", before).filter("__own IS NOT NULL").drop("__carry", "__own", "__order")


def scd2_from_log(
    log: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: str,
    tiebreak: Sequence[str] = (),
    gone: Column | None = None,
    bucket_width: int = MONTH,
) -> DataFrame:
    """OP-C2: keys, tracked columns and validity, as merges of all loads in order of time would give.

    ``log`` has a row per load, key and observation; ``at`` is the instant of the load.
    Of several rows of a key at one instant the greatest by ``tiebreak``, then by its values, counts.
    ``gone`` marks observations that the key has vanished: they close it and open nothing.
    NULL in a key or tracked column is a value; rows without an instant are dropped. How rows are
    ordered in the log, or which of them came late, makes no difference.
    """
    states = _states(log, keys, tracked, at, tiebreak, gone)
    # NULL equals NULL here, which joins and windows on keys do not mind: only windows are used.
    states = states.withColumn("__bucket", axis_bucket(states, "__at", bucket_width))
    seen = _with_before(states, keys, F.col("__v"), F.col("__at"))
    islands = seen.filter(F.col("__before").isNull() | ~F.col("__before.v").eqNullSafe(F.col("__v"))).drop("__before")
    # The next start is the one before on the axis turned round.
    turned = islands.withColumn("__bucket", -F.col("__bucket"))
    until = _with_before(turned, keys, F.col("__at"), -F.unix_micros("__at"))
    return until.filter("NOT __v.__gone").select(
        *as_columns(keys),
        *[F.col(f"__v.`{c}`").alias(c) for c in tracked],
        F.col("__at").alias(START),
        F.col("__before.v").alias(END),
        F.col("__before").isNull().alias(CURRENT),
    )


def scd2_with_late(
    history: DataFrame,
    log: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: str,
    **options,
) -> DataFrame:
    """The history with late loads put in where they belong: an old interval is split, closed earlier
    or begins earlier.

    ``log`` is what ``history`` was made from. Only keys that ``late`` names are derived
    anew; the rows of all others are passed on as they are.
    """
    touched = one_per_key(late, keys).withColumnsRenamed({k: f"__t_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"`__t_{k}`"))
    again = log.join(touched, same, "left_semi").unionByName(late, allowMissingColumns=True)
    rest = history.join(touched, same, "left_anti")
    return rest.select(*keys, *tracked, START, END, CURRENT).unionByName(scd2_from_log(again, keys, tracked, at, **options))
