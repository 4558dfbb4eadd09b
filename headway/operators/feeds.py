"""Feed versions, change gate, feed metrics (OP-N8, OP-C5, OP-T8, OP-T9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.functions.cleaning import version_text, whole_number

from .ordered import axis_bucket, carried


def changed_feeds(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """OP-N8/C5: feeds whose version is new. Both have feed_url, version_date."""
    # One version per feed, the newest, so that no feed is given twice.
    known = stored.groupBy("feed_url").agg(F.max("version_date").alias("__stored"))
    seen = incoming.withColumn("version_date", version_text("version_date"))
    return (
        seen.join(known, "feed_url", "left")
        .filter(~F.col("version_date").eqNullSafe(F.col("__stored")))
        .drop("__stored")
    )


def next_versions(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """State to store once the load is done: incoming versions override stored ones."""
    fresh = incoming.select("feed_url", version_text("version_date").alias("version_date"))
    old = stored.join(fresh.select("feed_url"), "feed_url", "left_anti")
    return old.select("feed_url", "version_date").unionByName(fresh)


def with_header_epoch(df: DataFrame, json: str = "json_str") -> DataFrame:
    """``header_ts`` of a raw message; NULL if it has none."""
    return df.withColumn(
        "header_ts", whole_number(F.get_json_object(json, "$.header.timestamp"), "bigint")
    )


def with_previous(
    df: DataFrame,
    by: str,
    seq: str,
    value: str,
    out: str,
    bucket_width: int,
    prior: DataFrame | None = None,
) -> DataFrame:
    """``value`` of the preceding row of the same ``by`` in ``seq`` order.

    ``seq`` is unique within ``by``. There are few feeds, so a window per feed
    would be a handful of tasks; the sequence is cut into buckets instead.
    ``prior`` (``by``, ``value``) holds the last values of an earlier batch.
    """
    rows = df.withColumn("__bucket", axis_bucket(df, seq, bucket_width))
    marks = rows.groupBy(by, "__bucket").agg(
        F.max_by(value, seq).alias("last"), F.lit(True).alias("wanted")
    )
    if prior is not None:
        start = F.lit(-(2**62)).cast("bigint").alias("__bucket")  # before all others
        marks = marks.unionByName(
            prior.select(by, start, F.col(value).alias("last"), F.lit(False).alias("wanted"))
        )
    carry = carried(marks, [by], "__bucket").select(
        by, "__bucket", F.col("carry").alias(value), F.lit(True).alias("__carry")
    )
    rows = rows.withColumn("__carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(by, "__bucket").orderBy(F.col("__carry").desc(), seq)
    return (
        rows.withColumn(out, F.lag(value).over(w))
        .filter(~F.col("__carry"))
        .drop("__carry", "__bucket")
    )


def changed_messages(
    df: DataFrame,
    feed: str = "feed",
    seq: str = "seq",
    ts: str = "header_ts",
    bucket_width: int = 3600,
    prior: DataFrame | None = None,
) -> DataFrame:
    """OP-T8: messages whose header time differs from the one before of their feed.

    A message without header time is dropped and remembered nowhere. The
    result has ``previous_ts``; A, B, A keeps all three.
    """
    timed = df.filter(F.col(ts).isNotNull())
    return with_previous(timed, feed, seq, ts, "previous_ts", bucket_width, prior).filter(
        ~F.col(ts).eqNullSafe(F.col("previous_ts"))
    )


def feed_metrics(
    changed: DataFrame,
    observed_at: Column,
    payload: str = "json_str",
    feed: str = "feed",
    ts: str = "header_ts",
) -> DataFrame:
    """OP-T9: seconds since the previous update and payload bytes, one row each."""
    previous = F.nullif(F.col("previous_ts"), F.lit(0))
    pairs = F.array(
        F.struct(F.lit("update_interval_sec").alias("metric"), (F.col(ts) - previous).alias("value")),
        F.struct(
            F.lit("payload_size_bytes").alias("metric"),
            F.octet_length(payload).cast("bigint").alias("value"),
        ),
    )
    return changed.select(
        observed_at.alias("timestamp"), F.col(feed).alias("feed"), F.inline(pairs)
    ).filter(F.col("value").isNotNull())
