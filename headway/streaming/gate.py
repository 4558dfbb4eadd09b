"""Change gate and feed metrics on a message stream (OP-T8, OP-T9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators.feeds import changed_messages
from headway.session import filesystem


def gate_sink(
    state: str,
    sink: Callable[[DataFrame, int], None],
    feed: str = "feed",
    seq: str = "seq",
    ts: str = "header_ts",
    bucket_width: int = 3600,
) -> Callable[[DataFrame, int], None]:
    """Micro-batches of messages, cut to those that change their feed.

    The last header time per feed is a table of one row per feed, written per
    batch next to the output. A batch reads the state its predecessor wrote and
    overwrites its own, so doing it again after a failure gives the same result.
    States are kept as long as Spark keeps the checkpoint of their batch, so a flow
    whose checkpoint was rolled back finds the state it needs.
    """
    schema = f"{feed} string, {ts} bigint"

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        prior = None
        if batch_id > 0:
            fs, before = filesystem(spark, f"{state}/batch-{batch_id - 1}")
            if not fs.exists(before):
                raise FileNotFoundError(
                    f"batch {batch_id} needs the feed state of batch {batch_id - 1} at {before}; it is gone or was "
                    "never written: does the state folder belong to this checkpoint?"
                )
            prior = spark.read.schema(schema).parquet(f"{state}/batch-{batch_id - 1}")
        df = df.persist()  # read for the output and for the state
        try:
            sink(changed_messages(df, feed, seq, ts, bucket_width, prior), batch_id)
            last = (
                df.filter(F.col(ts).isNotNull())
                .groupBy(F.col(feed).cast("string").alias(feed))
                .agg(F.max_by(F.col(ts).cast("bigint"), seq).alias(ts))
            )
            if prior is not None:
                last = last.unionByName(prior.join(last.select(feed), feed, "left_anti"))
            last.write.mode("overwrite").parquet(f"{state}/batch-{batch_id}")
            kept = int(spark.conf.get("spark.sql.streaming.minBatchesToRetain", "100"))
            fs, old = filesystem(spark, f"{state}/batch-{batch_id - 1 - kept}")
            fs.delete(old, True)
        finally:
            df.unpersist()

    return write
