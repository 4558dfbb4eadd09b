"""Figures per time window on a stream, and the rows that came too late for them (OP-T1, OP-M6, OP-M7).

Spark drops rows behind the watermark from a streaming aggregation without a trace. Here a first flow
parts each micro-batch by a watermark of its own, the greatest time of the batches before less the delay: rows
whose window is over go to a table of late rows, all others to a folder that the second flow reads.
That one aggregates on the state store, with the same delay. It has seen no more than the first
flow when it takes a row, so its watermark is never ahead and it drops nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.session import filesystem

from .flows import WATERMARK, Sink

TS = "vehicle_timestamp"


def window_end(every: str, ts: str = TS) -> Column:
    """End of the window of a row; usable where ``window`` itself is not, as in filters."""
    micros, width = F.unix_micros(ts), F.lit(_micros(every))
    return F.timestamp_micros(micros - F.pmod(micros, width) + width)


def _micros(span: str) -> int:
    n, unit = span.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000


def landed_batches(path: str) -> Sink:
    """A folder per micro-batch that appears in one step, for a flow that reads on.

    A batch done again changes nothing if its folder is there. Needs a file system that
    renames folders in one step.
    """
    path = path.rstrip("/")

    def write(df: DataFrame, batch_id: int) -> None:
        fs, there = filesystem(df.sparkSession, f"{path}/batch={batch_id}")
        if fs.exists(there):  # done before; the second flow may have read it
            return
        aside = f"{path}/_making-{batch_id}"
        df.write.mode("overwrite").parquet(aside)
        if not fs.rename(filesystem(df.sparkSession, aside)[1], there):
            raise OSError(f"{aside} could not become {there}")

    return write


def late_split(
    state: str, on_time: Sink, late: Sink, every: str, delay: str = WATERMARK, ts: str = TS
) -> Sink:
    """OP-T1: micro-batches parted into rows whose window is open and rows that are late.

    Late rows get ``watermark`` and ``late_by`` (seconds from the end of their window to it).
    A row without a time is in neither. The greatest time so far is a table of one row
    per batch; a batch reads its predecessor's, so doing it again gives the same parts. States are kept as
    long as Spark keeps the checkpoint of their batch.
    """
    schema = f"{ts} timestamp"

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        top = None
        if batch_id > 0:
            fs, before = filesystem(spark, f"{state}/batch-{batch_id - 1}")
            if not fs.exists(before):
                raise FileNotFoundError(f"batch {batch_id} needs the state of batch {batch_id - 1} at {before}")
            top = spark.read.schema(schema).parquet(str(before)).agg(F.max(F.unix_micros(ts))).first()[0]
        df = df.persist()  # read for both parts and for the state
        try:
            timed = df.filter(F.col(ts).isNotNull())
            end = window_end(every, ts)
            if top is None:
                on_time(timed, batch_id)
            else:
                mark = F.timestamp_micros(F.lit(top - _micros(delay)))
                late_by = (F.unix_micros(mark) - F.unix_micros(end)) / F.lit(1e6)
                on_time(timed.filter(end > mark), batch_id)
                late(timed.filter(end <= mark).withColumns({"watermark": mark, "late_by": late_by}), batch_id)
            newest = timed.agg(F.max(ts).alias(ts))
            if top is not None:
                newest = newest.select(F.greatest(F.col(ts), F.timestamp_micros(F.lit(top))).alias(ts))
            newest.coalesce(1).write.mode("overwrite").parquet(f"{state}/batch-{batch_id}")
            kept = int(spark.conf.get("spark.sql.streaming.minBatchesToRetain", "100"))
            fs, old = filesystem(spark, f"{state}/batch-{batch_id - 1 - kept}")
            fs.delete(old, True)
        finally:
            df.unpersist()

    return write


def on_time_stream(spark, path: str, schema, delay: str = WATERMARK, ts: str = TS) -> DataFrame:
    """What ``landed_batches`` lays down, with the watermark. All folders there are taken at once, as
    parts of a batch could be ahead of the rest of it."""
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    return rows.withWatermark(ts, delay)


def active_vehicles_stream(
    positions: DataFrame, every: str = "5 minutes", by: Sequence[str] = (), vehicle: str = "entity_id", ts: str = TS
) -> DataFrame:
    """OP-M6 on a stream: distinct vehicles and positions per window, given once it is over.

    The state holds a row per window and vehicle, and one per window for the sums of those.
    """
    window = F.window(ts, every)
    each = positions.groupBy(window.alias("w"), vehicle, *by).agg(F.count(F.lit(1)).alias("n"))
    out = each.groupBy(F.window(F.col("w"), every).alias("w"), *by).agg(
        F.count(vehicle).alias("active_vehicles"), F.sum("n").alias("positions")
    )
    return out.select(F.col("w.start").alias("window_start"), *by, "active_vehicles", "positions")


def arrival_rate_stream(
    monitored: DataFrame, every: str = "5 minutes", by: Sequence[str] = (), ts: str = TS
) -> DataFrame:
    """OP-M7 on a stream of monitor rows: positions and share of arrivals per window, given once it is over."""
    arrived = (F.col("status") == "arrived").cast("int")
    out = monitored.groupBy(F.window(ts, every).alias("w"), *by).agg(
        F.count("*").alias("positions"), F.avg(arrived).alias("arrival_rate")
    )
    return out.select(F.col("w.start").alias("window_start"), *by, "positions", "arrival_rate")
