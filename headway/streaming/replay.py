"""Messages from the archive through the same flows as live ones (OP-K6, OP-T11).

What has been processed is a table of marks: per batch and partition of a topic the last offset. The replay
takes archived messages past the marks in ranges of offsets, each a batch that can be done
again, and the live stream goes on behind the last of them. So nothing is lost and nothing comes twice,
wherever the flow was cut off.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import filesystem

from .flows import Sink

PLACE = ("topic", "partition")
_MARKS = "topic string, partition int, last bigint, writer string"
Flow = Callable[[DataFrame], DataFrame]


def marks(spark: SparkSession, path: str, other_than: str | None = None) -> DataFrame:
    """topic, partition, last: the greatest offset processed; of all writers, or all but one."""
    fs, found = filesystem(spark, path)
    if not fs.exists(found):
        rows = spark.createDataFrame([], _MARKS)
    else:
        rows = spark.read.schema(_MARKS).option("recursiveFileLookup", "true").parquet(path)
    if other_than is not None:
        rows = rows.filter(F.col("writer") != other_than)
    return rows.groupBy(*PLACE).agg(F.max("last").alias("last"))


def _put_marks(batch: DataFrame, path: str, writer: str, number: int) -> None:
    seen = batch.groupBy(*[F.col(c).cast(k).alias(c) for c, k in zip(PLACE, ("string", "int"), strict=True)]).agg(
        F.max(F.col("offset").cast("bigint")).alias("last")
    )
    seen.withColumn("writer", F.lit(writer)).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{writer}-{number}")


def past(messages: DataFrame, known: DataFrame) -> DataFrame:
    """Messages behind the marks of their partition; those of a partition without a mark all are.

    Marks are broadcast, a row per partition of a topic: a shuffle by partition would be a task per partition.
    """
    done = known.select(*[F.col(c).alias(f"__{c}") for c in PLACE], "last")
    same = (F.col("topic").cast("string") == F.col("__topic")) & (F.col("partition") == F.col("__partition"))
    rows = messages.join(F.broadcast(done), same, "left").filter(F.col("offset") > F.coalesce("last", F.lit(-1)))
    return rows.select(*messages.columns)


def replay(
    spark: SparkSession,
    archive: str,
    marks_path: str,
    flow: Flow,
    sink: Sink,
    range_size: int = 1_000_000,
    writer: str = "replay",
    base: str | None = None,
) -> int:
    """Run what the archive holds behind the marks through ``flow`` into ``sink``; gives the number of batches.

    A batch takes the next ``range_size`` offsets of every partition. Its marks are written after its rows, so
    a batch that was cut off is done again under the same number, and ``sink`` replaces it. Messages that
    were archived twice are taken once. ``base`` is the archive, where ``archive`` is a topic's folder of it.
    """
    number = 0
    while True:
        fs, done = filesystem(spark, f"{marks_path.rstrip('/')}/{writer}-{number}/_SUCCESS")
        if fs.exists(done):
            number += 1
            continue
        rest = past(spark.read.option("basePath", base or archive).parquet(archive), marks(spark, marks_path))
        first = rest.groupBy(*PLACE).agg(F.min("offset").alias("__first"))
        batch = rest.join(F.broadcast(first), list(PLACE)).filter(F.col("offset") < F.col("__first") + range_size).drop("__first")
        batch = batch.dropDuplicates([*PLACE, "offset"])
        if batch.isEmpty():
            return number
        sink(flow(batch), number)
        _put_marks(batch, marks_path, writer, number)
        number += 1


def live_after(marks_path: str, flow: Flow, sink: Sink, writer: str = "live") -> Sink:
    """Micro-batches of raw messages (topic, partition, offset, value) through ``flow``, but for what others have
    done before; keeps marks of its own. The source may start at any offset up to the first that is left."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        # Not its own marks: a batch done again has to give the same rows.
        rows = past(df, marks(spark, marks_path, other_than=writer)).persist()
        try:
            sink(flow(rows), batch_id)
            _put_marks(rows, marks_path, writer, batch_id)
        finally:
            rows.unpersist()

    return write


def starting_offsets(spark: SparkSession, marks_path: str) -> str:
    """Where a Kafka source goes on, as its option ``startingOffsets`` wants it; one entry per partition."""
    out: dict[str, dict[str, int]] = {}
    for r in marks(spark, marks_path).collect():
        out.setdefault(r.topic, {})[str(r.partition)] = r.last + 1
    return json.dumps(out, sort_keys=True)
