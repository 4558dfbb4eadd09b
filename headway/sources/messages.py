"""Live message streams (OP-S7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.feeds import with_header_epoch

# Topics of the three feeds.
TOPICS = ("gtfs-trip-updates", "gtfs-vehicle-positions", "gtfs-alerts")

# Steps of a sequence number in a second: milliseconds, and 22 bits to tell apart what
# comes in the same one.
SEQ_PER_SECOND = 1000 << 22


def feed_messages(messages: DataFrame) -> DataFrame:
    """Raw messages as the change gate takes them: feed, seq, header_ts, json_str.

    The feed is the topic. ``seq`` orders the messages of a feed over all partitions of
    the topic: the time the broker took the message, then partition (10 bits) and
    offset (12 bits). In a folder a message is a file, ordered by its time of
    modification and, within a millisecond, by a hash of its name.
    """
    columns = messages.columns
    if "offset" in columns:
        at = F.unix_millis("timestamp")
        rest = F.pmod(F.col("partition"), F.lit(1 << 10)) * (1 << 12) + F.pmod(F.col("offset"), F.lit(1 << 12))
    else:
        at = F.unix_millis("modified")
        rest = F.pmod(F.xxhash64("file"), F.lit(1 << 22))
    rows = messages.select(
        F.col("topic").cast("string").alias("feed"),
        (at * (1 << 22) + rest).alias("seq"),
        F.col("value").cast("string").alias("json_str"),
    )
    return with_header_epoch(rows)


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Columns of the Kafka source. The connector package must be on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def directory_messages(
    spark: SparkSession,
    path: str,
    whole_file: bool = False,
    max_files_per_trigger: int | None = None,
    archive_to: str | None = None,
) -> DataFrame:
    """Messages landed as text files, one per line or one per file.

    Sub-folders ``topic=<name>`` give the topic; ``file`` and ``modified`` tell where a
    message came from. With ``archive_to`` (OP-K7)
    files move there once the batch after theirs has started.
    """
    reader = spark.readStream.schema("value string, topic string").option("wholetext", whole_file)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_to:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive_to)
    origin = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified")
    return reader.text(path).select("value", "topic", *origin)
