"""Session settings for large runs, and where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# For jobs on a cluster. Skew joins are split even if that costs a shuffle:
# one trip, feed or service may hold a large share of all rows.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def builder(app: str) -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for k, v in RECOMMENDED.items():
        b = b.config(k, v)
    return b


def tune(spark: SparkSession) -> SparkSession:
    """The adaptive settings, on a session somebody else made."""
    for k, v in RECOMMENDED.items():
        if k.startswith("spark.sql.adaptive."):
            spark.conf.set(k, v)
    return spark


def ensure_shared(spark: SparkSession) -> SparkSession:
    """Give a local session without ``spark.checkpoint.dir`` a folder of its own.

    For entry points, benches and notebooks on one machine. On a cluster the
    setting has to name a folder that driver and executors share.
    """
    if not _shared(spark):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="headway-"))
    return spark


def _shared(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for an intermediate table, below ``spark.checkpoint.dir``."""
    root = _shared(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path object, for folders that no reader or writer covers."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found
