"""State of loaded feed versions (OP-S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import VERSIONS


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object feed url -> version, in a file or a folder of files.

    Missing, empty or broken means no state; a path that cannot be reached is an error.
    """
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found):
        return spark.createDataFrame([], VERSIONS)
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.explode(F.from_json("value", "map<string,string>")).alias("feed_url", "version_date")
    )


def feed_versions(spark: SparkSession, landing: str) -> DataFrame:
    """Versions of the feeds that have landed: per region folder ``<short>_<yyyy-MM-dd>``
    the newest date. Only folder names are read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(landing)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()] if fs.exists(at) else []
    folders = spark.createDataFrame([(n,) for n in names], "name string")
    pattern = r"^([A-Za-z0-9]+)_(\d{4}-\d{2}-\d{2})$"
    return (
        folders.filter(F.col("name").rlike(pattern))
        .groupBy(F.regexp_extract("name", pattern, 1).alias("feed_url"))
        .agg(F.max(F.regexp_extract("name", pattern, 2)).alias("version_date"))
    )


class VersionState:
    """The loaded versions, swapped as a whole: a reader sees the old state or the new one."""

    def __init__(self, spark: SparkSession, base: str):
        # Sinks know sources, so the import waits.
        from headway.sinks.tables import VersionedTable

        self.table = VersionedTable(spark, base)
        self.spark = spark

    def read(self) -> DataFrame:
        if self.table.version() is None:
            return self.spark.createDataFrame([], VERSIONS)
        return self.table.read()

    def commit(self, versions: DataFrame) -> None:
        """Call it after the load: a load that fails is then done again."""
        self.table.replace(versions.select("feed_url", "version_date"))
        self.table.drop_old()
