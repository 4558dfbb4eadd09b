"""Schedule feed files (OP-S1..S3, OP-U2)."""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.schemas import TABLES, TableSpec

log = logging.getLogger(__name__)

# Cell texts the usual CSV readers of the data frame world take
# for a missing value.
MISSING_TEXTS = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


class FeedFiles:
    """One listing of a landing folder, for all tables; headers are read once per file.

    ``<any>/<table>.csv`` or ``.txt`` is a file of the table; a directory of that
    name, as Spark writes it, holds several. ``unreadable`` names the files whose header
    could not be read.
    """

    AT_ONCE = 32

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.files: list[str] = []
        self.unreadable: list[str] = []
        self._headers: dict[str, tuple[str, ...] | None] = {}
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.listFiles(path, True) if fs.exists(path) else None
        while found is not None and found.hasNext():
            status = found.next()
            if status.getLen() > 0 and not status.getPath().getName().startswith(("_", ".")):
                self.files.append(status.getPath().toString())

    def of(self, table: str) -> list[str]:
        name = re.compile(rf"^.*{re.escape(table)}\.(?:csv|txt)(?:\.\w+)?(?:/[^/]+)?$")
        return [f for f in self.files if name.match(f)]

    def by_header(self, table: str, on_unreadable: str) -> dict[tuple[str, ...], list[str]]:
        """Files of a table by their own header; no header is taken from another file."""
        files = self.of(table)
        with ThreadPoolExecutor(self.AT_ONCE) as pool:
            found = list(pool.map(self._header, files))
        groups = defaultdict(list)
        for file, header in zip(files, found, strict=True):
            if isinstance(header, Exception):
                if on_unreadable == "fail":
                    raise OSError(f"cannot read {file}") from header
                self.unreadable.append(file)
                log.warning("left out, as it cannot be read: %s", file)
            else:
                groups[header].append(file)
        return groups

    def _header(self, file: str) -> tuple[str, ...] | Exception:
        if file not in self._headers:
            try:
                self._headers[file] = _header(self.spark, file)
            except Py4JJavaError as e:
                self._headers[file] = e
        return self._headers[file]


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Names in the first line, through the codec the file name asks for."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.InputStreamReader(plain, "UTF-8")
        line = jvm.java.io.BufferedReader(reader).readLine() or ""
    finally:
        stream.close()
    return tuple(c.strip() for c in next(csv.reader([line.lstrip("\ufeff")]), ()))


def _missing_to_null(c: str) -> Column:
    return F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")).alias(c)


def feed_region(path: Column) -> Column:
    return F.regexp_extract(path, r"([A-Za-z0-9]+)_\d{4}-\d{2}-\d{2}/", 1)


def feed_version(path: Column) -> Column:
    return F.try_to_date(F.regexp_extract(path, r"[A-Za-z0-9]+_(\d{4}-\d{2}-\d{2})/", 1))


def with_feed_provenance(df: DataFrame) -> DataFrame:
    """OP-S3: region and version from the folder ``<short>_<yyyy-MM-dd>`` of each row."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*", feed_region(path).alias("feed_region"), feed_version(path).alias("feed_version")
    )


def read_feed_table(
    spark: SparkSession,
    base: str | FeedFiles,
    table: str | TableSpec,
    provenance: bool = False,
    multi_line: bool = False,
    on_unreadable: str = "fail",
) -> DataFrame:
    """OP-S1/S2: all files of a table in all region folders, as text columns.

    Columns are matched by the header of each file: regions, and parts of one
    folder, order and omit them as they like. Only header lines are read here; there
    is one distributed scan per distinct header. ``base`` may be a ``FeedFiles``, so
    that several tables share a listing. A missing table is an empty frame.

    ``on_unreadable="fail"`` raises for a file that cannot be opened, ``"empty"``
    leaves the whole file out, logs it and names it in ``FeedFiles.unreadable``. Damage
    further inside a file always fails the read: no file is taken in part.
    ``multi_line`` allows line breaks in quoted cells, at the price of one task per file.
    """
    if on_unreadable not in ("fail", "empty"):
        raise ValueError(f"unknown on_unreadable {on_unreadable!r}")
    spec = TABLES[table] if isinstance(table, str) else table
    listing = base if isinstance(base, FeedFiles) else FeedFiles(spark, base)

    scans = []
    for header, files in listing.by_header(spec.name, on_unreadable).items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        # Every one of these files has been seen to have this header.
        reader = spark.read.schema(schema).option("ignoreCorruptFiles", False)
        scan = reader.csv(files, header=True, escape='"', multiLine=multi_line)
        if provenance:
            scan = with_feed_provenance(scan)
        extra = ["feed_region", "feed_version"] if provenance else []
        scans.append(scan.select(*[_missing_to_null(c) for c in header], *extra))
    if not scans:
        names = T.StructType([T.StructField(f.name, T.StringType()) for f in spec.text_schema])
        if provenance:
            names = names.add("feed_region", "string").add("feed_version", "date")
        return spark.createDataFrame([], names)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
