"""File tables and other batch sinks (OP-K1..K3, OP-K5, OP-K8..K12)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.cleaning import as_columns
from headway.operators.latest import latest_per_key
from headway.operators.scd2 import scd2_merge_open
from headway.session import filesystem
from headway.sources.jdbc import JdbcConf


def spread(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """OP-K3: fixed write parallelism, else whatever adaptive execution finds apt."""
    return df.repartition(num_partitions) if num_partitions else df.hint("rebalance")


def write_staging(df: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """OP-K1: a staging table, overwritten by each run."""
    spread(df, num_partitions).write.mode("overwrite").parquet(path)


def write_jdbc(
    df: DataFrame,
    conf: JdbcConf,
    table: str,
    mode: str = "append",
    num_partitions: int | None = None,
    batch_size: int = 10_000,
) -> None:
    """OP-K1/K2/K5: to a database; ``num_partitions`` bounds its connections."""
    options = conf.write_options(table, batch_size)
    spread(df, num_partitions).write.format("jdbc").options(**options).mode(mode).save()


def service_day(path: str, service_date: dt.date) -> str:
    return f"{path.rstrip('/')}/service_date={service_date.isoformat()}"


def append_serving(df: DataFrame, path: str, service_date: dt.date) -> None:
    """OP-K2: the rows of a service date. Running the date again replaces them."""
    df.hint("rebalance").write.mode("overwrite").parquet(service_day(path, service_date))


def sorted_layout(
    df: DataFrame, sort_key: Sequence[str], partition: str | None = None
) -> DataFrame:
    """OP-K11: rows in the order of the whole key, so that scans skip files and row groups.

    Ranges of the whole sort key: a file spans a small part of it, and rows of a hot
    first column are spread over several files. ``partition`` is the column the
    write is partitioned by, if it is.
    """
    by = [*([partition] if partition else []), *sort_key]
    return df.repartitionByRange(*as_columns(by)).sortWithinPartitions(*as_columns(by))


def publish(df: DataFrame, servers: str, topic: str, value: str = "json_str", **options) -> None:
    """OP-K9: one message per row. Needs the Kafka connector on the class path."""
    (
        df.select(F.col(value).alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    """OP-K12: a few rows to look at."""
    return df.limit(n)


class Pointer:
    """Which version of a table counts: a small append-only table of numbers.

    A row per version, or per version and bucket it wrote. ``_switch`` is what
    makes a version count, with one file; every ``FOLD`` versions the files are
    written as one, so their number stays bounded.
    """

    FOLD = 64
    SCHEMA = "seq bigint, bucket int, filled boolean"

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _exists(self, path: str) -> bool:
        fs, found = filesystem(self.spark, path)
        return fs.exists(found)

    def _delete(self, path: str) -> bool:
        fs, found = filesystem(self.spark, path)
        return fs.exists(found) and fs.delete(found, True)

    def _pointers(self) -> DataFrame:
        folders = [f"{self.base}/{f}" for f in ("pointer", "pointer-folded")]
        have = [f for f in folders if self._exists(f)]
        if not have:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*have)

    def version(self) -> int | None:
        return self._pointers().agg(F.max("seq")).first()[0]

    def _next(self) -> int:
        found = self.version()
        return 0 if found is None else found + 1

    def _switch(self, seq: int, buckets: Sequence[tuple[int, bool]] = ()) -> None:
        rows = [(seq, *b) for b in buckets] or [(seq, None, None)]
        one = self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1)
        one.write.mode("append").parquet(f"{self.base}/pointer")
        if seq % self.FOLD == self.FOLD - 1:
            self._fold()

    def _fold(self) -> None:
        """Rows that repeat are harmless, so the old files go last."""
        whole = self.spark.createDataFrame(self._pointers().distinct().collect(), self.SCHEMA)
        whole.coalesce(1).write.mode("append").parquet(f"{self.base}/pointer-folded")
        self._delete(f"{self.base}/pointer")

    def _current(self) -> int:
        found = self.version()
        if found is None:
            raise FileNotFoundError(f"no version of {self.base}")
        return found


class VersionedTable(Pointer):
    """OP-K8: a table that is rebuilt and swapped while others read it.

    Each version has its own folder. A reader sees the old version or the new
    one, never a mix, and a rebuild that fails changes nothing.
    """

    def _folder(self, seq: int) -> str:
        return f"{self.base}/version-{seq}"

    def drop_old(self, keep: int = 2) -> None:
        """Delete the folders of all but the last ``keep`` versions."""
        for seq in range(self._current() - keep, -1, -1):
            if not self._delete(self._folder(seq)):
                break

    def read(self, seq: int | None = None) -> DataFrame:
        """The current version, or the one asked for."""
        return self.spark.read.parquet(self._folder(self._current() if seq is None else seq))

    def replace(self, df: DataFrame, sort_key: Sequence[str] = ()) -> DataFrame:
        """Write ``df``, which may read the current version, then switch to it."""
        seq = self._next()
        rows = sorted_layout(df, sort_key) if sort_key else df.hint("rebalance")
        rows.write.mode("overwrite").parquet(self._folder(seq))
        self._switch(seq)
        return self.read()


class ScdTable(Pointer):
    """A type 2 dimension whose history is written once and whose open rows are
    rewritten only where they change.

    Open rows are cut into ``buckets`` by a hash of their key.
    ``run=n/is_current=true/bucket=b`` is the copy of bucket b that run n wrote, and
    ``run=n/is_current=false`` holds the rows run n closed. A merge first finds the buckets
    in which a key is new or changed, from one row per key, and merges and writes these
    only; a reader takes the newest copy of every bucket by its folder. The pointer
    lists per run the buckets it wrote. Runs past the pointer are leftovers of a
    failure: no reader sees them and the next run overwrites them.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, buckets: int = 16):
        super().__init__(spark, base)
        self.schema = schema
        self.buckets = buckets

    def _copies(self) -> dict[int, list[tuple[int, bool]]]:
        """Per bucket the runs that wrote it, newest first, and whether rows are left."""
        seen = self._pointers().filter("bucket IS NOT NULL").distinct().orderBy(F.desc("seq")).collect()
        copies: dict[int, list[tuple[int, bool]]] = {}
        for r in seen:
            copies.setdefault(r.bucket, []).append((r.seq, r.filled))
        return copies

    def _copy(self, seq: int, bucket: int) -> str:
        return f"{self.base}/rows/run={seq}/is_current=true/bucket={bucket}"

    def read_open(self, only: Sequence[int] | None = None) -> DataFrame:
        self._current()
        paths = [
            self._copy(*copies[0][:1], bucket)
            for bucket, copies in self._copies().items()
            if copies[0][1] and (only is None or bucket in only)
        ]
        names = [n for n in self.schema.names if n != "is_current"]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        kept = T.StructType([self.schema[n] for n in names])
        rows = self.spark.read.schema(kept).parquet(*paths)
        return rows.withColumn("is_current", F.lit(True)).select(*self.schema.names)

    def read(self) -> DataFrame:
        more = [T.StructField("run", T.LongType()), T.StructField("bucket", T.IntegerType())]
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, *more])).parquet(f"{self.base}/rows")
        closed = rows.filter((F.col("run") <= self._current()) & ~F.col("is_current"))
        return self.read_open().unionByName(closed.select(*self.schema.names))

    def _bucket(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _touched(
        self, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str], close_missing: bool
    ) -> list[int]:
        """Buckets with a key that the merge opens or closes; at most ``buckets`` numbers."""
        values = F.struct(*tracked).alias("v")
        both = (
            self.read_open().select(*keys, values, F.lit(True).alias("is_open"))
            .unionByName(stage.select(*keys, values, F.lit(False).alias("is_open")))
        )
        is_open = F.col("is_open")
        per_key = both.groupBy(*keys).agg(
            *[
                fn(F.when(side, F.col("v"))).alias(f"{name}_{end}")
                for name, side in (("open", is_open), ("staged", ~is_open))
                for end, fn in (("lo", F.min), ("hi", F.max))
            ]
        )
        staged, opened = F.col("staged_lo").isNotNull(), F.col("open_lo").isNotNull()
        no_key = reduce(or_, (F.col(k).isNull() for k in keys))
        same = (
            F.col("open_lo").eqNullSafe(F.col("staged_lo"))
            & F.col("open_hi").eqNullSafe(F.col("staged_hi"))
            & F.col("open_lo").eqNullSafe(F.col("open_hi"))
        )
        change = staged & (no_key | ~opened | ~same)
        if close_missing:
            change = change | (opened & (no_key | ~staged))
        return [r[0] for r in per_key.filter(change).select(self._bucket(keys)).distinct().collect()]

    def merge(
        self,
        stage: DataFrame,
        keys: Sequence[str],
        tracked: Sequence[str],
        sort_key: Sequence[str],
        *,
        dedup_stage: bool = False,
        close_missing: bool = False,
        **options,
    ) -> None:
        """Merge staged rows; into an empty table they go as they are, or one per key."""
        seq, rows = self._next(), stage.select(*self.schema.names)
        if dedup_stage:
            rows = latest_per_key(rows, keys, ["start_dt_scd"])
        touched = list(range(self.buckets))
        if seq > 0:
            touched = self._touched(rows, keys, tracked, close_missing)
            rows = scd2_merge_open(
                self.read_open(touched),
                rows.filter(self._bucket(keys).isin(touched)) if touched else rows.filter("false"),
                keys,
                tracked,
                close_missing=close_missing,
                **options,
            )
        path = f"{self.base}/rows/run={seq}"
        if touched:
            placed = rows.withColumn("bucket", self._bucket(keys))
            by = ["is_current", "bucket"]
            ordered = placed.hint("rebalance", *by).sortWithinPartitions(*by, *sort_key)
            ordered.write.mode("overwrite").partitionBy(*by).parquet(path)
        filled = {b for b in touched if self._exists(self._copy(seq, b))}
        self._switch(seq, [(b, b in filled) for b in touched])

    def drop_old(self, keep: int = 2) -> None:
        """Delete copies of buckets that none of the last ``keep`` versions reads."""
        first = self._current() - keep + 1
        for bucket, copies in self._copies().items():
            for (newer, _), (seq, filled) in zip(copies, copies[1:], strict=False):
                if newer <= first and filled and not self._delete(self._copy(seq, bucket)):
                    break
