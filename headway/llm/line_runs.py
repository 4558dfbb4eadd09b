"""Line de-duplication over levelled sorted runs.

A run is a table of line keys (128-bit hashes) sorted by key, with the number of
documents that hold the line and the largest of their ids. A new batch is anti-joined
with the runs: keys that an earlier batch held are no longer fresh. The fresh ones become a run
of level 0. As soon as a level has ``fanout`` runs, they are merged into one
run of the next level, so a line is rewritten once per level and a lookup reads at
most fanout - 1 runs a level.

``fresh_lines`` does this for a batch of any kind, day by day. ``kept_texts`` keeps a line that enough
documents hold in the largest of them: one pass finds the keys of enough documents, then
batches come by descending ranges of doc_id. A key is fresh in the batch that holds its largest document and in no
later one, so what the runs say of it after the last batch is where it stays.

Documents pass their lines as hashes; texts are only met by the hashes to drop.
Runs are written below a folder all executors share. The list of runs is returned
by each step, not kept in a file: a failed batch changes nothing.

Nulls and ties: NULL text is one empty line. Rows that share a doc_id are one
document for the counts. Rows with a NULL doc_id add nothing to the runs and keep
all their lines. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import map_texts, stored
from headway.operators.skew import one_per_key
from headway.session import scratch_path

_SPACE = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """A 16-byte key per line, None for lines too short to count."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(_SPACE).lower()
        # A code point has at most four bytes; continuation bytes are not counted.
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def lines_of(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """doc_id and k1, k2 of each distinct long line."""

    def each(ids, texts):
        owner, found = [], []
        for doc_id, text in zip(ids, texts, strict=True):
            keys = {k for k in line_keys(text, min_chars) if k}
            owner += [doc_id] * len(keys)
            found += keys
        k = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
        return {"doc_id": owner, "k1": k[:, 0], "k2": k[:, 1]}

    return map_texts(docs.where(F.col("doc_id").isNotNull()), each, "doc_id bigint, k1 bigint, k2 bigint")


@dataclass(frozen=True)
class Runs:
    """The run tables by level; level 0 is the newest."""

    spark: SparkSession
    fanout: int = 4
    levels: tuple[tuple[str, ...], ...] = field(default=())

    def _write(self, df: DataFrame) -> str:
        path = scratch_path(self.spark, "line-run")
        df.sortWithinPartitions("k1", "k2").write.option("compression", "zstd").parquet(path)
        return path

    def _read(self, paths) -> DataFrame:
        return self.spark.read.schema("k1 bigint, k2 bigint, n_docs bigint, last_doc bigint").parquet(*paths)

    def table(self) -> DataFrame | None:
        """All runs, merged by key."""
        paths = [p for level in self.levels for p in level]
        return _merged(self._read(paths), len(paths) > 1) if paths else None

    def add(self, lines: DataFrame) -> Runs:
        """The runs with a batch of (doc_id, k1, k2), each document and key once, added and compacted."""
        run = lines.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        levels = [list(level) for level in self.levels] or [[]]
        levels[0].append(self._write(run))
        at = 0
        while len(levels[at]) >= self.fanout:
            if at + 1 == len(levels):
                levels.append([])
            levels[at + 1].append(self._write(_merged(self._read(levels[at]), True)))
            levels[at] = []
            at += 1
        return Runs(self.spark, self.fanout, tuple(map(tuple, levels)))


def _merged(df: DataFrame, several: bool) -> DataFrame:
    if not several:
        return df
    return df.groupBy("k1", "k2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))


def _fresh(runs: Runs, lines: DataFrame) -> DataFrame:
    seen = runs.table()
    return lines if seen is None else lines.join(seen, ["k1", "k2"], "left_anti")


def fresh_lines(runs: Runs, batch: DataFrame, min_chars: int = 40) -> tuple[DataFrame, Runs]:
    """The lines (doc_id, k1, k2) of a batch that no earlier batch held, and the runs with the batch added."""
    lines = stored(lines_of(batch, min_chars).distinct(), "lines")
    return _fresh(runs, lines), runs.add(lines)


def kept_texts(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 4) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (what stays), kept_sha256."""
    spark = docs.sparkSession
    lines = stored(lines_of(docs, min_chars).distinct(), "lines")
    common = one_per_key(lines, ["k1", "k2"], F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    shared = stored(lines.join(common.select("k1", "k2"), ["k1", "k2"]), "line-common")
    # Batches of about as many lines each; later ones have smaller ids.
    parts = [i / batches for i in range(batches - 1, 0, -1)]
    bounds = shared.agg(F.percentile_approx("doc_id", parts)).first()[0] if parts else []
    batch = sum((F.col("doc_id") <= b).cast("int") for b in bounds or []) + F.lit(0)
    path = scratch_path(spark, "line-batches")
    shared.withColumn("batch", batch).write.partitionBy("batch").option("compression", "zstd").parquet(path)
    shared = spark.read.schema("doc_id bigint, k1 bigint, k2 bigint, batch int").parquet(path)

    runs = Runs(spark, fanout)
    for b in range(batches):
        runs = runs.add(_fresh(runs, shared.where(F.col("batch") == b).select("doc_id", "k1", "k2")))
    # A key is in one run only, with the largest document that holds it.
    drop = (
        shared.join(runs.table().select("k1", "k2", "last_doc"), ["k1", "k2"])
        .where("doc_id <> last_doc")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("k1", "k2")).alias("drop"))
    )
    drop = stored(drop.select("doc_id", F.transform("drop", lambda d: d["k1"]).alias("d1"), F.transform("drop", lambda d: d["k2"]).alias("d2")), "line-drops")

    def each(keys, texts):
        ids, d1, d2 = keys
        lines_n, dropped, kept, digest = [], [], [], []
        for a, b, text in zip(d1, d2, texts, strict=True):
            lines = text.split(b"\n")
            if a:
                gone = {x.to_bytes(8, "little", signed=True) + y.to_bytes(8, "little", signed=True) for x, y in zip(a, b, strict=True)}
                stay = [x for x, k in zip(lines, line_keys(text, min_chars), strict=True) if k not in gone]
            else:
                stay = lines
            whole = b"\n".join(stay)
            lines_n.append(len(lines))
            dropped.append(len(lines) - len(stay))
            kept.append(whole.decode())
            digest.append(hashlib.sha256(whole).hexdigest())
        return {"doc_id": ids, "n_lines": lines_n, "n_dropped": dropped, "text": kept, "kept_sha256": digest}

    # What is dropped grows with the documents, so the plan is the one for large tables at any size.
    met = docs.select("doc_id", "text").join(drop.hint("merge"), "doc_id", "left")
    return map_texts(met, each, "doc_id bigint, n_lines bigint, n_dropped bigint, text string, kept_sha256 string", ("doc_id", "d1", "d2"))
