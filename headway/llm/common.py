"""What the operators share: intermediate tables, words, shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it again: lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, as texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def ascii_lower(text: Column) -> Column:
    """A-Z only, whatever the locale; NULL becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def map_texts(
    df: DataFrame, each: Callable[[list, list[bytes]], dict | None], schema: str, keys: Iterable[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Apply a function to (keys, UTF-8 texts) of every Arrow batch; it returns columns by name."""
    small_batches(df.sparkSession)
    keys = list(keys)
    names = [part.split()[0] for part in schema.split(", ")]
    narrow = df.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column(k).to_pylist() for k in keys]
            out = each(cells[0] if len(keys) == 1 else cells, batch.column("_text").to_pylist())
            if out is not None:
                yield pa.RecordBatch.from_pydict({n: out[n] for n in names}, schema=arrow[0])

    from pyspark.sql.pandas.types import to_arrow_schema

    kind = df.sparkSession.createDataFrame([], schema).schema
    arrow = [to_arrow_schema(kind)]
    return narrow.mapInArrow(run, kind)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; other letters stay as they are."""
    return text.lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: two rounds of shift and odd multiplication."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# Texts are hashed in runs of about this many bytes.
PIECE = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15 | 3  # odd, and 3 modulo 4, so that powers differ in high bits
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64))
_powers = [np.ones(1, np.uint64)] * 2


def _power_tables(n: int) -> list[np.ndarray]:
    """_FACTOR^i and its inverse, for i below n."""
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            for j, f in enumerate((_FACTOR, pow(_FACTOR, -1, 1 << 64))):
                x = np.full(n, f, np.uint64)
                x[0] = 1
                _powers[j] = np.multiply.accumulate(x)
    return _powers


def _piece_hashes(piece: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of some bytes: a polynomial over table values, from prefix sums."""
    b = np.frombuffer(piece.lower() if lower else piece, np.uint8)
    gap = np.concatenate([[True], _SPACE[b], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    power, inverse = _power_tables(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUE[b] * power[: len(b)], out=total[1:])
        return start, mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def _pieces(text: bytes):
    """Long texts in pieces that end before white space."""
    at = 0
    while len(text) - at > 2 * PIECE:
        cut = min((x for x in (text.find(c, at + PIECE) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if x >= 0), default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after another, and the number of words of each.

    A-Z is lower case unless `lower` is false.
    """
    hashes, counts = [], np.zeros(len(texts), np.int64)
    run, size = [], 0

    def flush():
        start, h = _piece_hashes(b" ".join(texts[i] for i in run), lower)
        bounds = np.cumsum([0] + [len(texts[i]) + 1 for i in run])
        counts[run] = np.diff(np.searchsorted(start, bounds))
        hashes.append(h)

    for i, text in enumerate(texts):
        if len(text) > 2 * PIECE:
            if run:
                flush()
                run, size = [], 0
            parts = [_piece_hashes(x, lower)[1] for x in _pieces(text)]
            hashes += parts
            counts[i] = sum(map(len, parts))
            continue
        run.append(i)
        size += len(text)
        if size > PIECE:
            flush()
            run, size = [], 0
    if run:
        flush()
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts


def gram_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each place of a row of word hashes; the last k - 1 places start none."""
    out, have = w, 1
    with np.errstate(over="ignore"):
        # By doubling: the hash of 2 m words from two hashes of m words, and then of any k.
        while have < k:
            step = min(have, k - have)
            out = mixed(out[: len(out) - step] * np.uint64(_FACTOR) + mixed(out[step:]) + np.uint64(step))
            have += step
    return out


def shingle_hashes(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each run of `size` words of each text (fewer words are one run), runs and words by text.

    Words are split at ASCII white space, A-Z is lower case.
    """
    h, words = word_hashes(texts)
    runs = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    out = np.zeros(len(h), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = out * np.uint64(_FACTOR)
            out[: max(0, len(h) - j)] += h[j:]
        out = mixed(out + np.uint64(size))
        ends = np.cumsum(words)
        starts = ends - words
        for i in np.flatnonzero((words > 0) & (words < size)):
            x = np.uint64(0)
            for y in h[starts[i] : ends[i]]:
                x = x * np.uint64(_FACTOR) + y
            out[starts[i]] = mixed(np.array([x + np.uint64(words[i])]))[0]
    # Runs of a text are its first positions.
    keep = np.arange(len(h)) - np.repeat(starts, words) < np.repeat(runs, words)
    return out[keep], runs, words


def split_runs(flat: np.ndarray, runs: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(runs)[:-1]) if len(runs) else []


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
