"""Token ids as directly addressable codes.

A segment stores the ids of a run of documents. An id is cut into chunks of
``BITS`` bits, lowest first. Level 0 has the first chunk of every id; an id with
more chunks sets its continuation bit there and has its next chunk in level 1, and so
on. Per level a rank directory holds the number of set bits before every block of
512 bits, so the place of an id in the next level is one directory entry plus the
ones of at most 512 bits: any id is read without decoding its neighbours. Document
ends are kept beside them.

Segments are cells of a Parquet table, in order of (shard, part): Spark's writer
commits them, so a lost executor or a repeated task leaves no half file, and any
store Spark reaches will do. A document lies in one segment.

Nulls and ties: NULL text is empty and is its end id alone; an empty table gives no
segments. Rows with a NULL doc_id come first; equal ids stay next to each other in the order
of their texts. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from headway.llm.common import small_batches
from headway.session import scratch_path

BITS, BLOCK, SEGMENT = 8, 512, 1 << 20
SCHEMA = (
    "shard int, part int, first_doc bigint, n_docs bigint, n_ids bigint, doc_ids binary, ends binary, "
    "chunks array<binary>, more array<binary>, ranks array<binary>"
)


class Codes:
    """The levels of one segment."""

    def __init__(self, chunks, more, ranks):
        self.chunks = [np.frombuffer(c, np.uint8) for c in chunks]
        self.more = [np.frombuffer(m, np.uint8) for m in more]
        self.ranks = [np.frombuffer(r, np.uint32) for r in ranks]

    @staticmethod
    def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
        chunks, more, ranks, rest = [], [], [], ids.astype(np.uint32)
        while len(rest):
            chunks.append((rest & np.uint32(0xFF)).astype(np.uint8).tobytes())
            rest = rest >> np.uint32(BITS)
            on = rest > 0
            bits = np.packbits(on, bitorder="little")
            ones = np.bitwise_count(bits)
            per = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8), dtype=np.uint32)
            more.append(bits.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(per)[:-1]]).astype(np.uint32).tobytes())
            rest = rest[on]
        return chunks, more, ranks

    def __getitem__(self, at: int) -> int:
        """The id at one place, by one rank per level."""
        value = 0
        for level, (chunk, more, ranks) in enumerate(zip(self.chunks, self.more, self.ranks, strict=True)):
            value |= int(chunk[at]) << (BITS * level)
            if not more[at >> 3] >> (at & 7) & 1:
                return value
            block = at // BLOCK
            whole = more[block * (BLOCK // 8) : at >> 3]
            part = int(more[at >> 3]) & ((1 << (at & 7)) - 1)
            at = int(ranks[block]) + int(np.bitwise_count(whole).sum()) + part.bit_count()
        raise ValueError("a continuation bit on the last level")

    def all(self) -> np.ndarray:
        """Every id in order."""
        value = None
        for level in range(len(self.chunks) - 1, -1, -1):
            n = len(self.chunks[level])
            here = self.chunks[level].astype(np.uint32)
            if value is not None:
                on = np.unpackbits(self.more[level], count=n, bitorder="little").astype(bool)
                here[on] |= value << np.uint32(BITS)
            value = here
        return np.zeros(0, np.uint32) if value is None else value


# Words whose ids one Python worker remembers, twice.
_REMEMBERED = 500_000
_TAIL = b"!\"#$%&()*+,-./:;=?@[]^_`{}~\\"
_encoders: dict[str, _Encoder] = {}


class _Encoder(dict):
    """Ids of a text as little-endian 32-bit numbers, word by word.

    The tokenizer's split never joins what white space parts, puts a run of ASCII signs after a
    letter into a token of its own, and lowers case; so ids are kept by lower-case word,
    a word with signs at its end is its stem and the signs, and each distinct stem is
    encoded once. White space other than ASCII stays inside a word and is split by the
    library. Texts that may hold special tokens are encoded as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.old: dict[bytes, bytes] = {}

    def _whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _REMEMBERED:
            self.old = dict(self)
            self.clear()
        value = self.old.get(word)
        if value is None:
            stem = word.rstrip(_TAIL)
            last = stem[-4:].decode(errors="ignore")[-1:]
            if 0 < len(stem) < len(word) and last.isalpha() and last < "\u0250" and len(last.lower()) == 1:
                value = self[stem] + self[word[len(stem) :]]
            elif word.isalpha():
                # ASCII letters only: one piece, as it is.
                value = np.array([t.id for t in self.tokenizer.model.tokenize(word.decode())], "<u4").tobytes()
            else:
                value = self._whole(word)
        self[word] = value
        return value

    def ids(self, text: bytes) -> np.ndarray:
        if b"<|" in text:
            return np.frombuffer(self._whole(text), "<u4")
        return np.frombuffer(b"".join(map(self.__getitem__, text.lower().split())), "<u4")


def encoder(path: str) -> _Encoder:
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, order: list[Column] | None = None, segment: int = SEGMENT) -> None:
    """Write the ids of every text, each followed by end_id, as segments in the given order (default: doc_id)."""
    small_batches(docs.sparkSession)
    order = order or [F.col("doc_id")]
    names = [f"_o{i}" for i in range(len(order))]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("body"), *[c.alias(n) for c, n in zip(order, names, strict=True)])
    # The text only breaks ties inside a partition.
    rows = rows.repartitionByRange(*names).sortWithinPartitions(*names, "body").select("doc_id", "body", F.spark_partition_id().alias("shard"))

    def run(batches):
        enc, held, size, part, shard = None, [], 0, 0, 0
        for batch in batches:
            enc = enc or encoder(tokenizer)
            for doc_id, body, shard in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "body", "shard")), strict=True):
                ids = np.append(enc.ids(body), np.uint32(end_id))
                held.append((doc_id, ids))
                size += len(ids)
                if size >= segment:
                    yield _segment(shard, part, held)
                    held, size, part = [], 0, part + 1
        if held:
            yield _segment(shard, part, held)

    rows.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path)


_ARROW = pa.schema([
    ("shard", pa.int32()), ("part", pa.int32()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.binary()),
    ("ends", pa.binary()), ("chunks", pa.list_(pa.binary())), ("more", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
])
_NO_ID = np.iinfo(np.int64).min


def _segment(shard: int, part: int, held: list[tuple[int | None, np.ndarray]]) -> pa.RecordBatch:
    ends = np.cumsum([len(x) for _, x in held]).astype(np.int64)
    chunks, more, ranks = Codes.encode(np.concatenate([x for _, x in held]))
    doc_ids = np.array([_NO_ID if d is None else d for d, _ in held], np.int64)
    row = [shard, part, held[0][0], len(held), int(ends[-1]), doc_ids.tobytes(), ends.tobytes(), chunks, more, ranks]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)


def read_segments(spark, path: str) -> DataFrame:
    """The segments with `offset`, the number of ids in all segments before."""
    seg = spark.read.schema(SCHEMA).parquet(path)
    # Sums by shard first: the one window over all rows has a row per shard.
    within = Window.partitionBy("shard").orderBy("part")
    shards = seg.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = shards.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    places = seg.select("shard", "part", (F.sum("n_ids").over(within) - F.col("n_ids")).alias("inner")).join(before, "shard")
    return seg.join(places.select("shard", "part", (F.col("before") + F.col("inner")).alias("offset")), ["shard", "part"])


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the segments."""
    small_batches(spark)

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_ids", "ends", "chunks", "more", "ranks", "offset")]
            for doc_ids, ends, chunks, more, ranks, offset in zip(*columns, strict=True):
                ids, ends = Codes(chunks, more, ranks).all(), np.frombuffer(ends, np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                owner = np.frombuffer(doc_ids, np.int64)
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner, mask=owner == _NO_ID), pa.array(starts + offset), pa.array(ends - starts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    seg = read_segments(spark, path)
    return seg.select("doc_ids", "ends", "chunks", "more", "ranks", "offset").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_at(spark, path: str, places: DataFrame) -> DataFrame:
    """place, id: random access to ids by their number in the whole file, each segment met by an equality join."""
    seg = read_segments(spark, path)
    # A place lies in the segment whose range holds it; ranges are cut in steps of SEGMENT so that equality finds them.
    step = F.lit(SEGMENT)
    spans = seg.withColumn("cell", F.explode(F.sequence(F.floor(F.col("offset") / step), F.floor((F.col("offset") + F.col("n_ids") - 1) / step))))
    met = places.select("place", F.floor(F.col("place") / step).alias("cell")).join(spans, "cell").where(
        "place >= offset and place < offset + n_ids"
    )

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("place", "offset", "chunks", "more", "ranks")]
            rows = [(p, Codes(c, m, r)[p - o]) for p, o, c, m, r in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], pa.int64()) for k in (0, 1)], names=["place", "id"])

    return met.select("place", "offset", "chunks", "more", "ranks").mapInArrow(run, "place bigint, id bigint")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write, then read back: what `read_documents` returns."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path, end_id)
    return read_documents(docs.sparkSession, path)
