"""Mixing sources to target weights by Pfair scheduling.

A source of weight w owes one block every 1 / w slots: its block i may be placed
from slot floor(i / w) on and must be placed before slot ceil((i + 1) / w). Earliest deadline
first meets all of these when the weights sum to one, so in every prefix of
t slots each source has more than w * t - 1 and fewer than w * t + 1 blocks.

Weights are whole parts of ``PARTS``, so that all bounds are exact integers; over a billion
slots this is less than a millionth of a block off the given weights. The slots of a phase are dealt
in periods, each by a task of its own. What a period starts from does not depend on the
periods before the last one: at any slot the blocks begun by the even flow (floor(w * t) of
each source, and of the blocks under way those of the earliest deadlines) can be continued
without a miss, and after one period from there no window is open that such a start could
have broken, as a period is longer than the longest window. So a task runs one period
ahead of each of its two edges, then places the blocks between the two edges; a
perfect placement of these exists (Hall's condition holds at each edge alone), and earliest
deadline first finds it. When a source is used up the others go on with their weights scaled up,
from a new period: one phase per source at most. The driver runs only the periods in which a
phase may end and keeps a row per phase and source; slots are made by tasks.

A period has at least 1 / (least weight) slots, if the phase is that long. With square roots of source
sizes this is small; a weight below a millionth makes long periods, so few tasks.

Documents of a source come in pseudo-random order (by hash of seed and doc_id); their
ranks are counts per hash bucket plus ranks inside a bucket, so no source is one
window. Nothing is dropped or repeated: every document gets one slot.

Nulls and ties: a NULL source is a source of its own; equal ids are ordered by text length and
stay separate rows. A NULL doc_id hashes as such. Empty table: no rows. Sources without a
weight get none of the mix and come after everything else.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from headway.llm.common import stored

BLOCK, PERIOD, BUCKET_ROWS = 16, 1024, 500
PARTS = 1 << 50


def parts_of(weights: dict[str, float], period: int) -> dict[str, int]:
    """Weights as whole parts of a period (largest remainders; at least one part each)."""
    total = sum(weights.values())
    want = {k: period * w / total for k, w in weights.items()}
    parts = {k: max(1, int(x)) for k, x in want.items()}
    order = sorted(want, key=lambda k: (want[k] - parts[k], k))
    over = sum(parts.values()) - period
    while over > 0:
        k = max(parts, key=lambda k: (parts[k] - want[k] if parts[k] > 1 else float("-inf"), k))
        parts[k] -= 1
        over -= 1
    for i in range(-over):
        parts[order[-1 - i % len(order)]] += 1
    return parts


def _placed(parts: dict[str, int], slots: range, start: dict[str, int], stop: dict[str, int] | None = None) -> Iterator[tuple[int, str, int]]:
    """(slot, source, its block) for each slot, from the blocks `start` on and before the blocks `stop`."""
    total, waiting, ready = sum(parts.values()), {}, []

    def wait(k, i, slot):
        if stop is None or i < stop[k]:
            waiting.setdefault(max(slot, i * total // parts[k]), []).append((k, i))

    for k in parts:
        wait(k, start[k], slots.start)
    for slot in slots:
        for k, i in waiting.pop(slot, ()):
            heapq.heappush(ready, (-(-(i + 1) * total // parts[k]), k, i))
        _, k, i = heapq.heappop(ready)
        yield slot, k, i
        wait(k, i + 1, slot + 1)


def earliest_deadline_first(parts: dict[str, int]) -> list[tuple[str, int]]:
    """(source, its block) for each slot of a period of sum(parts) slots."""
    return [(k, i) for _, k, i in _placed(parts, range(sum(parts.values())), dict.fromkeys(parts, 0))]


def period_of(parts: dict[str, int], period: int) -> int:
    """Slots of a period: at least `period`, four per source, and more than any window has."""
    return max(period, 4 * len(parts), -(-sum(parts.values()) // min(parts.values())) + 2)


def edge(parts: dict[str, int], length: int, p: int) -> dict[str, int]:
    """Blocks of each source that are placed before period p of `length` slots."""
    if p == 0:
        return dict.fromkeys(parts, 0)
    total, at = sum(parts.values()), (p - 1) * length
    begun = {k: n * at // total for k, n in parts.items()}
    under_way = sorted((-(-(i + 1) * total // parts[k]), k) for k, i in begun.items() if parts[k] * at % total)
    for _, k in under_way[: at - sum(begun.values())]:
        begun[k] += 1
    for _, k, i in _placed(parts, range(at, at + length), begun):
        begun[k] = i + 1
    return begun


def period_slots(parts: dict[str, int], length: int, p: int, start: dict[str, int], stop: dict[str, int] | None) -> Iterator[tuple[int, str, int]]:
    """(slot, source, its block) for each slot of period p between its two edges; the first needs none."""
    return _placed(parts, range(p * length, (p + 1) * length), start, stop if p else None)


def phases(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> list[dict]:
    """Phases with first slot, slots, slots of a period, parts, and the first block of each source in it."""
    left, done, first, out = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    while active := {k: weights[k] for k in left if left[k] > 0}:
        parts = parts_of(active, PARTS)
        length, total = min(period_of(parts, period), sum(left.values())), sum(parts.values())
        # No source ends before the least slot from which a last block may be placed.
        p = min((left[k] - 1) * total // n for k, n in parts.items()) // length
        start, slots = edge(parts, length, p), None
        while slots is None:
            stop = edge(parts, length, p + 1) if p else None
            n = dict(start)
            for slot, k, i in period_slots(parts, length, p, start, stop):
                n[k] = i + 1
                if n[k] == left[k]:
                    slots = slot + 1
                    break
            start, p = stop or n, p + 1
        out.append({"first": first, "slots": slots, "length": length, "parts": parts, "done": {k: done[k] for k in parts}})
        for k in active:
            left[k] -= n[k]
            done[k] += n[k]
        first += slots
    return out


def slots_of(plan: list[dict], numbers: Iterator[int]) -> Iterator[tuple]:
    """source_key, block, slot, release, deadline, phase of the slots of some periods, which are numbered over all phases."""
    firsts = [0]
    for p in plan:
        firsts.append(firsts[-1] - (-p["slots"] // p["length"]))
    known = None
    for number in numbers:
        i = bisect_right(firsts, number) - 1
        phase, p = plan[i], number - firsts[i]
        parts, length, total = phase["parts"], phase["length"], sum(phase["parts"].values())
        start = known[1] if known and known[0] == (i, p) else edge(parts, length, p)
        known = (i, p + 1), edge(parts, length, p + 1) if phase["slots"] > length else None
        for slot, k, b in period_slots(parts, length, p, start, known[1]):
            if slot == phase["slots"]:
                break
            yield (
                k, phase["done"][k] + b, phase["first"] + slot,
                phase["first"] + b * total // parts[k], phase["first"] - (-(b + 1) * total // parts[k]), i,
            )


def square_root(counts: dict[str, int]) -> dict[str, float]:
    """Weights between natural shares and equal ones."""
    return {k: n**0.5 for k, n in counts.items()}


def ranked(docs: DataFrame, seed: int = 17) -> tuple[DataFrame, dict[str, int]]:
    """docs with source_key, hash and hash bucket; and the rows per source."""
    key = F.concat(F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce("source", F.lit("")))
    rows = docs.select("*", key.alias("source_key"), F.xxhash64(F.lit(seed), "doc_id").alias("_h"))
    counts = {r[0]: r[1] for r in rows.groupBy("source_key").agg(F.count(F.lit(1))).collect()}
    buckets = max(1, -(-max(counts.values(), default=1) // BUCKET_ROWS))
    return rows.withColumn("_b", F.pmod("_h", F.lit(buckets))), counts


def schedule(docs: DataFrame, weights: Callable[[dict[str, int]], dict[str, float]] | dict[str, float] = square_root, block: int = BLOCK, period: int = PERIOD, seed: int = 17) -> DataFrame:
    """doc_id, source, source_rank, block, slot, in_block, release, deadline.

    `weights` is a table by source (NULL source: None) or a function of the
    number of rows by source. `release` and `deadline` are the slots between which the phase allows the block.
    """
    spark = docs.sparkSession
    size = F.length(F.coalesce("text", F.lit(""))).alias("_size")
    rows, counts = ranked(docs.select("doc_id", "source", size), seed)
    rows = stored(rows, "mix-rows")
    per = rows.groupBy("source_key", "_b").agg(F.count(F.lit(1)).alias("n"))
    before = per.select("source_key", "_b", (F.sum("n").over(Window.partitionBy("source_key").orderBy("_b")) - F.col("n")).alias("before"))
    inner = F.row_number().over(Window.partitionBy("source_key", "_b").orderBy("_h", "doc_id", "_size")) - 1
    rank = (
        rows.withColumn("_inner", inner)
        .join(before, ["source_key", "_b"])
        .select("doc_id", "source", "source_key", (F.col("before") + F.col("_inner")).alias("source_rank"))
        .withColumn("block", F.expr(f"source_rank div {block}"))
        .withColumn("in_block", F.col("source_rank") % F.lit(block))
    )

    name = lambda k: None if k[0] == "0" else k[1:]
    given = weights({k: n for k, n in counts.items()}) if callable(weights) else {k: float(weights.get(name(k), 0)) for k in counts}
    blocks = {k: -(-n // block) for k, n in counts.items()}
    wanted = {k: n for k, n in blocks.items() if given.get(k, 0) > 0}
    plan = phases(wanted, given, period)
    used = plan[-1]["first"] + plan[-1]["slots"] if plan else 0
    for k in sorted(blocks.keys() - wanted.keys()):
        plan.append({"first": used, "slots": blocks[k], "length": period, "parts": {k: 1}, "done": {k: 0}})
        used += blocks[k]
    kind = "source_key string, block bigint, slot bigint, release bigint, deadline bigint, phase int"
    schema = to_arrow_schema(spark.createDataFrame([], kind).schema)

    def run(batches):
        rows = slots_of(plan, (n for batch in batches for n in batch.column(0).to_pylist()))
        while part := list(islice(rows, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)

    periods = sum(-(-p["slots"] // p["length"]) for p in plan)
    placed = spark.range(periods).mapInArrow(run, kind)
    # The plan knows nothing of the size of `placed`, which grows with the documents.
    return rank.join(placed.hint("merge"), ["source_key", "block"]).select(
        "doc_id", "source", "source_rank", "block", "in_block", "slot", "release", "deadline", "phase"
    )
