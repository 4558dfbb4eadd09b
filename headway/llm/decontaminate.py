"""Benchmark passages in documents: SimHash of item-sized windows, multi-index lookup, exact check.

An item is the multiset of its 5-word shingles. A window is a run of as many
shingles of a document (all of it, if the document is shorter), so its size is the
item's, rounded to a ratio of ``RATIO`` for the fingerprints. A fingerprint has 64
bits, each the majority over the window's shingle hashes; running bit counts give
all windows of a text by one subtraction each.

Lookup: 64 bits are four blocks of 16. If a window is within ``radius`` of an item,
one of the blocks is within radius // 4, so a table per block that lists for each of
the 65,536 block values the items that near guarantees all fingerprints within the
radius. Those are then compared bit by bit. Fingerprints alone miss windows near the least
similarity, where the bits that differ have a wide spread. So windows are also found by anchors: a window
(or shorter text) of similarity ``least`` holds at least that share of the item's shingles, so
it holds one of any choice of more shingles than may be lacking; the rarest of the slab are chosen.
With these no window of that similarity is missed, short of the 64-bit hashes. Pairs are decided by the exact
weighted similarity (sum of smaller counts over sum of larger counts, shingles
weighted by how often they occur) of the item with the windows of exactly its size
that hold an anchor or lie around a near fingerprint, by one pass over them.

Items are taken in slabs of ``SLAB``, the only thing sent to the tasks; documents
are never shuffled. Windows start every eighth of their size (one shingle for short items).

Nulls and ties: items and texts that are NULL or empty match nothing; an item without an item_id is one all the same, with NULL in
its rows; shorter texts than 5
words are one shingle. One row per document and item with its best window, the
earliest of equals. A repeated doc_id or item_id gives rows of its own per row
that holds it. Other columns are ignored. No benchmark or no documents: no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import map_texts, shingle_hashes, small_batches, split_runs

RADIUS, SLAB, RATIO, LEAST = 15, 1024, 1.15, 0.75
# Tables of slabs that a worker keeps.
KEPT_MB = 256
# Bytes of texts searched at once.
_CHUNK = 200_000
_SCHEMA = "doc_id bigint, item_id bigint, similarity double, first_word bigint, window_words bigint"


def _bits(s: np.ndarray) -> np.ndarray:
    """The 64 bits of each hash as 64 bytes."""
    return np.unpackbits(s.view(np.uint8)).reshape(-1, 64)


def _running(s: np.ndarray, largest: int) -> np.ndarray:
    """Bit counts before each position.

    Counts stand side by side in 64-bit words and overflow into each other, but the difference
    of two rows is exact as long as a window's counts fit their bytes.
    """
    if largest < 256:
        out = np.zeros((len(s) + 1, 8), np.uint64)
        np.cumsum(_bits(s).view(np.uint64), axis=0, out=out[1:])
        return out
    out = np.zeros((len(s) + 1, 64), np.uint32)
    np.cumsum(_bits(s), axis=0, dtype=np.uint32, out=out[1:])
    return out


def _majority(difference: np.ndarray, sizes) -> np.ndarray:
    """64-bit fingerprints from the difference of two rows of running counts."""
    counts = difference.view(np.uint8) if difference.dtype == np.uint64 else difference
    return np.packbits((counts > sizes).reshape(-1)).view(np.uint64)


def _flips(most: int) -> np.ndarray:
    """All 16-bit patterns of at most `most` ones."""
    return np.array([sum(1 << i for i in c) for n in range(most + 1) for c in combinations(range(16), n)], np.uint16)


class _Index:
    """The items of a slab by size class, up to 32 in a group, and their anchors."""

    def __init__(self, items: list[tuple[int, bytes]], radius: int, least: float = LEAST):
        self.radius, self.groups = radius, []
        by_size, flips = defaultdict(list), _flips(radius // 4)
        for (item_id, _), s in zip(items, split_runs(*shingle_hashes([t for _, t in items])[:2]), strict=True):
            if len(s):
                by_size[round(np.log(len(s)) / np.log(RATIO))].append((item_id, s, Counter(s.tolist())))
        for members in by_size.values():
            size = round(np.mean([len(s) for _, s, _ in members]))
            for at in range(0, len(members), 32):
                part = members[at : at + 32]
                whole = [_running(s, len(s)) for _, s, _ in part]
                fps = np.concatenate([_majority(w[-1:] - w[:1], len(s) // 2) for w, (_, s, _) in zip(whole, part, strict=True)])
                near = np.zeros((4, 65536), np.uint32)
                for i, fp in enumerate(fps):
                    for b in range(4):
                        near[b, flips ^ np.uint16((int(fp) >> (16 * b)) & 0xFFFF)] |= np.uint32(1 << i)
                self.groups.append((size, part, fps, near))
        self.largest = max((g[0] for g in self.groups), default=0)
        self.members = [m for g in self.groups for m in g[1]]
        # Shingles of each item that a window or text of similarity `least` has at least.
        self.needed = [max(1, math.ceil(least * len(s) - 1e-9)) for _, s, _ in self.members]
        often, of = Counter(x for _, _, counts in self.members for x in counts), defaultdict(list)
        for number, (_, s, counts) in enumerate(self.members):
            lacking = len(s) - self.needed[number]
            for x in sorted(counts, key=lambda x: (often[x], x)):
                of[x].append(number)
                lacking -= counts[x]
                if lacking < 0:
                    break
        self.keys = np.array(sorted(of), np.uint64)
        self.with_key = [of[x] for x in self.keys.tolist()]
        self.some = np.zeros(1 << 20, bool)
        self.some[self.keys >> np.uint64(44)] = True

    def anchors(self, s: np.ndarray):
        """(position, numbers of the items it is an anchor of)"""
        at = np.flatnonzero(self.some[s >> np.uint64(44)])
        key = np.searchsorted(self.keys, s[at])
        hit = self.keys[np.minimum(key, len(self.keys) - 1)] == s[at]
        for p, k in zip(at[hit].tolist(), key[hit].tolist(), strict=True):
            yield p, self.with_key[k]

    def candidates(self, fps: np.ndarray, near: np.ndarray, prints: np.ndarray):
        """(item, windows) within the radius."""
        blocks = prints.view(np.uint16).reshape(-1, 4)
        mask = near[0].take(blocks[:, 0])
        for b in (1, 2, 3):
            mask |= near[b].take(blocks[:, b])
        some = np.flatnonzero(mask)
        mask, prints = mask[some], prints[some]
        for i, fp in enumerate(fps):
            at = np.flatnonzero(mask & np.uint32(1 << i))
            yield i, some[at[np.bitwise_count(prints[at] ^ fp) <= self.radius]]


def _best(s: list[int], item: Counter, size: int) -> tuple[float, int]:
    """Best similarity and its window among all windows of the item's size (all of `s` if it is shorter)."""
    m, best, held, both = min(size, len(s)), (0.0, 0), Counter(), 0
    for end, x in enumerate(s, 1):
        if x in item:
            held[x] += 1
            both += held[x] <= item[x]
        if end > m:
            gone = s[end - m - 1]
            if gone in item:
                both -= held[gone] <= item[gone]
                held[gone] -= 1
        if end >= m and both and both / (m + size - both) > best[0]:
            best = both / (m + size - both), end - m
    return best


def _search(index: _Index, ids: list, texts: list[bytes], least: float) -> list[tuple]:
    s, runs, words = shingle_hashes(texts)
    if not len(s) or not index.groups:
        return []
    ends = np.cumsum(runs)
    starts = ends - runs
    total = _running(s, index.largest)
    end_of = np.repeat(ends, runs)
    full = runs > 0
    # First and last start of the windows to try, by text and item.
    ranges: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for p, numbers in index.anchors(s):
        d = int(np.searchsorted(ends, p, side="right"))
        p -= int(starts[d])
        for number in numbers:
            ranges[d, number].append((p - len(index.members[number][1]) + 1, p))
    first = 0
    for size, members, fps, near in index.groups:
        step = max(1, size // 8)
        begin = np.arange(0, max(0, len(s) - size + 1), step)
        prints = _majority(total[size::step][: len(begin)] - total[: len(begin) * step : step][: len(begin)], size // 2)
        inside = begin + size <= end_of[begin]
        # The first and last window of each text; the whole text if it is shorter.
        lo = np.concatenate([starts[full], np.maximum(starts, ends - size)[full]])
        hi = np.minimum(lo + size, np.concatenate([ends[full], ends[full]]))
        edge = _majority(total[hi] - total[lo], (hi - lo)[:, None] // 2)
        begin, prints = np.concatenate([begin, lo]), np.concatenate([prints, edge])
        inside = np.concatenate([inside, np.ones(len(lo), bool)])
        for i, at in index.candidates(fps, near, prints):
            more = max(0, size - len(members[i][1]))
            for p in begin[at[inside[at]]].tolist():
                d = int(np.searchsorted(ends, p, side="right"))
                p -= int(starts[d])
                ranges[d, first + i].append((p - step - 2, p + step + 2 + more))
        first += len(members)
    out = []
    for (d, number), tried in ranges.items():
        item_id, item, counts = index.members[number]
        last, best = max(0, int(runs[d]) - len(item)), (0.0, 0)
        for a, b in _merged(tried, last):
            # Only the part of the text that the windows cover.
            own = s[starts[d] + a : min(ends[d], starts[d] + b + len(item))].tolist()
            if sum(x in counts for x in own) >= index.needed[number]:
                value, where = _best(own, counts, len(item))
                best = min(best, (-value, where + a))
        if -best[0] >= least:
            out.append((ids[d], item_id, -best[0], best[1], min(int(words[d]), len(item) + 4)))
    return out


def _merged(ranges: list[tuple[int, int]], last: int) -> list[tuple[int, int]]:
    """Ranges within 0 and last, those that touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((min(max(0, a), last), min(max(0, b), last)) for a, b in ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _slabs(benchmark: DataFrame, slab: int) -> Iterator[list[tuple[int, bytes]]]:
    items = benchmark.where("text is not null").select("item_id", "text")
    part = []
    for row in items.toLocalIterator():
        part.append((row.item_id, row.text.encode()))
        if len(part) == slab:
            yield part
            part = []
    yield part


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS, slab: int = SLAB) -> DataFrame:
    """doc_id, item_id, similarity, first_word, window_words of each document that holds an item."""
    return reduce(DataFrame.unionByName, [_leaks(docs, s, least, radius) for s in _slabs(benchmark, slab)])


def holds_leak(benchmark: DataFrame, text: str = "text", least: float = LEAST, radius: int = RADIUS, slab: int = SLAB) -> Column:
    """Whether a text holds any item, as a filter on a column of texts: the same search, no shuffle."""
    small_batches(benchmark.sparkSession)

    def of(items):
        @F.pandas_udf("boolean")
        def held(texts: pd.Series) -> pd.Series:
            texts = texts.tolist()
            found = {row[0] for row in _in_chunks(items, radius, list(range(len(texts))), texts, least)}
            return pd.Series([i in found for i in range(len(texts))])

        return held(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))

    return reduce(or_, [of(s) for s in _slabs(benchmark, slab)])


_built: dict = {}


def _index(items: list[tuple[int, bytes]], radius: int, least: float) -> _Index:
    """Built once per Python worker and slab, as long as the tables of all slabs (a MB per group) are not too large."""
    key = (radius, least, hash(tuple(items)))
    if key not in _built:
        if sum(len(i.groups) for i in _built.values()) > KEPT_MB:
            _built.clear()
        _built[key] = _Index(items, radius, least)
    return _built[key]


def _in_chunks(items: list[tuple[int, bytes]], radius: int, ids: list, texts: list[bytes], least: float) -> list[tuple]:
    index, rows, at, size = _index(items, radius, least), [], 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _CHUNK or i + 1 == len(texts):
            rows += _search(index, ids[at : i + 1], texts[at : i + 1], least)
            at, size = i + 1, 0
    return rows


def _leaks(docs: DataFrame, items: list[tuple[int, bytes]], least: float, radius: int) -> DataFrame:
    def each(ids, texts):
        rows = _in_chunks(items, radius, ids, texts, least)
        names = ("doc_id", "item_id", "similarity", "first_word", "window_words")
        return {n: [r[k] for r in rows] for k, n in enumerate(names)}

    return map_texts(docs, each, _SCHEMA)
