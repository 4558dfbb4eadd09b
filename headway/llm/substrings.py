"""Passages that an earlier document holds, by relative Lempel-Ziv parsing.

The reference of a document is all documents with a smaller doc_id, cut into blocks of ``window // 2 + 1``
words. Of the blocks that start within a window of ``window`` words the one with the least hash is
its seed, so equal windows have equal seeds at equal places, and a document has a seed every
eleven words or so. The index of the reference is a table: for each seed the first document that has
it, and where. Seeds of one document only are left out.

A document is then parsed greedily, each seed against the indexed block it equals: a factor
(document, place, length) goes on as long as the next seed stands in the same document at the same
distance. Seeds follow each other without a gap, so a factor is a copy of the earlier document's words from
its first seed to the end of its last. Factors of ``window`` words or more are duplicate spans.

At factor boundaries the parse says nothing: there a window may stand in another earlier document than
the one the factors point to, or in none. These windows, whose seed an earlier document has but which no
factor holds, are looked up on their own by a 128-bit hash, among themselves and the windows whose seed stands
first in their own document. That finds them all: the first document that holds a window either has its seed
first, or has it at a boundary, as no factor can hold the window there. So the spans
are those of all windows that an earlier document holds, no more and no fewer.

Copies are never paired: a seed or window meets its first document only, which partial sums find, and
the joins are by unique keys, so Spark can split a hot one.

Nulls and ties: a NULL or empty text has no words. Rows with a NULL doc_id keep all their words
and are no reference. Rows that share a doc_id are no reference for one another; each is answered on its
own. Empty table: no rows. Other columns are ignored. Seeds are compared by 64-bit
hashes, of which two or more in a row have to agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import gram_hashes, map_texts, mixed, signed, stored, word_hashes
from headway.operators.skew import one_per_key

WINDOW = 50


class _Seeded:
    """Words, windows and seeds of some texts, one after another."""

    def __init__(self, texts: list[bytes], window: int):
        self.block = window // 2 + 1
        reach = window - self.block + 1  # blocks that start in a window and end in it
        self.h, self.counts = word_hashes(texts, lower=False)
        self.base = np.cumsum(self.counts) - self.counts
        n = len(self.h)
        self.owner = np.repeat(np.arange(len(texts)), self.counts)
        self.at = np.arange(n) - np.repeat(self.base, self.counts)
        # Places where a window starts.
        self.starts = np.flatnonzero(np.repeat(self.counts, self.counts) - self.at >= window)
        if not len(self.starts):
            self.seed_of = self.place = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)
            return
        gram = gram_hashes(self.h, self.block)
        least, have = gram, 1
        while have < reach:
            step = min(have, reach - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        self.seed_of = least[self.starts]
        # A block is a seed if it is the least of some window that holds it.
        low = np.zeros(len(gram), np.uint64)
        low[self.starts] = self.seed_of
        window_at = np.zeros(len(gram), bool)
        window_at[self.starts] = True
        seeds = np.zeros(len(gram), bool)
        for d in range(reach):
            m = len(gram) - d
            seeds[d:] |= window_at[:m] & (low[:m] == gram[d:])
        self.place = np.flatnonzero(seeds)
        self.key = gram[self.place]


def seeds(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """key, doc_id, part, at: where each text first has each of its seeds."""

    def each(keys, texts):
        ids, parts = (np.array(k, np.int64) for k in keys)
        s = _Seeded(texts, window)
        owner = s.owner[s.place] if len(s.place) else s.place
        order = np.lexsort((s.place, s.key, owner))
        new = np.ones(len(order), bool)
        new[1:] = (s.key[order[1:]] != s.key[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
        first = order[new]
        owner, place = owner[first], s.place[first]
        return {"key": signed(s.key[first]), "doc_id": ids[owner], "part": parts[owner], "at": s.at[place]}

    return map_texts(docs, each, "key bigint, doc_id bigint, part int, at int", ("doc_id", "part"))


def _spans(places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending starts of stretches of a length as disjoint spans."""
    if not len(places):
        return places, places
    gap = np.flatnonzero(np.diff(places) > length)
    return places[np.concatenate([[0], gap + 1])], places[np.concatenate([gap, [len(places) - 1]])] + length


def _factors(s: _Seeded, ids: np.ndarray, known: tuple, window: int) -> tuple:
    """Starts of the windows that factors hold, and of those to look up with whether they may go; places in all words.

    known: text number, key, first document and place there of the indexed seeds.
    """
    number, key, doc, at = known
    salt = mixed(np.arange(1, len(ids) + 1, dtype=np.uint64))
    own = mixed(key.view(np.uint64) ^ salt[number])
    order = np.argsort(own, kind="stable")
    number, key, doc, at, own = (x[order] for x in (number, key.view(np.uint64), doc, at, own))

    def find(owner: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.minimum(np.searchsorted(own, mixed(wanted ^ salt[owner])), len(own) - 1)
        return i, (key[i] == wanted) & (number[i] == owner)

    owner = s.owner[s.place]
    i, indexed = find(owner, s.key)
    earlier = indexed & (doc[i] < ids[owner])
    shift = at[i] - s.at[s.place]
    goes_on = (
        earlier[1:] & earlier[:-1] & (doc[i[1:]] == doc[i[:-1]]) & (shift[1:] == shift[:-1])
        & (np.diff(s.place) <= s.block) & (owner[1:] == owner[:-1])
    )
    first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    last = np.concatenate([first[1:], [len(s.place)]]) - 1
    start, end = s.place[first], s.place[last] + s.block
    long = earlier[first] & (end - start >= window)
    # Windows within a factor: from its start to a window before its end.
    step = np.zeros(len(s.h) + 1, np.int64)
    np.add.at(step, start[long], 1)
    np.add.at(step, end[long] - window + 1, -1)
    held = np.cumsum(step)[s.starts] > 0

    of_window = s.owner[s.starts]
    i, indexed = find(of_window, s.seed_of)
    ask = indexed & ~held & (doc[i] < ids[of_window])
    offer = indexed & (doc[i] == ids[of_window])
    some = ask | offer
    return s.starts[held & indexed], s.starts[some], ask[some]


_PARSED = "doc_id bigint, part int, starts array<int>, ends array<int>, windows array<struct<at:int,k1:bigint,k2:bigint,asks:boolean>>"


def parsed(shared: DataFrame, window: int = WINDOW) -> DataFrame:
    """Duplicate spans by factors, and windows to look up, of texts (doc_id, part, text, known) with indexed seeds."""

    def each(keys, texts):
        ids, parts, lists, docs, ats = keys
        s = _Seeded(texts, window)
        ids = np.array(ids, np.int64)
        number = np.repeat(np.arange(len(ids)), [len(x) for x in lists])
        flat = tuple(np.array([y for x in part for y in x], np.int64) for part in (lists, docs, ats))
        held, some, asks = _factors(s, ids, (number, *flat), window) if len(s.place) else ([np.zeros(0, np.int64)] * 3)
        ends = s.base + s.counts
        if len(some):
            k1, k2 = (signed(gram_hashes(x, window)[some]) for x in (s.h, mixed(s.h + np.uint64(window))))
        out = {"doc_id": ids, "part": parts, "starts": [], "ends": [], "windows": []}
        bounds = [(np.searchsorted(x, s.base), np.searchsorted(x, ends)) for x in (held, some)]
        for i in range(len(ids)):
            (h0, h1), (w0, w1) = ((int(b[0][i]), int(b[1][i])) for b in bounds)
            start, end = _spans(held[h0:h1] - s.base[i], window)
            out["starts"].append(start.tolist())
            out["ends"].append(end.tolist())
            out["windows"].append([
                {"at": a, "k1": x, "k2": y, "asks": q}
                for a, x, y, q in zip((some[w0:w1] - s.base[i]).tolist(), k1[w0:w1].tolist(), k2[w0:w1].tolist(), asks[w0:w1].tolist(), strict=True)
            ] if w1 > w0 else [])
        return out

    columns = ("doc_id", "part", "key", "first_doc", "first_at")
    return map_texts(shared, each, _PARSED, columns)


def duplicate_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, part, starts, ends (of word spans, exclusive), found (starts of windows at boundaries), of documents with any."""
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), _part().alias("part"), "text")
    found = stored(seeds(rows, window), "seeds")
    first = F.min(F.struct("doc_id", "at")).alias("first")
    index = one_per_key(found, ["key"], first, F.max("doc_id").alias("last")).where("last > first.doc_id")
    index = index.select("key", F.col("first.doc_id").alias("first_doc"), F.col("first.at").alias("first_at"))
    # A text's list has each of its own seeds at most once.
    known = (
        found.select("key", "doc_id", "part").join(index, "key")
        .groupBy("doc_id", "part")
        .agg(F.collect_set(F.struct("key", "first_doc", "first_at")).alias("known"))
        .select("doc_id", "part", "known.key", "known.first_doc", "known.first_at")
    )
    # What is known grows with the documents, so the plan is the one for large tables at any size.
    shared = stored(rows.join(known.hint("merge"), ["doc_id", "part"]).dropDuplicates(["doc_id", "part"]), "seeded-texts")
    parts = stored(parsed(shared, window), "factors")

    windows = parts.select("doc_id", "part", F.inline("windows"))
    twice = one_per_key(windows, ["k1", "k2"], F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last")).where("last > first_doc")
    hits = (
        windows.where("asks").select("doc_id", "part", "at", "k1", "k2").join(twice.select("k1", "k2", "first_doc"), ["k1", "k2"])
        .where("first_doc < doc_id")
        .groupBy("doc_id", "part")
        .agg(F.collect_list("at").alias("found"))
    )
    spans = parts.where(F.size("starts") > 0).select("doc_id", "part", "starts", "ends")
    return stored(spans.join(hits.hint("merge"), ["doc_id", "part"], "full"), "spans")


def _part():
    """Tells rows that share a doc_id apart, so that their lists stay apart."""
    return F.hash(F.coalesce(F.col("text"), F.lit("")))


def kept_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, text (what stays, joined by one space)."""
    spans = duplicate_spans(docs, window)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _part().alias("part"), "text")

    def each(keys, texts):
        ids, starts, ends, found = keys
        out = {"doc_id": ids, "n_words": [], "n_removed": [], "kept_sha256": [], "text": []}
        for text, a, b, at in zip(texts, starts, ends, found, strict=True):
            words = text.split()
            n = len(words)
            if a or at:
                gone = np.zeros(n + 1, np.int64)
                at = np.array(at or [], np.int64)
                np.add.at(gone, np.concatenate([np.array(a or [], np.int64), at]), 1)
                np.add.at(gone, np.concatenate([np.array(b or [], np.int64), at + window]), -1)
                words = [words[j] for j in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            whole = b" ".join(words)
            out["n_words"].append(n)
            out["n_removed"].append(n - len(words))
            out["kept_sha256"].append(hashlib.sha256(whole).hexdigest())
            out["text"].append(whole.decode())
        return out

    met = rows.join(spans.hint("merge"), ["doc_id", "part"], "left")
    return map_texts(met, each, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string", ("doc_id", "starts", "ends", "found"))
