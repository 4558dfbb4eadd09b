"""Runs of periodic words by seeding and extending diagonals.

A run is a stretch of words with smallest period q, of at least max(least, 2 q) words, that no
neighbour extends with period q. On the diagonal of lag q its words equal those q later, over its length
less q, so over max(least - q, q) words or more: two k-grams of the text that lie q apart are equal.

Lags are taken in classes [Q, 2 Q). Within a class every run has Q equal words in a row, so one of
the k-grams that start at a multiple of s, with s + k - 1 <= Q, lies within and recurs q later. An index of
all k-grams of the class, sorted by (hash, place), gives the later places of each such seed within the
class's lags; these are at most 2 n pairs a class however often a k-gram occurs. Lags below twice
the least overlap are read off directly. A pair is extended both ways, word by word in growing strides, unless
the furthest-covered table of its lag says that an earlier extension went past it, or it lies in a known run whose
period divides the lag: that run is then the whole stretch.
Stretches with one extent are one run with the least lag.

Texts of a batch are indexed together, with a mark of its own between any two, so that short texts cost
little; no text meets another. Words are compared by 64-bit hashes within a text.

Nulls and ties: a NULL or empty text has no words and no runs. Among runs of one length the earliest
counts as the longest one, then the one with the smaller period. Rows with a NULL doc_id are not rewritten
by ``planted``. Every row is answered on its own, repeated doc_ids too. Empty table: no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from headway.llm.common import gram_hashes, map_texts, mixed, word_hashes

LEAST = 12


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The rewriting rule of the task: the original word at each place, or None for a text left alone."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def _extent(w: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """First and last place (exclusive) of the equal stretch around `at` on the diagonal."""
    hi, step, n = at, 16, len(w) - lag
    while hi < n:
        end = min(n, hi + step)
        differs = np.flatnonzero(w[hi:end] != w[hi + lag : end + lag])
        if len(differs):
            hi += int(differs[0])
            break
        hi, step = end, 2 * step
    lo, step = at, 16
    while lo > 0:
        start = max(0, lo - step)
        differs = np.flatnonzero(w[start:lo] != w[start + lag : lo + lag])
        if len(differs):
            lo = start + int(differs[-1]) + 1
            break
        lo, step = start, 2 * step
    return lo, hi


def _direct(w: np.ndarray, lags: range, least: int, found: dict) -> None:
    """All stretches of small lags, over the whole of `w` at once."""
    for lag in lags:
        if lag >= len(w):
            break
        same = np.concatenate([[False], w[:-lag] == w[lag:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for lo, hi in zip(*(x[edge[1::2] - edge[::2] >= max(least - lag, lag)].tolist() for x in (edge[::2], edge[1::2])), strict=True):
            found.setdefault((lo, hi + lag), lag)


class _Covered:
    """What known runs cover: for each place the longest of them."""

    def __init__(self, n: int):
        self.start, self.end, self.lag = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, np.int64)

    def add(self, lo: int, hi: int, lag: int) -> None:
        at = slice(lo, hi)
        longer = self.end[at] - self.start[at] < hi - lo
        for x, v in ((self.start, lo), (self.end, hi), (self.lag, lag)):
            x[at][longer] = v

    def holds(self, i: np.ndarray, lag: np.ndarray, k: int) -> np.ndarray:
        """Pairs of k-grams within one run whose period divides their lag."""
        return (self.end[i] >= i + lag + k) & (lag % self.lag[i] == 0)


def runs(w: np.ndarray, owner: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of word hashes; words of texts lie together, `owner` ascending."""
    found: dict[tuple[int, int], int] = {}
    if not len(w):
        return []
    # A mark of its own after each text: equal to no word and no other mark.
    cut = np.flatnonzero(np.diff(owner)) + 1
    shift = np.zeros(len(w), np.int64)
    shift[cut] = 1
    place = np.arange(len(w)) + np.cumsum(shift)
    line = mixed(np.arange(len(w) + len(cut), dtype=np.uint64) + np.uint64(1 << 62))
    line[place] = w
    of = np.full(len(line), -1, np.int64)
    of[place] = owner
    origin = np.full(len(line), -1, np.int64)
    origin[place] = np.arange(len(w))

    first = -(-least // 2)  # of lags below this, least - lag words are equal; from here on as many as the lag
    _direct(line, range(1, least), least, found)
    covered = _Covered(len(line))
    for (lo, hi), lag in found.items():
        covered.add(lo, hi, lag)
    places = None
    q = least
    longest = int(np.bincount(owner).max())
    while 2 * q <= longest:
        k = max(first, q // 2)
        stride = q - k + 1
        gram = gram_hashes(line, k)
        # Texts without a repeated k-gram have no run of this class or a later one.
        if places is None:
            places = np.flatnonzero(of[: len(gram)] >= 0)
        else:
            places = places[places < len(gram)]
        places = places[of[places] == of[places + k - 1]]
        order = places[np.lexsort((places, gram[places], of[places]))]
        new = np.concatenate([[True], (gram[order[1:]] != gram[order[:-1]]) | (of[order[1:]] != of[order[:-1]])]) if len(order) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        often = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
        order, group = order[often], group[often]
        if not len(order):
            break
        slots = group * len(line) + order
        seed = order % stride == 0
        i, base = order[seed], group[seed] * len(line)
        lo, hi = (np.searchsorted(slots, base + np.minimum(i + d, len(line))) for d in (q, 2 * q))
        n = hi - lo
        left = np.repeat(i, n)
        right = order[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if n.sum() else left
        lag = right - left
        turn = np.lexsort((left, lag))
        left, lag = left[turn], lag[turn]
        furthest: dict[int, int] = {}
        # In slices, so that what was found covers the pairs after it.
        at = 0
        while at < len(left):
            x, t = left[at : at + 4096], lag[at : at + 4096]
            at += 4096
            open_ = ~covered.holds(x, t, k)
            for a, b in zip(x[open_].tolist(), t[open_].tolist(), strict=True):
                if a < furthest.get(b, 0):
                    continue
                s, e = _extent(line, a, b)
                furthest[b] = e
                if e - s >= max(least - b, b) and (s, e + b) not in found:
                    found[s, e + b] = b
                    covered.add(s, e + b, b)
        places = places[np.isin(of[places], np.unique(of[order]))]
        q *= 2
    return [(int(origin[s]), int(origin[e - 1]) + 1, q) for (s, e), q in sorted(found.items())]


def periodic_runs(docs: DataFrame, least: int = LEAST, rewrite: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the longest run, runs_sha256, collapsed_sha256,
    runs (start, length, period), collapsed (the words that stay).

    ``rewrite`` gives the original word at each place of a text that is to be changed first.
    """

    def each(ids, texts):
        words = [t.split() for t in texts]
        h, counts = word_hashes(texts, lower=False)
        ends = np.cumsum(counts)
        for i, (doc_id, own) in enumerate(zip(ids, words, strict=True)):
            take = rewrite(doc_id, len(own)) if rewrite else None
            if take is not None:
                h[ends[i] - counts[i] : ends[i]] = h[ends[i] - counts[i] : ends[i]][take]
                words[i] = [own[j] for j in take.tolist()]
        of_text: list[list[tuple[int, int, int]]] = [[] for _ in ids]
        owner = np.repeat(np.arange(len(ids)), counts)
        for s, e, q in runs(h, owner, least):
            i = int(owner[s])
            base = int(ends[i] - counts[i])
            of_text[i].append((s - base, e - s, q))
        out = {c: [] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed")}
        for own, found in zip(words, of_text, strict=True):
            found.sort(key=lambda r: (r[0], r[2]))
            best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
            out["n_runs"].append(len(found))
            for c, v in zip(("start", "length", "period"), best, strict=True):
                out[c].append(v)
            out["exponent_milli"].append(1000 * best[1] // best[2] if found else None)
            out["runs_sha256"].append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest())
            if found:
                stay = np.ones(len(own), bool)
                for s, n, q in found:
                    stay[s + q : s + n] = False
                own = [own[j] for j in np.flatnonzero(stay).tolist()]
            whole = b" ".join(own)
            out["collapsed_sha256"].append(hashlib.sha256(whole).hexdigest())
            out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in found])
            out["collapsed"].append(whole.decode())
        return out | {"doc_id": ids}

    return map_texts(
        docs, each,
        "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
        "collapsed_sha256 string, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
    )
