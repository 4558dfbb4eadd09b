"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import combinations


def words(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text: str | None, size: int = 5) -> list[tuple]:
    w = words(text)
    if not w:
        return []
    size = min(size, len(w))
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]


def classes(docs: list[tuple], percent: int = 75) -> dict:
    """doc_id -> (n_shingles, smallest linked doc_id)."""
    sets = {i: set(shingles(t)) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def leaks(docs: list[tuple], items: list[tuple], least: float = 0.75) -> dict:
    """(doc_id, item_id) -> best similarity over every window of the item's size."""
    out = {}
    for d, text in docs:
        s = shingles(text)
        for i, item in items:
            want = Counter(shingles(item))
            if not want.keys() & set(s):
                continue
            m = min(sum(want.values()), len(s))
            best = 0.0
            for p in range(len(s) - m + 1) if m else ():
                low = sum((Counter(s[p : p + m]) & want).values())
                best = max(best, low / (m + sum(want.values()) - low))
            if best >= least:
                out[d, i] = best
    return out


def top_k(rows: list[tuple], is_query, k: int = 5) -> dict:
    out = defaultdict(list)
    for q, v in rows:
        if is_query(q):
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), c) for c, w in rows if c != q)
            out[q] = [(c, -s) for s, c in found[:k]]
    return dict(out)


def kept_lines(docs: list[tuple], min_chars: int = 40, min_docs: int = 5) -> dict:
    """doc_id -> (lines, dropped, text)."""
    strip = "\x20\x09\x0a\x0b\x0c\x0d"

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(strip))

    where = defaultdict(set)
    for d, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                where[key(line)].add(d)
    out = {}
    for d, text in docs:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= min_chars and len(where[key(x)]) >= min_docs and d != max(where[key(x)]))]
        out[d] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out
