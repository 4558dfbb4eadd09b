"""Brown class-based bigram model with exchange clustering.

p(w | v) = p(class w | class v) * p(w | class w). The ``clustered`` most frequent words are
assigned to ``classes`` classes by exchange: a word moves to the class that raises the
likelihood of the class bigrams most. Every round counts each word's neighbours by class
from a table of word bigrams (a row per distinct pair of clustered words), then
words move one after another; the best round is kept.

Every other word that occurs ``least`` times or more then joins the class that makes its neighbours likeliest, given
the class bigrams: which classes stand before and after it is counted in the tasks, and the counts of a word meet in
one task in the form of a small vector, where it is decided. Frequent words come first, so that the
neighbours of the rest have classes. Class bigrams are then counted anew over all of these. Only rarer words
form one open class, whose emissions come from their own counts, with mass for a word never seen; the end of a text is a
class and also the context of its start. A rare word next to another counts it as open in the class bigrams.

Counts, classes, bigrams and scores cover whole texts of all documents. Word counts and the classes of all but the
frequent words grow with the corpus and stay tables. Sent to the tasks are the counts and classes of the ``head`` most
frequent words, bounded by parameter; all other words meet the texts in a join, per text and distinct word.

Nulls and ties: NULL text is empty and is its end token alone. A NULL doc_id is
training data. Rows are scored one by one, also equal ones. Words of equal count are
ordered by their bytes; of classes that fit equally the first counts. Empty table: no rows; no training text: every
word unknown.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import small_batches, stored, words_of

CLUSTERED, CLASSES, HEAD, ROUNDS, LEAST = 2_000, 48, 131_072, 6, 5
END = b""
# Distinct words a task counts before it passes them on.
_HELD = 400_000


def remainder(mod: int) -> Column:
    """crc32 of the doc_id as text; a NULL id gives 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod, F.lit(0))


def _bodies(docs: DataFrame, *more: Column) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(*more, F.coalesce("text", F.lit("")).cast("binary").alias("body"))


def token_counts(docs: DataFrame) -> DataFrame:
    """word, c over whole texts; the end of a text is the empty word."""

    def run(batches):
        held = Counter()
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            for body in bodies:
                held.update(words_of(body))
            held[END] += len(bodies)
            if len(held) > _HELD:
                yield _rows(held)
                held = Counter()
        yield _rows(held)

    def _rows(held):
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    parts = _bodies(docs).mapInArrow(run, "word binary, n bigint").where("n > 0")
    return parts.groupBy("word").agg(F.sum("n").alias("c"))


def word_bigrams(docs: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """a, b, n: how often a word is followed by another. ids: clustered words; open words are m, the end m + 1."""
    m = len(ids)
    k = m + 2

    def run(batches):
        total, flat = np.zeros(k * k, np.int64), []

        def add():
            x = np.array([m + 1, *flat], np.int64)
            total[:] += np.bincount(x[:-1] * k + x[1:], minlength=k * k)
            flat.clear()

        for batch in batches:
            for body in batch.column("body").to_pylist():
                flat.extend(ids.get(w, m) for w in words_of(body))
                flat.append(m + 1)
                if len(flat) > 1_000_000:
                    add()
        if flat:
            add()
        some = np.flatnonzero(total)
        for at in range(0, len(some), 100_000):
            x = some[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(x // k), pa.array(x % k), pa.array(total[x])], names=["a", "b", "n"])

    parts = _bodies(docs).mapInArrow(run, "a bigint, b bigint, n bigint")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _xlx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def likelihood(table: np.ndarray) -> float:
    """What exchange raises: class bigrams against their two margins."""
    return float(_xlx(table).sum() - _xlx(table.sum(axis=0)).sum() - _xlx(table.sum(axis=1)).sum())


def best_class(table: np.ndarray, own: int, right: np.ndarray, left: np.ndarray, itself: int, free: int) -> int:
    """The class among the first `free` where a word of class `own` raises the likelihood most.

    right[c], left[c]: how often class c follows, precedes the word; itself: how often it follows itself.
    """
    table, right, left = table.astype(float), right.astype(float), left.astype(float)
    table[own, :] -= right
    table[:, own] -= left
    table[own, own] += itself
    right, left = right.copy(), left.copy()
    right[own] -= itself
    left[own] -= itself
    n_out, n_in = right.sum() + itself, left.sum() + itself
    # Margins already with what the word's neighbours add, wherever it goes.
    rows, cols = table.sum(axis=1) + left, table.sum(axis=0) + right
    gain = (_xlx(table + right[None, :]) - _xlx(table)).sum(axis=1) + (_xlx(table + left[:, None]) - _xlx(table)).sum(axis=0)
    d = np.diag(table)
    gain += _xlx(d + right + left + itself) + _xlx(d) - _xlx(d + right) - _xlx(d + left)
    gain -= _xlx(rows + n_out) - _xlx(rows) + _xlx(cols + n_in) - _xlx(cols)
    gain = gain[:free]
    return own if gain[own] >= gain.max() - 1e-9 else int(gain.argmax())


def exchange(bigrams: DataFrame, words: int, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each clustered word, then of open words and the end; and the class bigram counts."""
    spark = bigrams.sparkSession
    k = classes + 2
    of = np.concatenate([np.arange(words) % classes, [classes, classes + 1]])
    best = None
    for turn in range(rounds + 1):
        names = spark.createDataFrame(pa.table({"id": np.arange(len(of)), "class": of}))
        named = bigrams.join(names.toDF("a", "ca"), "a").join(names.toDF("b", "cb"), "b")
        table = np.zeros((k, k), np.int64)
        for r in named.groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
            table[r.ca, r.cb] = r.n
        value = likelihood(table)
        if best is None or value > best[0]:
            best = value, of, table
        if turn == rounds or not words:
            break
        profile = (
            named.select("n", "a", "b", "ca", "cb", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("side"))
            .where("side < 2 or a = b")
            .select(F.expr("if(side = 1, b, a)").alias("w"), "side", F.expr("if(side = 0, cb, ca)").alias("c"), "n")
            .where(F.col("w") < words)
            .groupBy("w", "side", "c").agg(F.sum("n").alias("n"))
            .toArrow()
        )
        of = moved(of, table, *(profile.column(c).to_numpy() for c in ("w", "side", "c", "n")), classes)
    return best[1], best[2]


def moved(of: np.ndarray, table: np.ndarray, w: np.ndarray, side: np.ndarray, c: np.ndarray, n: np.ndarray, classes: int) -> np.ndarray:
    """Classes after each word, most frequent first, has gone where it fits best.

    The class bigrams follow every move; the words' own counts by class (at most three per
    word and class: after it, before it, with itself) are those of the start of the round.
    """
    of, table, k = of.copy(), table.astype(float), classes + 2
    seen = np.zeros((3, len(of), k), np.int64)
    np.add.at(seen, (side, w, c), n)
    for word in range(len(of) - 2):
        own, right, left, itself = int(of[word]), seen[0, word], seen[1, word], int(seen[2, word].sum())
        new = best_class(table, own, right, left, itself, classes)
        if new != own:
            for to, sign in ((own, -1), (new, 1)):
                table[to, :] += sign * right
                table[:, to] += sign * left
            # The word with itself stands in both its row and its column.
            table[own, own] += itself
            table[new, own] -= itself
            table[own, new] -= itself
            table[new, new] += itself
            of[word] = new
    return of


# A count in a word's vector: which class before or after it, and how often.
_CELL = np.dtype([("cell", "<u2"), ("n", "<u4")])
_PROFILE = "word binary, cells binary"


class _Tally:
    """How often each whole number has come."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.size += len(self.parts[-1][0])
            if self.size > 8_000_000 and len(self.parts) > 1:
                self.parts = [self.merged()]
                self.size = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in self.parts])).astype(np.int64)


def _vectors(keys: np.ndarray, counts: np.ndarray, width: int, names) -> Iterator[pa.RecordBatch]:
    """Rows of (word, cells) from counts by word * width + cell."""
    owner = keys // width
    start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(keys) else np.zeros(0, np.int64)
    cells = np.empty(len(keys), _CELL)
    cells["cell"], cells["n"] = keys % width, counts
    end = np.concatenate([start[1:], [len(keys)]])
    for at in range(0, len(start), 50_000):
        lo, hi = start[at : at + 50_000], end[at : at + 50_000]
        offsets = (np.concatenate([lo, hi[-1:]]) - lo[0]) * _CELL.itemsize
        column = pa.Array.from_buffers(
            pa.binary(), len(lo), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(cells[lo[0] : hi[-1]].tobytes())]
        )
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in owner[lo].tolist()], pa.binary()), column], names=["word", "cells"])


def neighbours(docs: DataFrame, words: list[bytes], of: np.ndarray, first: int, tail: bool, classes: int) -> DataFrame:
    """word, cells: how often each class stands after and before a word; and a row without a word with the class bigrams.

    ``of`` has the classes of ``words`` (open at first). Counted are the words from the ``first`` on or, with
    ``tail``, those that are not among ``words``. Cells: k + 1 classes after the word, then as many
    before it; the last of them is a neighbour that is not among ``words``. The bigrams are those within ``words`` and ends.
    """
    k = classes + 2
    width = 2 * (k + 1)
    ids = {w: i for i, w in enumerate(words)}
    h = len(words)
    # Beyond the words: the end, then whatever is not among them.
    class_of = np.concatenate([of, [classes + 1, k]]).astype(np.int64)

    def run(batches):
        local: dict[bytes, int] = {}
        held, table, flat, others = _Tally(), np.zeros(k * k, np.int64), [], []

        def add():
            x = np.array([h, *flat], np.int64)
            c = class_of[x]
            known = (c[:-1] < k) & (c[1:] < k)
            table[:] += np.bincount((c[:-1] * k + c[1:])[known], minlength=k * k)
            if tail:
                at = np.flatnonzero(x == h + 1)
                own = np.array([local.setdefault(w, len(local)) for w in others], np.int64)
            else:
                at = np.flatnonzero((x >= first) & (x < h))
                own = x[at]
            held.add(np.concatenate([own * width + c[at + 1], own * width + k + 1 + c[at - 1]]))
            flat.clear()
            others.clear()

        for batch in batches:
            for body in batch.column("body").to_pylist():
                found = words_of(body)
                got = [ids.get(w, h + 1) for w in found]
                if tail:
                    others.extend(w for w, i in zip(found, got, strict=True) if i > h)
                flat.extend(got)
                flat.append(h)
                if len(flat) > 1_000_000:
                    add()
                    if len(local) > _HELD:
                        yield from _vectors(*held.merged(), width, list(local))
                        held, local = _Tally(), {}
        if flat:
            add()
        yield from _vectors(*held.merged(), width, list(local) if tail else words)
        cells = np.empty(k * k, _CELL)
        some = np.flatnonzero(table)
        cells = cells[: len(some)]
        cells["cell"], cells["n"] = some, table[some]
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([cells.tobytes()], pa.binary())], names=["word", "cells"])

    return _bodies(docs).mapInArrow(run, _PROFILE)


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Vectors of cells added up: per task first, then a row per cell."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("cells").to_pylist()), _CELL)
            np.add.at(total, x["cell"], x["n"].astype(np.int64))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["cell", "n"])

    out = np.zeros(size, np.int64)
    for r in rows.select("cells").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out


def fitting(table: np.ndarray, classes: int) -> np.ndarray:
    """What one neighbour in a cell says for each class: the log probability of the pair, less that of the class."""
    t = np.log(table + 0.5)
    rows, cols = np.log((table + 0.5).sum(axis=1)), np.log((table + 0.5).sum(axis=0))
    after = t[:classes].T - rows[:classes]
    before = t[:, :classes] - cols[:classes]
    # A neighbour that is not among the words counts as open.
    return np.vstack([after, after[classes], before, before[classes]])


def joined(profiles: DataFrame, table: np.ndarray, classes: int, least: int) -> DataFrame:
    """word, c, class (open: ``classes``) of each word in profiles; and rows without a word, with what classes have in cells."""
    k = classes + 2
    width = 2 * (k + 1)
    weights = fitting(table, classes)

    def run(batches):
        sums = np.zeros((classes + 1, width), np.int64)

        def decided(words, counts):
            c = counts[:, : k + 1].sum(axis=1)
            own = np.where(c >= least, (counts @ weights).argmax(axis=1), classes)
            np.add.at(sums, own, counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(c), pa.array(own, pa.int32()), pa.nulls(len(words), pa.binary())], names=["word", "c", "class", "cells"]
            )

        last, carried = None, None
        for batch in batches:
            words, cells = batch.column("word").to_pylist(), batch.column("cells").to_pylist()
            if not words:
                continue
            new = np.ones(len(words), bool)
            new[1:] = [a != b for a, b in zip(words[1:], words, strict=False)]
            owner = np.cumsum(new) - 1
            x = np.frombuffer(b"".join(cells), _CELL)
            counts = np.zeros((owner[-1] + 1, width), np.int64)
            np.add.at(counts, (np.repeat(owner, [len(v) // _CELL.itemsize for v in cells]), x["cell"]), x["n"].astype(np.int64))
            names = [w for w, n in zip(words, new.tolist(), strict=True) if n]
            # A word may go on in the next batch.
            if last is not None and names[0] == last:
                counts[0] += carried
            elif last is not None:
                yield decided([last], carried[None])
            if len(names) > 1:
                yield decided(names[:-1], counts[:-1])
            last, carried = names[-1], counts[-1]
        if last is not None:
            yield decided([last], carried[None])
        some = np.flatnonzero(sums.reshape(-1))
        whole = np.empty(len(some), _CELL)
        whole["cell"], whole["n"] = some, sums.reshape(-1)[some]
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.binary()), pa.array([None], pa.int64()), pa.array([None], pa.int32()), pa.array([whole.tobytes()], pa.binary())],
            names=["word", "c", "class", "cells"],
        )

    rows = profiles.where("word is not null").repartition("word").sortWithinPartitions("word")
    return rows.mapInArrow(run, "word binary, c bigint, class int, cells binary")


@dataclass
class ClassModel:
    counts: DataFrame  # word, c
    total: int  # N
    distinct: int  # V
    head: dict[bytes, tuple[int, int]]  # frequent words: count, id (open words: len(emit))
    of: np.ndarray  # class by id, then of open words and the end
    step: np.ndarray  # log10 p(class | class)
    emit: np.ndarray  # log10 p(word | class) by id
    tail: DataFrame  # word, c, class of all other words
    share: np.ndarray  # by class, log10 of what the count of a word and a half are divided by; open words too
    classed: int  # training tokens whose word has a class


def _frequent(counts: DataFrame, head: int) -> list:
    """The most frequent words. Those of too small a count are left out by a histogram of counts before any are sorted."""
    words = counts.where(F.length("word") > 0).withColumn("step", F.floor(F.log2(F.col("c").cast("double")) * 8))
    sizes = sorted(((r.step, r.n) for r in words.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    lowest, have = 0, 0
    for step, n in sizes:
        lowest, have = step, have + n
        if have >= head:
            break
    return words.where(F.col("step") >= lowest).orderBy(F.desc("c"), "word").limit(head).select("word", "c").collect()


def train(
    docs: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES, head: int = HEAD, rounds: int = ROUNDS, least: int = LEAST
) -> ClassModel:
    counts = stored(token_counts(docs), "lm-counts")
    n = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    k = classes + 2
    width = 2 * (k + 1)
    top = [(bytes(r.word), r.c) for r in _frequent(counts, head)]
    words = [w for w, _ in top]
    m = min(clustered, len(words))
    bigrams = stored(word_bigrams(docs, {w: i for i, w in enumerate(words[:m])}), "lm-bigrams")
    of, table = exchange(bigrams, m, classes, rounds)

    # The other frequent words, then all the rest.
    own = np.concatenate([of[:m], np.full(len(words) - m, classes)]).astype(np.int64)
    if len(words) > m:
        found = joined(neighbours(docs, words, own, m, False, classes), table, classes, least)
        known = {bytes(r.word): r["class"] for r in found.where("word is not null").select("word", "class").collect()}
        own[m:] = [known[w] for w in words[m:]]
    profiles = stored(neighbours(docs, words, own, len(words), True, classes), "lm-neighbours")
    table = _summed(profiles.where("word is null"), k * k).reshape(k, k)
    tail = stored(joined(profiles, table, classes, least), "lm-tail")
    sums = _summed(tail.where("word is null"), (classes + 1) * width).reshape(classes + 1, width)
    # A pair of two rare words is counted with the first of them.
    table[: classes + 1] += sums[:, :k]
    table[: classes + 1, classes] += sums[:, k]
    table[:, : classes + 1] += sums[:, k + 1 : 2 * k + 1].T
    tail = tail.where("word is not null").select("word", "c", "class")

    per, margin = table.sum(axis=0), table.sum(axis=1)
    alone = (per + 0.5) / (per.sum() + 0.5 * len(per))
    step = np.log10((table + 2.0 * alone[None, :]) / (margin[:, None] + 2.0))
    c = np.array([x for _, x in top], float)
    total, members = np.bincount(own, c, classes + 1), np.bincount(own, minlength=classes + 1)
    for r in tail.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        total[r["class"]] += r.c
        members[r["class"]] += r.n
    members[classes] += 1  # a word never seen
    share = np.log10(total + 0.5 * members, out=np.zeros(classes + 1), where=total + members > 0)
    with_class = own < classes
    ids = np.where(with_class, np.cumsum(with_class) - 1, with_class.sum())
    emit = np.log10(c + 0.5)[with_class] - share[own[with_class]]
    return ClassModel(
        counts, n.total, n.distinct, {w: (x, int(i)) for (w, x), i in zip(top, ids, strict=True)}, np.concatenate([own[with_class], [classes, classes + 1]]),
        step, emit, tail, share, int(total[:classes].sum()),
    )


def scores(docs: DataFrame, model: ClassModel) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10 of the text's probability), one row per row of docs."""
    m = len(model.emit)
    floor = math.log10(model.total + 0.5 * (model.distinct + 1))
    head, of, step, emit, share = model.head, model.of, model.step, model.emit, model.share
    is_open = len(share) - 1
    ends = float(model.counts.where(F.length("word") == 0).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    emitted = np.concatenate([emit, [0.0]])
    waits = 255  # in a path: a word whose class comes with the join

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("model", pa.float64()),
                            ("path", pa.binary()), ("which", pa.binary()), ("words", pa.list_(pa.binary()))])
        for batch in batches:
            out = [[] for _ in schema]
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                words = words_of(body)
                n = len(words)
                got = [head.get(w) for w in words]
                tail: dict[bytes, int] = {}
                which = np.array([tail.setdefault(w, len(tail)) for w, g in zip(words, got, strict=True) if g is None], np.int32)
                ids = np.fromiter((-1 if g is None else g[1] for g in got), np.int64, n)
                c = np.fromiter((0 if g is None else g[0] for g in got), float, n)
                known = ids >= 0
                path = np.where(known, of[ids], waits).astype(np.uint8)
                opened = ids == m
                base = float(np.log10(c[known] + 0.5).sum()) + math.log10(ends + 0.5) - (n + 1) * floor
                value = float(emitted[ids[known]].sum()) + float(np.log10(c[opened] + 0.5).sum()) - int(opened.sum()) * float(share[is_open])
                row = (doc_id, n + 1, int(known.sum()) + (ends > 0), base, value, path.tobytes(), which.tobytes(), list(tail))
                for column, v in zip(out, row, strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    parts = _bodies(docs, F.col("doc_id")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, base double, model double, path binary, which binary, words array<binary>"
    )
    parts = stored(parts.withColumn("row", F.monotonically_increasing_id()), "lm-parts")
    asked = parts.select("row", F.posexplode("words").alias("at", "word"))
    met = asked.join(model.tail, "word").groupBy("row").agg(F.collect_list(F.struct("at", "c", "class")).alias("met"))
    whole = parts.select("row", "doc_id", "n_tokens", "n_known", "base", "model", "path", "which", F.size("words").alias("distinct")).join(met, "row", "left")
    end = step.shape[0] - 1

    def finish(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            found, sizes = batch.column("met"), batch.column("distinct").to_numpy()
            at_row = np.cumsum(sizes) - sizes
            counts, own = np.zeros(sizes.sum()), np.full(sizes.sum(), is_open)
            flat = found.flatten()
            row = np.repeat(np.arange(n), found.value_lengths().fill_null(0).to_numpy())
            place = at_row[row] + flat.field("at").to_numpy()
            counts[place], own[place] = flat.field("c").to_numpy(), flat.field("class").to_numpy()
            # Which of its rare words a row has, one after another; then all paths in a row, an end between any two.
            which = batch.column("which").to_pylist()
            row = np.repeat(np.arange(n), [len(w) // 4 for w in which])
            place = at_row[row] + np.frombuffer(b"".join(which), np.int32)
            paths = batch.column("path").to_pylist()
            mark = bytes([end])
            path = np.frombuffer(mark + mark.join(paths) + mark, np.uint8).astype(np.int64)
            path[path == waits] = own[place]
            of_row = lambda values: np.bincount(row, values, n)
            steps = np.add.reduceat(step[path[:-1], path[1:]], np.cumsum([0] + [len(p) + 1 for p in paths[:-1]]))
            add = of_row(np.log10(counts + 0.5)[place])
            known = batch.column("n_known").to_numpy() + of_row(counts[place] > 0).astype(np.int64)
            value = batch.column("model").to_numpy() + add - of_row(share[own[place]]) + steps
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), pa.array(known), pa.array(batch.column("base").to_numpy() + add), pa.array(value)],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    small_batches(docs.sparkSession)
    rows = whole.select("doc_id", "n_tokens", "n_known", "base", "model", "path", "which", "distinct", "met")
    return rows.mapInArrow(finish, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
