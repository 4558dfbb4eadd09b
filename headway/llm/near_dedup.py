"""MinHash near-duplicates with tensored banding.

Each text is the set of its distinct 5-word shingles. Two small collections of
``keys`` sub-keys, each over ``width`` minhashes, are computed per text; table
(i, j) is keyed by the pair of left sub-key i and right sub-key j. So keys^2
tables of 2 * width minhashes each cost 2 * keys * width minhashes instead of
2 * width * keys^2. At the defaults a pair of Jaccard 0.75 misses all 256
tables with probability 2 * (1 - 0.75^2)^16 < 4e-6.

Sub-keys that no other text has cannot meet anyone and are dropped, and so is a text with
fewer than ``SHARED`` others. In each table every member meets
the smallest and the largest member only, and is compared with the ``STAR`` of these it meets
in most tables; links are confirmed on the full
sets and joined to components. Texts in tables
that still hold several components are then compared across these components, where
they share one of their rarest shingles: a set and one of Jaccard 0.75 share one of the
rarest quarter of each. No pair of them is a row. Texts that share such shingles are sent
to one home, in blocks of bounded size, any two blocks in one task; there each text at home is
compared with all others on full sets, and only links that join two components leave the
task. So in a group just below the threshold, rows grow with the group until it fills a block of
``BLOCK_TEXTS``, and then with the number of its blocks. No link between components is lost.

Nulls and ties: a NULL text and a text without words have no shingles and link
with nothing. Rows that share a doc_id are one document. Rows with a NULL doc_id
are returned with a NULL component, kept. Empty table: no rows. Other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import map_texts, mixed, shingle_hashes, signed, small_batches, split_runs, stored
from headway.llm.graph import components
from headway.operators.skew import one_per_key

KEYS, WIDTH = 16, 2
# Of 2 * KEYS sub-keys a pair of Jaccard 0.75 shares 18 on average; fewer than
# this has a chance below 1e-6.
SHARED = 5
# Members of its tables that a text is compared with before texts of several components meet.
STAR = 4
# Texts, and shingles of all of them, that a block holds.
BLOCK_TEXTS, BLOCK_SHINGLES = 2048, 2_000_000


def sketches(docs: DataFrame, keys: int = KEYS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, fp (fingerprint of the whole set), left and right sub-keys."""
    rng = np.random.default_rng(20240601)
    odd = rng.integers(0, 1 << 63, 2 * keys * width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, 2 * keys * width, dtype=np.uint64)
    salt = mixed(np.arange(1, 2 * keys + 1, dtype=np.uint64))

    def each(ids, texts):
        n, fp, left, right = [], [], [], []
        for s in split_runs(*shingle_hashes(texts)[:2]):
            s = np.unique(s)
            n.append(len(s))
            fp.append(xxhash.xxh3_128_digest(s.tobytes()))
            if not len(s):
                left.append(None)
                right.append(None)
                continue
            low = None
            with np.errstate(over="ignore"):
                for at in range(0, len(s), 2048):
                    part = (s[at : at + 2048, None] * odd + add).min(axis=0)
                    low = part if low is None else np.minimum(low, part)
                key = salt.copy()
                for j in range(width):
                    key = mixed(key + low.reshape(2 * keys, width)[:, j])
            left.append(signed(key[:keys]))
            right.append(signed(key[keys:]))
        return {"doc_id": ids, "n_shingles": n, "fp": fp, "left": left, "right": right}

    return map_texts(docs, each, "doc_id bigint, n_shingles bigint, fp binary, left array<bigint>, right array<bigint>")


def _sets(docs: DataFrame) -> DataFrame:
    def each(ids, texts):
        return {"doc_id": ids, "shingles": [np.unique(s).tobytes() for s in split_runs(*shingle_hashes(texts)[:2])]}

    return map_texts(docs, each, "doc_id bigint, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have the Jaccard similarity."""
    small_batches(pairs.sparkSession)
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")

    def run(batches):
        for batch in batches:
            a, b = [], []
            for x, y, p, q in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sa", "sb")), strict=True):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _across(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components of `rest` (rep, n_shingles, component) with the similarity.

    Shingles are ordered by how many texts of `rest` hold them, rarest first. Of a set
    of n, any set similar enough shares one of the first n - ceil(n * percent / 100) + 1.
    Shingles of one text only stand first and need not be looked at.
    """

    def run(batches):
        for batch in batches:
            owner, found = batch.column("rep").to_pylist(), [np.frombuffer(x, np.int64) for x in batch.column("shingles").to_pylist()]
            if owner:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(owner, np.int64), [len(x) for x in found])), pa.array(np.concatenate(found))], names=["rep", "h"]
                )

    small_batches(rest.sparkSession)
    tokens = rest.select("rep").join(sets.toDF("rep", "shingles"), "rep").mapInArrow(run, "rep bigint, h bigint")
    tokens = stored(tokens, "minhash-tokens")
    counts = tokens.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Own hashes are drawn once per text, so the list is as long as the text at most.
    lists = tokens.join(counts, "h").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("n", "h"))).alias("t")).join(rest, "rep")
    alone = F.col("n_shingles") - F.size("t")
    first = F.expr(f"n_shingles - (n_shingles * {percent} + 99) div 100 + 1") - alone
    prefix = lists.where(first > 0).select("rep", "component", F.explode(F.slice("t", F.lit(1), first.cast("int"))).alias("t"))
    prefix = stored(prefix.select(F.col("t.h").alias("h"), "component", "rep"), "minhash-prefix")

    several = one_per_key(prefix, ["h"], F.min("rep").alias("lo"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    met = prefix.select("h", "rep").join(several.where("c0 < c1").select("h", "lo"), "h")

    # A text is at home with the least text it shares a first shingle with, and visits the homes of
    # all others it shares one with. Near copies share a home, so each is sent there once, not once a shingle.
    home = met.groupBy("rep").agg(F.min("lo").alias("home"))
    homes = met.select("h", "rep").join(home, "rep").select("h", "home").distinct()
    visits = stored(met.select("h", "rep").join(one_per_key(homes, ["h", "home"]), "h").select("rep", "home").distinct(), "minhash-visits")
    facts = rest.select("rep", "n_shingles", "component").join(home.withColumnRenamed("home", "own"), "rep")
    guests = visits.join(facts, "rep").withColumn("at_home", F.col("home") == F.col("own"))
    sizes = one_per_key(guests, ["home"], F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("t"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_TEXTS), F.ceil(F.col("t") / BLOCK_SHINGLES)).cast("int")
    own_block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (
        guests.join(sizes.select("home", blocks.alias("blocks")), "home")
        .withColumn("block", own_block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("home", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component", "at_home")
    )
    dealt = dealt.join(sets.toDF("rep", "shingles"), "rep").repartition("home", "i", "j").sortWithinPartitions("home", "i", "j")

    def link(batches):
        held, at = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("home", "i", "j", "block", "rep", "component", "at_home", "shingles")), strict=True):
                if row[:3] != at:
                    if held:
                        yield _spanning(held, at[1], at[2], percent)
                    held, at = [], row[:3]
                held.append(row[3:])
        if held:
            yield _spanning(held, at[1], at[2], percent)

    return dealt.mapInArrow(link, "a bigint, b bigint")


def _spanning(rows: list[tuple], i: int, j: int, percent: int) -> pa.RecordBatch:
    """Links between the components of some texts (block, rep, component, at_home, shingles): those that join what
    was apart, so fewer than there are texts. Texts of block i meet those of block j."""
    sets = [np.frombuffer(r[4], np.uint64) for r in rows]
    words, ids = np.unique(np.concatenate(sets), return_inverse=True)
    n = np.array([len(x) for x in sets])
    shared = np.bincount(ids, minlength=len(words)) > 1
    ids = np.split(ids, np.cumsum(n)[:-1])
    ids = [x[shared[x]] for x in ids]
    roots = {r[2]: r[2] for r in rows}

    def root(c: int) -> int:
        while roots[c] != c:
            roots[c] = c = roots[roots[c]]
        return c

    a, b = [], []
    block = np.array([r[0] for r in rows])
    held = np.zeros(len(words), bool)
    for mine, theirs in {(i, j), (j, i)}:
        others = np.flatnonzero(block == theirs)
        others = others[[len(ids[k]) > 0 for k in others]] if len(others) else others
        if not len(others):
            continue
        flat = np.concatenate([ids[k] for k in others])
        starts = np.cumsum([0] + [len(ids[k]) for k in others[:-1]])
        for x in np.flatnonzero(block == mine).tolist():
            if not rows[x][3]:
                continue
            held[ids[x]] = True
            both = np.add.reduceat(held[flat].view(np.int8), starts, dtype=np.int64)
            held[ids[x]] = False
            for y in others[100 * both >= percent * (n[x] + n[others] - both)].tolist():
                p, q = root(rows[x][2]), root(rows[y][2])
                if p != q:
                    roots[max(p, q)] = min(p, q)
                    a.append(min(rows[x][1], rows[y][1]))
                    b.append(max(rows[x][1], rows[y][1]))
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, percent: int = 75, keys: int = KEYS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id), kept, set_id."""
    sketch = stored(sketches(docs.select("doc_id", "text"), keys, width), "minhash")
    some = sketch.where(F.col("n_shingles").cast("boolean") & F.col("doc_id").isNotNull())

    # Equal sets are one class; its smallest doc_id stands for it from here on.
    classes = stored(
        some.groupBy("n_shingles", "fp").agg(F.min("doc_id").alias("rep"), F.first("left").alias("left"), F.first("right").alias("right")),
        "minhash-classes",
    )
    sub = classes.select("rep", F.explode(F.concat(
        F.transform("left", lambda k: F.struct(F.lit(True).alias("is_left"), k.alias("key"))),
        F.transform("right", lambda k: F.struct(F.lit(False).alias("is_left"), k.alias("key"))),
    )).alias("k")).select("rep", "k.is_left", "k.key")
    met = sub.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    side = lambda flag: F.collect_list(F.when(F.col("is_left") == F.lit(flag), F.col("key")))
    shared = (
        sub.join(met, "key", "left_semi")
        .groupBy("rep")
        .agg(side(True).alias("left"), side(False).alias("right"))
        .where((F.size("left") > 0) & (F.size("right") > 0) & (F.size("left") + F.size("right") >= SHARED))
    )
    shared = stored(shared.join(classes.select("rep", "n_shingles"), "rep"), "minhash-shared")
    rows = shared.select("rep", "n_shingles", "right", F.explode("left").alias("l")).select(
        "rep", "n_shingles", F.explode(F.transform("right", lambda r: F.xxhash64("l", r))).alias("key")
    )
    ends = rows.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    tables = stored(rows.join(ends, "key"), "minhash-tables")

    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    sets = stored(_sets(texts.join(tables.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")), "minhash-sets")

    # Of the ends of its tables a text is compared with those it shares most tables with.
    met = tables.select("rep", F.explode(F.array("lo", "hi")).alias("other")).where("rep <> other").groupBy("rep", "other").agg(F.count(F.lit(1)).alias("n"))
    likely = F.slice(F.sort_array(F.collect_list(F.struct("n", "other")), asc=False), 1, STAR)
    star = met.groupBy("rep").agg(likely.alias("likely")).select("rep", F.explode("likely.other").alias("other"))
    star = stored(star.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct(), "minhash-star")
    first = stored(_confirmed(star, sets, percent), "minhash-links")
    found = components(first)

    # What is left: tables with members of several components.
    own = tables.select("key", "rep", "n_shingles").join(found.toDF("rep", "component"), "rep", "left")
    own = own.withColumn("component", F.coalesce("component", "rep"))
    several = own.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("key")
    rest = stored(own.join(several, "key", "left_semi").drop("key").distinct(), "minhash-rest")
    more = stored(_across(rest, sets, percent), "minhash-more")
    if not more.isEmpty():
        found = components(first.union(more))

    of_class = classes.select("n_shingles", "fp", "rep").join(found.toDF("rep", "component"), "rep", "left").select(
        "n_shingles", "fp", F.col("rep").alias("set_id"), F.coalesce("component", "rep").alias("component")
    )
    out = sketch.select("doc_id", "n_shingles", "fp").join(of_class, ["n_shingles", "fp"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.cast("bigint").alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id"),
    )
