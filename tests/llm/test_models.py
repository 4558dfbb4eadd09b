"""Top-k, class model, quality, chat, mixing, pipeline, and the queries against their SQL."""

from __future__ import annotations

import hashlib
import math
import os
import random
from collections import Counter, defaultdict
from zlib import crc32

import brute
import numpy as np
import oracle
import pytest

import corpus_pipeline
from headway.llm import chat, class_lm, exact_topk, mixing, quality
from headway.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_query(spark, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), ORACLE[name]) is None


# --- top-k ---
VECTORS = "vec_id bigint, embedding array<double>, v string, cg int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS).repartition(4)


def ranked(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


@pytest.mark.parametrize("dims", [1, 7, 8, 40])
def test_top_k(spark, monkeypatch, dims):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_topk, "GROUP_ROWS", 150)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 9)
    rng = np.random.default_rng(dims)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, dims) * 0.5 ** (np.arange(dims) / 8)]) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # one very common vector
    got = ranked(exact_topk.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == brute.top_k([(i, [math.floor(256 * x) for x in v]) for i, v in rows], lambda i: i % 20 == 0)


def test_top_k_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [9.0, 9.0]), (5, [1.0]), (6, []), (7, [0.0, 1.0]), (7, [0.0, 1.0])]
    got = ranked(exact_topk.top_k(vectors(spark, rows), F.col("vec_id") % 5 == 0))
    assert got == {0: [(7, 131072), (7, 131072), (5, 65536), (6, 0)], 5: [(0, 65536), (6, 0), (7, 0), (7, 0)]}
    large = [(0, [1e12, 1.0]), (1, [1e12, 1.0]), (2, [-1e12, 5.0]), (3, [1e12, 2.0])]
    got = ranked(exact_topk.top_k(vectors(spark, large), F.col("vec_id") == 0))
    assert got[0] == [(1, (1 << 63) - 1), (3, (1 << 63) - 1), (2, -(1 << 63))]
    assert exact_topk.top_k(vectors(spark, []), F.lit(True)).count() == 0
    assert exact_topk.top_k(vectors(spark, [(1, [1.0])]), F.lit(True)).count() == 0


# --- class model ---
DOCS = "doc_id bigint, text string, source string, c bigint, row bigint, word string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, s, 1, 2, "w") for i, t, s in texts], DOCS).repartition(3)


def grammar(n, seed=0):
    """Three kinds of words that follow each other in turn."""
    r = random.Random(seed)
    return [(i, " ".join(f"{'abc'[j % 3]}{r.randrange(30)}" for j in range(r.randrange(1, 80))), "s") for i in range(n)]


def test_base_score_and_model(spark):
    texts = [*grammar(300), (500, None, "s"), (501, "", "s"), (501, "", "s"), (502, "never seen words", "s"), (None, "a1 b2", "s"), (504, "A1\x0bb2 " * 20_000, "s")]
    train = [t for t in texts if t[0] is None or crc32(str(t[0]).encode()) % 5 != 1]
    model = class_lm.train(documents(spark, train), clustered=60, classes=3, head=70, rounds=12)
    got = class_lm.scores(documents(spark, texts), model).collect()
    c = Counter(w for _, t, _ in train for w in [*brute.words(t), ""])
    n, v = sum(c.values()), len(c)
    assert (model.total, model.distinct) == (n, v)
    want = sorted(
        (i or -1, len(w) + 1, sum(c[x] > 0 for x in [*w, ""]), round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, ""]), 5))
        for i, t, _ in texts for w in [brute.words(t)]
    )
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    # Classes tell which kind comes next, so the model beats single words clearly.
    held = [r for r in got if r.doc_id and crc32(str(r.doc_id).encode()) % 5 == 1 and r.doc_id < 300]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)
    kinds = defaultdict(Counter)
    for word, (_, i) in model.head.items():
        if i < 60:
            kinds[int(model.of[i])][word[:1]] += 1
    assert sum(max(k.values()) for k in kinds.values()) >= 55


def word_table(model):
    """word -> (count, class, log10 of its probability in the class), for all words the model knows."""
    m, is_open = len(model.emit), len(model.share) - 1
    out = {w: (c, int(model.of[i]) if i < m else is_open) for w, (c, i) in model.head.items()}
    out |= {bytes(r.word): (r.c, r["class"]) for r in model.tail.collect()}
    return {w: (c, k, math.log10(c + 0.5) - model.share[k]) for w, (c, k) in out.items()}


@pytest.mark.parametrize(("clustered", "head"), [(20, 40), (10, 15), (0, 0)])
def test_probabilities_sum_to_one(spark, clustered, head):
    texts = grammar(60, 5)
    model = class_lm.train(documents(spark, texts), clustered=clustered, classes=4, head=head, rounds=2)
    m, total = len(model.emit), 10.0**model.step
    assert total.sum(axis=1) == pytest.approx(np.ones(6))
    known = word_table(model)
    counts = {bytes(r.word): r.c for r in model.counts.collect()}
    assert {w: c for w, (c, _, _) in known.items()} == {w: c for w, c in counts.items() if w} and len(model.head) <= head
    assert all((k == 4) == (c < class_lm.LEAST) for w, (c, k, _) in known.items() if w not in model.head)
    for k in range(5):
        members = [10**p for _, own, p in known.values() if own == k]
        unseen = 10 ** (math.log10(0.5) - model.share[4]) if k == 4 else 0
        assert not members or sum(members) + unseen == pytest.approx(1)
    assert model.emit == pytest.approx(np.array([known[w][2] for w, (_, i) in sorted(model.head.items(), key=lambda x: x[1][1]) if i < m]))
    assert model.classed == sum(c for c, k, _ in known.values() if k < 4)


@pytest.mark.parametrize(("clustered", "head"), [(60, 70), (8, 10), (8, 1000), (0, 0)])
def test_score_is_the_path_through_the_classes(spark, clustered, head):
    texts = [*grammar(80), (500, None, "s"), (501, " ", "s"), (502, "never seen a1 words", "s"), (None, "b2 a1", "s")]
    model = class_lm.train(documents(spark, texts[:60]), clustered=clustered, classes=3, head=head, rounds=3)
    known, want = word_table(model), []
    for i, text, _ in texts:
        path, value = [4], 0.0
        for w in brute.words(text):
            c, k, p = known.get(w.encode(), (0, 3, math.log10(0.5) - model.share[3]))
            path.append(k)
            value += p
        path.append(4)
        want.append((i or -1, round(value + sum(model.step[a, b] for a, b in zip(path, path[1:], strict=False)), 6)))
    got = [(r.doc_id or -1, round(r.score, 6)) for r in class_lm.scores(documents(spark, texts), model).collect()]
    got, want = sorted(got), sorted(want)
    assert [i for i, _ in got] == [i for i, _ in want] and [x for _, x in got] == pytest.approx([x for _, x in want])


def test_class_bigrams_are_counts_of_the_corpus(spark):
    """Where every word that has a class is among the frequent ones, to the last pair; and else but for pairs of two rare words."""
    texts = grammar(80)
    for head in (1000, 12):
        model = class_lm.train(documents(spark, texts), clustered=8, classes=3, head=head, rounds=2)
        known = word_table(model)
        table, unclear = np.zeros((5, 5), int), 0
        for _, text, _ in texts:
            words = brute.words(text)
            path = [4, *(known[w.encode()][1] for w in words), 4]
            for n, (a, b) in enumerate(zip(path, path[1:], strict=False)):
                rare = 0 < n < len(words) and all(w.encode() not in model.head for w in words[n - 1 : n + 1])
                table[a, 3 if rare else b] += 1
                unclear += rare
        per, margin = table.sum(axis=0), table.sum(axis=1)
        alone = (per + 0.5) / (per.sum() + 2.5)
        assert model.step == pytest.approx(np.log10((table + 2.0 * alone) / (margin[:, None] + 2.0)))
        assert (unclear > 0) == (head == 12)


def test_words_join_the_class_of_their_neighbours():
    """Against the likelihood of the neighbours, one word at a time."""
    rng = np.random.default_rng(3)
    classes, k = 4, 6
    table = rng.integers(0, 50, (k, k))
    weights = class_lm.fitting(table, classes)
    t = table + 0.5
    for _ in range(50):
        right, left = rng.integers(0, 4, k + 1), rng.integers(0, 4, k + 1)
        values = []
        for c in range(classes):
            after = sum(n * math.log(t[c, j if j < k else classes] / t[c].sum()) for j, n in enumerate(right))
            before = sum(n * math.log(t[j if j < k else classes, c] / t[:, c].sum()) for j, n in enumerate(left))
            values.append(after + before)
        assert np.concatenate([right, left]) @ weights == pytest.approx(np.array(values))


def test_best_class_is_the_best(spark):
    """Gains against moving the word and counting anew."""
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, k = 12, 4
        pairs = rng.integers(0, 6, (n, n)) * (rng.random((n, n)) < 0.5)
        of = rng.integers(0, k, n)

        def table(of, pairs=pairs, n=n, k=k):
            out = np.zeros((k, k), np.int64)
            np.add.at(out, (of[:, None].repeat(n, 1), of[None, :].repeat(n, 0)), pairs)
            return out

        for w in range(n):
            right = np.bincount(of, pairs[w], k).astype(np.int64)
            left = np.bincount(of, pairs[:, w], k).astype(np.int64)
            got = class_lm.best_class(table(of), int(of[w]), right, left, int(pairs[w, w]), k)
            values = [class_lm.likelihood(table(np.where(np.arange(n) == w, c, of))) for c in range(k)]
            assert values[got] == pytest.approx(max(values))


def test_class_model_of_nothing(spark):
    model = class_lm.train(documents(spark, []))
    assert class_lm.scores(documents(spark, []), model).count() == 0
    row = class_lm.scores(documents(spark, [(1, "a b", "s")]), model).first()
    assert (row.n_tokens, row.n_known) == (3, 0) and row.base_score == pytest.approx(0) and math.isfinite(row.score)


# --- quality ---
def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.rsplit('/', 1)[0]}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.97
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.99


def test_quality_never_sees_negatives_or_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    held_out = class_lm.remainder(3) == 1
    other = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality")).when(F.col("quality") == 0, None).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.quality_scores(docs, x).collect()} for x in (labels, other))
    assert a == pytest.approx(b)


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0, "t"), (1, 0, 0, "t"), (2, None, 0, "t"), (None, 1, 1, "t")], "doc_id bigint, quality int, toxic int, x string")
    texts = [(1, "some plain words here", "s"), (1, "some plain words here", "s"), (2, None, "s"), (None, "", "s"), (3, "ü " * 100_000, "s")]
    got = quality.quality_scores(documents(spark, texts), labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    none = quality.quality_scores(documents(spark, texts), labels.where("false")).collect()
    assert [r.score for r in none] == [0.5] * 5
    assert quality.quality_scores(documents(spark, []), labels).count() == 0


def test_quality_learns_from_a_sample_of_rows(spark, monkeypatch):
    """Ids with more rows than the sample: rows are drawn, not ids, and no more than the sample."""
    seen, fit = [], quality.fit
    monkeypatch.setattr(quality, "estimate_prior", lambda pos, unl: seen.append((pos, unl)) or 0.5)
    monkeypatch.setattr(quality, "fit", lambda pos, unl, prior: fit(pos, unl, prior))
    ids = [i for i in range(40) if crc32(str(i).encode()) % 3 != 1][:9]
    texts = [(i, " ".join(["word"] * (10 * j + n + 1)), "s") for j, i in enumerate([*ids, None]) for n in range(200)] + [(ids[0], "same text", "s")] * 300
    labels = spark.createDataFrame([(i, 1) for i in ids[:3]], "doc_id bigint, quality int")
    quality.train(documents(spark, texts), labels, sample=50)
    (pos, unl), = seen
    assert (len(pos), len(unl)) == (50, 50)


def test_prior_and_risk():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(2, 1, (4000, 3)), rng.normal(-2, 1, (4000, 3))
    one = lambda x: np.hstack([x, np.ones((len(x), 1))])
    for share in (0.3, 0.8):
        n = int(4000 * share)
        unl = np.vstack([rng.normal(2, 1, (n, 3)), rng.normal(-2, 1, (4000 - n, 3))])
        prior = quality.estimate_prior(one(pos), one(unl))
        assert abs(prior - share) < 0.05
        theta = quality.fit(one(pos), one(unl), prior)
        assert ((one(pos) @ theta) > 0).mean() > 0.97 and ((one(neg) @ theta) < 0).mean() > 0.97


# --- chat ---
MESSAGES = "tree_id bigint, node_id bigint, parent_id bigint, score double, role string, text string, leaf_id int, depth int, back int"


def messages(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1) for r in rows], MESSAGES)


def test_best_branches(spark):
    rows = [
        (1, 1, None, 0.0, "user", "root"), (1, 2, 1, 1.0, "assistant", "a"), (1, 3, 1, 3.0, "assistant", "b"), (1, 4, 2, 9.0, "user", "c"), (1, 5, 3, 1.0, "user", "d"),
        (1, 6, 3, 1.0, "user", "e"), (2, 1, 77, None, "user", "orphan"), (2, 9, 9, 0.0, "user", "own parent"),
        (3, 1, 2, 0.0, "user", "cycle"), (3, 2, 1, 0.0, "user", "cycle"), (3, 3, 2, 0.0, "user", "hangs from it"),
        (None, 1, None, 0.0, "user", "no tree"), (4, None, None, 0.0, "user", "no node"),
    ]
    out = chat.conversations(messages(spark, rows), keep=2).withColumn("back", chat.read_back())
    got = {(r.tree_id, r.branch): [t.text for t in r.back] for r in out.collect()}
    assert got == {(1, 1): ["root", "a", "c"], (1, 2): ["root", "b", "d"], (2, 1): ["orphan"], (2, 2): ["own parent"]}
    assert chat.conversations(messages(spark, [])).count() == 0


def test_every_path_of_a_random_forest(spark):
    r, rows, parent = random.Random(4), [], {}
    for tree in range(6):
        for node in range(60):
            parent[tree, node] = None if node == 0 else r.randrange(max(0, node - 4), node)
            rows.append((tree, node, parent[tree, node], float(r.randrange(5)), "user", f"{tree} {node}"))
    got = defaultdict(dict)
    for x in chat.paths(messages(spark, rows), keep=10**6).collect():
        got[x.tree_id, x.leaf_id][x.depth] = x.node_id
    want = {}
    for tree, node in parent:
        if (tree, node) not in {(t, p) for (t, _), p in parent.items()}:
            path, at = [], node
            while at is not None:
                path.insert(0, at)
                at = parent[tree, at]
            want[tree, node] = dict(enumerate(path))
    assert got == want


def test_escapes_are_reversible(spark):
    bits = ["[INST]", "[/INST]", "<s>", "</s>", "\\", "[", "<", "INST]", "/", "s>", "LF]", "\n", " ", "é", "\U0001f600", "[\\LF]", "[\\INST]", ""]
    r, rows = random.Random(8), []
    for i in range(120):
        for turn in range(4):
            text = "".join(r.choice(bits) for _ in range(r.randrange(9)))
            role = r.choice(["user", "assistant", "system", None, "".join(r.choice(bits) for _ in range(4))])
            rows.append((i, turn, turn - 1 if turn else None, 0.0, role, r.choice([text, text, None])))
    rows += [(900, t, t - 1 if t else None, 0.0, ("user", "assistant")[t % 2], "long " * 3000) for t in range(70)]
    out = chat.conversations(messages(spark, rows)).withColumn("back", chat.read_back()).withColumn("under", chat.loss_text())
    want = defaultdict(list)
    for i, _, _, _, role, text in rows:
        want[i].append((role or "", text or ""))
    for x in out.collect():
        assert [(t.role, t.text) for t in x.back] == want[x.tree_id]
        assert x.under == "".join(t for role, t in want[x.tree_id] if role == "assistant")
        assert hashlib.sha256(x.under.encode()).hexdigest()


def test_repeated_nodes_stay(spark):
    rows = [(1, 1, None, 0.0, "user", "b"), (1, 1, None, 0.0, "user", "a"), (1, 1, None, 0.0, "user", "a"), (1, 2, 1, 0.0, "user", "c")]
    out = chat.conversations(messages(spark, rows)).withColumn("back", chat.read_back()).collect()
    assert [[t.text for t in r.back] for r in out] == [["a", "a", "b", "c"]]


# --- mixing ---
@pytest.mark.parametrize("parts", [{"a": 1}, {"a": 1, "b": 1}, {"a": 5, "b": 2, "c": 1}, {"a": 61, "b": 40, "c": 17, "d": 9, "e": 1}])
def test_every_prefix_is_within_a_block(parts):
    pattern, total, seen = mixing.earliest_deadline_first(parts), sum(parts.values()), Counter()
    assert Counter(k for k, _ in pattern) == parts
    for t, (k, i) in enumerate(pattern, 1):
        assert i == seen[k] and i * total // parts[k] <= t - 1 < -(-(i + 1) * total // parts[k])
        seen[k] += 1
        assert all(abs(seen[x] - t * n / total) < 1 for x, n in parts.items())


def mixed_docs(n=900):
    r = random.Random(2)
    texts = [(i, "t", r.choice(["big"] * 6 + ["mid"] * 3 + ["low", None])) for i in range(n)]
    return [*texts, (5, "t", "big"), (5, "t", "big"), (None, None, "mid"), (None, "x", "zero")]


def test_schedule(spark):
    texts = mixed_docs()
    weights = {"big": 1.0, "mid": 2.0, "low": 0.5, None: 0.5}
    rows = mixing.schedule(documents(spark, texts), weights, block=4, period=64).collect()
    assert Counter((r.doc_id, r.source) for r in rows) == Counter((i, s) for i, _, s in texts)
    by = defaultdict(list)
    for r in rows:
        assert r.release <= r.slot < r.deadline and r.in_block == r.source_rank % 4 and r.block == r.source_rank // 4
        by[r.source].append(r)
    for source, own in by.items():
        assert sorted(r.source_rank for r in own) == list(range(len(own))), source
        own.sort(key=lambda r: r.source_rank)
        assert all(a.slot <= b.slot for a, b in zip(own, own[1:], strict=False))
    slots = {}
    for r in rows:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    assert sorted(slots) == list(range(len(slots)))
    # The plain schedule: phase after phase, the pattern of each phase repeated.
    blocks = {k: -(-n // 4) for k, n in Counter(s for _, _, s in texts if s != "zero").items()}
    want, done = [], Counter()
    while left := {k: weights[k] for k in blocks if done[k] < blocks[k]}:
        pattern = mixing.earliest_deadline_first(mixing.parts_of({("0" if k is None else "1" + k): w for k, w in left.items()}, 64))
        for k, _ in pattern * 100:
            k = None if k == "0" else k[1:]
            want.append((k, done[k]))
            done[k] += 1
            if done[k] == blocks[k]:
                break
    assert [slots[s] for s in range(len(want))] == want and [slots[len(want)]] == [("zero", 0)]
    # While all sources last, each is within a block of its target share.
    total, seen = sum(weights.values()), Counter()
    for t in range(1, min(len(want), 60)):
        seen[want[t - 1][0]] += 1
        if all(seen[k] < blocks[k] for k in blocks):
            assert all(abs(seen[k] - t * w / total) < 1 for k, w in weights.items())
    assert mixing.schedule(documents(spark, [])).count() == 0


@pytest.mark.parametrize("weights", [{"a": 1e-9, "b": 1.0}, {k: 1.0 for k in "abcdefg"}, {"a": 0.5, "b": 0.25, "c": 0.25}])
def test_parts_sum_to_the_period(weights):
    parts = mixing.parts_of(weights, 64)
    assert sum(parts.values()) == 64 and min(parts.values()) >= 1
    assert all(abs(parts[k] - 64 * w / sum(weights.values())) <= 1 for k, w in weights.items())


@pytest.mark.parametrize("weights", [{k: 1.0 for k in "abcdefg"}, {"a": 2**0.5, "b": 1.0, "c": 0.004, "d": 0.3}])
def test_true_weights_hold_over_whole_phases(weights):
    """No rounding adds up from period to period, and periods are made one by one."""
    total, size = sum(weights.values()), 6000
    plan = mixing.phases({k: 1 + round(size * w / total) for k, w in weights.items()}, weights, 64)
    assert plan[0]["slots"] >= size - 1000 and plan[0]["slots"] > 8 * plan[0]["length"]
    periods = range(sum(-(-p["slots"] // p["length"]) for p in plan))
    rows = [x for i in reversed(periods) for x in reversed(list(mixing.slots_of(plan, [i])))][::-1]
    assert rows == list(mixing.slots_of(plan, periods)) and [x[2] for x in rows] == list(range(len(rows)))
    seen = Counter()
    for t, (k, block, slot, release, deadline, phase) in enumerate(rows, 1):
        assert block == seen[k] and release <= slot < deadline
        seen[k] += 1
        if phase == 0:
            assert all(abs(seen[x] - t * w / total) < 1 for x, w in weights.items())
    assert seen == {k: 1 + round(size * w / total) for k, w in weights.items()}


def test_schedule_keeps_true_weights(spark):
    """Seven equal sources in periods of 64 slots: each has a seventh of every prefix."""
    rows = mixing.schedule(documents(spark, [(i, "t", f"s{i % 7}") for i in range(2100)]), dict.fromkeys([f"s{i}" for i in range(7)], 1.0), block=1, period=64).collect()
    seen = Counter()
    for t, r in enumerate(sorted(rows, key=lambda r: r.slot), 1):
        assert r.slot == t - 1
        seen[r.source] += 1
        assert r.phase > 0 or all(abs(seen[f"s{i}"] - t / 7) < 1 for i in range(7))


# --- pipeline ---
def stage_docs(spark):
    r = random.Random(9)
    plain = lambda i: ". ".join(" ".join(f"w{r.randrange(300)}" for _ in range(12)).capitalize() for _ in range(8)) + "."
    texts = [(i, plain(i), "src0" if i % 3 else f"src{i % 5}") for i in range(120)]
    texts += [(200 + i, texts[i][1], "src1") for i in range(20)] + [(300, None, None), (301, "", "src1"), (None, plain(1), "src1"), (302, "x " * 50_000, "src2")]
    rows = [(i, t, "en", s, len(t or ""), "extra", 3) for i, t, s in texts]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, place string, slot int")


def test_stages_take_odd_rows(spark):
    docs = stage_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.where("false")):
            out = stage(spark, rows, SF_DIR)
            got = out.collect()
            if name.startswith("token"):
                assert len(got) == rows.count()
                continue
            assert out.columns == docs.columns
            assert not Counter(map(tuple, got)) - Counter(map(tuple, rows.collect()))
            if name.startswith("mixing"):
                assert len(got) == rows.count()
            if name.startswith("MinHash"):
                assert {r.doc_id for r in got} == {r.doc_id for r in rows.collect() if not 200 <= (r.doc_id or 0) < 220}


def test_pipeline_against_plain_stages(spark):
    from headway.llm.queries import tokenizer_path
    from headway.llm.token_files import encoder

    read = lambda t: spark.read.parquet(f"{SF_DIR}/{t}.parquet")
    docs = {r.doc_id: r.text for r in read("documents").collect()}
    scores = {r.doc_id: r.predicted for r in quality.quality_scores(read("documents"), read("labels")).collect()}
    docs = {i: t for i, t in docs.items() if scores[i] == 1}
    docs = {i: docs[i] for i, (_, root) in brute.classes(list(docs.items())).items() if root == i}
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    leaked = {d for d, _ in brute.leaks(list(docs.items()), items)}
    docs = {i: t for i, t in docs.items() if i not in leaked}
    from pyspark.sql import functions as F

    place = {r.doc_id: (r.slot, r.in_block) for r in mixing.schedule(read("documents").where(F.col("doc_id").isin(list(docs)))).collect()}
    enc, at, want = encoder(tokenizer_path()), 0, []
    for i in sorted(docs, key=place.get):
        ids = np.array([*enc.tokenizer.encode(docs[i], add_special_tokens=False).ids, 1], "<u4")
        want.append((i, at, len(ids), crc32(ids.tobytes())))
        at += len(ids)
    got = sorted(corpus_pipeline.run(spark, SF_DIR).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == want
