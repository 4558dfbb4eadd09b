"""Near-duplicates, decontamination, line runs, licenses and token files against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest

from headway.llm import common, decontaminate, licenses, line_runs, near_dedup, token_files
from headway.llm.graph import components
from headway.llm.queries import tokenizer_path
from headway.session import scratch_path

DOCS = "doc_id bigint, text string, source string, rep bigint, key string, row bigint"


def frame(spark, texts, schema=DOCS):
    """Documents with more columns than asked for, named as operators name theirs."""
    return spark.createDataFrame([(i, t, "s", 1, "k", 2) for i, t in texts], schema).repartition(3)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def edited(w, times, seed):
    r, w = random.Random(seed), list(w)
    for _ in range(times):
        w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    return w


# --- words and shingles ---
def test_hashes_follow_words(monkeypatch):
    r = random.Random(1)
    texts = ["", " ", "a", "A\x0bb", "one two three four five", "é É \x00 x\x1cy"]
    texts += ["".join(r.choice(" \t\nabcAé\x85") for _ in range(r.randrange(300))) for _ in range(60)]
    for piece in (40, 1 << 20):
        monkeypatch.setattr(common, "PIECE", piece)
        seen, back = {}, {}
        for size in (1, 5):
            flat, runs, n = common.shingle_hashes([t.encode() for t in texts], size)
            for t, h, k in zip(texts, common.split_runs(flat, runs), n, strict=True):
                want = brute.shingles(t, size)
                assert (len(h), k) == (len(want), len(brute.words(t)))
                for x, y in zip(h.tolist(), want, strict=True):
                    assert seen.setdefault((size, y), x) == x and back.setdefault((size, x), y) == y
    assert common.shingle_hashes([])[0].tolist() == []


# --- near-duplicates ---
def near_texts():
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three")]
    base = prose(1, 120)
    texts += [(10 + i, " ".join(edited(base, i % 4, i))) for i in range(40)]
    texts += [(100 + i, " ".join(base)) for i in range(30)]
    # A chain: neighbours are near, ends are far.
    chain = prose(2, 100)
    for i in range(12):
        texts.append((200 + i, " ".join(chain)))
        chain = chain[6:] + prose(300 + i, 6)
    # Documents that share a passage only.
    passage = prose(3, 60)
    texts += [(300 + i, " ".join(prose(400 + i, 60) + passage + prose(500 + i, 60))) for i in range(40)]
    texts += [(400 + i, " ".join(prose(600 + i, 50))) for i in range(30)]
    texts.append((900, " ".join(prose(9, 60_000))))
    return texts


def test_near_duplicates(spark):
    texts = near_texts()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute.classes(texts)


def test_near_duplicates_odd_rows(spark):
    out = near_dedup.near_duplicates(frame(spark, [(7, "a b c"), (7, "a b c"), (None, "a b c"), (8, "A b\x0bc")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in out) == [(-1, -1, True), (7, 7, True), (7, 7, True), (8, 7, False)]
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a bigint, b bigint")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def nearly_near(n, edits, seed=5):
    """Copies of one text with so many words changed that most pairs are just below the threshold."""
    r, base, out = random.Random(seed), prose(1, 200, 10**6), []
    for i in range(n):
        w = list(base)
        for p in r.sample(range(200), edits):
            w[p] = f"x{r.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("texts, shingles", [(2048, 2_000_000), (9, 2_000_000), (2048, 3000)])
def test_links_just_above_and_below(spark, monkeypatch, texts, shingles):
    """In one block and in several; some of the pairs are links."""
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", texts)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", shingles)
    docs = nearly_near(60, 4) + [(100 + i, t) for i, t in nearly_near(40, 5, seed=6)] + [(200 + i, t) for i, t in near_texts() if t]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.classes(docs) and 1 < len({c for i, (_, c) in got.items() if i < 60}) < 60


def test_rows_grow_with_a_group_not_its_square(spark, monkeypatch):
    counts, write = {}, near_dedup.stored

    def counting(df, label):
        out = write(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "stored", counting)
    found = []
    for n in (600, 1200):
        near_dedup.near_duplicates(frame(spark, nearly_near(n, 5))).count()
        found.append(dict(counts))
    assert found[1]["minhash-visits"] <= 3 * 1200
    for label, n in found[0].items():
        assert found[1][label] <= 2.5 * n + 100, label


# --- decontamination ---
def leak_case():
    items = [(i, " ".join(prose(1000 + i, n))) for i, n in enumerate((15, 18, 24, 33, 40, 47, 59, 80, 300))]
    items += [(20, "short one"), (21, ""), (22, None)]
    docs = [(1, None), (2, ""), (3, "x"), (4, "Short ONE")]
    for i, (_, item) in enumerate(items[:9]):
        w = item.split()
        docs.append((10 + i, " ".join(prose(i, 100 + i) + w + prose(50 + i, 70))))
        docs.append((30 + i, " ".join(prose(i, 31) + edited(w, 1, i) + prose(50 + i, 20))))
        docs.append((50 + i, " ".join(w[: len(w) // 3] + prose(70 + i, 50))))
        docs.append((70 + i, item.upper()))
    docs += [(200 + i, " ".join(prose(2000 + i, 150))) for i in range(60)]
    docs.append((300, " ".join(prose(5, 70_000) + items[4][1].split())))
    return docs, items


def test_leaks(spark):
    docs, items = leak_case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(frame(spark, docs), bench).collect()}
    want = brute.leaks([d for d in docs if d[0] != 300], [(i, t) for i, t in items if t])
    assert got.pop((300, 4)) == 1.0
    assert got == pytest.approx(want)
    slabs = decontaminate.leaks(frame(spark, docs), bench, slab=4)
    assert {(r.doc_id, r.item_id) for r in slabs.collect()} == want.keys() | {(300, 4)}


@pytest.mark.parametrize(("words", "edits"), [(40, 1), (50, 1), (100, 2), (200, 5)])
def test_no_leak_near_the_least_similarity_is_missed(words, edits):
    """Items with changed words, similarity mostly between 0.75 and 0.85, against every window."""
    items = [(i, " ".join(prose(7000 + i, words))) for i in range(120)]
    docs = []
    for i, (_, item) in enumerate(items):
        w = item.split()
        for j in range(edits):
            w[len(w) * (j + 1) // (edits + 1)] = f"x{i}"
        docs.append((i, " ".join([*prose(9000 + i, 20 + i), *w, *prose(8000 + i, 30)])))
    docs += [(500 + i, " ".join(item.split()[: words * 4 // 5])) for i, (_, item) in enumerate(items[:40])]
    want = brute.leaks(docs, items)
    assert sum(0.75 <= x < 0.85 for x in want.values()) >= 120
    rows = decontaminate._in_chunks([(i, t.encode()) for i, t in items], decontaminate.RADIUS, [d for d, _ in docs], [t.encode() for _, t in docs], 0.75)
    assert {(d, i): x for d, i, x, _, _ in rows} == pytest.approx(want) and len(rows) == len(want)


def test_leaks_of_nothing(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.leaks(frame(spark, [(1, "a b c d e f")]), none).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert decontaminate.leaks(frame(spark, []), some).count() == 0
    twice = decontaminate.leaks(frame(spark, [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f")]), some)
    assert sorted((r.doc_id or 0) for r in twice.collect()) == [0, 5, 5]


@pytest.mark.parametrize("radius", [0, 7, 15, 19])
def test_blocks_find_every_fingerprint_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    index = decontaminate._Index([(i, " ".join(prose(i, 30)).encode()) for i in range(20)], radius)
    prints = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    for _, _, fps, near in index.groups:
        flips = np.zeros(400, np.uint64)
        for i in range(400):
            for b in rng.choice(64, radius, replace=False):
                flips[i] ^= np.uint64(1) << np.uint64(b)
        every = np.concatenate([prints, flips ^ fps[rng.integers(0, len(fps), 400)]])
        got = {(i, int(w)) for i, at in index.candidates(fps, near, every) for w in at}
        want = {(i, int(w)) for i, fp in enumerate(fps) for w in np.flatnonzero(np.bitwise_count(every ^ fp) <= radius)}
        assert got == want and len(want) >= 400


def test_items_without_an_id_filter_too_and_slabs_are_kept(spark):
    item, other = " ".join(prose(1, 40, 10**6)), " ".join(prose(2, 40, 10**6))
    items = spark.createDataFrame([(None, item), (3, other), (4, None), (None, "")], "item_id bigint, text string")
    docs = frame(spark, [(1, item), (2, "clean words only"), (3, "x " + other + " y"), (4, None)])
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()) == [(1, None), (3, 3)]
    for slab in (1, 1024):
        assert sorted(r.doc_id for r in docs.where(~decontaminate.holds_leak(items, slab=slab)).collect()) == [2, 4]
    parts = [[(1, item.encode())], [(2, other.encode())]]
    first = [decontaminate._index(p, 3, 0.75) for p in parts]
    assert [decontaminate._index(p, 3, 0.75) for p in parts] == first


# --- lines ---
def line_texts():
    long = "this line is common to very many documents, Indeed"
    texts = [(i, f"own line of document {i} that nobody else has at all\n  {long.upper() if i % 2 else long}\t\nshort\nshort") for i in range(30)]
    texts += [(100, None), (101, ""), (102, "\n\n"), (103, long + "\n" + long), (104, "é" * 39), (105, "x" * 200_000 + "\n" + long)]
    texts += [(110 + i, "é" * 40 + "\n" + "É" * 40) for i in range(5)]
    texts += [(120 + i, "only four documents hold this particular line of text") for i in range(4)]
    return texts


@pytest.mark.parametrize("batches, fanout", [(1, 4), (2, 4), (4, 4), (9, 3)])
def test_kept_texts(spark, batches, fanout):
    texts = line_texts()
    got = line_runs.kept_texts(frame(spark, texts), batches=batches, fanout=fanout).collect()
    want = brute.kept_lines(texts)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got} == want
    assert all(r.kept_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in got)
    if batches == 2:
        assert line_runs.kept_texts(frame(spark, []), batches=batches).count() == 0


def test_repeated_ids_count_once(spark):
    line = "a line of at least forty characters, which is a lot"
    rows = [(1, line), (1, line), (1, line), (2, line), (3, line), (4, line), (None, line)]
    got = line_runs.kept_texts(frame(spark, rows)).collect()
    assert sum(r.n_dropped for r in got) == 0
    got = line_runs.kept_texts(frame(spark, [*rows, (5, line)])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 0), (1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 0)]


def test_runs_are_levelled(spark):
    runs, lines = line_runs.Runs(spark, fanout=3), [f"line number {i} with enough characters to count" for i in range(40)]
    for b in range(10):
        batch = frame(spark, [(b, "\n".join(lines[b : b + 5]))])
        fresh, runs = line_runs.fresh_lines(runs, batch)
        assert fresh.count() == (5 if b == 0 else 1)
        assert all(len(level) < 3 for level in runs.levels)
    assert runs.table().agg({"n_docs": "sum"}).first()[0] == 50
    assert [len(level) for level in runs.levels] == [1, 0, 1]


# --- licenses ---
def test_license_places_and_blocks(spark):
    t = licenses.TEMPLATES["mit-notice"]
    texts = [
        (1, "MIT License mit-license, the GNU General Public\nLicense; cc by"),
        (2, None), (3, ""), (4, "..."),
        (5, " ".join(prose(1, 200)) + " " + t + " " + " ".join(prose(2, 100))),
        (6, "Permission is hereby refused to any person"),
        (7, "Ünder the Apache LICENSE"),
        (8, " ".join(prose(4, 100_000)) + " released under the MIT license"),
        (8, "mit license"), (None, "mit license"),
    ]
    got = licenses.scan(frame(spark, texts)).collect()
    by = {r.doc_id: r for r in got if r.doc_id != 8}
    assert (by[1].n_base, by[1].first_word, by[1].last_word, by[1].base_labels) == (4, 0, 9, "cc-by,gpl,mit")
    assert [(by[i].n_words, by[i].n_base, by[i].first_word, by[i].labels, by[i].score) for i in (2, 3, 4)] == [(0, 0, None, "", 0.0)] * 3
    assert by[5].labels == "mit-notice" and by[5].score == 1.0 and by[5].n_base == 0
    assert by[6].labels == "" and by[7].base_labels == "apache"
    assert sorted((r.n_words, r.labels, r.first_word) for r in got if r.doc_id == 8) == [(2, "mit", 0), (100_005, "mit,mit-release", 100_003)]
    assert len(got) == len(texts) and by[None].labels == "mit"
    assert licenses.scan(frame(spark, [])).count() == 0


def test_license_join_is_exact(spark):
    """Every block against every template, counted plainly."""
    r = random.Random(3)
    sets = {k: sorted(set(licenses._words(t))) for k, t in licenses.TEMPLATES.items()}
    vocabulary = sorted({w for s in sets.values() for w in s})
    texts = []
    for i in range(150):
        k = r.choice(list(sets))
        some = r.sample(sets[k], max(1, len(sets[k]) - r.randrange(4))) + r.sample(vocabulary, 5)
        r.shuffle(some)
        texts.append((i, " ".join(prose(i, r.randrange(90)) + some + prose(i + 1, r.randrange(90)))))
    got = {(x.doc_id, m.label, m.block, round(m.containment, 9)) for x in licenses.scan(frame(spark, texts)).collect() for m in x.matches or []}
    want = set()
    for i, text in texts:
        w = licenses._words(text)
        for b in range(max(0, (len(w) - 1 - licenses.BLOCK + licenses.STRIDE) // licenses.STRIDE) + 1):
            block = set(w[b * licenses.STRIDE : b * licenses.STRIDE + licenses.BLOCK])
            for k, s in sets.items():
                if 100 * len(block & set(s)) >= licenses.PERCENT * len(s):
                    want.add((i, k, b, round(len(block & set(s)) / len(s), 9)))
    assert got == want and len(want) > 50


def test_templates_fit_into_a_block():
    assert all(len(licenses._words(t)) <= licenses.BLOCK - licenses.STRIDE for t in licenses.TEMPLATES.values())


def test_long_templates_match_anywhere(spark):
    """A template longer than a block, and one longer than two blocks share."""
    for n in (45, 200):
        body = " ".join(f"term{i}" for i in range(n))
        texts = [(i, " ".join([*prose(i, 7 * i), body, *prose(i + 50, 40)])) for i in range(12)]
        got = licenses.scan(frame(spark, texts), templates={"body": body}).collect()
        assert [(r.labels, r.score) for r in got] == [("body", 1.0)] * 12


# --- token files ---
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_codes(n):
    rng = np.random.default_rng(n)
    ids = np.concatenate([rng.integers(0, 1 << int(b), n, dtype=np.uint64) for b in (1, 8, 16, 32)]).astype(np.uint32)
    rng.shuffle(ids)
    codes = token_files.Codes(*token_files.Codes.encode(ids))
    assert (codes.all() == ids).all()
    assert all(codes[i] == ids[i] for i in rng.integers(0, max(1, len(ids)), 200) if len(ids))


def test_word_by_word_equals_the_whole_text():
    enc = token_files.encoder(tokenizer_path())
    texts = ["", " ", "It's a test, isn't it? 123 4.5", "Ünïcode space é   x", "<|endoftext|> a<|startoftext|>b", "İstanbul ǅ ﬁ", "a\x00b\x1cc\x85d", "don 't  'S", "́ a ͅ", "x'. x.' it's. \"q\", é. é… ß, 5. a5, a\u0301. İ. <|ENDOFTEXT|>", "a-b c_d, e.f (g) !!! ... ***%%%"]
    bits = ["a", "ab", "É", "ü", "'", "'s", ".", ",", "…", "5", " ", "<", "|", ">", "\u0301", "İ", "ﬁ", "*", "字", "-"]
    r = random.Random(2)
    texts += ["".join(r.choice(bits) for _ in range(r.randrange(40))) for _ in range(400)]
    texts += [" ".join(prose(i, 50)) for i in range(5)]
    for t in texts:
        assert enc.ids(t.encode()).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_round_trip(spark):
    texts = [(5, "a b"), (3, None), (4, ""), (1, " ".join(prose(1, 30_000))), (None, "null id"), (9, "same"), (9, "same"), (8, "Ünï")]
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(frame(spark, texts), tokenizer_path(), path, segment=1000)
    enc, at, want, whole = token_files.encoder(tokenizer_path()), 0, [], []
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        whole += ids
        at += len(ids)
    assert sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start) == want
    places = spark.createDataFrame([(p,) for p in range(0, at, 97)], "place bigint")
    assert {r.place: r.id for r in token_files.token_at(spark, path, places).collect()} == {p: whole[p] for p in range(0, at, 97)}
    assert token_files.round_trip(frame(spark, []), tokenizer_path()).count() == 0
