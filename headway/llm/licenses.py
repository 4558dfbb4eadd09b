"""License scan: exact set-similarity join of text blocks with license templates.

A text's words are cut into blocks of ``BLOCK`` words, one every ``STRIDE``, so that
any ``BLOCK - STRIDE`` words in a row lie whole in one block; with longer templates blocks are twice
as long as the longest, one every length of it. A block matches a template
if it contains at least ``percent`` of the template's distinct words. Template words are
ordered by how many documents hold them, rarest first; words of no template cannot
count and leave the sets. Then

* prefix: with o shared words needed of m, a match shares one of the first m - o + 1
  template words and of the first |block| - o + 1 block words;
* length: a block with fewer than o template words is out;
* position: what stands before the shared word on either side cannot be shared any more.

Pairs that pass are counted in full. Beside the blocks, ``PHRASES`` are found as words in a row.

Only DataFrame expressions. Two passes over the texts: frequencies (the result has a row per
template word), then words, phrases and blocks. Blocks exist only for texts that hold a prefix word.

Nulls and ties: NULL text is empty, has no words, and scores 0. Rows are scanned one by
one, equal ones too, whatever their doc_id. Template words of equal frequency are ordered
by the words. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ascii_lower, stored

BLOCK, STRIDE, PERCENT = 64, 32, 80

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as licenses word them, by label; none has over BLOCK - STRIDE words.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-release": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def words_in(text: Column) -> Column:
    """Runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _words(text: str) -> list[str]:
    return "".join(c.lower() if c.isalnum() else " " for c in text).split()


def _starts(words: str, phrase: str) -> Column:
    """Places where the phrase's words stand in a row."""
    parts = phrase.split(" ")
    here = lambda i: reduce(Column.__and__, [F.get(words, i + j) == F.lit(p) for j, p in enumerate(parts)])
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _rows(spark, structs: list[Column]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*structs)))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks (label, block, containment)."""
    spark = docs.sparkSession
    sets = {k: sorted(set(_words(t))) for k, t in templates.items()}
    need = {k: -(-percent * len(s) // 100) for k, s in sets.items()}
    # The longest template lies whole in one block wherever it stands.
    longest = max((len(_words(t)) for t in templates.values()), default=0)
    size, stride = (BLOCK, STRIDE) if longest <= BLOCK - STRIDE else (2 * longest, longest)
    vocabulary = sorted({w for s in sets.values() for w in s})

    texts = docs.select("doc_id", words_in(F.col("text")).alias("words"))
    held = texts.select(F.explode(F.array_intersect("words", _literal(vocabulary))).alias("word"))
    counts = {r.word: r.n for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    ranked = {k: sorted(rank[w] for w in s) for k, s in sets.items()}
    prefixes = sorted({order[r] for k, s in ranked.items() for r in s[: len(s) - need[k] + 1]})

    # Phrases: sought only where their least common word is.
    first_of = {p: min(p.split(" "), key=lambda w: (counts.get(w, 0) if w in counts else 0, -len(w))) for p in phrases}
    starts = {
        p: F.when(F.array_contains("words", first_of[p]), _starts("words", p)).otherwise(F.array().cast("array<int>")) for p in phrases
    }
    # Blocks: word sets as ascending ranks, template words only.
    at = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("words") - 1 - (size - stride)) / F.lit(stride)).cast("int")))
    ranks = lambda i: F.array_sort(F.transform(
        F.array_intersect(F.slice("words", i * stride + 1, size), _literal(order)), lambda w: F.array_position(_literal(order), w).cast("int") - 1
    ))
    blocks = F.when(F.arrays_overlap("words", _literal(prefixes)), F.transform(at, lambda i: F.struct(i.alias("block"), ranks(i).alias("ranks"))))
    found = stored(
        texts.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("bigint").alias("n_words"),
            *[s.alias(f"s{i}") for i, s in enumerate(starts.values())],
            F.filter(blocks, lambda b: F.size(b["ranks"]) >= min(need.values(), default=1)).alias("blocks"),
        ),
        "license-words",
    )

    # The join: block prefix words with template prefix words.
    matched = found.select("row", F.lit("").alias("label"), F.lit(0).alias("block"), F.lit(0.0).alias("containment")).where("false")
    if templates:
        index = _rows(spark, [
            F.struct(F.lit(r).alias("rank"), F.lit(p).alias("p"), F.lit(len(s)).alias("m"), F.lit(need[k]).alias("o"), F.lit(k).alias("label"))
            for k, s in ranked.items() for p, r in enumerate(s[: len(s) - need[k] + 1])
        ])
        whole = _rows(spark, [F.struct(F.lit(k).alias("label"), F.array(*[F.lit(r) for r in s]).alias("template")) for k, s in ranked.items()])
        pairs = (
            found.select("row", F.inline("blocks")).select("row", "block", "ranks", F.size("ranks").alias("n"), F.posexplode("ranks").alias("q", "rank"))
            .join(index, "rank")
            .where("n >= o and q <= n - o and 1 + least(m - p - 1, n - q - 1) >= o")
            .select("row", "block", "label", "ranks", "m", "o")
            .distinct()
        )
        matched = (
            pairs.join(whole, "label")
            .withColumn("both", F.size(F.array_intersect("ranks", "template")))
            .where("both >= o")
            .select("row", "label", "block", (F.col("both") / F.col("m")).alias("containment"))
        )
    per_text = matched.groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"),
        F.array_sort(F.collect_list(F.struct("label", "block", "containment"))).alias("matches"),
    )
    names = [f"s{i}" for i in range(len(phrases))]
    every = F.flatten(F.array(*names)) if names else F.array().cast("array<int>")
    base = F.array_sort(F.array_distinct(F.filter(
        F.array(*[F.when(F.size(s) > 0, F.lit(label)) for s, label in zip(names, phrases.values(), strict=True)]), lambda x: x.isNotNull()
    ))) if names else F.array().cast("array<string>")
    out = found.select("row", "doc_id", "n_words", every.alias("every"), base.alias("base")).join(per_text, "row", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id",
        "n_words",
        F.size("every").cast("bigint").alias("n_base"),
        F.array_min("every").cast("bigint").alias("first_word"),
        F.array_max("every").cast("bigint").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("every") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        "matches",
    )
