"""The dealt operators over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm import centroids, chat, class_lm, decontaminate, exact_topk, licenses, line_runs, mixing, near_dedup, periodic, quality, substrings, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector."""
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of all documents."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")


@query
def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram scores of all documents, learnt from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = class_lm.remainder(5) == 1
    model = class_lm.train(docs.where(~held_out))
    return class_lm.scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from trusted positives and unlabelled texts."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back; each turn replies to the one before."""
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"), F.lit(text).alias("text"))
        for i, role in enumerate(("user", "assistant"))
    ])))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("bigint")
    messages = rows.withColumn("node_id", place).select(
        F.col("conv_id").alias("tree_id"), "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
        F.when(F.col("role") == "assistant", F.length("text")).otherwise(0).cast("double").alias("score"), "role", "text",
    )
    out = chat.conversations(messages).withColumn("back", chat.read_back()).withColumn("under", chat.loss_text())
    every = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree_id").alias("conv_id"),
        F.size("back").cast("bigint").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length("under").cast("bigint").alias("loss_chars"),
        F.sha2("under", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that many documents share."""
    return line_runs.kept_texts(table(spark, sf_dir, "documents")).drop("text")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in a mix by square-root weights of the sources."""
    return mixing.schedule(table(spark, sf_dir, "documents"))


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors after ten rounds from eight starts."""
    return centroids.k_means(table(spark, sf_dir, "embeddings"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of periodic words of all documents, a tenth of them rewritten."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=periodic.planted).drop("runs", "collapsed")


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of fifty words that an earlier document holds."""
    return substrings.kept_words(table(spark, sf_dir, "documents")).drop("text")


ORACLE["op1_exact_topk"] = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE["op2_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w)),
n AS (SELECT w.doc_id, count(s.sh) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * n_both >= 75 * (na.n + nb.n - n_both)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
r(id, to_id) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.id, e.b FROM r JOIN e ON r.to_id = e.a),
c AS (SELECT id, min(to_id) AS component_id FROM r GROUP BY id),
f AS (SELECT doc_id, md5(array_to_string(list(sh ORDER BY sh), '|')) AS h FROM s GROUP BY doc_id),
k AS (SELECT h, min(doc_id) AS set_id FROM f GROUP BY h)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept, k.set_id
FROM n JOIN c ON c.id = n.doc_id LEFT JOIN f ON f.doc_id = n.doc_id LEFT JOIN k USING (h)
"""


def _license_sql() -> str:
    words = (
        r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    phrases = " UNION ALL ".join(
        f"SELECT {p.split(' ')!r} AS p, '{label}' AS label" for p, label in licenses.PHRASES.items()
    )
    sets = {k: sorted(set(licenses._words(t))) for k, t in licenses.TEMPLATES.items()}
    templates = " UNION ALL ".join(
        f"SELECT {s!r} AS t, '{k}' AS label, {-(-licenses.PERCENT * len(s) // 100)} AS o" for k, s in sets.items()
    )
    b, s = licenses.BLOCK, licenses.STRIDE
    return f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents),
p AS ({phrases}), t AS ({templates}),
h AS (SELECT r, label, i FROM (SELECT r, label, p, ws, unnest(range(0, len(ws))) AS i FROM w, p
        WHERE list_has_all(ws, p)) WHERE ws[i + 1:i + len(p)] = p),
base AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM h GROUP BY r),
blocks AS (SELECT r, list_distinct(ws[k * {s} + 1:k * {s} + {b}]) AS bs FROM (
  SELECT r, ws, unnest(range(0, CAST(greatest(0, floor((len(ws) - 1 - {b - s}) / {s})) AS BIGINT) + 1)) AS k FROM w
  WHERE list_has_any(ws, (SELECT list_distinct(flatten(list(t))) FROM t)))),
m AS (SELECT r, list(DISTINCT label) AS labels, max(n_both / m) AS best FROM (
  SELECT r, label, o, len(list_intersect(bs, t)) AS n_both, len(t) AS m FROM blocks, t) WHERE n_both >= o GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(m.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN m USING (r)
"""


ORACLE["op3_licenses"] = _license_sql()


def _escaped_sql(c: str) -> str:
    out = f"replace({c}, '\\', '\\\\')"
    for plain, inside in chat.CONTROL.items():
        out = f"replace({out}, '{plain}', '{inside}')"
    return out


ORACLE["op7_chat"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length({_escaped_sql('text')}) + CASE WHEN role = 'assistant' THEN 7
    ELSE 16 + length(replace({_escaped_sql('role')}, chr(10), '{chat.NEWLINE}')) END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

ORACLE["op8_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, i, ls[i] AS line,
    translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
k AS (SELECT key, max(doc_id) AS last_doc FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, coalesce(l.doc_id <> k.last_doc, FALSE) AS gone FROM l LEFT JOIN k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


def _centroid_sql(k: int = 8, dims: int = 64, factor: int = 1024, rounds: int = 10, seed: int = 3) -> str:
    """Lloyd's rounds written out; every distance is measured."""

    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (SELECT r, vec_id, min(distance) AS distance, arg_min(cluster, (distance, cluster)) AS cluster FROM (
    SELECT r, vec_id, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM e, c{n}) GROUP BY r, vec_id)"""

    steps = []
    for n in range(rounds):
        steps.append(assigned(n))
        steps.append(f"""m{n} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
    SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT a.cluster, unnest(range(1, {dims + 1})) AS i, unnest(v) AS x FROM a{n} a JOIN e USING (r)) GROUP BY cluster, i)
    GROUP BY cluster)""")
        steps.append(f"c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.c, o.c) AS c FROM c{n} o LEFT JOIN m{n} m USING (cluster))")
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v AS c FROM (
  SELECT sha256('{seed}:' || vec_id) AS h, v FROM e WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k})),
{",".join(steps)},
{assigned(rounds)}
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


ORACLE["op11_centroids"] = _centroid_sql()

ORACLE["op13_substring_dedup"] = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT r, doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
f AS (SELECT h, min(doc_id) AS first_doc FROM s GROUP BY h),
g AS (SELECT r, i FROM s JOIN f USING (h) WHERE first_doc < doc_id),
d AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS i FROM g),
p AS (SELECT r, doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM w),
k AS (SELECT p.r, string_agg(x, ' ' ORDER BY p.i) AS kept, count(*) AS n FROM p LEFT JOIN d ON d.r = p.r AND d.i = p.i WHERE d.i IS NULL GROUP BY p.r)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (r)
"""
