"""Documents to token files: quality, near-duplicates, benchmark leaks, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import decontaminate, mixing, near_dedup, quality, token_files
from headway.llm.common import small_batches
from headway.llm.queries import table, tokenizer_path
from headway.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the positive-unlabelled classifier accepts."""
    small_batches(spark)
    return docs.where(quality.train(docs, table(spark, sf_dir, "labels")).accepts("text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each near-duplicate group; rows without an id stay."""
    gone = near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    # What goes grows with the documents, so the plan is the one for large tables at any size.
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return docs.where(~decontaminate.holds_leak(table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, which the files keep."""
    places = mixing.schedule(docs)
    # Rows that share id and source also share their place, so that none is doubled.
    places = places.groupBy("doc_id", "source").agg(F.min(F.struct("slot", "in_block")).alias("place"))
    same = F.col("docs.doc_id").eqNullSafe(F.col("places.doc_id")) & F.col("docs.source").eqNullSafe(F.col("places.source"))
    met = docs.alias("docs").join(places.alias("places").hint("merge"), same).orderBy("places.place")
    return met.select(*[F.col(f"docs.`{c}`") for c in docs.columns])


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 read back from token files in the order of the mix."""
    try:
        rows = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        # By the number in a file's name: as text, part-100000 would come before part-99999.
        order = [F.regexp_extract("_file", r"part-(\d+)", 1).try_cast("bigint"), F.col("_file"), F.col("_row")]
    except AnalysisException:  # not read from files: no order to keep
        rows, order = docs.select("doc_id", "text"), None
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(rows, tokenizer_path(), path, order=order)
    return token_files.read_documents(spark, path)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]

# SQL cannot express the classifier, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name.split()[0].lower()}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
