"""Exact inner-product top-k by columnar branch and bound.

Candidates are laid out dimension by dimension. A block of dimensions at a time
adds to the partial scores; what the rest of the dimensions can still add or
take is at most the product of the remaining norms of query and candidate. A
candidate whose partial score plus that bound is below the k-th best lower bound is
dropped and the columns are compacted, so later dimensions touch survivors only.
Ties with the bound survive, so the result is exact.

Queries are a stated set, searched against all rows: both sides are cut into groups
by hash, every (query group, candidate group) meets in one task that streams its
candidates in batches and keeps the k best per query, which also starts the next batch with a
high bound. Candidate groups grow with the table once there are ``MOST_GROUPS``, so what is merged
afterwards stays k rows per query and group. Nothing is broadcast or collected.

Nulls and ties: vectors that are NULL or hold a NULL, NaN or infinite component
take no part, nor do rows with a NULL vec_id. Shorter vectors count as filled up with zeros.
Equal scores go to the smaller vec_id. A query never meets rows of its own vec_id;
repeated query rows are one query, repeated candidates count each. Scores outside
a long are clipped to it. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import stored

DIMS, QUERY_ROWS, GROUP_ROWS, MOST_GROUPS = 8, 2048, 1024, 1024
_SCHEMA = "query_id bigint, vec_id bigint, score bigint"


def scaled(vector: str, factor: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))


def whole(vector: str) -> Column:
    """Without NULL, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(vectors: list[list[int]], dims: int) -> np.ndarray:
    """Dimension-major, filled up with zeros."""
    if vectors and all(len(v) == dims for v in vectors):
        return np.array(vectors, np.int64).T
    out = np.zeros((dims, len(vectors)), np.int64)
    for i, v in enumerate(vectors):
        out[: len(v), i] = v
    return out


def _rest(columns: np.ndarray) -> np.ndarray:
    """Norm of the dimensions from each block on; one row more, zeros."""
    squares = columns.astype(float) ** 2
    starts = range(0, len(columns), DIMS)
    return np.sqrt(np.vstack([*(squares[s:].sum(axis=0) for s in starts), np.zeros(columns.shape[1])]))


class _Search:
    """The k best candidates of each query so far."""

    def __init__(self, ids: list[int], vectors: list[list[int]], k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, vec_id)

    def add(self, ids: list[int], vectors: list[list[int]]) -> None:
        dims = max((len(v) for v in [*self.vectors, *vectors]), default=0)
        queries, columns = _matrix(self.vectors, dims), _matrix(vectors, dims)
        largest = int(np.abs(queries).max(initial=0)), int(np.abs(columns).max(initial=0))
        if max(largest) >= 1 << 62 or largest[0] * largest[1] * max(1, dims) >= 1 << 53:
            self._plain(ids, queries, columns)
            return
        ids = np.array(ids, np.int64)
        q_rest, c_rest = _rest(queries), _rest(columns)
        queries, columns = queries.astype(float), columns.astype(float)
        for i, own in enumerate(self.ids):
            alive = np.flatnonzero(ids != own)
            score = np.zeros(len(alive))
            bound = -self.best[i][-1][0] if len(self.best[i]) == self.k else -np.inf
            compact = columns[:, alive] if len(alive) < len(ids) else columns
            for b, at in enumerate(range(0, dims, DIMS)):
                score += queries[at : at + DIMS, i] @ compact[at : at + DIMS]
                if at + DIMS >= dims:
                    break
                # Rounding of the norms: one unit to spare.
                slack = q_rest[b + 1, i] * c_rest[b + 1, alive] + 1
                if len(score) >= self.k:
                    bound = max(bound, np.partition(score - slack, len(score) - self.k)[len(score) - self.k])
                keep = score + slack >= bound
                if keep.mean() < 0.7:
                    alive, score, compact = alive[keep], score[keep], compact[:, keep]
            keep = score >= bound if np.isfinite(bound) else np.ones(len(score), bool)
            alive, score = alive[keep], score[keep]
            first = np.lexsort((ids[alive], -score))[: self.k]
            self._merge(i, [(-int(score[j]), int(ids[alive[j]])) for j in first])

    def _plain(self, ids: list[int], queries: np.ndarray, columns: np.ndarray) -> None:
        """Sums beyond what a double holds exactly."""
        queries, columns, top = queries.astype(object), columns.astype(object), (1 << 63) - 1
        for i, own in enumerate(self.ids):
            scores = (min(top, max(-top - 1, int(s))) for s in queries[:, i] @ columns)
            self._merge(i, sorted((-s, v) for s, v in zip(scores, ids, strict=True) if v != own)[: self.k])

    def _merge(self, i: int, found: list[tuple[int, int]]) -> None:
        self.best[i] = sorted([*self.best[i], *found])[: self.k]

    def rows(self) -> pa.RecordBatch:
        rows = [(q, v, -s) for q, best in zip(self.ids, self.best, strict=True) for s, v in best]
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: Column, k: int = 5, factor: int = 256, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for rows where `queries` holds, the k best of all other rows."""
    spark = vectors.sparkSession
    rows = vectors.where(whole(vector) & F.col(id_col).isNotNull())
    rows = stored(rows.select(F.col(id_col).cast("bigint").alias("vec_id"), scaled(vector, factor).alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query")), "topk-vectors")
    n = rows.agg(F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("is_query"), 1)).alias("queries")).first()
    groups = max(1, min(MOST_GROUPS, -(-n["all"] // GROUP_ROWS)))
    query_groups = max(1, -(-n["queries"] // QUERY_ROWS))
    numbers = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    # A query's group depends on its id alone, so that repeated rows of it meet.
    asked = rows.where("is_query").select("vec_id", "v").distinct().select(
        F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(query_groups)).cast("int").alias("qg"), numbers(groups).alias("cg"), F.lit(0).alias("kind"), "vec_id", "v"
    )
    # The position salts the group, as very many equal vectors may carry one id.
    offered = rows.withColumn("cg", F.pmod(F.monotonically_increasing_id() + F.xxhash64(F.lit(2), "vec_id"), F.lit(groups)).cast("int")).select(
        numbers(query_groups).alias("qg"), "cg", F.lit(1).alias("kind"), "vec_id", "v"
    )
    met = asked.unionByName(offered).repartition(F.col("qg"), F.col("cg")).sortWithinPartitions("qg", "cg", "kind")

    def run(batches):
        at, held, search, kind_now = None, ([], []), None, None
        for batch in batches:
            for key, kind, vec_id, v in zip(zip(batch.column("qg").to_pylist(), batch.column("cg").to_pylist(), strict=True), *(batch.column(c).to_pylist() for c in ("kind", "vec_id", "v")), strict=True):
                if key != at or kind != kind_now or (kind and len(held[0]) >= 4096):
                    if kind_now == 0:
                        search = _Search(*held, k)
                    elif kind_now == 1 and search is not None:
                        search.add(*held)
                    held = ([], [])
                    if key != at:
                        if search is not None:
                            yield search.rows()
                        search, at = None, key
                    kind_now = kind
                held[0].append(vec_id)
                held[1].append(v)
        if kind_now == 1 and search is not None:
            search.add(*held)
        if search is not None:
            yield search.rows()

    found = met.mapInArrow(run, _SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
