"""Exact k-means over integer vectors with a vantage-point tree over the centroids.

Components become integers, floor(factor * x). Each round builds a vantage-point tree over the
centroids on the driver and broadcasts it; its size is the number of centroids times that of a
vector, both parameters. A vector searches the tree best first: the open node with the least
lower bound comes next, its vantage point is measured, and its children stay open while their bound is
within the radius of the best centroid so far. The radius is inclusive, and bounds carry some slack for
rounding, so no centroid at an equal distance is cut off; among equals the smaller number wins. Many
vectors take their steps side by side, each with an order of nodes of its own. Distances at vantage
points and in leaves are exact integers: doubles while sums stay below 2^53, Python integers beyond.

Tasks add up their vectors by cluster; Spark adds these partial sums as decimals, and the driver
gets one row per cluster and component. Rounds read the vectors from a written table.

Nulls and ties: vectors that are NULL, have another number of components, or hold a NULL, NaN or infinite
component take no part. Rows with a NULL vec_id belong to clusters and move their centroids, but never start
one. Repeated rows count each. Rows that tie for a start are ordered by their components. Fewer rows
than centroids give fewer centroids. Scaled components, distances and sums outside a long are
clipped to it, after exact comparison. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored
from headway.llm.exact_topk import scaled, whole

LEAF = 2
_TOP = (1 << 63) - 1


@dataclass(frozen=True)
class Node:
    """A vantage point with an inner and an outer child, or a leaf with a few centroids.

    near and far are the least and greatest distances of the child's centroids from the
    vantage point of its parent.
    """

    members: tuple[int, ...]  # the vantage point, or all of a leaf
    children: tuple[tuple[int, float, float], ...] = ()  # (node, near, far)


def _squared(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact squared distances; both sides are doubles or Python integers."""
    d = rows - one
    return (d * d).sum(axis=1)


def _exact(largest: int, dims: int) -> type:
    return float if 4 * largest * largest * max(1, dims) < 1 << 53 else object


def _matrix(rows: list, kind: type) -> np.ndarray:
    return np.array(rows, dtype=kind).reshape(len(rows), -1)


def _root(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(float))


class Tree:
    """A vantage-point tree over centroids given as lists of integers."""

    def __init__(self, centroids: list[list[int]], leaf: int = LEAF):
        self.centroids = centroids
        self.largest = max((abs(x) for c in centroids for x in c), default=0)
        self.nodes: list[Node] = []
        points = _matrix(centroids, _exact(self.largest, len(centroids[0])))
        self._grow(points, np.arange(len(centroids)), leaf)

    def _grow(self, points: np.ndarray, members: np.ndarray, leaf: int) -> int:
        number = len(self.nodes)
        self.nodes.append(Node(tuple(members.tolist())))
        if len(members) > leaf:
            # The member farthest from the first one parts the rest well.
            top = members[int(np.argmax(_squared(points[members], points[members[0]])))]
            rest = members[members != top]
            d = _root(_squared(points[rest], points[top]))
            order = np.argsort(d, kind="stable")
            children = []
            for half in np.array_split(order, 2):
                if len(half):
                    children.append((self._grow(points, rest[half], leaf), float(d[half].min()), float(d[half].max())))
            self.nodes[number] = Node((int(top),), tuple(children))
        return number

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and exact squared distance of the nearest centroid of each integer row, and distances measured."""
        largest = max(self.largest, int(np.abs(vectors.astype(float)).max(initial=0)))
        kind = _exact(largest, vectors.shape[1])
        vectors, points = vectors.astype(kind), _matrix(self.centroids, kind)
        n, measured = len(vectors), 0
        best = np.full(n, np.inf) if kind is float else np.full(n, 1 << 2000, object)
        number = np.full(n, len(points), np.int64)
        # The open nodes of every vector with their lower bounds; infinity is closed.
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, 0] = 0
        active = np.arange(n)
        while len(active):
            choice = bounds[active].argmin(axis=1)
            lowest = bounds[active, choice]
            # Inclusive: a node at just the radius may hold a tie.
            go = np.isfinite(lowest) & (lowest <= self._radius(best[active]))
            active, choice = active[go], choice[go]
            bounds[active, choice] = np.inf
            for node in np.unique(choice).tolist():
                rows, own = active[choice == node], self.nodes[node]
                for c in own.members:
                    d = _squared(vectors[rows], points[c])
                    measured += len(rows)
                    better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
                    best[rows[better]], number[rows[better]] = d[better], c
                if own.children:
                    away = _root(d)
                    for child, near, far in own.children:
                        low = np.maximum(np.maximum(away - far, near - away), 0)
                        bounds[rows, child] = low - 1e-9 * (away + far) - 1e-9
        return number, best, measured

    @staticmethod
    def _radius(best: np.ndarray) -> np.ndarray:
        if best.dtype == object:
            return np.array([float(x) ** 0.5 if x < 1 << 1000 else np.inf for x in best])
        return np.sqrt(best)


def _cells(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _clip(x) -> int:
    return max(-_TOP - 1, min(_TOP, int(x)))


def _starts(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where(F.col("vec_id").isNotNull()).select(order.alias("h"), "v").orderBy("h", "v").limit(k)
    return [list(r.v) for r in first.collect()]


def _moved(rows: DataFrame, tree, dims: int, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: exact floors of the means; empty clusters stay."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tree.value
        total = [[0] * dims for _ in index.centroids]
        count = [0] * len(total)
        for batch in batches:
            v = _cells(batch, dims)
            number, _, _ = index.nearest(v)
            safe = int(np.abs(v.astype(float)).max(initial=0)) * max(1, len(v)) < 1 << 62
            for c in np.unique(number).tolist():
                part = v[number == c] if safe else v[number == c].astype(object)
                total[c] = [a + int(b) for a, b in zip(total[c], part.sum(axis=0).tolist(), strict=True)]
                count[c] += len(part)
        rows = [(c, d, s, count[c]) for c, sums in enumerate(total) if count[c] for d, s in enumerate(sums)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([str(r[2]) for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.int64())],
            names=["cluster", "d", "s", "n"],
        )

    parts = rows.select("v").mapInArrow(sums, "cluster int, d int, s string, n bigint")
    whole = parts.groupBy("cluster", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out = [list(c) for c in centroids]
    for r in whole.collect():  # clusters times components
        out[r.cluster][r.d] = int(r.s) // r.n
    return out


def k_means(
    vectors: DataFrame, k: int = 8, dims: int = 64, factor: int = 1024, rounds: int = 10, seed: int = 3,
    id_col: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    spark = vectors.sparkSession
    rows = vectors.where(whole(vector) & (F.size(vector) == dims))
    rows = stored(rows.select(F.col(id_col).cast("bigint").alias("vec_id"), scaled(vector, factor).alias("v")), "centroid-vectors")
    centroids = _starts(rows, k, seed)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not centroids:
        none = spark.createDataFrame([], schema + ", cluster_inertia bigint, inertia bigint, centroid_sha256 string")
        return none
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(Tree(centroids))
        moved = _moved(rows, tree, dims, centroids)
        tree.destroy()
        if moved == centroids:  # all later rounds are the same
            break
        centroids = moved
    tree = spark.sparkContext.broadcast(Tree(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance, _ = tree.value.nearest(_cells(batch, dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array([_clip(x) for x in distance.tolist()], pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    found = stored(rows.mapInArrow(assign, schema), "centroid-clusters")
    tree.destroy()
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    every = _clip(sum(inertia.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame(
        [(c, _clip(s), every, digest[c]) for c, s in inertia.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return found.join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
