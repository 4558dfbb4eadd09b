"""Connected components of an edge table, with tables written between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in edges (a, b).

    Each round takes the least label among the neighbours and then the label
    of that label, so long chains halve. Sums are partial before the shuffle, so
    a centre with very many edges is not one task's work. Nothing is collected
    but whether a label has changed.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "id"), "id").select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("next")
        )
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        new = stored(step.join(jump, "next").select("id", "old", F.least("next", "far").alias("label")), "labels")
        labels = new.select("id", "label")
        if new.where("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
