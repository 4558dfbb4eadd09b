"""As-of joins against brute force (OP-N3)."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators.asof import asof_join, asof_lookup, interval_index, lookup_layout
from headway.session import RECOMMENDED

LEFT = "id int, k string, at int"
RIGHT = "k string, r_at int, seq int, name string"


def brute(left, right, how="inner"):
    out = []
    for id_, k, at in left:
        hits = [r for r in right if None not in (k, at, r[1]) and r[0] == k and r[1] <= at]
        if hits:
            out.append((id_, k, at, *max(hits, key=lambda r: r[1:])[1:]))
        elif how == "left":
            out.append((id_, k, at, None, None, None))
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.collect())


keys = st.sampled_from(["a", "b", "c", None])
times = st.one_of(st.none(), st.integers(-50, 400))
lefts = st.lists(st.tuples(keys, times), max_size=60)
rights = st.lists(st.tuples(keys, times, st.integers(0, 3)), max_size=60)


@settings(max_examples=6, deadline=None)
@given(lefts, rights, st.sampled_from([1, 7, 100, 100000]), st.sampled_from(["inner", "left"]))
def test_asof_join(spark, ls, rs, width, how):
    left = [(i, k, at) for i, (k, at) in enumerate(ls)]
    right = [(k, at, seq, f"n{i:02d}") for i, (k, at, seq) in enumerate(rs)]
    df = asof_join(
        spark.createDataFrame(left, LEFT),
        spark.createDataFrame(right, RIGHT),
        ["k"],
        "at",
        "r_at",
        ["seq"],
        bucket_width=width,
        how=how,
    )
    assert df.columns == ["id", "k", "at", "r_at", "seq", "name"]
    assert got(df) == brute(left, right, how)


@settings(max_examples=6, deadline=None)
@given(lefts, rights, st.sampled_from([(10, 50), (30, 390), (60, 120)]))
def test_lookup(spark, ls, rs, shape):
    width, horizon = shape
    left = [(i, k, at) for i, (k, at) in enumerate(ls)]
    right = [(k, at, seq, f"n{i:02d}") for i, (k, at, seq) in enumerate(rs)]
    index = interval_index(
        spark.createDataFrame(right, RIGHT), ["k"], "r_at", ["seq"], width, horizon
    )
    df = asof_lookup(
        spark.createDataFrame(left, LEFT), index, [("k", "k")], "at", "r_at", width, horizon
    )
    assert got(df.select("id", "k", "at", "r_at", "seq", "name")) == brute(left, right)


def test_microsecond_times(spark):
    left = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-01 10:00:00.000002' AS at")
    right = spark.sql(
        "SELECT 1 AS k, explode(array(timestamp_ntz'2024-01-01 10:00:00.000001', "
        "timestamp_ntz'2024-01-01 10:00:00.000003')) AS r_at"
    )
    assert str(asof_join(left, right, ["k"], "at", "r_at").first().r_at).endswith("000001")


def test_hot_key_and_copies(spark):
    """A third of all rows on one key, many of them on one instant."""
    rng = random.Random(1)
    left = [(i, "hot" if i % 3 == 0 else f"k{i % 97}", rng.choice([500, rng.randrange(1000)])) for i in range(6000)]
    right = [("hot" if i % 3 == 0 else f"k{i % 97}", rng.choice([499, rng.randrange(1000)]), i % 5, f"n{i}") for i in range(3000)]
    df = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT),
        ["k"], "at", "r_at", ["seq"], bucket_width=50,
    )
    assert got(df) == brute(left, right)
    index = interval_index(spark.createDataFrame(right, RIGHT), ["k"], "r_at", ["seq"], 50, 1000)
    again = asof_lookup(spark.createDataFrame(left, LEFT), index, [("k", "k")], "at", "r_at", 50, 1000)
    assert got(again.select(df.columns)) == brute(left, right)


def test_right_side_is_reduced_once(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 10 AS k", "id AS at").write.parquet(str(tmp_path / "l"))
    spark.range(1000).selectExpr("id % 10 AS k", "id AS r_at", "id AS v").write.parquet(str(tmp_path / "r"))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in "lr")
    df = asof_join(left, right, ["k"], "at", "r_at")
    df.collect()
    plan = plan_of(df)
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


SKEWED = {
    **RECOMMENDED,
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


def hot_probe(spark):
    """Two thirds of the rows on one key and instant."""
    return spark.range(0, 200000, 1, 8).selectExpr(
        "id",
        "IF(id % 3 > 0, 'hot', concat('k', id % 500)) AS k",
        "CAST(IF(id % 3 > 0, 1000, id % 5000) AS INT) AS at",
    )


def few_answers(spark):
    return spark.range(0, 500).selectExpr(
        "explode(array('hot', concat('k', id))) AS k", "CAST(id * 7 AS INT) AS r_at"
    )


def test_skewed_lookup_is_split(spark, conf):
    """Without a broadcast the adaptive skew join splits the hot probe."""
    conf(SKEWED)
    index = interval_index(few_answers(spark), ["k"], "r_at")
    df = asof_lookup(hot_probe(spark), index, [("k", "k")], "at", "r_at")
    df.collect()
    assert "skew=true" in plan_of(df)


def test_skewed_asof_join_is_split(spark, conf):
    """Copies of a left row are one row in the window and split in the join."""
    conf(SKEWED)
    df = asof_join(hot_probe(spark), few_answers(spark), ["k"], "at", "r_at")
    n = len(df.collect())
    assert "skew=true" in plan_of(df)
    assert n == sum(1 for i in range(200000) if i % 3 or i % 5000 >= i % 500 * 7)


def test_bad_join_type(spark):
    df = spark.createDataFrame([], LEFT)
    with pytest.raises(ValueError):
        asof_join(df, df, ["k"], "at", "at", how="outer")


def test_lookup_drops_columns_it_adds(spark):
    left = spark.createDataFrame([(1, "a", 5)], LEFT)
    right = spark.createDataFrame([("a", 3, 0, "n")], RIGHT)
    out = asof_lookup(left, interval_index(right, ["k"], "r_at"), [("k", "k")], "at", "r_at")
    assert not [c for c in out.columns if c.startswith("__")]
    assert out.select(F.col("r_at")).first()[0] == 3


def test_kept_index_is_not_shuffled_again(spark):
    right = spark.range(500).selectExpr("concat('k', id % 50) AS k", "CAST(id * 7 AS INT) AS r_at")
    index = lookup_layout(interval_index(right, ["k"], "r_at"), ["k"], 8).persist()
    left = spark.range(2000).selectExpr("id", "concat('k', id % 50) AS k", "CAST(id AS INT) AS at")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = asof_lookup(left, index, [("k", "k")], "at", "r_at")
        df.collect()
        plan = plan_of(df).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        index.unpersist()
    above_cache = plan.split("InMemoryRelation")[0]
    assert above_cache.count("Exchange hashpartitioning") == 1
    assert above_cache.count("Sort [") == 1
