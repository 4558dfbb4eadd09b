"""Type 2 merges against the two statements they stand for (OP-C2, C3, N4, N5)."""

from __future__ import annotations

import datetime as dt
import os
import re
from collections import Counter

import duckdb
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.functions.cleaning import with_scd_columns
from headway.operators import scd2
from headway.schemas import TABLES
from headway.session import RECOMMENDED
from headway.sinks.tables import ScdTable

SCHEMA = "k string, a string, b int, start_dt_scd timestamp, end_dt_scd timestamp, is_current boolean"
KEYS, TRACKED = ["k"], ["a", "b"]
D1, D2, D3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def opened(rows, at):
    return [(*r, at, None, True) for r in rows]


def got(df):
    return Counter(tuple(r) for r in df.collect())


def update_and_insert(dim, stage):
    """The merge as a database does it: close changed rows, insert new versions."""
    con = duckdb.connect()
    ddl = "(k VARCHAR, a VARCHAR, b INT, start_dt_scd TIMESTAMP, end_dt_scd TIMESTAMP, is_current BOOLEAN)"
    for name, rows in (("dim", dim), ("stage", stage)):
        con.execute(f"CREATE TABLE {name} {ddl}")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, ?, ?, ?)", rows)
    con.execute(
        """UPDATE dim SET is_current = false, end_dt_scd = s.start_dt_scd FROM stage s
           WHERE dim.k = s.k AND dim.is_current = true
             AND (dim.a IS DISTINCT FROM s.a OR dim.b IS DISTINCT FROM s.b)"""
    )
    con.execute(
        """INSERT INTO dim SELECT s.k, s.a, s.b, s.start_dt_scd, NULL, true
           FROM stage s LEFT JOIN dim d ON d.k = s.k AND d.is_current = true
           WHERE d.k IS NULL OR d.a IS DISTINCT FROM s.a OR d.b IS DISTINCT FROM s.b"""
    )
    return Counter(con.execute("SELECT * FROM dim").fetchall())


key = st.sampled_from(["x", "y", "z", "w", None])
row = st.tuples(key, st.sampled_from(["p", "q", None]), st.sampled_from([1, 2, None]))
rows = st.lists(row, max_size=25)


@settings(max_examples=5, deadline=None)
@given(rows, rows, rows)
def test_merge_equals_update_and_insert(spark, history, now, staged):
    dim = [(*r, D1, D2, False) for r in history] + opened(now, D2)
    stage = opened(staged, D3)
    merged = scd2.scd2_merge(frame(spark, dim), frame(spark, stage), KEYS, TRACKED)
    assert got(merged) == update_and_insert(dim, stage)


@settings(max_examples=3, deadline=None)
@given(rows, rows)
def test_second_merge_changes_nothing(spark, now, staged):
    def one_per_key(rs):
        return list({r[0]: r for r in rs if r[0] is not None}.values())

    dim, stage = frame(spark, opened(one_per_key(now), D1)), frame(spark, opened(one_per_key(staged), D2))
    once = scd2.scd2_merge(dim, stage, KEYS, TRACKED)
    assert got(scd2.scd2_merge(once, stage, KEYS, TRACKED)) == got(once)
    per_key = once.filter("is_current").groupBy("k").count()
    assert per_key.filter("count > 1").isEmpty()


def test_close_missing_and_dedup(spark):
    dim = frame(spark, opened([("x", "p", 1), ("gone", "p", 1), (None, "p", 1)], D1))
    stage = frame(spark, opened([("x", "q", 1), ("x", "q", 1)], D2))
    merged = scd2.scd2_merge(
        dim, stage, KEYS, TRACKED, close_missing=True, run_ts=F.lit(D3), dedup_stage=True
    )
    assert got(merged) == Counter(
        [("x", "p", 1, D1, D2, False), (None, "p", 1, D1, D3, False), ("gone", "p", 1, D1, D3, False), ("x", "q", 1, D2, None, True)]
    )
    with pytest.raises(ValueError):
        scd2.scd2_merge(dim, stage, KEYS, TRACKED, close_missing=True)


def test_changed_rows_null_to_value(spark):
    dim = frame(spark, opened([("x", None, 1), ("y", "p", 1), ("z", "p", None)], D1))
    stage = frame(spark, opened([("x", "p", 1), ("y", "p", 1), ("z", "p", None)], D2))
    assert [r.k for r in scd2.changed_rows(dim, stage, KEYS, TRACKED).collect()] == ["x"]


def test_as_of(spark):
    dim = frame(spark, [("x", "p", 1, D1, D2, False), ("x", "q", 1, D2, None, True)])
    for at, value in [(D1, ["p"]), (D2, ["q"]), (dt.datetime(2023, 1, 1), [])]:
        assert [r.a for r in scd2.as_of(dim, F.lit(at)).collect()] == value


def test_hot_key_does_not_multiply(spark):
    """A key with many copies on both sides: rows add up, they do not multiply."""
    same = [("hot", "p", 1)] * 2000 + [(f"k{i}", "p", i) for i in range(4000)]
    dim, stage = frame(spark, opened(same, D1)), frame(spark, opened(same + [("hot", "q", 1)], D2))
    merged = scd2.scd2_merge(dim, stage, KEYS, TRACKED)
    assert merged.filter("k = 'hot' AND NOT is_current").count() == 2000
    assert merged.filter("k = 'hot' AND is_current").count() == 2001
    assert merged.filter("k <> 'hot'").count() == 4000


def test_table_keeps_history_and_ignores_leftovers(spark, tmp_path):
    base = str(tmp_path / "dim")
    table = ScdTable(spark, base, frame(spark, []).schema)
    days = [
        [("x", "p", 1), ("y", "p", 1)],
        [("x", "q", 1), ("y", "p", 1), ("n", "p", 1)],
        [("x", "r", 1), ("y", "p", 1)],
    ]
    want = None
    for i, day in enumerate(days):
        at = dt.datetime(2024, 1, 1 + i)
        stage = frame(spark, opened(day, at))
        want = stage if want is None else scd2.scd2_merge(want, stage, KEYS, TRACKED)
        table.merge(stage, KEYS, TRACKED, ["k", "start_dt_scd"])
        assert got(table.read()) == got(want)
    table.drop_old(keep=1)  # only open rows of earlier runs go, history stays
    assert got(table.read()) == got(want)
    assert table.version() == 2
    assert "is_current=false" not in "".join(table.read_open().inputFiles())
    # A run that failed before its switch leaves a folder nobody reads.
    frame(spark, [("ghost", "p", 1, D1, D2, False)]).drop("is_current").write.parquet(
        f"{base}/rows/run=3/is_current=false/bucket=0"
    )
    assert got(table.read()) == got(want)
    table.merge(frame(spark, opened(days[0], D3)), KEYS, TRACKED, ["k", "start_dt_scd"])
    assert table.read().filter("k = 'ghost'").isEmpty()


def test_only_touched_buckets_are_written(spark, tmp_path):
    base = str(tmp_path / "dim")
    table = ScdTable(spark, base, frame(spark, []).schema, buckets=8)
    rows = [(f"k{i}", "p", i) for i in range(200)]
    table.merge(frame(spark, opened(rows, D1)), KEYS, TRACKED, ["k"])
    changed = [("k7", "q", 7), *[r for r in rows if r[0] != "k7"]]
    before = set(table.read_open().inputFiles())
    table.merge(frame(spark, opened(changed, D2)), KEYS, TRACKED, ["k"])
    after = set(table.read_open().inputFiles())
    assert len(before - after) == 1 and len(after - before) == 1
    assert got(table.read()) == got(scd2.scd2_merge(frame(spark, opened(rows, D1)), frame(spark, opened(changed, D2)), KEYS, TRACKED))
    # Nothing to do: nothing is written.
    table.merge(frame(spark, opened(changed, D3)), KEYS, TRACKED, ["k"])
    assert set(table.read_open().inputFiles()) == after and table.version() == 2
    table.drop_old(keep=1)
    assert table.read().count() == 201
    assert not [f for f in before - after if os.path.exists(f.removeprefix("file://"))]


def test_options_hold_on_the_first_run(spark, tmp_path):
    table = ScdTable(spark, str(tmp_path / "dim"), frame(spark, []).schema)
    table.merge(frame(spark, opened([("x", "p", 1), ("x", "q", 1)], D1)), KEYS, TRACKED, ["k"], dedup_stage=True)
    assert table.read_open().count() == 1
    table.merge(frame(spark, opened([("y", "p", 1)], D2)), KEYS, TRACKED, ["k"], close_missing=True, run_ts=F.lit(D2))
    assert [r.k for r in table.read_open().collect()] == ["y"] and table.read().count() == 2


def test_pointers_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ScdTable, "FOLD", 3)
    table = ScdTable(spark, str(tmp_path / "dim"), frame(spark, []).schema, buckets=2)
    for i in range(7):
        table.merge(frame(spark, opened([(f"k{i}", "p", 1)], D1)), KEYS, TRACKED, ["k"])
    assert table.version() == 6 and table.read().count() == 7
    assert len(list((tmp_path / "dim/pointer").glob("*.parquet"))) == 1


@pytest.mark.parametrize("name", TABLES)
def test_every_tracked_column_of_every_table(spark, name):
    """Row i of the staged copy has tracked column i patched; one more has none."""
    spec = TABLES[name]
    n = len(spec.tracked)
    i = F.col("id")
    made = {"string": i.cast("string"), "integer": i.cast("int"), "double": i / 2}
    made["date"] = F.date_add(F.lit(dt.date(2024, 1, 1)), i.cast("int"))
    fresh = spark.range(n + 1).select(
        "id", *[made[f.dataType.typeName()].alias(f.name) for f in spec.schema.fields]
    )
    dim = with_scd_columns(fresh, F.lit(D1))
    patched = {c: F.when(i != k, F.col(c)) for k, c in enumerate(spec.tracked)}
    stage = with_scd_columns(fresh.withColumns(patched), F.lit(D2)).drop("id")
    merged = scd2.scd2_merge(dim.drop("id"), stage, spec.key, spec.tracked)
    counts = {tuple(r)[:2]: r["count"] for r in merged.groupBy("start_dt_scd", "is_current").count().collect()}
    assert counts == {(D1, True): 1, (D1, False): n, (D2, True): n}
    assert set(spec.key) | set(spec.tracked) == {f.name for f in spec.schema.fields}


def stored(spark, path, rows):
    frame(spark, rows).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_table_that_starts_empty(spark, tmp_path):
    table = ScdTable(spark, str(tmp_path / "dim"), frame(spark, []).schema)
    table.merge(frame(spark, []), KEYS, TRACKED, ["k"])
    assert table.read().isEmpty() and table.read_open().isEmpty()
    rows = opened([("x", "p", 1), (None, "p", 1)], D1)
    table.merge(frame(spark, rows), KEYS, TRACKED, ["k"])
    assert got(table.read()) == Counter(rows)


def test_shuffles(spark, tmp_path, conf):
    """Open rows and staged keys are shuffled once for both uses, never by value."""
    dim, stage = (
        stored(spark, tmp_path / n, opened([(f"k{i}", "p", i) for i in range(50)], at))
        for n, at in (("dim", D1), ("stage", D2))
    )
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    merged = scd2.scd2_merge(dim, stage, KEYS, TRACKED)
    merged.collect()
    plan = plan_of(merged).split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 2
    made = re.findall(r"Exchange hashpartitioning\((.*)\), \w+, \[plan_id", plan)
    assert made and not [m for m in made if "a#" in m or "b#" in m]


@pytest.mark.parametrize("hot_side", ["dim", "stage"])
def test_hot_key_is_split(spark, tmp_path, conf, hot_side):
    cold = [(f"k{i}", "p", i) for i in range(2000)]
    hot = cold + [("hot", "p", i) for i in range(20000)]
    sides = {"dim": cold, "stage": cold, hot_side: hot}
    conf(
        {
            **RECOMMENDED,
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.files.maxPartitionBytes": "16k",
            "spark.sql.files.openCostInBytes": "1k",
        }
    )
    dim = stored(spark, tmp_path / "dim", opened(sides["dim"], D1))
    stage = stored(spark, tmp_path / "stage", opened(sides["stage"], D2))
    merged = scd2.scd2_merge(dim, stage, KEYS, TRACKED)
    assert len(merged.collect()) == len(hot)
    assert "skew=true" in plan_of(merged).split("== Initial Plan ==")[0]
