from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
# Forked Python workers, if any, must find the package as well.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    changed = []

    def put(settings):
        for k, v in settings.items():
            changed.append((k, spark.conf.get(k, None)))
            spark.conf.set(k, v)

    yield put
    for k, old in reversed(changed):
        spark.conf.unset(k) if old is None else spark.conf.set(k, old)


def plan_of(df) -> str:
    """Physical plan; run the frame first to see what adaptive execution made of it."""
    return df._jdf.queryExecution().executedPlan().toString()


def tuples(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
