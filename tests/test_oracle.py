"""Every registered query against its SQL on the driver tables."""

from __future__ import annotations

import os

import oracle
import pytest

from headway.demos import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert QUERIES.keys() <= e.queries().keys() and e.oracle_sql().keys() <= e.queries().keys()
