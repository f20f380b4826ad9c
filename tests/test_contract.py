"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from bindings.check import compare, connect
from bindings.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query_matches_sql(spark, connection, key):
    df = entry.queries()[key](spark, SF_DIR)
    # every query of the library reads files
    assert key not in QUERIES or "Relation [" in df._jdf.queryExecution().optimizedPlan().toString()
    oracle = entry.oracle_sql().get(key)
    if oracle is None:
        assert df.count() > 0
    else:
        assert compare(df, connection, oracle) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
