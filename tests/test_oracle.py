"""Every registered query runs; those with a SQL twin give the same rows."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, con, name):
    assert compare(QUERIES[name](spark, small), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_with_rows(spark, small, name):
    assert len(QUERIES[name](spark, small).collect()) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 25
