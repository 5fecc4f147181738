"""Every query with SQL gives the rows DuckDB gives."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = {k: q for k, q in entry.queries().items() if k not in entry.LLM_QUERIES}, {k: q for k, q in entry.oracle_sql().items() if k not in entry.LLM_ORACLES}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
