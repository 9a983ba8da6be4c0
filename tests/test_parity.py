"""Every SQL-expressible query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from parity import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SMALL)
    assert r["ok"], r


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert {r.level for r in rows} == {"UG", "GR"}
