"""Every query of the core registry against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as entry_mod
from tools.oracle_check import compare, duck
from turnstile.queries import ORACLE as SQL
from turnstile.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL) <= set(entry_mod.queries())
    assert set(SQL) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, detail = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert ok, detail


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["line_name", "total_passengers"] and df.count() > 0
