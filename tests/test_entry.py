"""Driver contract: entry() smoke check and every registered query against its DuckDB
oracle at sf0.001 (the driver does the same at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "gwp_absolute" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    qs, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 40


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert r["status"] == "OK", r
