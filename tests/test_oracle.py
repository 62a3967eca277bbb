"""Every registered query against its DuckDB oracle, on sf0.001."""

import pytest
from oracle_check import compare

import __spark_entry__ as entry
from punctuality.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["origin", "month", "low_str", "med_str", "high_str", "cause_str"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, sorted(QUERIES))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(results, name):
    r = results[name]
    assert r["cols_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["hash_match"], r
