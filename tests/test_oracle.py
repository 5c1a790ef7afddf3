"""Every registered query against its DuckDB oracle on the smallest driver scale."""

import re

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

from conftest import SMALL

# The training-data operators have their own tests.
QUERIES = {k: f for k, f in E.queries().items() if k != "pipeline" and not re.match(r"op\d+_", k)}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, QUERIES[key], ORACLE.get(key), SMALL, con)
    if key in ORACLE:
        assert r["names_match"], r
        assert r["spark_rows"] == r["oracle_rows"], r
        assert r["values_match"], r
        assert r["types_match"], r
    else:
        assert r["spark_rows"] > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_score" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) <= set(ORACLE)
