"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tickwell.registry import load_all  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
KEYS = sorted(load_all())
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in check_oracle.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, con, key):
    text, _, ok = check_oracle.check(spark, con, key, QUERIES[key], SQL.get(key), SF_DIR)
    assert ok, text


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "close_price" in df.columns and df.count() > 0


def test_every_query_has_sql():
    assert set(KEYS) <= set(SQL) and set(KEYS) <= set(QUERIES)
