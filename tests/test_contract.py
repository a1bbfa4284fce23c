"""The driver contract: entry runs, every query has a callable, and every
oracle-backed query equals its DuckDB statement on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "from_user_id", "to_user_id", "text"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_all_queries_match_oracle(spark):
    q, sqls = entry.queries(), entry.oracle_sql()
    con = duck(SF)
    bad = []
    for name in q:
        r = compare(spark, name, SF, q, sqls, con)
        if r["status"] not in ("match", "no-oracle"):
            bad.append(r)
    assert not bad, bad
