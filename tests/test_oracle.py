"""Every registered query against its DuckDB SQL on the smallest driver tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from ordermill.plans import oracle, registry
from tools.oracle_check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_DIR}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def test_every_query_has_oracle_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(registry.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    cols = sorted(df.columns)
    got = [r.asDict() for r in df.collect()]
    rel = duck.sql(contract.oracle_sql()[name])
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(rel.columns) == cols
    assert len(got) == len(want)
    assert rows_of(got, cols) == rows_of(want, cols)


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "avg_order_value" in df.columns
