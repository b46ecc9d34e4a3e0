"""Registered queries vs. their DuckDB oracle on the smallest driver scale."""

import collections
import os

import pytest

import __spark_entry__ as entry
from barsmith import catalog
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
KEYS = ["scan_raw_bars", "stage_bars", "stock_returns", "moving_averages", "technical_indicators",
        "fact_daily_fused", "fact_daily", "dim_stock_summary", "fact_portfolio", "registered_views"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.exists(f"{SF}/lineitem.parquet"):
        pytest.skip("driver test data not present")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    own = set(catalog.spark_queries())  # the training-data operators have tests of their own
    assert own == set(catalog.oracle_queries()) and own <= set(entry.queries()) and own <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 44 and df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    s = collections.Counter(rows_of(df.columns, df.collect()))
    res = duck.execute(entry.oracle_sql()[key])
    cols = [c[0] for c in res.description]
    d = collections.Counter(rows_of(cols, res.fetchall()))
    assert sorted(df.columns) == sorted(cols)
    assert s == d
