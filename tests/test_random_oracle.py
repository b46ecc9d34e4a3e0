"""Random edge-case series: Spark plans vs the DuckDB oracle SQL on the same rows.

Series carry NULL closes, zero prices, flat runs, calendar gaps and NULL-dated
bars; the oracle CTEs (reference-shaped SQL) run on an identical staged table.
"""

import collections
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from barsmith import oracle as O
from barsmith.catalog import stabilize
from barsmith.plans.daily_fact import daily_performance_fused
from barsmith.plans.portfolio import portfolio_performance
from barsmith.plans.summary import stock_summary
from barsmith.sources.registry import TICKERS
from barsmith.sources.schema import FACT_COLUMNS, PORTFOLIO_COLUMNS, STAGED_COLUMNS, SUMMARY_COLUMNS
from tools.check_oracle import rows_of

UPDATED = dt.datetime.fromisoformat(O.UPDATED_AT)
SEEDS = [int(x) for x in os.environ.get("RANDOM_SEEDS", "1,7,42").split(",")]  # more: RANDOM_SEEDS=2,3,...


def random_rows(seed: int):
    rnd = random.Random(seed)
    rows = []
    for ticker in ("AAPL", "MSFT", "SPY", "QQQ", "TSLA"):
        day = dt.date(2001, 8, 1)
        price = rnd.randint(50, 500)
        for _ in range(rnd.randint(60, 140)):
            day += dt.timedelta(days=rnd.choice([1, 1, 1, 2, 3]))
            u = rnd.random()
            if u < 0.03:
                close = None
            elif u < 0.04:
                close = "0"
            elif u < 0.12:
                close = f"{price:.4f}"  # flat run
            else:
                price = max(1.0, price * (1 + rnd.gauss(0, 0.03)))
                close = f"{price:.4f}"
            open_ = None if close is None else f"{max(0.0, price + rnd.choice([-1, 0, 1]) * 0.25):.4f}"
            hi = None if close is None else f"{price + 1:.4f}"
            lo = None if close is None else f"{max(0.0, price - 1):.4f}"
            vol = rnd.choice([0.0, float(rnd.randint(100, 5000))]) if u > 0.02 else None
            ts = dt.datetime.combine(day, dt.time(4, 0))
            rows.append((ticker, TICKERS[ticker], ts, day, open_, hi, lo, close, vol, 1.0, 10))
        rows.append((ticker, TICKERS[ticker], None, None, "1.0000", "1.0000", "1.0000", "1.0000", 1.0, 1.0, 1))
    return rows


def spark_stg(spark, rows):
    df = spark.createDataFrame(
        [tuple(str(v) if isinstance(v, str) else v for v in r) for r in rows],
        "ticker string, company_name string, timestamp timestamp_ntz, trade_date date, o string, h string, "
        "l string, c string, volume double, vwap double, num_transactions bigint",
    )
    dec = "decimal(18,4)"
    return df.select(
        "ticker", "company_name", "timestamp", "trade_date",
        F.col("o").cast(dec).alias("open_price"), F.col("h").cast(dec).alias("high_price"),
        F.col("l").cast(dec).alias("low_price"), F.col("c").cast(dec).alias("close_price"),
        "volume", "vwap", "num_transactions",
    ).select(*STAGED_COLUMNS)


def duck_con(rows):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE raw_stg (ticker VARCHAR, company_name VARCHAR, ts TIMESTAMP, d DATE, o VARCHAR, h VARCHAR, "
        "l VARCHAR, c VARCHAR, volume DOUBLE, vwap DOUBLE, n BIGINT)"
    )
    con.executemany("INSERT INTO raw_stg VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?, ?, ?)", rows)
    con.execute(
        """CREATE VIEW stg AS SELECT ticker, company_name, ts AS "timestamp", d AS trade_date,
           CAST(o AS DECIMAL(18,4)) AS open_price, CAST(h AS DECIMAL(18,4)) AS high_price,
           CAST(l AS DECIMAL(18,4)) AS low_price, CAST(c AS DECIMAL(18,4)) AS close_price,
           volume, vwap, n AS num_transactions FROM raw_stg"""
    )
    return con


def compare(df, con, sql):
    s = collections.Counter(rows_of(df.columns, df.collect()))
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    d = collections.Counter(rows_of(cols, res.fetchall()))
    assert sorted(df.columns) == sorted(cols)
    only_s, only_d = s - d, d - s
    assert not only_s and not only_d, (list(only_s.elements())[:2], list(only_d.elements())[:2])


FACT_CTES = (O.CTE_RETURNS, O.CTE_MA, O.CTE_TI, O.CTE_FACT)


@pytest.mark.parametrize("seed", SEEDS)
def test_random_series_match_oracle(spark, seed):
    rows = random_rows(seed)
    stg = spark_stg(spark, rows)
    con = duck_con(rows)
    fact = daily_performance_fused(stg, updated_at=UPDATED)
    compare(stabilize(fact), con, O.with_ctes(O.stable_select(FACT_COLUMNS, "fact"), *FACT_CTES))
    for rec in ("sma_recommendation", "composite_recommendation"):
        dim = stock_summary(fact, as_of=O.AS_OF, recommendation_col=rec, updated_at=UPDATED)
        compare(stabilize(dim), con,
                O.with_ctes(O.stable_select(SUMMARY_COLUMNS, "summary"), *FACT_CTES, O.cte_summary(rec)))
        port = portfolio_performance(fact, recommendation_col=rec, updated_at=UPDATED)
        compare(stabilize(port), con,
                O.with_ctes(O.stable_select(PORTFOLIO_COLUMNS, "portfolio"), *FACT_CTES, O.cte_portfolio(rec)))
