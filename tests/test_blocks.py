"""Series cut into blocks give the rows of the series pass, whatever gaps and NULLs."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from barsmith.operators.blocks import HALO_ROWS, blocked_series_pass, daily_performance_blocked, numbered_bars
from barsmith.operators.series import series_pass
from barsmith.plans.daily_fact import daily_performance_fused
from barsmith.sources.bars import stage_landed
from conftest import LANDED_SCHEMA, bar, f2_bars, staged_from

UPDATED = dt.datetime(2025, 1, 1)


def gappy(spark, seed):
    rng = random.Random(seed)
    rows = []
    for ticker, nulls in (("AAPL", 0.0), ("MSFT", 0.3), ("TSLA", 0.93), ("SPY", 1.0), ("QQQ", 0.05)):
        day, quiet = dt.date(2000, 1, 1), 0
        for i in range(rng.randrange(250, 420)):
            day += dt.timedelta(days=1 if rng.random() < 0.9 else rng.randrange(2, 400))
            quiet = quiet - 1 if quiet else (rng.randrange(100, 160) if rng.random() < 0.004 else 0)  # long runs without a close
            close = None if quiet or rng.random() < nulls else 100 + rng.randrange(-900, 900) / 100
            rows.append(bar(ticker, day, close, open_=100, high=120, low=80, volume=rng.randrange(0, 5) * 100.0, vwap=1.0))
    rows.append(bar("AAPL", None, 5.0))
    rng.shuffle(rows)
    return stage_landed(spark.createDataFrame(rows, LANDED_SCHEMA))


def rounded(df):
    """Float means and deviations at 9 decimals: a frame's first rows are the same, its history isn't."""
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    a, b = rounded(a), rounded(b.select(*a.columns))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("seed,block_rows,span_days", [(1, HALO_ROWS, 30), (2, 131, 1), (3, 100, 10_000)])
def test_blocks_equal_the_series_pass_on_gappy_series(spark, seed, block_rows, span_days):
    stg = gappy(spark, seed).cache()
    same(blocked_series_pass(stg, block_rows, span_days), series_pass(stg))


def test_blocked_fact_equals_the_fused_one(spark):
    stg = stage_landed(f2_bars(spark, tickers=(("AAPL", -1), ("MSFT", 1), ("SPY", 1))))
    same(daily_performance_blocked(stg, UPDATED, block_rows=95, span_days=50), daily_performance_fused(stg, UPDATED))


def test_positions_count_on_over_spans(spark):
    stg = gappy(spark, 4)
    got = numbered_bars(stg, 45).where("ticker = 'MSFT'").orderBy("trade_date").collect()
    assert [r["_row"] for r in got] == list(range(len(got)))
    assert [r["_prev_date"] for r in got] == [None] + [r["trade_date"] for r in got[:-1]]
    assert [r["_prev_close"] for r in got] == [None] + [r["close_price"] for r in got[:-1]]
    assert [r["_prev_row"] for r in got if r["_prev_close"] is not None] == list(range(sum(r["_prev_close"] is not None for r in got)))


def test_one_hot_ticker_is_spread_over_tasks(spark):
    n = 20_000
    days = spark.range(n).select(
        (F.col("id") * 86_400_000).alias("T"), *[(F.lit(100) + F.col("id") % 37 + k).cast("decimal(18,4)").alias(x) for k, x in enumerate("OHLC")],
        F.lit(100.0).alias("V"), F.lit(1.0).alias("VW"), F.lit(1).cast("long").alias("N"), F.lit("AAPL").alias("ticker"))
    stg = stage_landed(days)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert tasks(series_pass(stg)) == [n]
        spread = tasks(blocked_series_pass(stg, block_rows=500, span_days=500))
        assert sum(spread) == n and len(spread) >= 16 and max(spread) <= 10 * 500
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_only_the_table_of_spans_has_windows_by_ticker_alone(spark):
    windows = lambda df: re.findall(r"Window \[.*\], \[(ticker#\d+)\], \[(\w+)#", df._jdf.queryExecution().optimizedPlan().toString())
    stg = gappy(spark, 5)
    assert {order for _, order in windows(blocked_series_pass(stg))} == {"_span"}
    assert "trade_date" in {order for _, order in windows(series_pass(stg))}


def test_duplicate_keys_raise_across_block_edges(spark):
    rows = [bar("AAPL", dt.date(2000, 1, 1) + dt.timedelta(days=i), 5) for i in range(200)]
    for i in (89, 90, 150):
        with pytest.raises(Exception, match="duplicate"):
            blocked_series_pass(staged_from(spark, rows + [rows[i]]), HALO_ROWS, 30).count()
    with pytest.raises(ValueError):
        blocked_series_pass(staged_from(spark, rows), HALO_ROWS - 1)


def test_empty_table(spark):
    assert blocked_series_pass(staged_from(spark, [])).count() == 0
