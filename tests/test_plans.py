"""Physical-plan shape: shuffles, joins and partial aggregation."""

import datetime as dt
import uuid

from barsmith.operators.indicators import technical_indicators, technical_indicators_joined
from barsmith.operators.moving_averages import moving_averages
from barsmith.operators.returns import stock_returns
from barsmith.plans import bucketed
from barsmith.plans.daily_fact import daily_performance, daily_performance_fused
from barsmith.plans.portfolio import portfolio_performance
from barsmith.plans.summary import latest_per_ticker, stock_summary
from barsmith.sources.bars import stage_landed
from barsmith.warehouse import Warehouse
from conftest import f2_bars


def plan(df):
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_fused_fact_has_one_exchange_and_no_join(spark):
    p = plan(daily_performance_fused(stage_landed(f2_bars(spark))))
    assert p.count("Exchange hashpartitioning") == 1
    assert "Join" not in p
    assert p.count("Sort [") == 2  # series order, then the RSI (ticker, has_prev) order


def test_joined_fact_needs_more_shuffles(spark):
    stg = stage_landed(f2_bars(spark))
    ret = stock_returns(stg)
    p = plan(daily_performance(ret, moving_averages(ret), technical_indicators_joined(stg)))
    assert p.count("Exchange") > 1 and "Join" in p


def test_marts_are_single_partial_aggregations(spark):
    f = daily_performance_fused(stage_landed(f2_bars(spark)), updated_at=dt.datetime(2025, 1, 1))
    # the summary groups by ticker: it reuses the fact's ticker partitioning
    p = plan(stock_summary(f, as_of="2025-06-01"))
    assert "Join" not in p and p.count("Exchange hashpartitioning") == 1
    # the portfolio groups by date: one more shuffle, after a map-side partial aggregate
    p = plan(portfolio_performance(f))
    assert "Join" not in p and p.count("Exchange hashpartitioning") == 2
    assert "partial_" in p


def test_summary_prunes_the_series_pass_down_to_its_columns(spark, tmp_path):
    from barsmith.sources.bars import read_landed

    f2_bars(spark).write.partitionBy("ticker").parquet(str(tmp_path / "landed"))
    fact = daily_performance_fused(stage_landed(read_landed(spark, str(tmp_path / "landed"))))
    p = plan(stock_summary(fact, as_of="2025-06-01"))
    # only the columns the summary needs reach the scan ...
    schema = p[p.index("ReadSchema: struct<") + len("ReadSchema: struct<"):].split(">")[0]
    fields = {f.split(":")[0] for f in schema.split(",")}
    assert {"T", "C", "V"} <= fields and not fields & {"O", "H", "L", "VW", "N"}
    # ... and no MACD / Bollinger / RSI window is computed
    assert "_macd_line" not in p and "_bb_sd" not in p and "_gain" not in p


def test_bucketed_joins_need_no_exchange(spark, tmp_path):
    stg = stage_landed(f2_bars(spark, tickers=(("AAPL", -1), ("MSFT", 1), ("SPY", 1))))
    name = f"buckets_{uuid.uuid4().hex[:10]}"
    w = Warehouse(spark, name, str(tmp_path / "tables"))
    bars = bucketed.bucketed_bars(w, stg, 4)
    p = plan(technical_indicators(bars))  # windows by ticker read the buckets as they are
    assert "Exchange" not in p and "Bucketed: true" in p
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        indicators, fact = bucketed.joined_indicators(w, bars, 4), bucketed.joined_fact(w, bars, 4, dt.datetime(2025, 1, 1))
        for df, joins in ((indicators, 2), (fact, 2)):
            p = plan(df)
            assert "Exchange" not in p and p.count("SortMergeJoin") == joins
        want = technical_indicators(stg)
        assert indicators.exceptAll(want).count() == 0 and want.exceptAll(indicators).count() == 0
        lazy = daily_performance(stock_returns(stg), moving_averages(stock_returns(stg)), technical_indicators_joined(stg), dt.datetime(2025, 1, 1))
        assert fact.exceptAll(lazy).count() == 0 and lazy.exceptAll(fact).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_latest_rows_and_benchmarks_take_one_scan_and_one_join(spark):
    f = daily_performance_fused(stage_landed(f2_bars(spark, tickers=(("AAPL", -1), ("SPY", 1), ("QQQ", 1)))), updated_at=dt.datetime(2025, 1, 1))
    p = plan(latest_per_ticker(f))
    assert "Join" not in p and p.count("WindowGroupLimit") >= 1
    # joined once, and only broadcast when its size is known (no hint)
    p = plan(portfolio_performance(f, keys_unique=False))
    assert p.count("SortMergeJoin") + p.count("BroadcastHashJoin") == 1
