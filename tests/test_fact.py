import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barsmith.functions import signals as S
from barsmith.operators.guards import find_duplicate_keys
from barsmith.operators.indicators import technical_indicators, technical_indicators_joined
from barsmith.operators.moving_averages import moving_averages
from barsmith.operators.returns import stock_returns
from barsmith.plans.daily_fact import daily_performance, daily_performance_fused
from barsmith.sources.bars import stage_landed
from barsmith.sources.schema import FACT_COLUMNS
from conftest import bar, f2_bars, series_rows, staged_from

UPDATED = dt.datetime(2025, 1, 1)


def joined(stg):
    ret = stock_returns(stg)
    return daily_performance(ret, moving_averages(ret), technical_indicators_joined(stg), updated_at=UPDATED)


def assert_same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fact_columns_and_first_bar(spark):
    stg = staged_from(spark, series_rows("AAPL", [100, 101, 99]))
    f = daily_performance_fused(stg, updated_at=UPDATED)
    assert f.columns == FACT_COLUMNS and len(FACT_COLUMNS) == 44
    first = f.orderBy("trade_date").first()
    assert first.performance_key == "AAPL_2025-01-01"
    assert first.rsi_14_day is None and first.macd_line is None and first.advanced_signal is None
    assert first.trend_signal == "NEUTRAL" and first.sma_recommendation == "HOLD"
    assert first.composite_recommendation == "HOLD"
    assert first.volatility_risk_level == "VERY_LOW_RISK" and first.bollinger_squeeze_indicator == "NORMAL"


def test_fused_equals_joined_on_edge_series(spark):
    rows = (
        series_rows("AAPL", [100, 102, 101, None, 103, 104, 90, 95] + list(range(80, 140, 3)))
        + series_rows("MSFT", [50] * 30)
        + series_rows("TSLA", [0, 5, 0, 7])
        + [bar("AAPL", None, 7), bar("MSFT", None, None)]
        + series_rows("NVDA", [None, None, 10, 11, None, None, 12] + list(range(20, 60)))
    )
    stg = staged_from(spark, rows)
    assert_same(daily_performance_fused(stg, updated_at=UPDATED), joined(stg))


def test_fused_equals_joined_on_f2(spark):
    stg = stage_landed(f2_bars(spark))
    assert_same(daily_performance_fused(stg, updated_at=UPDATED), joined(stg))


def test_indicator_forms_agree(spark):
    rows = (
        series_rows("AAPL", [100, 102, 101, None, 103, 104, 90, 95] + list(range(80, 140, 3)))
        + [bar("AAPL", None, 7)]
        + series_rows("NVDA", [None, None, 10, 11, None, None, 12] + list(range(20, 60)))
    )
    for stg in (staged_from(spark, rows), stage_landed(f2_bars(spark))):
        assert_same(technical_indicators(stg), technical_indicators_joined(stg))


def test_f2_reaches_every_combined_signal(spark):
    f = daily_performance_fused(stage_landed(f2_bars(spark)), updated_at=UPDATED)
    counts = Counter(r.advanced_signal for r in f.collect())
    assert counts["STRONG_BUY"] == 4 and counts["STRONG_SELL"] == 4
    assert counts["BUY"] == 1 and counts["SELL"] == 1
    hits = {(r.ticker, r.advanced_signal): r.trade_date for r in
            f.where(F.col("advanced_signal").isin("BUY", "SELL")).collect()}
    assert hits[("AAPL", "BUY")] == dt.date(2025, 3, 13)
    assert hits[("MSFT", "SELL")] == dt.date(2025, 3, 13)
    sb = sorted(r.trade_date for r in f.where("ticker = 'AAPL' and advanced_signal = 'STRONG_BUY'").collect())
    assert sb == [dt.date(2025, 4, d) for d in (3, 4, 5, 6)]
    rsi_labels = {r.rsi_signal for r in f.collect()} - {None}
    assert rsi_labels == {"EXTREMELY_OVERBOUGHT", "EXTREMELY_OVERSOLD", "OVERBOUGHT", "OVERSOLD", "NEUTRAL"}
    assert {r.sma_recommendation for r in f.collect()} == {"STRONG_BUY", "BUY", "HOLD", "SELL", "STRONG_SELL"}


def test_duplicate_key_fails_the_job(spark):
    rows = series_rows("AAPL", [100, 101, 102]) + [bar("AAPL", dt.date(2025, 1, 2), 99)]
    stg = staged_from(spark, rows)
    assert find_duplicate_keys(stg).count() == 1
    for df in (daily_performance_fused(stg), stock_returns(stg)):
        with pytest.raises(Exception, match="duplicate"):
            df.collect()
    assert daily_performance_fused(stg, check_keys=False).count() == 4  # opt-out: no guard


def test_invariant_to_input_order_and_partitions(spark):
    stg = stage_landed(f2_bars(spark))
    base = daily_performance_fused(stg, updated_at=UPDATED)
    shuffled = daily_performance_fused(stg.repartition(7).orderBy(F.rand(3)), updated_at=UPDATED)
    assert_same(base, shuffled)


def test_invariant_to_shuffle_partitions(spark):
    stg = stage_landed(f2_bars(spark))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = daily_performance_fused(stg, updated_at=UPDATED).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = daily_performance_fused(stg, updated_at=UPDATED).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_properties_on_f2(spark):
    f = daily_performance_fused(stage_landed(f2_bars(spark)), updated_at=UPDATED).collect()
    for r in f:
        if r.rsi_14_day is not None:
            assert 0 <= r.rsi_14_day <= 100
            assert r.bollinger_lower_band <= r.bollinger_middle_band <= r.bollinger_upper_band
            assert -100 <= r.signal_strength_score <= 100


def _labels(spark, exprs):
    return spark.range(1).select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first()


def test_composite_recommendation_branches(spark):
    L, cr = F.lit, S.composite_recommendation
    r = _labels(spark, [
        cr(L("STRONG_BUY"), L("OVERSOLD"), L("BULLISH"), L(12), L(11), L(10)),    # confirmed strong buy
        cr(L("STRONG_BUY"), L("OVERSOLD"), L("BULLISH"), L(9), L(9.5), L(10)),     # unconfirmed -> BUY via pair
        cr(L("STRONG_SELL"), L("OVERBOUGHT"), L("BEARISH"), L(8), L(9), L(10)),   # confirmed strong sell
        cr(L("BUY"), L("NEUTRAL"), L("NEUTRAL"), L(1), L(1), L(1)),               # BUY via combined
        cr(L("HOLD"), L("OVERSOLD"), L("BULLISH"), L(1), L(1), L(1)),              # BUY via RSI/MACD pair
        cr(L("SELL"), L("NEUTRAL"), L("NEUTRAL"), L(1), L(1), L(1)),              # SELL via combined
        cr(L("HOLD"), L("OVERBOUGHT"), L("BEARISH"), L(1), L(1), L(1)),            # SELL via pair
        cr(L("HOLD"), L("NEUTRAL"), L("NEUTRAL"), L(12), L(11), L(10)),            # BUY via SMA fallback
        cr(L("HOLD"), L("NEUTRAL"), L("NEUTRAL"), L(8), L(9), L(10)),              # SELL via SMA fallback
        cr(L("HOLD"), L("NEUTRAL"), L("NEUTRAL"), L(10), L(10), L(10)),            # HOLD
        cr(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string"), L(1), L(1), L(1)),
    ])
    assert list(r) == ["STRONG_BUY", "BUY", "STRONG_SELL", "BUY", "BUY", "SELL", "SELL", "BUY", "SELL", "HOLD", "HOLD"]


def test_label_thresholds(spark):
    L = F.lit
    r = _labels(spark, [
        S.bollinger_squeeze(F.round(L(4.996), 2)), S.bollinger_squeeze(L(4.99)), S.bollinger_squeeze(L(20.01)),
        S.volatility_risk_level(L(3.01)), S.volatility_risk_level(L(2.5)), S.volatility_risk_level(L(1.5)),
        S.volatility_risk_level(F.lit(None).cast("double")),
        S.volume_indicator(L(201.0), L(100.0)), S.volume_indicator(L(49.0), L(100.0)), S.volume_indicator(L(100.0), L(100.0)),
        S.trend_signal(L(2.0), L(1.0)), S.trend_signal(L(1.0), L(2.0)), S.trend_signal(L(1.0), L(1.0)),
        S.rsi_label(L(7.0), L(3.0)), S.rsi_label(L(3.0), L(7.0)), S.rsi_label(L(1.0), L(1.0)),
    ])
    assert list(r) == ["NORMAL", "SQUEEZE", "EXPANSION", "HIGH_RISK", "MEDIUM_RISK", "LOW_RISK", "VERY_LOW_RISK",
                       "HIGH", "LOW", "NORMAL", "BULLISH", "BEARISH", "NEUTRAL", "OVERBOUGHT", "OVERSOLD", "NEUTRAL"]


def test_performance_key_is_null_propagating(spark):
    r = _labels(spark, [S.performance_key(F.lit("AAPL"), F.lit(None).cast("date")),
                        S.performance_key(F.lit("AAPL"), F.lit(dt.date(2025, 1, 2)))])
    assert r[0] is None and r[1] == "AAPL_2025-01-02"
