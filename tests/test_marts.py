import datetime as dt

import pytest
from pyspark.sql import functions as F

from barsmith.catalog import stabilize
from barsmith.functions import signals as S
from barsmith.plans.daily_fact import daily_performance_fused
from barsmith.plans.portfolio import portfolio_performance
from barsmith.plans.summary import latest_per_ticker, stock_summary
from barsmith.sources.bars import stage_landed
from barsmith.sources.schema import PORTFOLIO_COLUMNS, SUMMARY_COLUMNS
from conftest import bar, f2_bars, series_rows, staged_from

UPDATED = dt.datetime(2025, 1, 1)


def fact(spark, rows):
    return daily_performance_fused(staged_from(spark, rows), updated_at=UPDATED)


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_summary_latest_and_stale(spark):
    rows = series_rows("AAPL", [100, 110, 105], start=dt.date(2025, 3, 1)) + series_rows(
        "MSFT", [50, 51], start=dt.date(2024, 1, 1)
    )
    s = {r.ticker: r for r in stock_summary(fact(spark, rows), as_of="2025-03-20", updated_at=UPDATED).collect()}
    assert list(stock_summary(fact(spark, rows), as_of="2025-03-20").columns) == SUMMARY_COLUMNS
    a = s["AAPL"]
    assert a.latest_trade_date == dt.date(2025, 3, 3) and float(a.current_price) == 105.0
    assert float(a.low_30d) == 100.0 and float(a.high_30d) == 110.0
    assert a.price_position_pct == pytest.approx(50.0)
    assert a.total_trading_days == 3 and a.volume_vs_avg_pct == pytest.approx(100.0)
    m = s["MSFT"]  # stale: no bar in the trailing window -> stats NULL, row kept
    assert m.latest_trade_date == dt.date(2024, 1, 2)
    assert m.avg_return_30d is None and m.low_30d is None and m.total_trading_days is None
    assert m.price_position_pct is None


def test_summary_window_is_inclusive_calendar_days(spark):
    rows = series_rows("AAPL", [100, 101, 102], start=dt.date(2025, 2, 18))  # 2/18, 2/19, 2/20
    s = stock_summary(fact(spark, rows), as_of="2025-03-20").first()  # as_of - 30 = 2025-02-18
    assert s.total_trading_days == 3


def test_summary_aggregate_form_equals_backjoin(spark):
    f = daily_performance_fused(stage_landed(f2_bars(spark)), updated_at=UPDATED)
    for rec in ("sma_recommendation", "composite_recommendation"):
        same(stock_summary(f, as_of="2025-06-01", recommendation_col=rec, updated_at=UPDATED),
             stock_summary(f, as_of="2025-06-01", recommendation_col=rec, updated_at=UPDATED, keys_unique=False))


def test_portfolio_missing_benchmark_and_single_stock(spark):
    rows = (
        series_rows("AAPL", [100, 102, 101])
        + series_rows("MSFT", [50, 51])
        + series_rows("SPY", [10, 11], start=dt.date(2025, 1, 2))  # no SPY bar on day 0
        + [bar("QQQ", dt.date(2025, 1, 10), 5)]  # benchmark-only day: no portfolio row
    )
    p = {r.trade_date: r for r in portfolio_performance(fact(spark, rows), updated_at=UPDATED).collect()}
    assert set(p) == {dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)}
    d0, d1, d2 = p[dt.date(2025, 1, 1)], p[dt.date(2025, 1, 2)], p[dt.date(2025, 1, 3)]
    assert d0.spy_return_pct is None and d0.alpha_vs_spy is None and d0.num_stocks == 2
    assert d1.spy_return_pct is None  # first SPY bar has no return
    assert d2.num_stocks == 1 and d2.portfolio_volatility is None and d2.risk_adjusted_return is None
    assert d2.spy_return_pct == pytest.approx(10.0)
    assert d2.alpha_vs_spy == pytest.approx(d2.portfolio_daily_return_pct - 10.0)
    assert float(d1.total_portfolio_value) == 153.0 and d1.avg_stock_price == pytest.approx(76.5)
    assert d0.market_regime == "NORMAL"  # null return, null volatility


def test_portfolio_counts_sum_and_forms_agree(spark):
    f = daily_performance_fused(stage_landed(f2_bars(spark, tickers=(("AAPL", -1), ("MSFT", 1), ("SPY", 1), ("QQQ", -1)))),
                                updated_at=UPDATED)
    for rec in ("sma_recommendation", "composite_recommendation"):
        a = portfolio_performance(f, recommendation_col=rec, updated_at=UPDATED)
        assert a.columns == PORTFOLIO_COLUMNS
        same(a, portfolio_performance(f, recommendation_col=rec, updated_at=UPDATED, keys_unique=False))
        for r in a.collect():
            assert r.num_strong_buy + r.num_buy + r.num_hold + r.num_sell + r.num_strong_sell == r.num_stocks
            assert r.num_bullish + r.num_bearish + r.num_neutral == r.num_stocks
            assert -200 <= r.sentiment_score <= 200


def test_regimes_and_sentiment_bounds(spark):
    L = F.lit
    cases = [(2.5, 1.5), (-2.5, 3.5), (1.0, 4.5), (0.2, 2.0), (1.0, 2.0), (None, None)]
    exprs = [S.market_regime(L(r).cast("double"), L(v).cast("double")) for r, v in cases]
    exprs += [S.sentiment_score(L(3), L(0), L(0), L(0), L(3)), S.sentiment_score(L(0), L(0), L(0), L(3), L(3)),
              S.sentiment_score(L(0), L(0), L(0), L(0), L(0))]
    r = spark.range(1).select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first()
    assert list(r)[:6] == ["BULL_MARKET", "BEAR_MARKET", "HIGH_VOLATILITY", "SIDEWAYS", "NORMAL", "NORMAL"]
    assert r[6] == 200.0 and r[7] == -200.0 and r[8] is None


def test_portfolio_with_custom_benchmarks(spark):
    f = daily_performance_fused(
        stage_landed(f2_bars(spark, tickers=(("AAPL", -1), ("MSFT", 1), ("SPY", 1), ("QQQ", -1)))), updated_at=UPDATED
    )
    one = portfolio_performance(f, benchmarks=("SPY",), updated_at=UPDATED)
    assert "spy_return_pct" in one.columns and "alpha_vs_spy" in one.columns
    assert "qqq_return_pct" not in one.columns
    # QQQ is now an ordinary stock of the portfolio
    assert {r.num_stocks for r in one.collect()} == {3}
    # three stocks a day: averages/stddevs depend on summation order in the last
    # bits, so the order-sensitive columns are compared at 6 decimals
    joined = portfolio_performance(f, benchmarks=("SPY",), updated_at=UPDATED, keys_unique=False)
    same(stabilize(one), stabilize(joined))
    table = spark.createDataFrame([("SPY",), (None,), ("SPY",)], "ticker string")
    assert one.columns == portfolio_performance(f, benchmarks=table, updated_at=UPDATED).columns
    same(stabilize(one), stabilize(portfolio_performance(f, benchmarks=table, updated_at=UPDATED)))


def test_latest_rows_keep_ties(spark):
    rows = [("AAPL", dt.date(2025, 1, d), float(d * 10 + k)) for d in (1, 2, 3) for k in (0, 1)] + [("MSFT", dt.date(2024, 1, 1), 5.0), ("MSFT", None, 6.0), ("X", None, 7.0)]
    fact = spark.createDataFrame(rows, "ticker string, trade_date date, close_price double").selectExpr(
        "*", "'n' AS company_name", "1.0D AS volume", "'HOLD' AS sma_recommendation", "'NEUTRAL' AS trend_signal")
    got = sorted((r.ticker, r.latest_trade_date.day, r.current_price) for r in latest_per_ticker(fact).collect())
    assert got == [("AAPL", 3, 30.0), ("AAPL", 3, 31.0), ("MSFT", 1, 5.0)]


def test_missing_benchmark_day_in_the_join_form(spark):
    rows = series_rows("AAPL", [100, 102, 101]) + series_rows("SPY", [10, 11], start=dt.date(2025, 1, 2))
    p = {r.trade_date.day: r for r in portfolio_performance(fact(spark, rows), updated_at=UPDATED, keys_unique=False).collect()}
    assert p[1].spy_return_pct is None and p[1].alpha_vs_spy is None and p[3].spy_return_pct == pytest.approx(10.0)
    assert p[3].qqq_return_pct is None and set(p) == {1, 2, 3}
