import datetime as dt

import pytest

from barsmith.operators.indicators import bollinger, macd, rsi, technical_indicators
from barsmith.operators.moving_averages import moving_averages
from barsmith.operators.returns import stock_returns
from conftest import bar, series_rows, staged_from

D0 = dt.date(2025, 1, 1)


def d(i):
    return D0 + dt.timedelta(days=i)


def test_first_and_second_bar(spark):
    stg = staged_from(spark, series_rows("AAPL", [100, 102]))
    r = {x.trade_date: x for x in stock_returns(stg).collect()}
    assert r[d(0)].daily_return_pct is None
    assert r[d(1)].daily_return_pct == pytest.approx(2.0)
    ma = {x.trade_date: x for x in moving_averages(stock_returns(stg)).collect()}
    assert ma[d(0)].sma_7_day == 100.0 and ma[d(0)].sma_90_day == 100.0
    assert ma[d(1)].sma_7_day == 101.0
    assert ma[d(0)].volatility_30_day is None and ma[d(1)].volatility_30_day is None
    rs = {x.trade_date: x for x in rsi(stg).collect()}
    assert d(0) not in rs  # no previous close
    assert rs[d(1)].rsi_14 == 100.0 and rs[d(1)].rsi_signal == "EXTREMELY_OVERBOUGHT"


def test_volatility_starts_on_third_bar(spark):
    stg = staged_from(spark, series_rows("AAPL", [100, 102, 101]))
    ma = {x.trade_date: x.volatility_30_day for x in moving_averages(stock_returns(stg)).collect()}
    assert ma[d(1)] is None and ma[d(2)] is not None


def test_falling_only(spark):
    stg = staged_from(spark, series_rows("AAPL", [100, 99, 98]))
    rs = {x.trade_date: x for x in rsi(stg).collect()}
    assert rs[d(2)].rsi_14 == 0.0 and rs[d(2)].rsi_signal == "EXTREMELY_OVERSOLD"
    ti = {x.trade_date: x for x in technical_indicators(stg).collect()}
    assert ti[d(2)].combined_signal == "HOLD"
    assert ti[d(2)].signal_strength_score == 33  # RSI vote only: MACD neutral, close below middle


def test_flat_prices(spark):
    stg = staged_from(spark, series_rows("AAPL", [100] * 25))
    ti = {x.trade_date: x for x in technical_indicators(stg).collect()}
    last = ti[d(24)]
    assert last.rsi_14_day == 100.0 and last.rsi_signal == "EXTREMELY_OVERBOUGHT"
    assert last.bollinger_width_pct == 0.0
    assert last.bollinger_percent_b is None
    assert last.bollinger_position == "BELOW_MIDDLE"
    assert last.macd_signal == "NEUTRAL" and last.macd_crossover == "NO_CROSSOVER"
    assert last.signal_strength_score == -33


def test_zero_previous_close_open_volume(spark):
    rows = [bar("AAPL", d(0), 0, open_=0, volume=0), bar("AAPL", d(1), 5, open_=4)]
    r = {x.trade_date: x for x in stock_returns(staged_from(spark, rows)).collect()}
    assert r[d(1)].daily_return_pct is None  # previous close is 0
    assert r[d(0)].intraday_volatility_pct is None  # open is 0
    assert r[d(0)].price_change_per_volume is None  # volume is 0
    assert r[d(1)].price_change_per_volume == pytest.approx((5 - 4) / 1000.0 * 1e6)
    assert r[d(1)].intraday_volatility_pct == pytest.approx((5 - 4) / 4 * 100)


def test_null_timestamp_row_is_dropped_without_touching_neighbours(spark):
    rows = series_rows("AAPL", [100, 110, 121]) + [bar("AAPL", None, 5)]
    r = {x.trade_date: x for x in stock_returns(staged_from(spark, rows)).collect()}
    assert None not in r and len(r) == 3
    assert r[d(0)].daily_return_pct is None  # the null-dated bar does not become a lag
    assert r[d(1)].daily_return_pct == pytest.approx(10.0)
    ti = technical_indicators(staged_from(spark, rows))
    assert ti.where("trade_date is null").count() == 0


def test_null_close_mid_series_drops_next_row_from_indicators(spark):
    closes = [100, 101, None, 103, 104]
    stg = staged_from(spark, series_rows("AAPL", closes))
    ti = {x.trade_date: x for x in technical_indicators(stg).collect()}
    assert d(0) not in ti and d(3) not in ti
    assert d(2) in ti and d(4) in ti
    rs = {x.trade_date: x for x in rsi(stg).collect()}
    # row 2 (null close): gain = loss = 0; row 4's frame holds rows 1, 2, 4
    assert rs[d(4)].avg_gain_14 == pytest.approx((1 + 0 + 1) / 3)


def test_macd_and_bollinger_values(spark):
    closes = [10, 11, 12, 13]
    stg = staged_from(spark, series_rows("AAPL", closes))
    m = {x.trade_date: x for x in macd(stg).collect()}
    # 12- and 26-row means coincide during warm-up
    assert m[d(3)].macd_line == 0.0 and m[d(3)].macd_signal == "NEUTRAL"
    b = {x.trade_date: x for x in bollinger(stg).collect()}
    assert b[d(3)].bb_middle == pytest.approx(11.5)
    sd = (sum((c - 11.5) ** 2 for c in closes) / 3) ** 0.5
    assert b[d(3)].bb_stddev == pytest.approx(sd)
    assert b[d(3)].bb_width_pct == pytest.approx(2 * sd / 11.5 * 100)
    assert b[d(3)].bb_position == "ABOVE_MIDDLE"
