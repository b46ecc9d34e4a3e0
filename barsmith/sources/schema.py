"""Schemas of the raw, staged and derived relations."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)

# Raw daily bar as landed per ticker: epoch-ms start, OHLC, volume, vwap, trades.
BAR_SCHEMA = T.StructType(
    [
        T.StructField("T", T.LongType()),
        T.StructField("O", PRICE),
        T.StructField("H", PRICE),
        T.StructField("L", PRICE),
        T.StructField("C", PRICE),
        T.StructField("V", T.DoubleType()),
        T.StructField("VW", T.DoubleType()),
        T.StructField("N", T.LongType()),
    ]
)

KEY = ["ticker", "trade_date"]

STAGED_COLUMNS = [
    "ticker", "company_name", "timestamp", "trade_date",
    "open_price", "high_price", "low_price", "close_price",
    "volume", "vwap", "num_transactions",
]

RETURNS_COLUMNS = [
    "ticker", "company_name", "trade_date", "timestamp",
    "open_price", "high_price", "low_price", "close_price",
    "volume", "vwap", "num_transactions",
    "daily_return_pct", "intraday_range", "intraday_volatility_pct", "price_change_per_volume",
]

MOVING_AVERAGE_COLUMNS = [
    "ticker", "company_name", "trade_date", "close_price", "volume", "daily_return_pct",
    "sma_7_day", "sma_30_day", "sma_90_day", "avg_volume_7_day", "volatility_30_day",
]

INDICATOR_COLUMNS = [
    "ticker", "trade_date", "close_price",
    "rsi_14_day", "rsi_signal",
    "macd_line", "macd_signal_line", "macd_histogram", "macd_signal", "macd_crossover",
    "bollinger_upper_band", "bollinger_middle_band", "bollinger_lower_band",
    "bollinger_width_pct", "bollinger_percent_b", "bollinger_position",
    "combined_signal", "signal_strength_score",
]

FACT_COLUMNS = [
    "performance_key", "ticker", "company_name", "trade_date", "timestamp",
    "open_price", "high_price", "low_price", "close_price",
    "volume", "vwap", "num_transactions",
    "daily_return_pct", "intraday_range", "intraday_volatility_pct", "price_change_per_volume",
    "sma_7_day", "sma_30_day", "sma_90_day", "avg_volume_7_day", "volatility_30_day",
    "rsi_14_day", "rsi_signal",
    "macd_line", "macd_signal_line", "macd_histogram", "macd_signal", "macd_crossover",
    "bollinger_upper_band", "bollinger_middle_band", "bollinger_lower_band",
    "bollinger_width_pct", "bollinger_percent_b", "bollinger_position",
    "advanced_signal", "signal_strength_score",
    "trend_signal", "sma_recommendation", "composite_recommendation",
    "volume_indicator", "volume_vs_avg_pct", "volatility_risk_level",
    "bollinger_squeeze_indicator", "dbt_updated_at",
]

SUMMARY_COLUMNS = [
    "ticker", "company_name", "latest_trade_date", "current_price", "current_volume",
    "current_recommendation", "current_trend",
    "avg_return_30d", "volatility_30d", "avg_volume_30d", "low_30d", "high_30d",
    "price_position_pct", "volume_vs_avg_pct", "total_trading_days", "dbt_updated_at",
]

PORTFOLIO_COLUMNS = [
    "trade_date", "num_stocks", "avg_stock_price", "total_portfolio_value",
    "portfolio_daily_return_pct", "portfolio_volatility", "worst_stock_return", "best_stock_return",
    "total_volume", "avg_stock_volume", "spy_return_pct", "qqq_return_pct",
    "alpha_vs_spy", "alpha_vs_qqq",
    "num_strong_buy", "num_buy", "num_hold", "num_sell", "num_strong_sell",
    "num_bullish", "num_bearish", "num_neutral", "sentiment_score",
    "avg_30d_volatility", "avg_intraday_volatility", "risk_adjusted_return",
    "market_regime", "dbt_updated_at",
]
