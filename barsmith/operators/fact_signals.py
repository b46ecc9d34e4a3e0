"""Signal columns of the daily fact, over the returns / MA / indicator columns.

Split in two groups so a single pass can place them where their inputs are
final: ``early_signal_columns`` only need moving averages and the rounded
Bollinger width; ``late_signal_columns`` need the combined indicator signal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barsmith.functions import signals as S


def updated_at_column(updated_at) -> Column:
    if updated_at is None:
        return F.current_timestamp()
    return updated_at if isinstance(updated_at, Column) else F.lit(updated_at)


def early_signal_columns() -> dict[str, Column]:
    c = F.col
    close, sma7, sma30, sma90 = c("close_price"), c("sma_7_day"), c("sma_30_day"), c("sma_90_day")
    return {
        "performance_key": S.performance_key(c("ticker"), c("trade_date")),
        "trend_signal": S.trend_signal(sma7, sma30),
        "sma_recommendation": S.sma_recommendation(close, sma7, sma30, sma90),
        "volume_indicator": S.volume_indicator(c("volume"), c("avg_volume_7_day")),
        "volume_vs_avg_pct": S.volume_vs_avg_pct(c("volume"), c("avg_volume_7_day")),
        "volatility_risk_level": S.volatility_risk_level(c("volatility_30_day")),
        "bollinger_squeeze_indicator": S.bollinger_squeeze(c("bollinger_width_pct")),
    }


def late_signal_columns(updated_at=None) -> dict[str, Column]:
    c = F.col
    return {
        "advanced_signal": c("combined_signal"),
        "composite_recommendation": S.composite_recommendation(
            c("combined_signal"), c("rsi_signal"), c("macd_signal"), c("close_price"), c("sma_7_day"), c("sma_30_day")
        ),
        "dbt_updated_at": updated_at_column(updated_at),
    }


def fact_signal_columns(updated_at=None) -> dict[str, Column]:
    """All fact signal columns (key, SMA signals, volume, risk, squeeze, composite)."""
    return {**early_signal_columns(), **late_signal_columns(updated_at)}
