from barsmith.operators.guards import assert_unique_keys, find_duplicate_keys
from barsmith.operators.indicators import (
    bollinger, gain_loss, macd, rsi, technical_indicators, technical_indicators_joined,
)
from barsmith.operators.series import series_pass
from barsmith.operators.moving_averages import moving_averages
from barsmith.operators.returns import stock_returns

__all__ = [
    "assert_unique_keys", "bollinger", "find_duplicate_keys", "gain_loss", "macd", "moving_averages", "rsi",
    "series_pass", "stock_returns", "technical_indicators", "technical_indicators_joined",
]
