"""The joined forms over bucketed tables: each window chain once, no exchange in the joins.

``technical_indicators_joined`` and ``daily_performance`` join relations on (ticker,
trade_date) that are themselves chains of windows; joined lazily, every side computes its
chain and is exchanged. Here the bars are written once in buckets of ``ticker``, which the
windows of every relation read without an exchange. Each relation is then written once in
buckets of (ticker, trade_date), sorted by both: the joins read bucket by bucket, and a
ticker's rows are spread over the buckets however long its series is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barsmith.operators.indicators import bollinger, indicators_from_parts, macd, rsi
from barsmith.operators.moving_averages import moving_averages
from barsmith.operators.returns import stock_returns, valid_dates
from barsmith.plans.daily_fact import daily_performance
from barsmith.plans.refresh import INDICATORS_VIEW, MOVING_AVERAGES_VIEW, RETURNS_VIEW
from barsmith.sources.schema import KEY, STAGED_COLUMNS
from barsmith.warehouse import Warehouse

BARS, RSI, MACD, BOLLINGER = "bucketed_bars", "bucketed_rsi", "bucketed_macd", "bucketed_bollinger"


def _buckets(spark: SparkSession, buckets: int | None) -> int:
    return buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed_bars(w: Warehouse, stg: DataFrame, buckets: int | None = None) -> DataFrame:
    """The dated bars in buckets of ``ticker``."""
    return w.bucketed(BARS, valid_dates(stg).select(*STAGED_COLUMNS), ["ticker"], _buckets(w.spark, buckets), KEY)


def joined_indicators(w: Warehouse, bars: DataFrame, buckets: int | None = None) -> DataFrame:
    """RSI x MACD x Bollinger, inner-joined over their bucketed tables: 18 columns."""
    n = _buckets(w.spark, buckets)
    parts = [w.bucketed(name, f(bars), KEY, n, KEY) for name, f in ((RSI, rsi), (MACD, macd), (BOLLINGER, bollinger))]
    return indicators_from_parts(*parts)


def joined_fact(w: Warehouse, bars: DataFrame, buckets: int | None = None, updated_at=None) -> DataFrame:
    """returns LEFT JOIN moving averages LEFT JOIN indicators over their bucketed tables."""
    n = _buckets(w.spark, buckets)
    returns = w.bucketed(f"bucketed_{RETURNS_VIEW}", stock_returns(bars), KEY, n, KEY)
    averages = w.bucketed(f"bucketed_{MOVING_AVERAGES_VIEW}", moving_averages(stock_returns(bars)), KEY, n, KEY)
    indicators = w.bucketed(f"bucketed_{INDICATORS_VIEW}", joined_indicators(w, bars, n), KEY, n, KEY)
    return daily_performance(returns, averages, indicators, updated_at)
