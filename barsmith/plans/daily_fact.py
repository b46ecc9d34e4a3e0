"""The wide daily fact (one row per ticker and trading day, 44 columns).

``daily_performance`` is the reference-shaped plan: returns LEFT JOIN moving
averages LEFT JOIN technical indicators on (ticker, trade_date).

``daily_performance_fused`` computes the same rows from one window pass over
staging (``operators.series.series_pass``): one exchange on ``ticker``, no joins,
one scan (the joined plan scans staging several times and shuffles on
(ticker, trade_date) for each join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.operators.fact_signals import fact_signal_columns, updated_at_column
from barsmith.operators.series import MA_OUTPUTS, series_pass
from barsmith.sources.schema import FACT_COLUMNS, INDICATOR_COLUMNS, KEY, RETURNS_COLUMNS


def _updated_at(updated_at) -> Column:
    return updated_at_column(updated_at)


def fact_signals(df: DataFrame, updated_at=None) -> DataFrame:
    """Final projection of the fact (44 columns in published order)."""
    cols = fact_signal_columns(updated_at)
    return df.select(*[cols[n].alias(n) if n in cols else F.col(n) for n in FACT_COLUMNS])


def daily_performance(returns: DataFrame, ma: DataFrame, ti: DataFrame, updated_at=None) -> DataFrame:
    """returns LEFT JOIN moving averages LEFT JOIN indicators on (ticker, trade_date)."""
    m = ma.select(*KEY, *MA_OUTPUTS)
    t = ti.select(*KEY, *[x for x in INDICATOR_COLUMNS if x not in (*KEY, "close_price")])
    joined = returns.select(*RETURNS_COLUMNS).join(m, KEY, "left").join(t, KEY, "left")
    return fact_signals(joined, updated_at)


def daily_performance_fused(stg: DataFrame, updated_at=None, check_keys: bool = True) -> DataFrame:
    """Same rows and values as ``daily_performance`` over one shuffle and no joins."""
    return series_pass(stg, check_keys, fact=True, updated_at=updated_at).select(*FACT_COLUMNS)
