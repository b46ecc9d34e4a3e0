"""Simple moving averages, 7-day volume average and 30-row return volatility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.functions.windows import decimal_means, rolling_mean, rolling_stddev, series
from barsmith.sources.schema import MOVING_AVERAGE_COLUMNS

SMA_WINDOWS = (7, 30, 90)
VOLUME_WINDOW = 7
VOLATILITY_WINDOW = 30


def moving_average_columns(spec=None) -> dict:
    """The two float columns, by sliding frames, over one ``series`` spec (partial frames allowed)."""
    w = spec if spec is not None else series()
    return {
        "avg_volume_7_day": rolling_mean("volume", VOLUME_WINDOW, w),
        "volatility_30_day": rolling_stddev("daily_return_pct", VOLATILITY_WINDOW, w),
    }


def moving_averages(returns: DataFrame) -> DataFrame:
    """Per (ticker, trade_date): close, volume, return and the rolling statistics."""
    base = ["ticker", "company_name", "trade_date", "close_price", "volume", "daily_return_pct"]
    means = sma(returns.select(*base))
    return means.select("*", *[v.alias(k) for k, v in moving_average_columns().items()]).select(*MOVING_AVERAGE_COLUMNS)


def sma(df: DataFrame, windows=SMA_WINDOWS) -> DataFrame:
    """Adds ``sma_<n>_day`` for each window length."""
    return decimal_means(df, "close_price", {f"sma_{n}_day": n for n in windows})


def avg_volume(df: DataFrame, n: int = VOLUME_WINDOW) -> DataFrame:
    return df.withColumn(f"avg_volume_{n}_day", rolling_mean("volume", n))


def volatility(df: DataFrame, n: int = VOLATILITY_WINDOW) -> DataFrame:
    return df.withColumn(f"volatility_{n}_day", rolling_stddev(F.col("daily_return_pct"), n))
