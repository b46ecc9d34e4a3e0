"""Daily returns and intraday metrics (the returns model)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.functions.numeric import ratio
from barsmith.functions.windows import previous, series
from barsmith.operators.guards import DUPLICATE_KEY_MESSAGE, guard
from barsmith.sources.schema import RETURNS_COLUMNS, STAGED_COLUMNS


def daily_return(close: Column, prev_close: Column) -> Column:
    """``(close - prev) / prev * 100`` when the previous close is positive, else NULL."""
    return F.when(prev_close > 0, ratio(close - prev_close, prev_close) * F.lit(100))


def intraday_range(high: Column, low: Column) -> Column:
    return high - low


def intraday_volatility_pct(high: Column, low: Column, open_: Column) -> Column:
    """``(high - low) / open * 100`` when open is positive."""
    return F.when(open_ > 0, ratio(high - low, open_) * F.lit(100))


def price_change_per_volume(close: Column, open_: Column, volume: Column) -> Column:
    """``(close - open) / volume * 1e6`` when volume is positive."""
    return F.when(volume > 0, ratio(close - open_, volume) * F.lit(1000000))


def intraday_columns() -> dict[str, Column]:
    c = F.col
    return {
        "intraday_range": intraday_range(c("high_price"), c("low_price")),
        "intraday_volatility_pct": intraday_volatility_pct(c("high_price"), c("low_price"), c("open_price")),
        "price_change_per_volume": price_change_per_volume(c("close_price"), c("open_price"), c("volume")),
    }


def with_intraday_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns(intraday_columns())


def valid_dates(df: DataFrame) -> DataFrame:
    """Rows with a trade date.

    The models drop null-dated bars *after* the windows. Because null dates sort
    last and every frame looks backwards only, a null-dated bar never lies in a
    dated bar's frame, so dropping them *before* the windows gives the same rows
    and keeps them out of the shuffle (the predicate reaches the scan as
    ``IsNotNull(T)``).
    """
    return df.where(F.col("trade_date").isNotNull())


def stock_returns(stg: DataFrame, check_keys: bool = True) -> DataFrame:
    """Staging + daily_return_pct, intraday_range, intraday_volatility_pct,
    price_change_per_volume; one row per dated bar."""
    w = series()
    c = F.col
    cols = [c(x) for x in STAGED_COLUMNS]
    out = valid_dates(stg).select(*cols, previous("close_price", w).alias("_prev_close"), previous("trade_date", w).alias("_prev_date"))
    if check_keys:
        out = out.where(guard(c("_prev_date") == c("trade_date"), DUPLICATE_KEY_MESSAGE))
    derived = {"daily_return_pct": daily_return(c("close_price"), c("_prev_close")), **intraday_columns()}
    return out.select(*[derived[n].alias(n) if n in derived else c(n) for n in RETURNS_COLUMNS])
