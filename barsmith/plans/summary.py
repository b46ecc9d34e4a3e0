"""Per-ticker summary: latest bar plus trailing 30-calendar-day statistics.

The reference takes ``max(trade_date)`` per ticker, inner-joins back to the fact
for the latest values, aggregates the last 30 calendar days separately and
left-joins the two. With unique (ticker, trade_date) keys (enforced by the fact
builders) the same result comes from ONE aggregation: ``max_by`` picks the
latest row and the 30-day statistics are conditional aggregates. That is at
most one partially-aggregated shuffle whose size is #tickers x #map tasks,
independent of history length (none when the fact is still hash-partitioned
by ticker, as straight after the series pass), and no join. ``keys_unique=False`` keeps
ties on the latest date (``rank() = 1``) and joins the statistics.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.functions.numeric import ratio
from barsmith.plans.daily_fact import _updated_at
from barsmith.sources.schema import SUMMARY_COLUMNS

TRAILING_DAYS = 30


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def trailing_days(df: DataFrame, as_of=None, days: int = TRAILING_DAYS) -> DataFrame:
    """Rows with ``trade_date >= as_of - days`` (inclusive, no upper bound)."""
    return df.where(F.col("trade_date") >= F.date_sub(_as_of(as_of), days))


def latest_dates(fact: DataFrame) -> DataFrame:
    """``max(trade_date)`` per ticker."""
    return fact.groupBy("ticker").agg(F.max("trade_date").alias("latest_trade_date"))


def stats_30d(fact: DataFrame, as_of=None, days: int = TRAILING_DAYS) -> DataFrame:
    """Trailing-window statistics per ticker (sample stddev, distinct day count)."""
    c = F.col
    return trailing_days(fact, as_of, days).groupBy("ticker").agg(
        F.avg("daily_return_pct").alias("avg_return_30d"),
        F.stddev_samp("daily_return_pct").alias("volatility_30d"),
        F.avg("volume").alias("avg_volume_30d"),
        F.min("close_price").alias("low_30d"),
        F.max("close_price").alias("high_30d"),
        F.count_distinct(c("trade_date")).alias("total_trading_days"),
    )


def latest_per_ticker(fact: DataFrame, recommendation_col: str = "sma_recommendation") -> DataFrame:
    """The bar(s) on each ticker's latest date, ties kept.

    ``rank() = 1`` over one scan: Spark's window group limit drops all but the latest
    rows of a ticker in each task before and after the exchange.
    """
    c = F.col
    newest = Window.partitionBy("ticker").orderBy(c("trade_date").desc())
    last = fact.where(c("trade_date").isNotNull()).withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
    return last.select(
        "ticker",
        "company_name",
        c("trade_date").alias("latest_trade_date"),
        c("close_price").alias("current_price"),
        c("volume").alias("current_volume"),
        c(recommendation_col).alias("current_recommendation"),
        c("trend_signal").alias("current_trend"),
    )


LATEST_COLUMNS = ["ticker", "company_name", "latest_trade_date", "current_price", "current_volume",
                  "current_recommendation", "current_trend"]


def latest_values(fact: DataFrame, recommendation_col: str = "sma_recommendation") -> DataFrame:
    """Latest bar per ticker (``max_by``; keys unique), in the summary's column names."""
    c = F.col
    last = F.max_by(
        F.struct(
            c("trade_date").alias("d"), c("company_name").alias("n"), c("close_price").alias("p"),
            c("volume").alias("v"), c(recommendation_col).alias("r"), c("trend_signal").alias("t"),
        ),
        c("trade_date"),
    )
    return fact.where(c("trade_date").isNotNull()).groupBy("ticker").agg(last.alias("_last")).select(
        "ticker",
        c("_last.n").alias("company_name"),
        c("_last.d").alias("latest_trade_date"),
        c("_last.p").alias("current_price"),
        c("_last.v").alias("current_volume"),
        c("_last.r").alias("current_recommendation"),
        c("_last.t").alias("current_trend"),
    )


def summary_from_parts(latest: DataFrame, stats: DataFrame, updated_at=None) -> DataFrame:
    """Summary rows from per-ticker latest values LEFT JOIN trailing statistics."""
    return _finish(latest.select(*LATEST_COLUMNS).join(stats, "ticker", "left"), updated_at)


def _finish(df: DataFrame, updated_at) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "price_position_pct": ratio(c("current_price") - c("low_30d"), c("high_30d") - c("low_30d")) * F.lit(100),
            "volume_vs_avg_pct": ratio(c("current_volume"), c("avg_volume_30d")) * F.lit(100),
            "dbt_updated_at": _updated_at(updated_at),
        }
    ).select(*SUMMARY_COLUMNS)


def stock_summary(
    fact: DataFrame,
    as_of=None,
    recommendation_col: str = "sma_recommendation",
    updated_at=None,
    days: int = TRAILING_DAYS,
    keys_unique: bool = True,
) -> DataFrame:
    """One row per ticker: latest price/volume/recommendation/trend + 30-day stats.

    ``recommendation_col`` names the fact column used as "the" recommendation
    (``sma_recommendation`` or ``composite_recommendation``).
    """
    c = F.col
    if not keys_unique:
        lv = latest_per_ticker(fact, recommendation_col)
        return _finish(lv.join(stats_30d(fact, as_of, days), "ticker", "left"), updated_at)

    in_win = c("trade_date") >= F.date_sub(_as_of(as_of), days)
    latest = F.max_by(
        F.struct(
            c("trade_date").alias("d"),
            c("company_name").alias("n"),
            c("close_price").alias("p"),
            c("volume").alias("v"),
            c(recommendation_col).alias("r"),
            c("trend_signal").alias("t"),
        ),
        c("trade_date"),
    )
    agg = fact.where(c("trade_date").isNotNull()).groupBy("ticker").agg(
        latest.alias("_last"),
        F.avg(F.when(in_win, c("daily_return_pct"))).alias("avg_return_30d"),
        F.stddev_samp(F.when(in_win, c("daily_return_pct"))).alias("volatility_30d"),
        F.avg(F.when(in_win, c("volume"))).alias("avg_volume_30d"),
        F.min(F.when(in_win, c("close_price"))).alias("low_30d"),
        F.max(F.when(in_win, c("close_price"))).alias("high_30d"),
        F.count(F.when(in_win, c("trade_date"))).alias("_days"),
    )
    flat = agg.select(
        "ticker",
        c("_last.n").alias("company_name"),
        c("_last.d").alias("latest_trade_date"),
        c("_last.p").alias("current_price"),
        c("_last.v").alias("current_volume"),
        c("_last.r").alias("current_recommendation"),
        c("_last.t").alias("current_trend"),
        "avg_return_30d", "volatility_30d", "avg_volume_30d", "low_30d", "high_30d",
        # a ticker with no bar in the window has no stats row at all (NULL, not 0)
        F.when(c("_days") > 0, c("_days")).alias("total_trading_days"),
    )
    return _finish(flat, updated_at)
