"""Per-day portfolio view of the stocks, compared with the benchmark funds.

The reference aggregates the non-benchmark rows by day and LEFT-joins the
benchmark rows twice (SPY and QQQ, ticker predicate inside ON). With unique
(ticker, trade_date) keys each benchmark has at most one row per day, so its
return is a conditional aggregate of the same GROUP BY: one partially-aggregated
shuffle keyed by date and no join. Days without any stock row produce no row
(``_stock_rows > 0``), days without a benchmark bar keep a NULL benchmark
return. ``keys_unique=False`` runs the join form: the benchmarks pivoted to one row per
day, joined once. No side is hinted: the adaptive plan broadcasts the benchmark days when
their measured size is below the session's threshold, and sort-merges them else.

The benchmarks are given as names or as a table with a column ``ticker``; they become
columns of the result, so there are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.functions import signals as S
from barsmith.functions.numeric import ratio
from barsmith.plans.daily_fact import _updated_at
from barsmith.sources.registry import BENCHMARKS


def _bench_name(ticker: str) -> str:
    return ticker.lower()


def portfolio_columns(benchmarks: Sequence[str] = BENCHMARKS) -> list[str]:
    head = [
        "trade_date", "num_stocks", "avg_stock_price", "total_portfolio_value",
        "portfolio_daily_return_pct", "portfolio_volatility", "worst_stock_return", "best_stock_return",
        "total_volume", "avg_stock_volume",
    ]
    bench = [f"{_bench_name(b)}_return_pct" for b in benchmarks] + [f"alpha_vs_{_bench_name(b)}" for b in benchmarks]
    tail = [
        "num_strong_buy", "num_buy", "num_hold", "num_sell", "num_strong_sell",
        "num_bullish", "num_bearish", "num_neutral", "sentiment_score",
        "avg_30d_volatility", "avg_intraday_volatility", "risk_adjusted_return",
        "market_regime", "dbt_updated_at",
    ]
    return head + bench + tail


LABEL_COUNTS = {
    "num_strong_buy": S.STRONG_BUY, "num_buy": S.BUY, "num_hold": S.HOLD,
    "num_sell": S.SELL, "num_strong_sell": S.STRONG_SELL,
}
TREND_COUNTS = {"num_bullish": S.BULLISH, "num_bearish": S.BEARISH, "num_neutral": S.NEUTRAL}


MAX_BENCHMARKS = 100
Benchmarks = Sequence[str] | DataFrame


def benchmark_names(benchmarks: Benchmarks) -> list[str]:
    """The benchmark tickers; of a table, its distinct non-null ``ticker``s in ascending order."""
    if not isinstance(benchmarks, DataFrame):
        return list(benchmarks)
    names = [r[0] for r in benchmarks.select("ticker").where("ticker IS NOT NULL").distinct().orderBy("ticker").limit(MAX_BENCHMARKS + 1).collect()]
    if len(names) > MAX_BENCHMARKS:
        raise ValueError(f"more than {MAX_BENCHMARKS} benchmarks")
    return names


def benchmark_days(fact: DataFrame, benchmarks: Benchmarks = BENCHMARKS) -> DataFrame:
    """One row per day with a benchmark bar: each benchmark's return (NULL without a bar)."""
    names = benchmark_names(benchmarks)
    bars = split_universe(fact, names)[1]
    returns = {t: F.max(F.when(F.col("ticker") == t, F.col("daily_return_pct"))).alias(f"{_bench_name(t)}_return_pct") for t in names}
    return bars.groupBy("trade_date").agg(F.count(F.lit(1)).alias("_bars"), *returns.values()).drop("_bars")


def split_universe(fact: DataFrame, benchmarks: Benchmarks = BENCHMARKS) -> tuple[DataFrame, DataFrame]:
    """(individual stocks, benchmark rows pruned to date/ticker/close/return)."""
    names = benchmark_names(benchmarks)
    stocks = fact.where(~F.col("ticker").isin(names))
    bench = fact.where(F.col("ticker").isin(names)).select(
        "trade_date", "ticker", "close_price", "daily_return_pct"
    )
    return stocks, bench


def _daily_aggregates(when, rec: Column, distinct_tickers: bool) -> list[Column]:
    """Aggregates over the stock rows selected by ``when`` (a row filter wrapper)."""
    c = F.col

    def count_label(col: Column, label: str) -> Column:
        return F.sum(when(F.when(col == label, F.lit(1)).otherwise(F.lit(0))))

    tick = when(c("ticker"))
    close = when(c("close_price"))
    ret = when(c("daily_return_pct"))
    return [
        (F.count_distinct(tick) if distinct_tickers else F.count(tick)).alias("num_stocks"),
        ratio(F.sum(close), F.count(close)).alias("avg_stock_price"),
        F.sum(close).alias("total_portfolio_value"),
        F.avg(ret).alias("portfolio_daily_return_pct"),
        F.stddev_samp(ret).alias("portfolio_volatility"),
        F.min(ret).alias("worst_stock_return"),
        F.max(ret).alias("best_stock_return"),
        F.sum(when(c("volume"))).alias("total_volume"),
        F.avg(when(c("volume"))).alias("avg_stock_volume"),
        *[count_label(rec, lab).alias(k) for k, lab in LABEL_COUNTS.items()],
        *[count_label(c("trend_signal"), lab).alias(k) for k, lab in TREND_COUNTS.items()],
        F.avg(when(c("volatility_30_day"))).alias("avg_30d_volatility"),
        F.avg(when(c("intraday_volatility_pct"))).alias("avg_intraday_volatility"),
    ]


def _finish(df: DataFrame, benchmarks: Sequence[str], updated_at) -> DataFrame:
    c = F.col
    ret, vol = c("portfolio_daily_return_pct"), c("portfolio_volatility")
    cols = {
        f"alpha_vs_{_bench_name(b)}": ret - c(f"{_bench_name(b)}_return_pct") for b in benchmarks
    }
    cols.update(
        {
            "sentiment_score": S.sentiment_score(
                c("num_strong_buy"), c("num_buy"), c("num_sell"), c("num_strong_sell"), c("num_stocks")
            ),
            "risk_adjusted_return": S.risk_adjusted_return(ret, vol),
            "market_regime": S.market_regime(ret, c("avg_30d_volatility")),
            "dbt_updated_at": _updated_at(updated_at),
        }
    )
    return df.withColumns(cols).select(*portfolio_columns(benchmarks))


def portfolio_performance(
    fact: DataFrame,
    benchmarks: Benchmarks = BENCHMARKS,
    recommendation_col: str = "sma_recommendation",
    updated_at=None,
    keys_unique: bool = True,
) -> DataFrame:
    """One row per trading day with stocks: size, return, dispersion, volume,
    signal counts, sentiment, alpha vs each benchmark and market regime."""
    c = F.col
    rec = c(recommendation_col)
    benchmarks = benchmark_names(benchmarks)
    if not keys_unique:
        stocks, _ = split_universe(fact, benchmarks)
        daily = stocks.groupBy("trade_date").agg(*_daily_aggregates(lambda x: x, rec, distinct_tickers=True))
        daily = daily.join(benchmark_days(fact, benchmarks), "trade_date", "left")
        return _finish(daily, benchmarks, updated_at)

    is_stock = ~c("ticker").isin(list(benchmarks))

    def stock(x: Column) -> Column:
        return F.when(is_stock, x)

    bench_returns = [
        F.max(F.when(c("ticker") == b, c("daily_return_pct"))).alias(f"{_bench_name(b)}_return_pct") for b in benchmarks
    ]
    daily = (
        fact.groupBy("trade_date")
        .agg(*_daily_aggregates(stock, rec, distinct_tickers=False), *bench_returns, F.count(stock(F.lit(1))).alias("_stock_rows"))
        .where(c("_stock_rows") > 0)
    )
    return _finish(daily, benchmarks, updated_at)
