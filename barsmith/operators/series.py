"""One window pass per ticker series: returns, moving averages, indicators.

Returns, moving averages and the three indicators are all functions of the same
per-ticker series ordered by date, so one hash exchange on ``ticker`` and one
sort feed a stack of window levels; no joins, one scan of staging (the
reference shape scans staging five times and joins on (ticker, trade_date)).
Means of decimal columns (close, RSI gain/loss) come from running totals and a
``lag`` of them (exact, O(1) per row); float means and stddevs use sliding
frames. Semantics kept exactly:

* NULL-dated bars are dropped first: they sort last and every frame looks
  backwards, so they never fall into a dated bar's frame, and the models drop
  them from every output;
* bars without a previous close (the first bar, and the bar after a NULL close)
  have NULL indicator columns, as the inner join of the indicators drops them;
* RSI averages run over the bars *that have* a previous close: their frames use
  a window partitioned by (ticker, has_prev), which reuses the ticker exchange
  and only adds one sort inside each partition;
* duplicate (ticker, trade_date) keys fail the job (checked on the same window).

A ticker is one task here: with unique (ticker, trade_date) it holds at most one bar a
day (~250 a year) and width comes from hashing many tickers. Where few long series hold
most of the bars, ``operators.blocks`` computes the same rows with a ticker spread over
tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barsmith.functions import signals as S
from barsmith.functions.windows import (
    mean_from_totals, previous, rolling_mean, rolling_stddev, running_totals, series,
)
from barsmith.operators.fact_signals import early_signal_columns, late_signal_columns
from barsmith.operators.guards import DUPLICATE_KEY_MESSAGE, guard
from barsmith.operators.indicators import (
    BOLLINGER_WINDOW, MACD_FAST, MACD_SIGNAL, MACD_SLOW, RSI_WINDOW, combined_columns, indicator_values,
)
from barsmith.operators.moving_averages import SMA_WINDOWS, moving_average_columns
from barsmith.operators.returns import daily_return, intraday_columns, valid_dates
from barsmith.sources.schema import STAGED_COLUMNS

MA_OUTPUTS = ["sma_7_day", "sma_30_day", "sma_90_day", "avg_volume_7_day", "volatility_30_day"]


def series_pass(
    stg: DataFrame, check_keys: bool = True, fact: bool = False, updated_at=None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Returns, moving averages and indicators of every dated bar in one pass.

    Output: the returns columns, the five moving-average columns, the 15
    published indicator columns (NULL where the bar has no previous close) and
    ``_has_prev`` (TRUE where the indicators model has a row); with ``fact``
    also every signal column of the daily fact. ``carry`` names input columns
    passed through unchanged.
    """
    c = F.col
    w = series()
    keep = [*STAGED_COLUMNS, *carry]
    lags = [previous("close_price", w).alias("_prev_close"), previous("trade_date", w).alias("_prev_date")]
    pre = price_levels(valid_dates(stg), w, keep, lags, check_keys, fact)

    # levels 5-6: RSI means over the bars that have a previous close (running
    # totals, then their lag). Partitioned by (ticker, _has_prev): the ticker
    # exchange still satisfies it, so this costs one in-partition sort and no
    # shuffle. Placed last so that the four levels above share a single sort.
    means = rsi_means(pre, series(["ticker", "_has_prev"]))
    return labelled(means.select(*[c(x) for x in means.columns if x not in ("_gain", "_loss")]), fact, updated_at)


def price_levels(df: DataFrame, w: WindowSpec, keep: list[str], lags: list[Column], check_keys: bool = True, fact: bool = False) -> DataFrame:
    """Window levels 1-4: everything but the RSI, over the series of ``w``.

    ``lags`` are the columns ``_prev_close`` and ``_prev_date``, as expressions over ``w``
    or columns of ``df``. Output: ``keep``, the returns, moving averages, MACD and Bollinger
    columns (with ``fact`` their signals), ``_has_prev``, ``_gain`` and ``_loss``.
    """
    c = F.col
    close = c("close_price")

    # level 1: lags, running totals of the close, and the float/stddev frames
    # (one exchange + one sort for everything below)
    ma = moving_average_columns(w)
    close_total, close_count = running_totals(close, w)
    lvl1 = df.select(
        *[c(x) for x in keep],
        *lags,
        close_total.alias("_close_total"),
        close_count.alias("_close_count"),
        ma["avg_volume_7_day"].alias("avg_volume_7_day"),
        rolling_stddev(close, BOLLINGER_WINDOW, w).alias("_bb_sd"),
    )
    if check_keys:
        lvl1 = lvl1.where(guard(c("_prev_date") == c("trade_date"), DUPLICATE_KEY_MESSAGE))

    # row-level values that the next windows read
    prev = c("_prev_close")
    lvl1 = lvl1.select(
        "*",
        daily_return(close, prev).alias("daily_return_pct"),
        prev.isNotNull().alias("_has_prev"),
        S.gain(close, prev).alias("_gain"),
        S.loss(close, prev).alias("_loss"),
    )

    # level 2: every close mean from the running totals (exact decimal
    # differences) and the volatility of the level-1 return
    def close_mean(n: int) -> Column:
        return mean_from_totals("_close_total", "_close_count", n, w)

    lvl2 = lvl1.select(
        "*",
        *[close_mean(n).alias(f"sma_{n}_day") for n in SMA_WINDOWS],
        close_mean(MACD_FAST).alias("_ema_fast"),
        close_mean(MACD_SLOW).alias("_ema_slow"),
        close_mean(BOLLINGER_WINDOW).alias("_bb_mid"),
        ma["volatility_30_day"].alias("volatility_30_day"),
    ).withColumn("_macd_line", c("_ema_fast") - c("_ema_slow"))

    # level 3: MACD signal line (a float mean: sliding frame); level 4: the
    # previous line and signal for the crossover (lag)
    lvl3 = lvl2.select("*", rolling_mean("_macd_line", MACD_SIGNAL, w).alias("_macd_sig"))
    lvl3 = lvl3.select(
        "*", previous("_macd_line", w).alias("_prev_macd_line"), previous("_macd_sig", w).alias("_prev_macd_sig")
    )

    # MACD and Bollinger values/labels are final once level 4 is done: compute
    # them here, in the codegen stage before the RSI sort, so the last stage only
    # holds the RSI and signal logic (small enough to be JIT-compiled).
    has_prev = c("_has_prev")
    line, sig = c("_macd_line"), c("_macd_sig")
    mid, sd = c("_bb_mid"), c("_bb_sd")
    macd_bb = indicator_values(
        None, None,
        line, sig, line - sig, S.macd_label(line, sig),
        S.crossover_label(line, sig, c("_prev_macd_line"), c("_prev_macd_sig")),
        S.bollinger_upper(mid, sd), mid, S.bollinger_lower(mid, sd),
        S.bollinger_width_pct(mid, sd), S.bollinger_percent_b(close, mid, sd), S.bollinger_position(close, mid, sd),
    )
    pre = lvl3.select(
        *[c(x) for x in keep],
        "daily_return_pct",
        *[v.alias(k) for k, v in intraday_columns().items()],
        *[c(x) for x in MA_OUTPUTS],
        has_prev, "_gain", "_loss",
        *[F.when(has_prev, v).alias(k) for k, v in macd_bb.items()],
    )
    return pre.select("*", *[v.alias(k) for k, v in early_signal_columns().items()]) if fact else pre


def rsi_means(df: DataFrame, w: WindowSpec) -> DataFrame:
    """``df`` with ``_avg_gain`` and ``_avg_loss`` over the last bars of ``w``, from running totals."""
    gain_total, gain_count = running_totals("_gain", w)
    loss_total, loss_count = running_totals("_loss", w)
    totals = df.select(
        "*", gain_total.alias("_gain_total"), gain_count.alias("_gain_count"),
        loss_total.alias("_loss_total"), loss_count.alias("_loss_count"),
    )
    return totals.select(
        *df.columns,
        mean_from_totals("_gain_total", "_gain_count", RSI_WINDOW, w).alias("_avg_gain"),
        mean_from_totals("_loss_total", "_loss_count", RSI_WINDOW, w).alias("_avg_loss"),
    )


def labelled(df: DataFrame, fact: bool = False, updated_at=None) -> DataFrame:
    """The RSI columns and, from all labels, the combined signal (with ``fact`` the fact's signals)."""
    c = F.col
    has_prev = c("_has_prev")
    rsi = indicator_values(S.rsi_value(c("_avg_gain"), c("_avg_loss")), S.rsi_label(c("_avg_gain"), c("_avg_loss")))
    with_rsi = df.select(
        *[c(x) for x in df.columns if x not in ("_avg_gain", "_avg_loss")],
        *[F.when(has_prev, v).alias(k) for k, v in rsi.items()],
    )
    # combined signal and score over the label columns (no CASE tree embedded twice)
    out = with_rsi.select("*", *[F.when(has_prev, v).alias(k) for k, v in combined_columns().items()])
    return out.select("*", *[v.alias(k) for k, v in late_signal_columns(updated_at).items()]) if fact else out
