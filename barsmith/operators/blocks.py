"""The series pass with each ticker cut into blocks: no task holds a whole series.

``series_pass`` hashes by ticker, so a long series is one task's work. Every frame of the
models looks back a bounded number of *bars*, so a series can be cut into blocks of bars,
each preceded by a halo of the bars its first rows look back to:

1. A bar's position in its series comes from two levels: its place within a span of days
   (window over (ticker, span)) plus the number of bars in earlier spans, which is carried
   from span to span in a table of one row per (ticker, span). The last close of the span
   before is carried along, so each bar knows its previous close, and so is the number of
   bars with a previous close.
2. Block = position / ``block_rows``. The last ``HALO_ROWS`` bars of a block are sent to the
   next one, too, whatever gaps lie between. The window levels of ``series_pass`` run over
   (ticker, block) and the halo's own rows are dropped. Running totals start with the halo;
   the means need only their differences.
3. The RSI looks back over bars *with a previous close*, which can lie any number of bars
   back. These are cut into blocks by their own number, with a halo of their own, and
   their two means are joined back by position.

Everything is the same as in ``series_pass``, for any gaps and NULL closes. It costs a
second exchange of the bars and two narrow ones; nothing in it is keyed by ticker alone but
the table of spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.functions import signals as S
from barsmith.functions.windows import series
from barsmith.operators.indicators import BOLLINGER_WINDOW, MACD_SIGNAL, MACD_SLOW, RSI_WINDOW
from barsmith.operators.moving_averages import SMA_WINDOWS, VOLATILITY_WINDOW
from barsmith.operators.returns import valid_dates
from barsmith.operators.series import labelled, price_levels, rsi_means
from barsmith.sources.schema import FACT_COLUMNS, STAGED_COLUMNS

# Bars before the first of a block that its frames reach: a mean over n bars is a
# difference of running totals n bars apart; the crossover's previous signal line takes
# MACD_SIGNAL means of MACD_SLOW bars, one bar back.
HALO_ROWS = max(max(SMA_WINDOWS), MACD_SLOW + MACD_SIGNAL, VOLATILITY_WINDOW, BOLLINGER_WINDOW)
BLOCK_ROWS = 4096
SPAN_DAYS = 4096


def numbered_bars(stg: DataFrame, span_days: int = SPAN_DAYS) -> DataFrame:
    """Dated bars with their place in the series, without a window over a whole ticker.

    Adds ``_prev_close``, ``_prev_date``, ``_row`` (position in the series, from 0) and
    ``_prev_row`` (position among the bars with a previous close; only right for those).
    """
    c = F.col
    span = F.floor(F.datediff("trade_date", F.lit("1970-01-01").cast("date")) / F.lit(span_days)).alias("_span")
    bars = valid_dates(stg).select(*STAGED_COLUMNS, span)

    spans = bars.select("ticker", "_span", "trade_date", "close_price").groupBy("ticker", "_span").agg(
        F.count(F.lit(1)).alias("_n"), F.count("close_price").alias("_closes"),
        F.max_by("close_price", "trade_date").alias("_last_close"), F.max("trade_date").alias("_last_date"),
    )
    w = Window.partitionBy("ticker").orderBy("_span")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    known = lambda x: x.isNotNull().cast("long")
    spans = spans.select("*", F.lag("_last_close").over(w).alias("_carry_close"), F.lag("_last_date").over(w).alias("_carry_date"))
    # a bar has a previous close if the bar before it has a close
    spans = spans.withColumn("_followed", c("_closes") - known(c("_last_close")) + known(c("_carry_close")))
    total = lambda x: F.coalesce(F.sum(x).over(earlier), F.lit(0))
    carried = spans.select(
        c("ticker").alias("_ticker"), c("_span").alias("_of"), "_carry_close", "_carry_date", total("_n").alias("_rows_before"), total("_followed").alias("_prev_before"))

    ws = series(["ticker", "_span"])
    placed = bars.select(
        "*", F.row_number().over(ws).alias("_at"), F.lag("close_price").over(ws).alias("_lag_close"), F.lag("trade_date").over(ws).alias("_lag_date"),
        F.count("close_price").over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("_closes_before"),
    )
    first = c("_at") == 1
    return placed.join(carried, (c("ticker") == c("_ticker")) & (c("_span") == c("_of"))).select(
        *STAGED_COLUMNS,
        F.when(first, c("_carry_close")).otherwise(c("_lag_close")).alias("_prev_close"),
        F.when(first, c("_carry_date")).otherwise(c("_lag_date")).alias("_prev_date"),
        (c("_rows_before") + c("_at") - 1).alias("_row"),
        (c("_prev_before") + c("_closes_before") + known(c("_carry_close")) - 1).alias("_prev_row"),
    )


def _block(row: str, size: int) -> Column:
    return F.floor(F.col(row) / F.lit(size)).cast("long")


def _with_halo(df: DataFrame, row: str, name: str, size: int, halo: int) -> DataFrame:
    """``df`` dealt to blocks of ``size`` rows; the last ``halo`` of each to the next block, too."""
    own = _block(row, size)
    blocks = F.when(F.col(row) % size >= size - halo, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn(name, F.explode(blocks))


def blocked_series_pass(
    stg: DataFrame, block_rows: int = BLOCK_ROWS, span_days: int = SPAN_DAYS, check_keys: bool = True, fact: bool = False, updated_at=None
) -> DataFrame:
    """``series_pass`` with no more than ``block_rows`` + ``HALO_ROWS`` bars of a ticker in one window."""
    if block_rows < HALO_ROWS:
        raise ValueError(f"block_rows must be at least {HALO_ROWS}")
    c = F.col
    rows = numbered_bars(stg, span_days)

    dealt = _with_halo(rows, "_row", "_block", block_rows, HALO_ROWS)
    keep = [*STAGED_COLUMNS, "_row", "_block"]
    pre = price_levels(dealt, series(["ticker", "_block"]), keep, [c("_prev_close"), c("_prev_date")], check_keys, fact)
    own = pre.where(c("_block") == _block("_row", block_rows)).drop("_gain", "_loss")

    prev = c("_prev_close")
    moves = rows.where(prev.isNotNull()).select(
        "ticker", "_row", "_prev_row", S.gain(c("close_price"), prev).alias("_gain"), S.loss(c("close_price"), prev).alias("_loss"))
    moves = _with_halo(moves, "_prev_row", "_prev_block", block_rows, RSI_WINDOW)
    means = rsi_means(moves, series(["ticker", "_prev_block"], "_prev_row")).where(c("_prev_block") == _block("_prev_row", block_rows))
    means = means.select("ticker", _block("_row", block_rows).alias("_block"), "_row", "_avg_gain", "_avg_loss")

    joined = own.join(means, ["ticker", "_block", "_row"], "left")
    return labelled(joined, fact, updated_at).drop("_block", "_row")


def daily_performance_blocked(stg: DataFrame, updated_at=None, check_keys: bool = True, block_rows: int = BLOCK_ROWS, span_days: int = SPAN_DAYS) -> DataFrame:
    """The daily fact over blocks of the series: same rows as ``daily_performance_fused``."""
    return blocked_series_pass(stg, block_rows, span_days, check_keys, fact=True, updated_at=updated_at).select(*FACT_COLUMNS)
