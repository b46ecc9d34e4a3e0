"""RSI, MACD and Bollinger Bands (the technical-indicators model).

These are the reference-shaped building blocks: each indicator is its own chain
of windows over staging, and ``technical_indicators`` inner-joins the three on
(ticker, trade_date). ``plans.daily_fact.daily_performance_fused`` computes the
same columns in one pass without the joins.

Definitions kept as in the models: the "EMA"s are simple rolling means (12/26
rows), the MACD signal line is a 9-row mean of the line, RSI uses simple 14-row
mean gain/loss over the bars that have a previous close, and the Bollinger
width is the half band (2 sd / middle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.functions import signals as S
from barsmith.functions.numeric import round_half_up
from barsmith.functions.windows import previous, rolling_mean, rolling_stddev, series
from barsmith.sources.schema import INDICATOR_COLUMNS, KEY

RSI_WINDOW = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
BOLLINGER_WINDOW = 20


def gain_loss(stg: DataFrame) -> DataFrame:
    """Price change split into gain and loss, for bars that have a previous close.

    A NULL comparison (NULL close) yields gain = loss = 0; the bar *after* a NULL
    close has no previous close and is dropped.
    """
    w = series()
    c = F.col
    pd_ = stg.select("ticker", "trade_date", "close_price", previous("close_price", w).alias("prev_close"))
    return pd_.where(c("prev_close").isNotNull()).select(
        "ticker",
        "trade_date",
        "close_price",
        "prev_close",
        (c("close_price") - c("prev_close")).alias("price_change"),
        S.gain(c("close_price"), c("prev_close")).alias("gain"),
        S.loss(c("close_price"), c("prev_close")).alias("loss"),
    )


def rsi(stg: DataFrame, n: int = RSI_WINDOW) -> DataFrame:
    """14-row RSI with its zone label (unrounded)."""
    c = F.col
    calc = gain_loss(stg).select(
        "ticker", "trade_date", "close_price", "price_change",
        rolling_mean("gain", n).alias("avg_gain_14"),
        rolling_mean("loss", n).alias("avg_loss_14"),
    )
    return calc.withColumns(
        {
            "rsi_14": S.rsi_value(c("avg_gain_14"), c("avg_loss_14")),
            "rsi_signal": S.rsi_label(c("avg_gain_14"), c("avg_loss_14")),
        }
    )


def macd(stg: DataFrame) -> DataFrame:
    """MACD line, 9-row signal line, histogram, signal and crossover labels (unrounded).

    Three stacked window levels on one spec: one sort, no extra exchange.
    """
    w = series()
    c = F.col
    ema = stg.select(
        "ticker", "trade_date", "close_price",
        rolling_mean("close_price", MACD_FAST, w).alias("ema_12"),
        rolling_mean("close_price", MACD_SLOW, w).alias("ema_26"),
    )
    line = ema.withColumn("macd_line", c("ema_12") - c("ema_26"))
    calc = line.withColumn("macd_signal_line", rolling_mean("macd_line", MACD_SIGNAL, w))
    return calc.select(
        "ticker", "trade_date", "close_price", "macd_line", "macd_signal_line",
        (c("macd_line") - c("macd_signal_line")).alias("macd_histogram"),
        S.macd_label(c("macd_line"), c("macd_signal_line")).alias("macd_signal"),
        S.crossover_label(
            c("macd_line"), c("macd_signal_line"), previous("macd_line", w), previous("macd_signal_line", w)
        ).alias("macd_crossover"),
    )


def bollinger(stg: DataFrame, n: int = BOLLINGER_WINDOW) -> DataFrame:
    """20-row Bollinger middle/sd, bands, width, %B and position (unrounded)."""
    c = F.col
    bb = stg.select(
        "ticker", "trade_date", "close_price",
        rolling_mean("close_price", n).alias("bb_middle"),
        rolling_stddev("close_price", n).alias("bb_stddev"),
    )
    mid, sd, close = c("bb_middle"), c("bb_stddev"), c("close_price")
    return bb.withColumns(
        {
            "bb_upper": S.bollinger_upper(mid, sd),
            "bb_lower": S.bollinger_lower(mid, sd),
            "bb_width_pct": S.bollinger_width_pct(mid, sd),
            "bb_percent_b": S.bollinger_percent_b(close, mid, sd),
            "bb_position": S.bollinger_position(close, mid, sd),
        }
    )


def indicator_values(
    rsi_val: Column | None, rsi_sig: Column | None,
    line: Column | None = None, signal_line: Column | None = None, hist: Column | None = None,
    macd_sig: Column | None = None, crossover: Column | None = None,
    upper: Column | None = None, middle: Column | None = None, lower: Column | None = None,
    width: Column | None = None, pct_b: Column | None = None, position: Column | None = None,
) -> dict[str, Column]:
    """The 13 published indicator values (rounded) and labels; the families whose
    inputs are given (RSI, MACD, Bollinger)."""
    out: dict[str, Column] = {}
    if rsi_val is not None:
        out.update({"rsi_14_day": round_half_up(rsi_val, 2), "rsi_signal": rsi_sig})
    if line is not None:
        out.update(_macd_values(line, signal_line, hist, macd_sig, crossover))
    if upper is not None:
        out.update(_bollinger_values(upper, middle, lower, width, pct_b, position))
    return out


def _macd_values(line, signal_line, hist, macd_sig, crossover) -> dict[str, Column]:
    return {
        "macd_line": round_half_up(line, 4),
        "macd_signal_line": round_half_up(signal_line, 4),
        "macd_histogram": round_half_up(hist, 4),
        "macd_signal": macd_sig,
        "macd_crossover": crossover,
    }


def _bollinger_values(upper, middle, lower, width, pct_b, position) -> dict[str, Column]:
    return {
        "bollinger_upper_band": round_half_up(upper, 2),
        "bollinger_middle_band": round_half_up(middle, 2),
        "bollinger_lower_band": round_half_up(lower, 2),
        "bollinger_width_pct": round_half_up(width, 2),
        "bollinger_percent_b": round_half_up(pct_b, 2),
        "bollinger_position": position,
    }


def combined_columns() -> dict[str, Column]:
    """Combined signal and strength score over the label *columns*."""
    c = F.col
    rsi_sig, macd_sig, crossover, position = c("rsi_signal"), c("macd_signal"), c("macd_crossover"), c("bollinger_position")
    return {
        "combined_signal": S.combined_signal(rsi_sig, macd_sig, crossover, position),
        "signal_strength_score": S.signal_strength_score(rsi_sig, macd_sig, position),
    }


def technical_indicators(stg: DataFrame, check_keys: bool = True) -> DataFrame:
    """The 18 indicator columns for every bar that has a previous close.

    Single window pass (see ``operators.series``); equal to
    ``technical_indicators_joined`` on unique (ticker, trade_date) keys.
    """
    from barsmith.operators.series import series_pass

    return series_pass(stg, check_keys).where(F.col("_has_prev")).select(*INDICATOR_COLUMNS)


def technical_indicators_joined(stg: DataFrame) -> DataFrame:
    """RSI x MACD x Bollinger, inner-joined on (ticker, trade_date): 18 columns."""
    return indicators_from_parts(rsi(stg), macd(stg), bollinger(stg))


def indicators_from_parts(rsi_rows: DataFrame, macd_rows: DataFrame, bollinger_rows: DataFrame) -> DataFrame:
    """The inner join of the three indicators' rows, with the combined signal and score."""
    r = rsi_rows.select(*KEY, "close_price", "rsi_14", "rsi_signal")
    m = macd_rows.select(*KEY, "macd_line", "macd_signal_line", "macd_histogram", "macd_signal", "macd_crossover")
    b = bollinger_rows.select(*KEY, "bb_upper", "bb_middle", "bb_lower", "bb_width_pct", "bb_percent_b", "bb_position")
    joined = r.join(m, KEY, "inner").join(b, KEY, "inner")
    c = F.col
    values = indicator_values(
        c("rsi_14"), c("rsi_signal"),
        c("macd_line"), c("macd_signal_line"), c("macd_histogram"), c("macd_signal"), c("macd_crossover"),
        c("bb_upper"), c("bb_middle"), c("bb_lower"), c("bb_width_pct"), c("bb_percent_b"), c("bb_position"),
    )
    labeled = joined.select(*KEY, "close_price", *[v.alias(k) for k, v in values.items()])
    return labeled.select("*", *[v.alias(k) for k, v in combined_columns().items()]).select(*INDICATOR_COLUMNS)
