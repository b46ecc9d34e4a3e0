"""Indicator values and trading-signal labels as pure Column expressions.

Each function maps already-computed columns to a value or a label; none of them
opens a window or a shuffle, so they all fuse into one codegen'd projection.
CASE order matters and is kept: the first matching branch wins and NULL
comparisons fall through to the ELSE label.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barsmith.functions.numeric import round_half_up

# --- fixed values: labels produced by the models ---------------------------
EXTREMELY_OVERBOUGHT = "EXTREMELY_OVERBOUGHT"
EXTREMELY_OVERSOLD = "EXTREMELY_OVERSOLD"
OVERBOUGHT = "OVERBOUGHT"
OVERSOLD = "OVERSOLD"
NEUTRAL = "NEUTRAL"
BULLISH = "BULLISH"
BEARISH = "BEARISH"
BULLISH_CROSSOVER = "BULLISH_CROSSOVER"
BEARISH_CROSSOVER = "BEARISH_CROSSOVER"
NO_CROSSOVER = "NO_CROSSOVER"
ABOVE_UPPER_BAND = "ABOVE_UPPER_BAND"
BELOW_LOWER_BAND = "BELOW_LOWER_BAND"
ABOVE_MIDDLE = "ABOVE_MIDDLE"
BELOW_MIDDLE = "BELOW_MIDDLE"
STRONG_BUY = "STRONG_BUY"
STRONG_SELL = "STRONG_SELL"
BUY = "BUY"
SELL = "SELL"
HOLD = "HOLD"
HIGH = "HIGH"
LOW = "LOW"
NORMAL = "NORMAL"
HIGH_RISK = "HIGH_RISK"
MEDIUM_RISK = "MEDIUM_RISK"
LOW_RISK = "LOW_RISK"
VERY_LOW_RISK = "VERY_LOW_RISK"
SQUEEZE = "SQUEEZE"
EXPANSION = "EXPANSION"
BULL_MARKET = "BULL_MARKET"
BEAR_MARKET = "BEAR_MARKET"
HIGH_VOLATILITY = "HIGH_VOLATILITY"
SIDEWAYS = "SIDEWAYS"

RECOMMENDATIONS = (STRONG_BUY, BUY, HOLD, SELL, STRONG_SELL)
TRENDS = (BULLISH, BEARISH, NEUTRAL)

# --- fixed values: thresholds and weights -----------------------------------
RSI_OVERBOUGHT = 70
RSI_OVERSOLD = 30
SCORE_RSI, SCORE_MACD, SCORE_BOLLINGER = 33, 33, 34
VOLUME_HIGH_FACTOR, VOLUME_LOW_FACTOR = 2, 0.5
RISK_HIGH, RISK_MEDIUM, RISK_LOW = 3.0, 2.0, 1.0
SQUEEZE_BELOW, EXPANSION_ABOVE = 5, 20
BULL_RETURN, BULL_MAX_VOL = 2, 2
BEAR_RETURN, BEAR_MIN_VOL = -2, 3
HIGH_VOL = 4
SIDEWAYS_ABS_RETURN = 0.5


# ---------------------------------------------------------------- RSI ------
def _rsi_formula(avg_gain: Column, avg_loss: Column) -> Column:
    # 100 - 100 / (1 + RS); the denominator guard never changes a reachable value
    # (zero loss is handled by the first CASE branch) but keeps ANSI mode safe.
    return F.lit(100) - F.lit(100) / (F.lit(1) + avg_gain / F.nullif(avg_loss, F.lit(0)))


def rsi_value(avg_gain: Column, avg_loss: Column) -> Column:
    """RSI from simple 14-row average gain/loss: 100 if no loss, 0 if no gain."""
    return (
        F.when(avg_loss == 0, F.lit(100.0))
        .when(avg_gain == 0, F.lit(0.0))
        .otherwise(_rsi_formula(avg_gain, avg_loss))
    )


def rsi_label(avg_gain: Column, avg_loss: Column) -> Column:
    """RSI zone, decided on the unrounded value."""
    rsi = _rsi_formula(avg_gain, avg_loss)
    return (
        F.when(avg_loss == 0, F.lit(EXTREMELY_OVERBOUGHT))
        .when(avg_gain == 0, F.lit(EXTREMELY_OVERSOLD))
        .when(rsi >= RSI_OVERBOUGHT, F.lit(OVERBOUGHT))
        .when(rsi <= RSI_OVERSOLD, F.lit(OVERSOLD))
        .otherwise(F.lit(NEUTRAL))
    )


def gain(close: Column, prev_close: Column) -> Column:
    """Upward move vs the previous close, 0 otherwise (also 0 on NULL)."""
    return F.when(close > prev_close, close - prev_close).otherwise(F.lit(0))


def loss(close: Column, prev_close: Column) -> Column:
    """Downward move vs the previous close, 0 otherwise (also 0 on NULL)."""
    return F.when(close < prev_close, prev_close - close).otherwise(F.lit(0))


# ---------------------------------------------------------------- MACD -----
def macd_label(line: Column, signal: Column) -> Column:
    return (
        F.when((line > signal) & ((line - signal) > 0), F.lit(BULLISH))
        .when((line < signal) & ((line - signal) < 0), F.lit(BEARISH))
        .otherwise(F.lit(NEUTRAL))
    )


def crossover_label(line: Column, signal: Column, prev_line: Column, prev_signal: Column) -> Column:
    return (
        F.when((line > signal) & (prev_line <= prev_signal), F.lit(BULLISH_CROSSOVER))
        .when((line < signal) & (prev_line >= prev_signal), F.lit(BEARISH_CROSSOVER))
        .otherwise(F.lit(NO_CROSSOVER))
    )


# ----------------------------------------------------------- Bollinger -----
def bollinger_upper(middle: Column, sd: Column) -> Column:
    return middle + F.lit(2) * sd


def bollinger_lower(middle: Column, sd: Column) -> Column:
    return middle - F.lit(2) * sd


def bollinger_width_pct(middle: Column, sd: Column) -> Column:
    """Half-band width ``2*sd / middle * 100`` (not the full 4*sd band)."""
    return (F.lit(2) * sd) / F.nullif(middle, F.lit(0)) * F.lit(100)


def bollinger_percent_b(close: Column, middle: Column, sd: Column) -> Column:
    return (close - bollinger_lower(middle, sd)) / F.nullif(F.lit(4) * sd, F.lit(0)) * F.lit(100)


def bollinger_position(close: Column, middle: Column, sd: Column) -> Column:
    return (
        F.when(close > bollinger_upper(middle, sd), F.lit(ABOVE_UPPER_BAND))
        .when(close < bollinger_lower(middle, sd), F.lit(BELOW_LOWER_BAND))
        .when(close > middle, F.lit(ABOVE_MIDDLE))
        .otherwise(F.lit(BELOW_MIDDLE))
    )


# ------------------------------------------------------ combined signals ---
def combined_signal(rsi_sig: Column, macd_sig: Column, crossover: Column, position: Column) -> Column:
    """Only the plain OVERSOLD/OVERBOUGHT zones count here, not the EXTREMELY_* ones."""
    return (
        F.when((rsi_sig == OVERSOLD) & (macd_sig == BULLISH) & (position == BELOW_LOWER_BAND), F.lit(STRONG_BUY))
        .when((rsi_sig == OVERBOUGHT) & (macd_sig == BEARISH) & (position == ABOVE_UPPER_BAND), F.lit(STRONG_SELL))
        .when((rsi_sig == OVERSOLD) & (crossover == BULLISH_CROSSOVER), F.lit(BUY))
        .when((rsi_sig == OVERBOUGHT) & (crossover == BEARISH_CROSSOVER), F.lit(SELL))
        .otherwise(F.lit(HOLD))
    )


def signal_strength_score(rsi_sig: Column, macd_sig: Column, position: Column) -> Column:
    """Sum of three votes: +-33 RSI, +-33 MACD, +-34 Bollinger (range -100..100)."""
    rsi_vote = (
        F.when(rsi_sig.isin(OVERSOLD, EXTREMELY_OVERSOLD), F.lit(SCORE_RSI))
        .when(rsi_sig.isin(OVERBOUGHT, EXTREMELY_OVERBOUGHT), F.lit(-SCORE_RSI))
        .otherwise(F.lit(0))
    )
    macd_vote = (
        F.when(macd_sig == BULLISH, F.lit(SCORE_MACD))
        .when(macd_sig == BEARISH, F.lit(-SCORE_MACD))
        .otherwise(F.lit(0))
    )
    band_vote = (
        F.when(position == BELOW_LOWER_BAND, F.lit(SCORE_BOLLINGER))
        .when(position == ABOVE_UPPER_BAND, F.lit(-SCORE_BOLLINGER))
        .otherwise(F.lit(0))
    )
    return rsi_vote + macd_vote + band_vote


def trend_signal(sma7: Column, sma30: Column) -> Column:
    return (
        F.when(sma7 > sma30, F.lit(BULLISH))
        .when(sma7 < sma30, F.lit(BEARISH))
        .otherwise(F.lit(NEUTRAL))
    )


def sma_recommendation(close: Column, sma7: Column, sma30: Column, sma90: Column) -> Column:
    return (
        F.when((close > sma7) & (sma7 > sma30) & (sma30 > sma90), F.lit(STRONG_BUY))
        .when((close < sma7) & (sma7 < sma30) & (sma30 < sma90), F.lit(STRONG_SELL))
        .when(close > sma30, F.lit(BUY))
        .when(close < sma30, F.lit(SELL))
        .otherwise(F.lit(HOLD))
    )


def composite_recommendation(
    combined: Column, rsi_sig: Column, macd_sig: Column, close: Column, sma7: Column, sma30: Column
) -> Column:
    """Advanced signal confirmed by the SMA trend, then RSI/MACD pairs, then SMA fallback."""
    fallback = (
        F.when((close > sma7) & (sma7 > sma30), F.lit(BUY))
        .when((close < sma7) & (sma7 < sma30), F.lit(SELL))
        .otherwise(F.lit(HOLD))
    )
    return (
        F.when((combined == STRONG_BUY) & (sma7 > sma30) & (close > sma30), F.lit(STRONG_BUY))
        .when((combined == STRONG_SELL) & (sma7 < sma30) & (close < sma30), F.lit(STRONG_SELL))
        .when((combined == BUY) | ((rsi_sig == OVERSOLD) & (macd_sig == BULLISH)), F.lit(BUY))
        .when((combined == SELL) | ((rsi_sig == OVERBOUGHT) & (macd_sig == BEARISH)), F.lit(SELL))
        .otherwise(fallback)
    )


def volume_indicator(volume: Column, avg7: Column) -> Column:
    return (
        F.when(volume > avg7 * VOLUME_HIGH_FACTOR, F.lit(HIGH))
        .when(volume < avg7 * VOLUME_LOW_FACTOR, F.lit(LOW))
        .otherwise(F.lit(NORMAL))
    )


def volume_vs_avg_pct(volume: Column, avg7: Column) -> Column:
    """Fact flavour: ``round((v / avg7 - 1) * 100, 2)`` (a change, in percent)."""
    return round_half_up((volume / F.nullif(avg7, F.lit(0)) - F.lit(1)) * F.lit(100), 2)


def volatility_risk_level(vol30: Column) -> Column:
    return (
        F.when(vol30 > RISK_HIGH, F.lit(HIGH_RISK))
        .when(vol30 > RISK_MEDIUM, F.lit(MEDIUM_RISK))
        .when(vol30 > RISK_LOW, F.lit(LOW_RISK))
        .otherwise(F.lit(VERY_LOW_RISK))
    )


def bollinger_squeeze(width_pct_rounded: Column) -> Column:
    """Decided on the width *after* rounding to 2 decimals, as the fact reads it."""
    return (
        F.when(width_pct_rounded < SQUEEZE_BELOW, F.lit(SQUEEZE))
        .when(width_pct_rounded > EXPANSION_ABOVE, F.lit(EXPANSION))
        .otherwise(F.lit(NORMAL))
    )


def performance_key(ticker: Column, trade_date: Column) -> Column:
    """``ticker || '_' || trade_date``; NULL if either part is NULL."""
    return F.concat(ticker, F.lit("_"), trade_date.cast("string"))


# ------------------------------------------------------------ portfolio ----
def sentiment_score(sb: Column, b: Column, s: Column, ss: Column, n: Column) -> Column:
    """``((2*SB + B) - (S + 2*SS)) / n * 100``; strong labels weigh 2, so -200..200."""
    net = (sb * 2 + b) - (s + ss * 2)
    return net / F.nullif(n, F.lit(0)) * F.lit(100)


def risk_adjusted_return(ret: Column, vol: Column) -> Column:
    return F.when(vol > 0, ret / F.nullif(vol, F.lit(0)))


def market_regime(ret: Column, vol: Column) -> Column:
    return (
        F.when((ret > BULL_RETURN) & (vol < BULL_MAX_VOL), F.lit(BULL_MARKET))
        .when((ret < BEAR_RETURN) & (vol > BEAR_MIN_VOL), F.lit(BEAR_MARKET))
        .when(vol > HIGH_VOL, F.lit(HIGH_VOLATILITY))
        .when(F.abs(ret) < SIDEWAYS_ABS_RETURN, F.lit(SIDEWAYS))
        .otherwise(F.lit(NORMAL))
    )
