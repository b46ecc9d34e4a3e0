"""Ticker registry of the raw layer.

Fixed values (must equal the reference's source declarations and staging
literals): one raw table per ticker, named ``<TICKER>_STOCK_API``, tagged with
the ticker and the company name below, in declaration order.
"""

from __future__ import annotations

# --- fixed values: ticker -> company name literal, in source order ---------
TICKERS: dict[str, str] = {
    "AAPL": "Apple Inc",
    "MSFT": "Microsoft Corporation",
    "AMZN": "Amazon Inc",
    "GOOGL": "Alphabet Inc",
    "META": "Meta Platforms Inc",
    "NVDA": "Nvidia Corporation",
    "QQQ": "Invesco QQQ Trust",
    "SPY": "SPDR S&P 500 ETF Trust",
    "TSLA": "Tesla Inc",
}

# --- fixed values: benchmark funds split out of the portfolio --------------
BENCHMARKS: tuple[str, ...] = ("SPY", "QQQ")

RAW_TABLE_SUFFIX = "_STOCK_API"


def raw_table_name(ticker: str) -> str:
    """Name of the raw per-ticker table (``AAPL`` -> ``AAPL_STOCK_API``)."""
    return f"{ticker}{RAW_TABLE_SUFFIX}"
