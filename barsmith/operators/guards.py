"""Lazy data-quality guards that ride along an existing window pass.

The models assume one bar per (ticker, trade_date) but never enforce it; a
duplicate would silently fan out every self-join. The guard compares each row's
date with the previous row's date *in the same window spec the operator already
sorts by*, so it adds no shuffle and no extra job: the query fails at execution
time with a clear error instead of returning fanned-out rows. Nothing is
de-duplicated silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barsmith.functions.windows import previous, series

DUPLICATE_KEY_MESSAGE = "duplicate (ticker, trade_date) bar in input: keys must be unique"


def duplicate_key_violation(spec: WindowSpec | None = None, date_col: str = "trade_date") -> Column:
    """TRUE where the row repeats the previous row's (partition, date) key."""
    return previous(date_col, spec) == F.col(date_col)


def guard(condition: Column, message: str) -> Column:
    """Filter predicate: TRUE, or raise ``message`` where ``condition`` holds."""
    return F.when(condition, F.raise_error(F.lit(message))).otherwise(F.lit(True))


def assert_unique_keys(df: DataFrame, spec: WindowSpec | None = None) -> DataFrame:
    """Pass-through that fails the job on a duplicate (ticker, trade_date)."""
    return df.where(guard(duplicate_key_violation(spec if spec is not None else series()), DUPLICATE_KEY_MESSAGE))


def find_duplicate_keys(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Eager-style report of duplicated keys (one partial-aggregated shuffle)."""
    k = keys or ["ticker", "trade_date"]
    return df.where(F.col(k[-1]).isNotNull()).groupBy(*k).count().where(F.col("count") > 1)
