"""Scalar numeric helpers shared by the models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, scale: int) -> Column:
    """``ROUND(x, scale)`` with engine-independent ties.

    ``round(double)`` breaks ties differently across engines; going through
    ``decimal(28,8)`` makes the result the same everywhere (half away from zero).
    """
    return F.round(c.cast("decimal(28,8)"), scale).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` evaluated in double precision; NULL when ``den`` is 0 or NULL.

    Decimal operands are converted after any exact decimal arithmetic, so the
    quotient is one IEEE division (identical in every engine).
    """
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def stable(c: Column, scale: int = 6) -> Column:
    """Round a float aggregate to ``scale`` decimals for cross-engine comparison.

    Sums of doubles (``avg``, ``stddev``) depend on summation order, which differs
    between engines in the last bits. Used only by the registered check queries.
    """
    return F.round(c.cast("decimal(38,12)"), scale).cast("double")
