"""Window specs and rolling statistics over one ticker's ordered series.

Every window in the models is ``PARTITION BY ticker ORDER BY trade_date`` with a
``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW`` frame. Two rules are encoded here:

* NULL dates sort **last** (``asc_nulls_last``): Spark sorts them first by
  default, which would leak a null-dated bar into the first real bar's ``lag``.
* Rolling means of decimal columns are ``sum(decimal) -> double / count``. The
  decimal sum is exact, so the mean does not depend on summation order and equal
  averages (e.g. SMA-7 == SMA-30 during warm-up) compare equal.

Sliding frames re-aggregate their rows for every output row (Spark does not
retract), so their cost is O(frame) per row; ``mean_from_totals`` gives the
same decimal means at O(1) from running totals. All specs share the one hash
exchange on ``ticker``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def series(partition: str | list[str] = "ticker", order: str = "trade_date") -> WindowSpec:
    """``PARTITION BY <partition> ORDER BY <order> ASC NULLS LAST``."""
    keys = [partition] if isinstance(partition, str) else list(partition)
    return Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())


def trailing(n: int, spec: WindowSpec | None = None) -> WindowSpec:
    """Frame of the current row and the ``n - 1`` rows before it."""
    return (spec if spec is not None else series()).rowsBetween(-(n - 1), Window.currentRow)


def previous(c: ColumnOrName, spec: WindowSpec | None = None, offset: int = 1) -> Column:
    """``lag(c, offset)`` over the series."""
    return F.lag(_col(c), offset).over(spec if spec is not None else series())


def rolling_mean(c: ColumnOrName, n: int, spec: WindowSpec | None = None) -> Column:
    """Mean of the non-null values in the last ``n`` rows (partial frames allowed).

    Computed as ``double(sum) / count``; NULL when the frame holds no value.
    """
    frame = trailing(n, spec)
    col = _col(c)
    return F.sum(col).over(frame).cast("double") / F.nullif(F.count(col).over(frame), F.lit(0))


def rolling_stddev(c: ColumnOrName, n: int, spec: WindowSpec | None = None) -> Column:
    """Sample standard deviation over the last ``n`` rows (NULL for < 2 values)."""
    return F.stddev_samp(_col(c)).over(trailing(n, spec))



def running_totals(c: ColumnOrName, spec: WindowSpec | None = None) -> tuple[Column, Column]:
    """Running sum and non-null count from the start of the series (O(1) per row)."""
    frame = (spec if spec is not None else series()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    col = _col(c)
    return F.sum(col).over(frame), F.count(col).over(frame)


def mean_from_totals(total: str, count: str, n: int, spec: WindowSpec | None = None) -> Column:
    """``rolling_mean`` over ``n`` rows from running totals of a *decimal* column.

    ``(S[i] - S[i-n]) / (C[i] - C[i-n])``: the decimal difference is exact, so
    the value equals ``rolling_mean`` bit for bit, at O(1) per row instead of
    re-aggregating the frame (Spark's sliding frames do not retract). Not for
    float columns, where the difference of running sums would cancel badly.
    """
    w = spec if spec is not None else series()
    zero = F.lit(0)
    now = F.coalesce(F.col(total), zero)
    back = F.coalesce(F.lag(total, n).over(w), zero)
    n_back = F.coalesce(F.lag(count, n).over(w), zero)
    return (now - back).cast("double") / F.nullif(F.col(count) - n_back, zero)


def decimal_means(df: DataFrame, c: str, names: dict[str, int], spec: WindowSpec | None = None) -> DataFrame:
    """``df`` with a rolling mean of the *decimal* column ``c`` per (name, rows), all from
    one pair of running totals."""
    total, count = running_totals(c, spec)
    totals = df.select("*", total.alias("_mean_total"), count.alias("_mean_count"))
    means = [mean_from_totals("_mean_total", "_mean_count", n, spec).alias(name) for name, n in names.items()]
    return totals.select(*df.columns, *means)
