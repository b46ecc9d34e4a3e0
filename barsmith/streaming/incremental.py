"""Incremental refresh of the marts from newly landed bars.

The models rebuild the fact from all history every day. A fact row only depends on a
bounded number of earlier bars of its ticker, so new or restated bars change only rows
of their own tickers from the first changed date on. ``incremental_fact`` recomputes
exactly these rows from

* the *tail*: the merged bars (a landed bar replaces the stored one with its key) of
  each changed ticker from its first changed date on;
* the *context*: its earlier bars. They are read backwards in blocks of days, twice as
  many each time, until a ticker has the ``CONTEXT_ROWS`` + 1 bars its frames can reach
  (and enough closes for the RSI, whose frame skips bars) or the stored history ends.
  What is read follows from the bars found, nothing else is remembered per ticker.

``refresh_batch`` applies a micro-batch to the catalog tables of a database: silver bars,
fact, summary, portfolio. All rows are written before the first table is switched. Tables
with one row per ticker and day are partitioned by month; only the months in which a row
really changes are written anew.

What a refresh writes follows from the silver bars and the batch alone, and the silver bars
are switched last. So a batch that failed on its way, between two tables or two months
included, is applied in full when it is delivered again: months that were already switched
compare equal, and the portfolio's are switched before the fact's. The id of the last batch
is a property of the silver table, by which a batch delivered twice is recognised.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barsmith.operators.guards import DUPLICATE_KEY_MESSAGE
from barsmith.operators.indicators import BOLLINGER_WINDOW, MACD_SIGNAL, MACD_SLOW, RSI_WINDOW
from barsmith.operators.moving_averages import SMA_WINDOWS, VOLATILITY_WINDOW
from barsmith.operators.series import series_pass
from barsmith.plans.daily_fact import daily_performance_fused
from barsmith.plans.portfolio import portfolio_performance
from barsmith.plans.summary import LATEST_COLUMNS, TRAILING_DAYS, latest_values, stats_30d, summary_from_parts
from barsmith.sources.bars import stage_landed, unregistered
from barsmith.sources.registry import TICKERS
from barsmith.sources.schema import BAR_SCHEMA, FACT_COLUMNS, KEY, STAGED_COLUMNS
from barsmith.plans.refresh import FACT_TABLE as FACT
from barsmith.plans.refresh import PORTFOLIO_TABLE as PORTFOLIO
from barsmith.plans.refresh import SILVER_TABLE as SILVER
from barsmith.plans.refresh import SUMMARY_TABLE as SUMMARY
from barsmith.plans.refresh import order_of, publish_all
from barsmith.session import scratch_tables
from barsmith.warehouse import Staged, Warehouse, month_of, months_in

REJECTS = "rejected_bars"
BATCH = "barsmith.batch"  # property of the silver table: the last batch applied

# Earlier bars needed by the longest dependency chain of one fact row.
CONTEXT_ROWS = max(
    max(SMA_WINDOWS) - 1,            # SMA-90
    MACD_SLOW + MACD_SIGNAL - 1,     # signal line of the previous bar (crossover)
    VOLATILITY_WINDOW,               # 30 returns, each needs its previous close
    BOLLINGER_WINDOW - 1,
    RSI_WINDOW,
)
CONTEXT_DAYS = 200  # first block read backwards; later ones double


def merge_bars(history: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored staged bars with every landed key replaced by the landed bar."""
    landed = changes.where(F.col("trade_date").isNotNull())
    kept = history.join(landed.select(*KEY), KEY, "left_anti").select(*STAGED_COLUMNS)
    return kept.unionByName(landed.select(*STAGED_COLUMNS))


def require_unique(bars: DataFrame) -> None:
    """Raise if two dated bars share (ticker, trade_date)."""
    again = bars.where(F.col("trade_date").isNotNull()).groupBy(*KEY).count().where("count > 1").first()
    if again is not None:
        raise ValueError(f"{DUPLICATE_KEY_MESSAGE}: {again['ticker']} {again['trade_date']}")


Reader = Callable[[dt.date | None, dt.date | None], DataFrame]  # stored bars with low <= trade_date < high, or more


def affected_bars(
    read: Reader, changes: DataFrame, oldest: dt.date | None, keep: Callable[[DataFrame], DataFrame], context_days: int = CONTEXT_DAYS
) -> DataFrame | None:
    """Bars needed to recompute every fact row that the changes can alter.

    Output: staged columns + ``_from`` (first changed date of the ticker); None without
    a dated change. ``read`` gives at least the stored bars of a date range (only its
    partitions), no stored bar is older than ``oldest``, ``keep`` writes a result that is used twice.
    Stored bars are cut down to the changed tickers by a semi-join before anything is
    shuffled.
    """
    c = F.col
    landed = changes.where(c("trade_date").isNotNull()).select(*STAGED_COLUMNS)
    starts = keep(landed.groupBy("ticker").agg(F.min("trade_date").alias("_from")))
    first, last = starts.agg(F.min("_from"), F.max("_from")).first()
    if first is None:
        return None

    def block(tickers: DataFrame, near: int, far: int) -> DataFrame:
        """Stored bars from ``far`` to ``near`` days before each ticker's first change."""
        rows = read(first - dt.timedelta(days=far), None if near == 0 else last - dt.timedelta(days=near))
        rows = rows.join(tickers, "ticker").where(c("trade_date") >= F.date_sub("_from", far))
        return (rows if near == 0 else rows.where(c("trade_date") < F.date_sub("_from", near))).select(*STAGED_COLUMNS, "_from")

    stored = block(starts, 0, context_days).join(landed.select(*KEY), KEY, "left_anti")
    found = keep(stored.select(*STAGED_COLUMNS, "_from").unionByName(landed.join(starts, "ticker").select(*STAGED_COLUMNS, "_from")))
    parts, counted, days, short = [found], found, context_days, starts
    while oldest is not None and oldest < last - dt.timedelta(days=days):
        have = counted.where(c("trade_date") < c("_from")).groupBy("ticker").agg(
            F.count(F.lit(1)).alias("_bars"), F.count("close_price").alias("_closes"))
        enough = have.where((c("_bars") > CONTEXT_ROWS) & (c("_closes") > RSI_WINDOW + 1))
        short = keep(short.join(enough, "ticker", "left_anti"))
        if short.isEmpty():
            break
        parts.append(keep(block(short, days, 2 * days)))
        counted = counted.unionByName(parts[-1])
        days *= 2
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def incremental_fact(history: DataFrame, changes: DataFrame, updated_at=None, context_days: int = CONTEXT_DAYS) -> DataFrame:
    """Fact rows of every affected ticker from its first changed date on.

    Equal to the full fact over ``merge_bars(history, changes)`` restricted to those
    rows. Raises on two landed bars, or two stored ones, with one key.
    """
    require_unique(changes)

    def read(low, high):
        rows = history.select(*STAGED_COLUMNS)
        rows = rows if low is None else rows.where(F.col("trade_date") >= F.lit(low))
        return rows if high is None else rows.where(F.col("trade_date") < F.lit(high))

    oldest = history.agg(F.min("trade_date")).first()[0]
    return _fresh(affected_bars(read, changes, oldest, lambda df: df, context_days), history.sparkSession, changes, updated_at)


def _fresh(bars: DataFrame | None, spark: SparkSession, changes: DataFrame, updated_at) -> DataFrame:
    if bars is None:
        bars = changes.limit(0).select(*STAGED_COLUMNS, F.lit(None).cast("date").alias("_from"))
    rows = series_pass(bars, fact=True, updated_at=updated_at, carry=("_from",))
    return rows.where(F.col("trade_date") >= F.col("_from")).select(*FACT_COLUMNS)


# ------------------------------------------------------------------ the tables


@lru_cache(4)
def schemas(spark: SparkSession) -> dict[str, T.StructType]:
    """Declared schemas of the tables, as the plans produce them."""
    landed = T.StructType([*BAR_SCHEMA.fields, T.StructField("ticker", T.StringType())])
    bars = spark.createDataFrame([], landed)
    staged = stage_landed(bars).select(*STAGED_COLUMNS)
    fact = daily_performance_fused(staged)
    summary = summary_from_parts(latest_values(fact), stats_30d(fact))
    return {SILVER: staged.schema, FACT: fact.schema, SUMMARY: summary.schema, PORTFOLIO: portfolio_performance(fact).schema, REJECTS: landed}


def _upserted(w: Warehouse, name: str, schema: T.StructType, df: DataFrame, months: set[str]) -> Staged:
    """The months ``months`` of a table with the rows of ``df`` replacing those with the same key."""
    rows = df.where(month_of().isin(sorted(months)))
    kept = w.read(name, schema, months).join(rows.select(*KEY), KEY, "left_anti")
    return w.stage(name, kept.unionByName(rows.select(*kept.columns)), order_of(FACT), by_month=True)


def _changed(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Keys of fresh rows that are new or differ from the stored one (its time of update aside)."""
    values = [x for x in FACT_COLUMNS if x not in (*KEY, "dbt_updated_at")]
    old = stored.select(*KEY, F.struct(*values).alias("_old"))
    joined = fresh.select(*KEY, F.struct(*values).alias("_new")).join(old, KEY, "left")
    return joined.where(F.col("_old").isNull() | ~F.col("_new").eqNullSafe(F.col("_old"))).select(*KEY)


def refresh_batch(
    spark: SparkSession,
    landed: DataFrame,
    database: str,
    location: str | None = None,
    registry: Mapping[str, str] | DataFrame = TICKERS,
    updated_at=None,
    as_of=None,
    recommendation_col: str = "sma_recommendation",
    batch_id: int | None = None,
) -> dict:
    """Apply one micro-batch of landed bars to the tables of ``database``.

    The database is created (at ``location``) if it doesn't exist; its fact must be
    partitioned by month. Bars of tickers that aren't registered go to the table
    ``rejected_bars``. Two bars with one key fail the batch before anything is stored.
    Returns what was done: numbers of rejected bars and of rewritten fact months, and
    whether the batch was applied (False if its ``batch_id`` has been).
    """
    w = Warehouse(spark, database, location)
    if w.exists(FACT) and not w.partitioned(FACT):
        raise ValueError(f"{w.name(FACT)} isn't partitioned by month")
    last = w.properties(SILVER).get(BATCH)
    if batch_id is not None and last is not None and batch_id <= int(last):
        return {"applied": False, "rejected": 0, "fact_months": 0}
    schema = schemas(spark)
    with scratch_tables(spark) as keep:
        return _refresh(w, keep, schema, landed, registry, updated_at, as_of, recommendation_col, batch_id)


def _refresh(w: Warehouse, keep, schema, landed, registry, updated_at, as_of, recommendation_col, batch_id) -> dict:
    landed = keep(landed.select(*schema[REJECTS].fieldNames()))
    rejects = unregistered(landed, registry)
    n_rejects = rejects.count()
    changes = keep(stage_landed(landed, registry).where(F.col("trade_date").isNotNull()).select(*STAGED_COLUMNS))
    require_unique(changes)

    stored_months = w.months(SILVER)

    def read(low, high):
        inside = [m for m in stored_months if (low is None or m >= str(low)[:7]) and (high is None or m <= str(high)[:7])]
        return w.read(SILVER, schema[SILVER], inside)

    updates: list[Staged] = []
    if n_rejects:
        kept = w.read(REJECTS, schema[REJECTS])
        new = rejects.select(*kept.columns)
        updates.append(w.stage(REJECTS, kept.exceptAll(new).unionByName(new)))  # delivered again: not twice
    oldest = dt.date.fromisoformat(f"{stored_months[0]}-01") if stored_months else None
    bars = affected_bars(read, changes, oldest, keep)
    touched: set[str] = set()
    if bars is not None:
        fresh = keep(_fresh(bars, w.spark, changes, updated_at))
        silver = _upserted(w, SILVER, schema[SILVER], changes, months_in(changes))
        touched = months_in(keep(_changed(fresh, w.read(FACT, schema[FACT], months_in(fresh)))))
        since = _trailing_start(w.spark, as_of)[:7]
        current = [m for m in w.months(FACT) if m not in touched]
        recent = w.read(FACT, schema[FACT], [m for m in current if m >= since])
        new_days = w.spark.createDataFrame([], schema[PORTFOLIO])
        if touched:
            fact = _upserted(w, FACT, schema[FACT], fresh, touched)
            rows = fact.read(w.spark)
            recent = recent.unionByName(rows)
            new_days = portfolio_performance(rows, recommendation_col=recommendation_col, updated_at=updated_at)
        other = w.read(PORTFOLIO, schema[PORTFOLIO]).where(~month_of().isin(sorted(touched)))
        updates.append(w.stage(PORTFOLIO, other.unionByName(new_days), order_of(PORTFOLIO)))
        # an affected ticker's latest bar is among its fresh rows
        latest = latest_values(fresh, recommendation_col)
        before = w.read(SUMMARY, schema[SUMMARY]).select(*LATEST_COLUMNS)
        latest = before.join(latest.select("ticker"), "ticker", "left_anti").unionByName(latest)
        updates.append(w.stage(SUMMARY, summary_from_parts(latest, stats_30d(recent, as_of), updated_at), order_of(SUMMARY)))
        updates += [fact, silver] if touched else [silver]
    publish_all(w, updates, whole=False)
    if batch_id is not None and w.exists(SILVER):
        w.set_properties(SILVER, {BATCH: str(batch_id)})
    return {"applied": True, "rejected": n_rejects, "fact_months": len(touched)}


def _trailing_start(spark: SparkSession, as_of) -> str:
    """First date of the summary's trailing window."""
    from barsmith.plans.summary import _as_of

    return str(spark.range(1).select(F.date_sub(_as_of(as_of), TRAILING_DAYS)).first()[0])


def start_refresh_stream(
    spark: SparkSession,
    landing_root: str,
    database: str,
    checkpoint_location: str,
    location: str | None = None,
    registry: Mapping[str, str] | DataFrame = TICKERS,
    updated_at=None,
    available_now: bool = True,
    as_of=None,
    recommendation_col: str = "sma_recommendation",
    max_files: int = 1000,
) -> StreamingQuery:
    """Structured Streaming over ``landing_root/ticker=<T>/*.parquet`` files.

    Each micro-batch (at most ``max_files`` files) is applied with ``refresh_batch``
    under its batch id; with ``available_now`` the query processes what has landed and
    stops (the daily-refresh mode).
    """
    schema = T.StructType([*BAR_SCHEMA.fields, T.StructField("ticker", T.StringType())])
    src = spark.readStream.schema(schema).option("basePath", landing_root).option("maxFilesPerTrigger", max_files).parquet(landing_root)

    def apply(df: DataFrame, batch_id: int) -> None:
        refresh_batch(spark, df, database, location, registry, updated_at, as_of, recommendation_col, batch_id)

    writer = src.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A table of ``database`` in its current state and published column order."""
    return Warehouse(spark, database).read(name, schemas(spark)[name])
