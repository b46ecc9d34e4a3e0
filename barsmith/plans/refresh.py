"""Views over the layers and the full refresh of the marts.

Staging and intermediate layers are views, the marts are tables. ``register_views`` has
all of them as lazy temp views of one session. ``refresh_marts`` keeps the marts as catalog
tables of a database (``barsmith.warehouse``), the same ones that the incremental refresh
brings up to date: it writes the silver bars and the daily fact first and builds the summary
and portfolio from the *written* fact, so the expensive window stage runs once and its
lineage is cut, and then points the tables at what was written.

The persistent views read the marts: the fact holds every column of the returns, moving
averages and indicators, so a view is a pruned scan of the current fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.operators.indicators import technical_indicators
from barsmith.operators.moving_averages import moving_averages
from barsmith.operators.returns import stock_returns, valid_dates
from barsmith.plans.daily_fact import daily_performance_fused
from barsmith.plans.portfolio import portfolio_performance
from barsmith.plans.summary import stock_summary
from barsmith.sources.bars import stage_bars
from barsmith.sources.schema import FACT_COLUMNS, INDICATOR_COLUMNS, MOVING_AVERAGE_COLUMNS, RETURNS_COLUMNS, STAGED_COLUMNS
from barsmith.warehouse import Staged, Warehouse

# --- fixed values: relation names of the layers ------------------------------
STAGING_VIEW = "stg_stock_prices"
RETURNS_VIEW = "int_stock_returns"
MOVING_AVERAGES_VIEW = "int_moving_averages"
INDICATORS_VIEW = "int_technical_indicators"
FACT_TABLE = "fct_daily_stock_performance"
SUMMARY_TABLE = "dim_stock_summary"
PORTFOLIO_TABLE = "fct_portfolio_performance"
SILVER_TABLE = "silver_bars"  # the dated staged bars that the marts were built from

# --- fixed values: relation tags and owner metadata (``meta.*``: ``owner`` is a
# reserved table property in Spark) -------------------------------------------
TABLE_PROPERTIES: dict[str, dict[str, str]] = {
    RETURNS_VIEW: {"tags": "intermediate,daily,returns", "meta.owner": "data_engineering",
                   "meta.contains_pii": "false"},
    MOVING_AVERAGES_VIEW: {"tags": "intermediate,technical_analysis,time_series",
                           "meta.owner": "analytics_engineering", "meta.contains_pii": "false",
                           "meta.refresh_frequency": "daily"},
    FACT_TABLE: {"tags": "marts,fact_table,daily", "meta.owner": "analytics", "meta.contains_pii": "false"},
    SUMMARY_TABLE: {"tags": "marts,dimension,summary", "meta.owner": "analytics", "meta.contains_pii": "false"},
    PORTFOLIO_TABLE: {"tags": "marts,fact_table,portfolio", "meta.owner": "analytics", "meta.contains_pii": "false"},
}

# Published row order of the marts (on disk, and of ``published``).
MART_ORDER = {FACT_TABLE: ("ticker", "-trade_date"), SUMMARY_TABLE: ("ticker",), PORTFOLIO_TABLE: ("-trade_date",)}


def register_views(spark: SparkSession, stg: DataFrame, prefix: str = "", updated_at=None) -> dict[str, DataFrame]:
    """Lazy temp views for staging, the three intermediate layers and the fact."""
    ret = stock_returns(stg)
    views = {
        STAGING_VIEW: stg,
        RETURNS_VIEW: ret,
        MOVING_AVERAGES_VIEW: moving_averages(ret),
        INDICATORS_VIEW: technical_indicators(stg),
        FACT_TABLE: daily_performance_fused(stg, updated_at=updated_at),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views


def order_of(name: str) -> list[Column]:
    return [F.col(k[1:]).desc() if k.startswith("-") else F.col(k).asc() for k in MART_ORDER[name]]


def published(name: str, df: DataFrame) -> DataFrame:
    """A mart in its published row order."""
    return df.orderBy(*order_of(name))


def publish_views(warehouse: Warehouse) -> None:
    """The staging and intermediate layers as persistent views over the current marts."""
    cols = lambda names: ", ".join(f"`{n}`" for n in names)
    fact, bars = warehouse.name(FACT_TABLE), warehouse.name(SILVER_TABLE)
    renamed = cols(x for x in INDICATOR_COLUMNS if x not in ("combined_signal", "signal_strength_score"))
    queries = {
        STAGING_VIEW: f"SELECT {cols(STAGED_COLUMNS)} FROM {bars}",
        RETURNS_VIEW: f"SELECT {cols(RETURNS_COLUMNS)} FROM {fact}",
        MOVING_AVERAGES_VIEW: f"SELECT {cols(MOVING_AVERAGE_COLUMNS)} FROM {fact}",
        # bars without a previous close aren't rows of the indicators; all others have a MACD label
        INDICATORS_VIEW: f"SELECT {renamed}, advanced_signal AS combined_signal, signal_strength_score FROM {fact} WHERE macd_signal IS NOT NULL",
    }
    for name, query in queries.items():
        warehouse.view(name, query, TABLE_PROPERTIES.get(name, {}))


def publish_all(warehouse: Warehouse, staged: Sequence[Staged], whole: bool = True) -> None:
    """Make staged tables current, one after the other, and (re)define the views."""
    for s in staged:
        warehouse.publish(s, TABLE_PROPERTIES.get(s.table, {}), whole)
    if staged and not warehouse.exists(RETURNS_VIEW):
        publish_views(warehouse)


def refresh_marts(
    spark: SparkSession,
    source: Mapping[str, DataFrame] | DataFrame,
    database: str,
    location: str | None = None,
    as_of=None,
    updated_at=None,
    recommendation_col: str = "sma_recommendation",
    ordered: bool = False,
) -> dict[str, DataFrame]:
    """Full refresh: staging -> fused fact (written) -> summary + portfolio (written).

    ``source`` is the raw table per ticker or one staged DataFrame; ``database`` is created
    (at ``location``) if it doesn't exist. The summary and the portfolio only read the
    written fact, so their jobs are submitted concurrently from two driver threads. The
    tables are switched when everything is written; a refresh that fails before leaves
    the old ones.

    The fact is partitioned by month, inside a month in its published order (ticker, date
    descending), so the incremental refresh can go on from it. With ``ordered`` it isn't
    partitioned: its files are consecutive ranges of the published order, and one
    statement switches it. Returns the current tables.
    """
    stg = stage_bars(source) if isinstance(source, Mapping) else source
    w = Warehouse(spark, database, location)
    if w.exists(FACT_TABLE) and ordered == w.partitioned(FACT_TABLE):
        raise ValueError(f"{w.name(FACT_TABLE)} was created with ordered={not ordered}")
    bars = w.stage(SILVER_TABLE, valid_dates(stg).select(*STAGED_COLUMNS), order_of(FACT_TABLE), by_month=True)
    rows = daily_performance_fused(bars.read(spark), updated_at=updated_at).select(*FACT_COLUMNS)
    fact = w.stage(FACT_TABLE, rows, order_of(FACT_TABLE), by_month=not ordered)
    written = fact.read(spark)
    small = {
        PORTFOLIO_TABLE: portfolio_performance(written, recommendation_col=recommendation_col, updated_at=updated_at),
        SUMMARY_TABLE: stock_summary(written, as_of=as_of, recommendation_col=recommendation_col, updated_at=updated_at),
    }
    with ThreadPoolExecutor(max_workers=len(small)) as pool:
        marts = list(pool.map(lambda item: w.stage(item[0], item[1], order_of(item[0])), small.items()))
    publish_all(w, [*marts, fact, bars])
    return {s.table: w.read(s.table, s.schema) for s in (fact, *marts)}
