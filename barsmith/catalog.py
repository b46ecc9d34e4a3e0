"""Registered queries: one Spark DataFrame builder and one DuckDB oracle per key.

Every query reads the stand-in raw layer derived from the driver's ``lineitem``
(landed once per input, see ``sources.fixtures``) and runs the library's own
operators over the whole of it. Keys follow the operator inventory; the SQL is
the independent, reference-shaped formulation from ``barsmith.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith import oracle as O
from barsmith.functions.numeric import stable
from barsmith.functions.windows import previous, series
from barsmith.operators.blocks import daily_performance_blocked
from barsmith.operators.indicators import (
    bollinger, gain_loss, macd, rsi, technical_indicators, technical_indicators_joined,
)
from barsmith.operators.moving_averages import avg_volume, moving_averages, sma, volatility
from barsmith.operators.returns import stock_returns, valid_dates
from barsmith.plans import bucketed
from barsmith.plans.daily_fact import daily_performance, daily_performance_fused
from barsmith.plans.refresh import (
    FACT_TABLE, INDICATORS_VIEW, MOVING_AVERAGES_VIEW, PORTFOLIO_TABLE, RETURNS_VIEW, STAGING_VIEW, SUMMARY_TABLE, TABLE_PROPERTIES, published,
)
from barsmith.plans.portfolio import portfolio_columns, portfolio_performance, split_universe
from barsmith.plans.summary import latest_dates, latest_per_ticker, stats_30d, stock_summary
from barsmith.session import shared_dir
from barsmith.sources.bars import stage_bars, stage_landed
from barsmith.sources.fixtures import land_raw_layer, landed_bars, raw_layer
from barsmith.sources.registry import RAW_TABLE_SUFFIX, TICKERS
from barsmith.sources.schema import (
    BAR_SCHEMA, FACT_COLUMNS, INDICATOR_COLUMNS, MOVING_AVERAGE_COLUMNS, RETURNS_COLUMNS, STAGED_COLUMNS,
    SUMMARY_COLUMNS,
)
from barsmith.warehouse import Warehouse

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Builder
    columns: list[str]
    sql: str | None


def updated_at():
    return F.expr(f"TIMESTAMP_NTZ'{O.UPDATED_AT}'")


def stabilize(df: DataFrame) -> DataFrame:
    """Round the order-sensitive float aggregates (``oracle.NOISY``) to 6 decimals."""
    return df.withColumns({c: stable(F.col(c)) for c in df.columns if c in O.NOISY})


# ------------------------------------------------------------------ inputs --
def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging over the landed raw layer read as one ticker-partitioned table."""
    return stage_landed(landed_bars(spark, sf_dir))


def staged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging as the UNION ALL of the nine per-ticker raw tables."""
    return stage_bars(raw_layer(spark, sf_dir))


def fused_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_performance_fused(staged(spark, sf_dir), updated_at=updated_at())


def blocked_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_performance_blocked(staged(spark, sf_dir), updated_at=updated_at(), block_rows=512, span_days=365)


def joined_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staged(spark, sf_dir)
    ret = stock_returns(stg)
    return daily_performance(ret, moving_averages(ret), technical_indicators_joined(stg), updated_at=updated_at())


# ---------------------------------------------------------------- builders --
def _scan_raw_bars(spark, sf_dir):
    raw = raw_layer(spark, sf_dir)
    parts = [raw[t].withColumn("source_table", F.lit(f"{t}{RAW_TABLE_SUFFIX}")) for t in TICKERS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _lag_close(spark, sf_dir):
    stg = valid_dates(staged(spark, sf_dir))
    return stg.select("ticker", "trade_date", "close_price", previous("close_price", series()).alias("prev_close"))


def _cols(builder: Builder, cols: list[str]) -> Builder:
    return lambda spark, sf_dir: builder(spark, sf_dir).select(*cols)


def _summary(rec: str, keys_unique: bool = True) -> Builder:
    return lambda spark, sf_dir: stock_summary(
        fused_fact(spark, sf_dir), as_of=O.AS_OF, recommendation_col=rec, updated_at=updated_at(), keys_unique=keys_unique
    )


def _portfolio(rec: str, keys_unique: bool = True) -> Builder:
    return lambda spark, sf_dir: portfolio_performance(
        fused_fact(spark, sf_dir), recommendation_col=rec, updated_at=updated_at(), keys_unique=keys_unique
    )


def _views(spark, sf_dir):
    from barsmith.plans.refresh import register_views

    register_views(spark, staged_union(spark, sf_dir), prefix="bs_", updated_at=updated_at())
    return spark.sql("SELECT * FROM bs_fct_daily_stock_performance")


INCREMENT_FROM = "2001-10-01"


def _incremental_tail(spark, sf_dir):
    """Daily-refresh job: bars before ``INCREMENT_FROM`` are the stored history,
    the rest arrive as landed changes; returns the recomputed fact rows."""
    from barsmith.streaming.incremental import incremental_fact

    stg = valid_dates(staged(spark, sf_dir))
    cut = F.lit(INCREMENT_FROM).cast("date")
    history, changes = stg.where(F.col("trade_date") < cut), stg.where(F.col("trade_date") >= cut)
    return incremental_fact(history, changes, updated_at=updated_at())


def _database(spark, kind) -> tuple[str, str]:
    """Name and location of a catalog database for one run of a query."""
    run = uuid.uuid4().hex[:12]
    return f"barsmith_{kind}_{run}", f"{shared_dir(spark)}/barsmith-{kind}/{run}"


def _bucketed_indicators(spark, sf_dir):
    w = Warehouse(spark, *_database(spark, "buckets"))
    return bucketed.joined_indicators(w, bucketed.bucketed_bars(w, staged(spark, sf_dir)))


def _bucketed_fact(spark, sf_dir):
    w = Warehouse(spark, *_database(spark, "buckets"))
    return bucketed.joined_fact(w, bucketed.bucketed_bars(w, staged(spark, sf_dir)), updated_at=updated_at())


def _stream_refresh(spark, sf_dir):
    from barsmith.streaming.incremental import read_table, start_refresh_stream

    database, location = _database(spark, "stream")
    q = start_refresh_stream(spark, land_raw_layer(spark, sf_dir), database, f"{location}/checkpoint", f"{location}/tables", updated_at=updated_at())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_table(spark, database, FACT_TABLE)


def _replayed(spark, sf_dir):
    """The whole landed layer brought in by five batches: history in which one ticker
    lacks most of a year and every 97th day is misstated by one, the restatements, the
    missing bars, newer bars, and the last days. Returns the database."""
    from barsmith.streaming.incremental import refresh_batch

    bars = landed_bars(spark, sf_dir)
    day = (F.col("T") / 86_400_000).cast("long")
    newer, last = day >= 11_000, day >= 11_590
    gap = (F.col("ticker") == "MSFT") & day.between(9_500, 9_800)
    wrong = (F.pmod(day, F.lit(97)) == 0) & ~newer & ~gap
    misstated = bars.where(wrong).withColumn("C", (F.col("C") + 1).cast("decimal(18,4)"))
    batches = [
        bars.where(~newer & ~gap & ~wrong).unionByName(misstated), bars.where(wrong), bars.where(gap), bars.where(newer & ~last), bars.where(last),
    ]
    database, location = _database(spark, "replay")
    for i, batch in enumerate(batches):
        refresh_batch(spark, batch, database, location, updated_at=updated_at(), as_of=O.AS_OF, batch_id=i)
    return database


def _replay(name: str) -> Builder:
    """A mart of the replayed database, read by its name in the catalog."""
    return lambda spark, sf_dir: spark.table(f"`{_replayed(spark, sf_dir)}`.`{name}`")


def _refreshed(spark, sf_dir, ordered: bool = False) -> str:
    from barsmith.plans.refresh import refresh_marts

    database, location = _database(spark, "marts")
    refresh_marts(spark, staged(spark, sf_dir), database, location, as_of=O.AS_OF, updated_at=updated_at(), ordered=ordered)
    return database


def _full_refresh(name: str, ordered: bool = False) -> Builder:
    return lambda spark, sf_dir: published(name, spark.table(f"`{_refreshed(spark, sf_dir, ordered)}`.`{name}`"))


def _continued(spark, sf_dir):
    """The catalog's fact after a full refresh of older bars and two batches of newer ones."""
    from barsmith.plans.refresh import refresh_marts
    from barsmith.streaming.incremental import refresh_batch

    bars = landed_bars(spark, sf_dir)
    day = (F.col("T") / 86_400_000).cast("long")
    database, location = _database(spark, "continued")
    refresh_marts(spark, stage_landed(bars.where(day < 11_000)), database, location, as_of=O.AS_OF, updated_at=updated_at())
    for i, batch in enumerate((bars.where((day >= 11_000) & (day < 11_590)), bars.where(day >= 11_590))):
        refresh_batch(spark, batch, database, updated_at=updated_at(), as_of=O.AS_OF, batch_id=i)
    return spark.table(f"`{database}`.`{FACT_TABLE}`")


def _view(name: str) -> Builder:
    """A persistent view over the refreshed marts."""
    return lambda spark, sf_dir: spark.table(f"`{_refreshed(spark, sf_dir)}`.`{name}`")


def _relation_properties(spark, sf_dir):
    """Tags and owner metadata of every relation as the catalog has them, and its rows."""
    database = _refreshed(spark, sf_dir)
    parts = []
    for name in TABLE_PROPERTIES:
        relation = f"`{database}`.`{name}`"
        rows = spark.table(relation).agg(F.count(F.lit(1)).alias("n_rows"))
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {relation}").collect()}
        found = F.explode(F.create_map(*[F.lit(x) for k, v in sorted(props.items()) if k == "tags" or k.startswith("meta.") for x in (k, v)]))
        parts.append(rows.select(F.lit(name).alias("relation"), found.alias("property", "value"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------- SQL ----
K = ["ticker", "trade_date"]
PORTFOLIO = portfolio_columns()
PORTFOLIO_COUNTS = ["num_strong_buy", "num_buy", "num_hold", "num_sell", "num_strong_sell",
                    "num_bullish", "num_bearish", "num_neutral"]
PORTFOLIO_AGG = [c for c in PORTFOLIO if c not in (
    "spy_return_pct", "qqq_return_pct", "alpha_vs_spy", "alpha_vs_qqq", "sentiment_score",
    "risk_adjusted_return", "market_regime", "dbt_updated_at")]


def _sql(ctes: tuple[str, ...], source: str, columns: list[str], where: str = "") -> str:
    return O.with_ctes(O.stable_select(columns, source) + (f" WHERE {where}" if where else ""), *ctes)


def _fact_sql(cols):
    return _sql(O.FACT, "fact", cols)


def _summary_sql(rec, cols=SUMMARY_COLUMNS):
    return _sql(O.FACT + (O.cte_summary(rec),), "summary", cols)


def _portfolio_sql(cols, rec="sma_recommendation"):
    return _sql(O.FACT + (O.cte_portfolio(rec),), "portfolio", cols)


RAW_COLS = BAR_SCHEMA.fieldNames() + ["source_table"]
GAIN_COLS = ["ticker", "trade_date", "close_price", "prev_close", "price_change", "gain", "loss"]
RSI_COLS = ["ticker", "trade_date", "close_price", "price_change", "avg_gain_14", "avg_loss_14", "rsi_14", "rsi_signal"]
MACD_COLS = ["ticker", "trade_date", "close_price", "macd_line", "macd_signal_line", "macd_histogram", "macd_signal", "macd_crossover"]
BB_COLS = ["ticker", "trade_date", "close_price", "bb_middle", "bb_stddev", "bb_upper", "bb_lower",
           "bb_width_pct", "bb_percent_b", "bb_position"]


def _rounded(cols_n: dict[str, int], src: Builder) -> Builder:
    from barsmith.functions.numeric import round_half_up

    def build(spark, sf_dir):
        df = src(spark, sf_dir)
        return df.withColumns({c: round_half_up(F.col(c), n) for c, n in cols_n.items()})
    return build


def _rounded_sql(ctes, source, cols, cols_n: dict[str, int]) -> str:
    exprs = [f"{O.rnd(c, cols_n[c])} AS {c}" if c in cols_n else c for c in cols]
    return O.with_ctes(f"SELECT {', '.join(exprs)} FROM {source}", *ctes)


# Published precision of the intermediate indicator values (as in the final
# indicator output): MACD at 4 decimals, Bollinger values at 2.
MACD_ROUND = {"macd_line": 4, "macd_signal_line": 4, "macd_histogram": 4}
BB_ROUND = {"bb_middle": 2, "bb_stddev": 2, "bb_upper": 2, "bb_lower": 2, "bb_width_pct": 2, "bb_percent_b": 2}


def _build_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}

    def add(name, build, cols, sql):
        q[name] = Query(build, cols, sql)

    raw_sql = O.with_ctes(
        f"SELECT T, O, H, L, C, V, VW, N, ticker || {O.RAW_TABLE_SUFFIX_SQL} AS source_table FROM raw_bars", *O.RAW
    )
    add("scan_raw_bars", _scan_raw_bars, RAW_COLS, raw_sql)
    add("stage_bars", staged_union, STAGED_COLUMNS, _sql(O.RAW, "stg", STAGED_COLUMNS))
    add("stage_landed", staged, STAGED_COLUMNS, _sql(O.RAW, "stg", STAGED_COLUMNS))
    add("filter_valid_dates", lambda s, d: valid_dates(staged_union(s, d)), STAGED_COLUMNS,
        _sql(O.RAW, "stg", STAGED_COLUMNS, "trade_date IS NOT NULL"))
    add("sorted_ticker_date", lambda s, d: staged_union(s, d).orderBy("ticker", "trade_date"), STAGED_COLUMNS,
        _sql(O.RAW, "stg", STAGED_COLUMNS))
    add("window_lag_close", _lag_close, K + ["close_price", "prev_close"],
        _sql(O.RETURNS, "ret_base", K + ["close_price", "prev_close"], "trade_date IS NOT NULL"))

    ret = lambda s, d: stock_returns(staged(s, d))
    add("stock_returns", ret, RETURNS_COLUMNS, _sql(O.RETURNS, "ret", RETURNS_COLUMNS))
    add("daily_return", _cols(ret, K + ["daily_return_pct"]), K + ["daily_return_pct"],
        _sql(O.RETURNS, "ret", K + ["daily_return_pct"]))
    im = K + ["intraday_range", "intraday_volatility_pct", "price_change_per_volume"]
    add("intraday_metrics", _cols(ret, im), im, _sql(O.RETURNS, "ret", im))

    sma_cols = K + ["sma_7_day", "sma_30_day", "sma_90_day"]
    add("sma_7_30_90", lambda s, d: sma(stock_returns(staged(s, d))).select(*sma_cols), sma_cols, _sql(O.MA, "ma", sma_cols))
    av_cols = K + ["avg_volume_7_day"]
    add("avg_volume_7", lambda s, d: avg_volume(stock_returns(staged(s, d))).select(*av_cols), av_cols,
        _sql(O.MA, "ma", av_cols))
    vol_cols = K + ["volatility_30_day"]
    add("volatility_30", lambda s, d: stabilize(volatility(stock_returns(staged(s, d))).select(*vol_cols)), vol_cols,
        _sql(O.MA, "ma", vol_cols))
    add("moving_averages", lambda s, d: stabilize(moving_averages(stock_returns(staged(s, d)))), MOVING_AVERAGE_COLUMNS,
        _sql(O.MA, "ma", MOVING_AVERAGE_COLUMNS))

    add("gain_loss_split", lambda s, d: gain_loss(staged(s, d)), GAIN_COLS, _sql(O.TI, "gl", GAIN_COLS))
    add("rsi_14", lambda s, d: rsi(staged(s, d)).where(F.col("trade_date").isNotNull()), RSI_COLS,
        _sql(O.TI, "rsi", RSI_COLS, "trade_date IS NOT NULL"))
    add("macd", _rounded(MACD_ROUND, lambda s, d: macd(staged(s, d))), MACD_COLS,
        _rounded_sql(O.TI, "macd", MACD_COLS, MACD_ROUND))
    xo = K + ["macd_crossover"]
    add("macd_crossover", lambda s, d: macd(staged(s, d)).select(*xo), xo, _sql(O.TI, "macd", xo))
    add("bollinger_bands", _rounded(BB_ROUND, lambda s, d: bollinger(staged(s, d))), BB_COLS,
        _rounded_sql(O.TI, "bb", BB_COLS, BB_ROUND))
    bp = K + ["bb_position"]
    add("bollinger_position", lambda s, d: bollinger(staged(s, d)).select(*bp), bp, _sql(O.TI, "bb", bp))

    ti = lambda s, d: technical_indicators(staged(s, d))
    add("technical_indicators", ti, INDICATOR_COLUMNS, _sql(O.TI, "ti", INDICATOR_COLUMNS))
    add("join_indicators_inner", _bucketed_indicators, INDICATOR_COLUMNS, _sql(O.TI, "ti", INDICATOR_COLUMNS))
    cs = K + ["combined_signal"]
    add("signal_combined", _cols(ti, cs), cs, _sql(O.TI, "ti", cs))
    ss = K + ["signal_strength_score"]
    add("signal_strength_score", _cols(ti, ss), ss, _sql(O.TI, "ti", ss))

    add("fact_daily", lambda s, d: published(FACT_TABLE, stabilize(joined_fact(s, d))), FACT_COLUMNS, _fact_sql(FACT_COLUMNS))
    jf = K + ["close_price", "sma_30_day", "rsi_14_day", "macd_signal", "bollinger_position"]
    add("join_fact_left", lambda s, d: _bucketed_fact(s, d).select(*jf), jf, _fact_sql(jf))
    add("fact_daily_fused", lambda s, d: stabilize(fused_fact(s, d)), FACT_COLUMNS, _fact_sql(FACT_COLUMNS))
    add("fact_daily_blocked", lambda s, d: stabilize(blocked_fact(s, d)), FACT_COLUMNS, _fact_sql(FACT_COLUMNS))
    for name, cols in {
        "signal_trend": K + ["trend_signal"],
        "signal_sma_recommendation": K + ["sma_recommendation"],
        "signal_composite_recommendation": K + ["composite_recommendation"],
        "volume_signals": K + ["volume_indicator", "volume_vs_avg_pct"],
        "risk_level": K + ["volatility_risk_level"],
        "bollinger_squeeze": K + ["bollinger_squeeze_indicator"],
        "performance_key": ["performance_key"],
    }.items():
        add(name, _cols(fused_fact, cols), cols, _fact_sql(cols))

    add("latest_dates", lambda s, d: latest_dates(fused_fact(s, d)), ["ticker", "latest_trade_date"],
        _sql(O.FACT + (O.cte_summary("sma_recommendation"),), "last_day", ["ticker", "latest_trade_date"]))
    lv = ["ticker", "company_name", "latest_trade_date", "current_price", "current_volume",
          "current_recommendation", "current_trend"]
    add("latest_per_ticker", lambda s, d: latest_per_ticker(fused_fact(s, d)), lv,
        _sql(O.FACT + (O.cte_summary("sma_recommendation"),), "last_bar", lv))
    st = ["ticker", "avg_return_30d", "volatility_30d", "avg_volume_30d", "low_30d", "high_30d", "total_trading_days"]
    add("stats_30d", lambda s, d: stabilize(stats_30d(fused_fact(s, d), as_of=O.AS_OF)), st,
        _sql(O.FACT + (O.cte_summary("sma_recommendation"),), "trailing_stats", st))
    add("dim_stock_summary", lambda s, d: published(SUMMARY_TABLE, stabilize(_summary("sma_recommendation")(s, d))), SUMMARY_COLUMNS,
        _summary_sql("sma_recommendation"))
    add("dim_stock_summary_composite", lambda s, d: stabilize(_summary("composite_recommendation")(s, d)),
        SUMMARY_COLUMNS, _summary_sql("composite_recommendation"))
    add("dim_stock_summary_backjoin", lambda s, d: stabilize(_summary("sma_recommendation", False)(s, d)),
        SUMMARY_COLUMNS, _summary_sql("sma_recommendation"))

    uc = ["trade_date", "ticker", "close_price", "daily_return_pct"]
    add("universe_split", lambda s, d: split_universe(fused_fact(s, d))[1], uc,
        _sql(O.FACT + (O.cte_portfolio(),), "bench_rows", uc))
    port = _portfolio("sma_recommendation")
    add("portfolio_daily_agg", lambda s, d: stabilize(port(s, d).select(*PORTFOLIO_AGG)), PORTFOLIO_AGG,
        _portfolio_sql(PORTFOLIO_AGG))
    pc = ["trade_date"] + PORTFOLIO_COUNTS
    add("portfolio_signal_counts", lambda s, d: port(s, d).select(*pc), pc, _portfolio_sql(pc))
    jb = ["trade_date", "spy_return_pct", "qqq_return_pct"]
    add("join_benchmarks", lambda s, d: _portfolio("sma_recommendation", False)(s, d).select(*jb), jb, _portfolio_sql(jb))
    pa = ["trade_date", "spy_return_pct", "qqq_return_pct", "alpha_vs_spy", "alpha_vs_qqq"]
    add("portfolio_alpha", lambda s, d: stabilize(port(s, d).select(*pa)), pa, _portfolio_sql(pa))
    psn = ["trade_date", "num_stocks", "sentiment_score"]
    add("portfolio_sentiment", lambda s, d: port(s, d).select(*psn), psn, _portfolio_sql(psn))
    pr = ["trade_date", "risk_adjusted_return"]
    add("portfolio_risk_adjusted", lambda s, d: stabilize(port(s, d).select(*pr)), pr, _portfolio_sql(pr))
    mr = ["trade_date", "market_regime"]
    add("market_regime", lambda s, d: port(s, d).select(*mr), mr, _portfolio_sql(mr))
    add("fact_portfolio", lambda s, d: published(PORTFOLIO_TABLE, stabilize(port(s, d))), PORTFOLIO, _portfolio_sql(PORTFOLIO))
    add("fact_portfolio_composite", lambda s, d: stabilize(_portfolio("composite_recommendation")(s, d)), PORTFOLIO,
        _portfolio_sql(PORTFOLIO, "composite_recommendation"))
    add("fact_portfolio_joinform", lambda s, d: stabilize(_portfolio("sma_recommendation", False)(s, d)), PORTFOLIO,
        _portfolio_sql(PORTFOLIO))

    add("incremental_fact_tail", lambda s, d: stabilize(_incremental_tail(s, d)), FACT_COLUMNS,
        _sql(O.FACT, "fact", FACT_COLUMNS, f"trade_date >= DATE '{INCREMENT_FROM}'"))
    add("stream_refresh_fact", lambda s, d: stabilize(_stream_refresh(s, d)), FACT_COLUMNS, _fact_sql(FACT_COLUMNS))
    add("registered_views", lambda s, d: stabilize(_views(s, d)), FACT_COLUMNS, _fact_sql(FACT_COLUMNS))
    for key, make in {"full_refresh": _full_refresh, "incremental_replay": _replay}.items():
        add(f"{key}_fact", lambda s, d, m=make(FACT_TABLE): stabilize(m(s, d).select(*FACT_COLUMNS)), FACT_COLUMNS, _fact_sql(FACT_COLUMNS))
        add(f"{key}_summary", lambda s, d, m=make(SUMMARY_TABLE): stabilize(m(s, d)), SUMMARY_COLUMNS, _summary_sql("sma_recommendation"))
        add(f"{key}_marts", lambda s, d, m=make(PORTFOLIO_TABLE): stabilize(m(s, d)), PORTFOLIO, _portfolio_sql(PORTFOLIO))
    add("full_refresh_ordered_fact", lambda s, d: stabilize(_full_refresh(FACT_TABLE, True)(s, d)), FACT_COLUMNS, _fact_sql(FACT_COLUMNS))
    add("catalog_fact_after_batches", lambda s, d: stabilize(_continued(s, d).select(*FACT_COLUMNS)), FACT_COLUMNS, _fact_sql(FACT_COLUMNS))
    add("view_staging", _view(STAGING_VIEW), STAGED_COLUMNS, _sql(O.RAW, "stg", STAGED_COLUMNS, "trade_date IS NOT NULL"))
    add("view_returns", _view(RETURNS_VIEW), RETURNS_COLUMNS, _sql(O.RETURNS, "ret", RETURNS_COLUMNS))
    add("view_moving_averages", lambda s, d: stabilize(_view(MOVING_AVERAGES_VIEW)(s, d)), MOVING_AVERAGE_COLUMNS, _sql(O.MA, "ma", MOVING_AVERAGE_COLUMNS))
    add("view_technical_indicators", _view(INDICATORS_VIEW), INDICATOR_COLUMNS, _sql(O.TI, "ti", INDICATOR_COLUMNS))
    add("relation_properties", _relation_properties, ["relation", "property", "value", "n_rows"], O.with_ctes(
        O.RELATION_PROPERTIES, *O.FACT, O.cte_summary("sma_recommendation"), O.cte_portfolio("sma_recommendation")))
    return q


QUERIES: dict[str, Query] = _build_queries()


def spark_queries() -> dict[str, Builder]:
    return {k: v.build for k, v in QUERIES.items()}


def oracle_queries() -> dict[str, str]:
    return {k: v.sql for k, v in QUERIES.items() if v.sql is not None}

