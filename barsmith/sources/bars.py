"""Raw-bar scans and the staging union (the bronze -> silver step).

The raw layer holds one table per ticker (``<TICKER>_STOCK_API``) with the bar
columns of ``BAR_SCHEMA``. Staging tags every table with its ticker and company
name and renames/types the bar columns; the tables are concatenated with a
positional UNION ALL (no de-duplication).
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.sources.registry import TICKERS, raw_table_name
from barsmith.sources.schema import BAR_SCHEMA

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def read_bars(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan one raw bar table with the declared schema (no inference).

    ``source`` is a path for ``parquet``/``json``/``csv``/``orc`` or a catalog
    table name for ``fmt="table"``.
    """
    if fmt == "table":  # cast to the declared schema, as the file readers apply it
        return spark.table(source).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BAR_SCHEMA.fields])
    reader = spark.read.schema(BAR_SCHEMA).options(**dict(options or {}))
    return reader.format(fmt).load(source)


def read_raw_layer(
    spark: SparkSession,
    root: str,
    registry: Mapping[str, str] = TICKERS,
    fmt: str = "parquet",
    layout: str = "{root}/{table}",
) -> dict[str, DataFrame]:
    """Scan every registered raw table under ``root`` (default ``root/<TICKER>_STOCK_API``)."""
    base = root.rstrip("/")
    return {t: read_bars(spark, layout.format(root=base, table=raw_table_name(t), ticker=t), fmt) for t in registry}


def read_landed(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """One scan over a raw layer laid out as ``root/ticker=<T>/...``.

    ``ticker`` is a partition column, so a ticker filter prunes whole folders and
    the file index is built once instead of once per ticker table.
    """
    schema = T.StructType([*BAR_SCHEMA.fields, T.StructField("ticker", T.StringType())])
    return spark.read.schema(schema).format(fmt).load(root)


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Zone-less timestamp of an epoch-milliseconds value.

    Independent of ``spark.sql.session.timeZone`` (``timestamp_millis`` + cast
    to date would shift the trading day with the session zone).
    """
    return F.timestamp_add("MILLISECOND", ms, F.expr(EPOCH_NTZ))


def project_bar(raw: DataFrame, ticker: str, company_name: str) -> DataFrame:
    """Tag one raw table with constant ticker/company and rename its columns."""
    ts = epoch_ms_to_timestamp(F.col("T"))
    return raw.select(
        F.lit(ticker).alias("ticker"),
        F.lit(company_name).alias("company_name"),
        ts.alias("timestamp"),
        ts.cast("date").alias("trade_date"),
        F.col("O").alias("open_price"),
        F.col("H").alias("high_price"),
        F.col("L").alias("low_price"),
        F.col("C").alias("close_price"),
        F.col("V").alias("volume"),
        F.col("VW").alias("vwap"),
        F.col("N").alias("num_transactions"),
    )


def stage_bars(raw: Mapping[str, DataFrame], registry: Mapping[str, str] = TICKERS) -> DataFrame:
    """UNION ALL of every tagged raw table, in registry order.

    All branches are narrow (scan + project), so the union adds no shuffle; a
    filter on ``ticker`` prunes whole branches through constant folding.
    """
    missing = [t for t in registry if t not in raw]
    if missing:
        raise KeyError(f"raw tables missing for tickers: {missing}")
    branches = [project_bar(raw[t], t, name) for t, name in registry.items()]
    return functools.reduce(DataFrame.union, branches)


def unregistered(
    bars: DataFrame, registry: Mapping[str, str] | DataFrame = TICKERS, ticker_col: str = "ticker"
) -> DataFrame:
    """The landed bars that ``stage_landed`` leaves out: no ticker, or one without a registry entry."""
    if isinstance(registry, DataFrame):
        known = registry.select(F.col("ticker").alias("_reg_ticker"))
        return bars.join(known, F.col(ticker_col) == F.col("_reg_ticker"), "left_anti")
    return bars.where(~F.coalesce(F.col(ticker_col).isin(list(registry)), F.lit(False)))


def stage_landed(
    bars: DataFrame, registry: Mapping[str, str] | DataFrame = TICKERS, ticker_col: str = "ticker"
) -> DataFrame:
    """Staging for a single landed table that already carries a ticker column.

    Equivalent to ``stage_bars`` over its per-ticker slices: rows of tickers
    without a registry entry are left out (they have no raw table; ``unregistered``
    gives them). ``registry``
    is either a small mapping (the company name becomes a literal map lookup:
    no join, no shuffle) or a DataFrame ``(ticker, company_name)`` for a large
    securities master, joined on ticker without a broadcast hint -- the join's
    hash partitioning on ticker is the one the series windows need anyway.
    """
    if isinstance(registry, DataFrame):
        master = registry.select(F.col("ticker").alias("_reg_ticker"), F.col("company_name").alias("_reg_name"))
        tagged = bars.join(master, F.col(ticker_col) == F.col("_reg_ticker"), "inner")
        name = F.col("_reg_name")
    else:
        names = F.create_map(*[F.lit(x) for kv in registry.items() for x in kv])
        tagged = bars.where(F.col(ticker_col).isin(list(registry)))
        name = names[F.col(ticker_col)]
    ts = epoch_ms_to_timestamp(F.col("T"))
    return tagged.select(
        F.col(ticker_col).alias("ticker"),
        name.alias("company_name"),
        ts.alias("timestamp"),
        ts.cast("date").alias("trade_date"),
        F.col("O").cast(BAR_SCHEMA["O"].dataType).alias("open_price"),
        F.col("H").cast(BAR_SCHEMA["H"].dataType).alias("high_price"),
        F.col("L").cast(BAR_SCHEMA["L"].dataType).alias("low_price"),
        F.col("C").cast(BAR_SCHEMA["C"].dataType).alias("close_price"),
        F.col("V").cast("double").alias("volume"),
        F.col("VW").cast("double").alias("vwap"),
        F.col("N").cast("bigint").alias("num_transactions"),
    )
