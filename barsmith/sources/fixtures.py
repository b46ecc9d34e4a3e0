"""Stand-in raw layer derived from the driver's ``lineitem`` table.

There is no stock table in the test data, so the raw per-ticker bar tables are
derived deterministically from ``lineitem`` (one bar per supplier bucket and
ship date) and *landed* once per input in the shared scratch folder, exactly as
an ingestion tool would land them. Every query then scans the landed tables via
``read_bars``; nothing downstream knows how they were produced.

Derivation (fixed values, shared with the DuckDB oracle):

* bucket ``k = l_suppkey % 9``; ticker = ``FIXTURE_TICKER_ORDER[k]``
* ``T`` = days since 1970-01-01 of ``l_shipdate`` x 86,400,000
* price ``px = decimal(18,2)(l_extendedprice) + 100000 * 2^k`` (per-ticker level)
* O / C = price of the first / last line by ``(l_orderkey, l_linenumber, px)``;
  H / L = max / min price; V = total quantity; VW = quantity-weighted price;
  N = number of lines.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.paths import modification_stamp, path_exists, read_text, write_text
from barsmith.session import shared_dir
from barsmith.sources.bars import read_landed, read_raw_layer
from barsmith.sources.registry import TICKERS
from barsmith.sources.schema import BAR_SCHEMA

# --- fixed values: bucket -> ticker order of the derived raw layer ----------
FIXTURE_TICKER_ORDER = ["AAPL", "QQQ", "MSFT", "AMZN", "SPY", "GOOGL", "META", "NVDA", "TSLA"]
FIXTURE_VERSION = "f1-v3"
LANDED_LAYOUT = "{root}/ticker={ticker}"


def derive_bars(lineitem: DataFrame) -> DataFrame:
    """Daily bars per derived ticker: columns ``BAR_SCHEMA`` + ``ticker``.

    One hash aggregate on (bucket, day) with map-side partial aggregation; the
    output has at most 9 x (#ship dates) rows.
    """
    k = F.col("l_suppkey") % len(FIXTURE_TICKER_ORDER)
    px = (
        F.col("l_extendedprice").cast("decimal(18,2)")
        + F.lit(100000) * F.expr(f"shiftleft(1L, cast(l_suppkey % {len(FIXTURE_TICKER_ORDER)} as int))")
    ).cast("decimal(18,2)")
    lines = lineitem.select(
        k.alias("k"),
        (F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * F.lit(86400000)).alias("T"),
        F.col("l_quantity").cast("decimal(18,2)").alias("q"),
        px.alias("px"),
        F.struct("l_orderkey", "l_linenumber", px.alias("px")).alias("ord"),
    )
    bars = lines.groupBy("k", "T").agg(
        F.min_by("px", "ord").alias("O"),
        F.max("px").alias("H"),
        F.min("px").alias("L"),
        F.max_by("px", "ord").alias("C"),
        F.sum("q").cast("double").alias("V"),
        (F.sum(F.col("px") * F.col("q")).cast("double") / F.sum("q").cast("double")).alias("VW"),
        F.count(F.lit(1)).alias("N"),
    )
    tickers = F.array(*[F.lit(t) for t in FIXTURE_TICKER_ORDER])
    return bars.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in BAR_SCHEMA.fields],
        F.element_at(tickers, F.col("k").cast("int") + 1).alias("ticker"),
    )


def _fingerprint(spark: SparkSession, path: str) -> str:
    stamp = modification_stamp(spark, path)
    return hashlib.sha1(f"{FIXTURE_VERSION}|{stamp}".encode()).hexdigest()[:16]


def land_raw_layer(spark: SparkSession, sf_dir: str) -> str:
    """Land the derived raw tables once per input; return the raw-layer root.

    Written with ``partitionBy("ticker")`` (one folder per raw table) to a folder of
    its own; a pointer file that is only ever created names the first one finished,
    so concurrent or interrupted runs never expose a partial layer.
    """
    lineitem_path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    home = f"{shared_dir(spark)}/barsmith-raw/{_fingerprint(spark, lineitem_path)}"
    pointer = f"{home}/_current"

    def landed() -> str | None:
        text = read_text(spark, pointer) if path_exists(spark, pointer) else ""
        return f"{home}/{text.strip()}" if text.endswith("\n") else None

    if (root := landed()) is not None:
        return root
    folder = f"bars-{uuid.uuid4().hex[:12]}"
    bars = derive_bars(spark.read.parquet(lineitem_path))
    # REBALANCE: clustered by ticker folder, a hot ticker split over several tasks
    bars.hint("rebalance", "ticker").sortWithinPartitions("ticker", "T").write.partitionBy("ticker").parquet(f"{home}/{folder}")
    write_text(spark, pointer, folder + "\n", overwrite=False)
    return landed() or f"{home}/{folder}"


def raw_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Per-ticker raw DataFrames of the landed stand-in layer for ``sf_dir``."""
    root = land_raw_layer(spark, sf_dir)
    return read_raw_layer(spark, root, TICKERS, layout=LANDED_LAYOUT)


def landed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed stand-in layer as one table with a ``ticker`` partition column."""
    return read_landed(spark, land_raw_layer(spark, sf_dir))
