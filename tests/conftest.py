from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from barsmith.sources.bars import stage_landed  # noqa: E402
from barsmith.sources.schema import BAR_SCHEMA  # noqa: E402

EPOCH = dt.date(1970, 1, 1)
DAY_MS = 86_400_000


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("barsmith-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barsmith-test-ckpt-"))
    yield s


def ms(day: dt.date) -> int:
    return (day - EPOCH).days * DAY_MS


LANDED_SCHEMA = T.StructType([*BAR_SCHEMA.fields, T.StructField("ticker", T.StringType())])


def _dec(x):
    return None if x is None else Decimal(str(x))


def bar(ticker, day, close, open_=None, high=None, low=None, volume=1000.0, vwap=None, n=10):
    """One raw bar (landed layout); ``day`` None gives a null timestamp."""
    c = _dec(close)
    o = _dec(open_) if open_ is not None else c
    known = [x for x in (o, c) if x is not None]
    h = _dec(high) if high is not None else (max(known) if known else None)
    lo = _dec(low) if low is not None else (min(known) if known else None)
    t = None if day is None else ms(day)
    return (t, o, h, lo, c, None if volume is None else float(volume), vwap, n, ticker)


def staged_from(spark, rows):
    df = spark.createDataFrame(rows, LANDED_SCHEMA)
    return stage_landed(df)


def series_rows(ticker, closes, start=dt.date(2025, 1, 1), **kw):
    return [bar(ticker, start + dt.timedelta(days=i), c, **kw) for i, c in enumerate(closes)]


def f2_bars(spark, tickers=(("AAPL", -1), ("MSFT", 1)), days=180, start="2025-01-01"):
    """FIXTURES F2: integer staircase reaching every combined-signal label."""
    frames = []
    for ticker, sgn in tickers:
        df = spark.range(days).select(F.col("id").alias("i"))
        close_c = F.expr(
            f"""cast(20000 + {sgn} * (
              case when i < 40 then i*20 + (i*37)%11
                   when i < 70 then 800 + (i-40)*100 - case when i in (62,66) then 101 else 0 end
                   when i < 92 then 3800 + (i%2)
                   when i < 95 then 3835 + (i-92)*5
                   when i < 130 then 3850
                   else 3850 - (i-130)*60 + ((i*i)%7)*90 end) as bigint)"""
        )
        df = df.withColumn("cc", close_c)
        df = df.withColumn("oc", F.col("cc") + (F.col("i") * 13) % 21 - 10)
        df = df.withColumn("hc", F.greatest("oc", "cc") + F.col("i") % 5)
        df = df.withColumn("lc", F.least("oc", "cc") - F.col("i") % 7)
        p = lambda x: (F.col(x).cast("decimal(18,4)") / 100).cast("decimal(18,4)")
        frames.append(
            df.select(
                (F.datediff(F.date_add(F.lit(start).cast("date"), F.col("i").cast("int")), F.lit("1970-01-01").cast("date")).cast("bigint") * DAY_MS).alias("T"),
                p("oc").alias("O"), p("hc").alias("H"), p("lc").alias("L"), p("cc").alias("C"),
                (F.lit(1000) + (F.col("i") * 7919) % 500 + F.when(F.col("i") % 30 == 29, 4000).otherwise(0)).cast("double").alias("V"),
                ((F.col("hc") + F.col("lc")) / 200.0).cast("double").alias("VW"),
                (F.lit(10) + F.col("i") % 90).cast("bigint").alias("N"),
                F.lit(ticker).alias("ticker"),
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def rows_by_key(df, *cols):
    return {(r["ticker"], r["trade_date"]): tuple(r[c] for c in cols) for r in df.collect()}
