"""Daily-refresh probe (a measurement tool, not a registered query).

Usage: python tools/refresh_probe.py N_TICKERS N_DAYS [CPUS]

Builds a synthetic history of N_TICKERS x N_DAYS daily bars as a
date-partitioned silver table plus its fact table, lands one new day for every
ticker, and times (a) the incremental refresh of the fact (``incremental_fact``
+ key upsert) against (b) rebuilding the whole fact from all bars. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    n_tickers, n_days = int(argv[1]), int(argv[2])
    cpus = argv[3] if len(argv) > 3 else "8"
    run = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("barsmith-refresh-probe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(int(cpus) * 8))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.path.join(run, "ckpt"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from barsmith.plans.daily_fact import daily_performance_fused
    from barsmith.plans.refresh import refresh_marts
    from barsmith.sources.schema import STAGED_COLUMNS
    from barsmith.streaming.incremental import FACT, SILVER, read_table, refresh_batch

    def bars(first_day: int, days: int):
        n = n_tickers * days
        ids = F.col("id")
        h = F.abs(F.xxhash64(ids + F.lit(first_day * n_tickers))) % 100000
        close = (F.lit(50) + (ids % n_tickers) % 500 + h / 1000.0).cast("decimal(18,4)")
        ts = F.timestamp_add("DAY", (ids / n_tickers).cast("int") + F.lit(first_day), F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'"))
        return spark.range(n).select(
            F.format_string("T%06d", (ids % n_tickers).cast("int")).alias("ticker"),
            F.lit("company").alias("company_name"),
            ts.alias("timestamp"),
            ts.cast("date").alias("trade_date"),
            (close - F.lit(0.5)).cast("decimal(18,4)").alias("open_price"),
            (close + F.lit(1)).cast("decimal(18,4)").alias("high_price"),
            (close - F.lit(1)).cast("decimal(18,4)").alias("low_price"),
            close.alias("close_price"),
            (F.lit(1000) + h % 5000).cast("double").alias("volume"),
            close.cast("double").alias("vwap"),
            (F.lit(10) + h % 90).cast("bigint").alias("num_transactions"),
        ).select(*STAGED_COLUMNS)

    database = "refresh_probe"
    t = time.perf_counter()
    refresh_marts(spark, bars(0, n_days), database, os.path.join(run, "tables"))
    setup = time.perf_counter() - t

    names = {"trade_date": None, "open_price": "O", "high_price": "H", "low_price": "L", "close_price": "C", "volume": "V", "vwap": "VW", "num_transactions": "N"}
    new_day = bars(n_days, 1)
    epoch_day = F.datediff("trade_date", F.lit("1970-01-01").cast("date")).cast("long")
    landed = new_day.select((epoch_day * 86_400_000).alias("T"), *[F.col(k).alias(v) for k, v in names.items() if v], "ticker")
    registry = new_day.select("ticker", "company_name")
    t = time.perf_counter()
    done = refresh_batch(spark, landed, database, registry=registry)
    incremental = time.perf_counter() - t

    t = time.perf_counter()
    daily_performance_fused(read_table(spark, database, SILVER)).write.format("noop").mode("overwrite").save()
    full = time.perf_counter() - t

    stored = read_table(spark, database, FACT)
    print(json.dumps({
        "tickers": n_tickers, "history_days": n_days, "history_bars": n_tickers * n_days,
        "setup_sec": round(setup, 1), "incremental_refresh_sec": round(incremental, 1),
        "full_rebuild_sec_noop": round(full, 1), "months_rewritten": done["fact_months"],
        "fact_rows_after": stored.count(), "run_dir": run,
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
