import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from barsmith.sources.bars import epoch_ms_to_timestamp, read_bars, read_raw_layer, stage_bars, stage_landed
from barsmith.sources.registry import TICKERS, raw_table_name
from barsmith.sources.schema import BAR_SCHEMA, STAGED_COLUMNS
from conftest import LANDED_SCHEMA, bar


def test_epoch_ms_is_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = spark.range(1).select(epoch_ms_to_timestamp(F.lit(1749000000000)).alias("ts")).first()
            assert r.ts == dt.datetime(2025, 6, 4, 1, 20)
            assert spark.range(1).select(epoch_ms_to_timestamp(F.lit(1749000000000)).cast("date").alias("d")).first().d == dt.date(2025, 6, 4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stage_bars_union_tags_and_types(spark):
    raw = {}
    for i, t in enumerate(TICKERS):
        rows = [bar(t, dt.date(2025, 1, 2), 10 + i)[:8]]
        raw[t] = spark.createDataFrame(rows, BAR_SCHEMA)
    stg = stage_bars(raw)
    assert stg.columns == STAGED_COLUMNS
    got = {r.ticker: (r.company_name, r.close_price, r.trade_date) for r in stg.collect()}
    assert set(got) == set(TICKERS)
    assert got["SPY"][0] == "SPDR S&P 500 ETF Trust"
    assert got["AAPL"][1] == Decimal("10.0000")
    assert got["AAPL"][2] == dt.date(2025, 1, 2)
    types = dict(stg.dtypes)
    assert types["timestamp"] == "timestamp_ntz" and types["trade_date"] == "date"
    assert types["close_price"] == "decimal(18,4)" and types["volume"] == "double"


def test_stage_union_keeps_duplicates(spark):
    row = bar("AAPL", dt.date(2025, 1, 2), 10)[:8]
    raw = {t: spark.createDataFrame([], BAR_SCHEMA) for t in TICKERS}
    raw["AAPL"] = spark.createDataFrame([row, row], BAR_SCHEMA)
    assert stage_bars(raw).count() == 2


def test_stage_landed_equals_union(spark):
    rows = [bar(t, dt.date(2025, 1, 2) + dt.timedelta(days=d), 10 + d) for t in TICKERS for d in range(3)]
    rows.append(bar("ZZZZ", dt.date(2025, 1, 2), 5))  # not registered: no raw table
    landed = spark.createDataFrame(rows, LANDED_SCHEMA)
    raw = {t: landed.where(F.col("ticker") == t).drop("ticker") for t in TICKERS}
    a, b = stage_landed(landed), stage_bars(raw)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_read_raw_layer_roundtrip(spark, tmp_path):
    for i, t in enumerate(TICKERS):
        spark.createDataFrame([bar(t, dt.date(2025, 1, 2), 1 + i)[:8]], BAR_SCHEMA).write.parquet(
            str(tmp_path / raw_table_name(t))
        )
    raw = read_raw_layer(spark, str(tmp_path))
    assert set(raw) == set(TICKERS)
    assert raw["MSFT"].schema == BAR_SCHEMA
    assert stage_bars(raw).count() == len(TICKERS)
    one = spark.createDataFrame([bar("AAPL", dt.date(2025, 1, 2), 3)[:8]], BAR_SCHEMA)
    one.write.csv(str(tmp_path / "csv"))
    one.write.json(str(tmp_path / "json"))
    one.createOrReplaceTempView("raw_aapl_bars")
    for source, fmt in ((str(tmp_path / "csv"), "csv"), (str(tmp_path / "json"), "json"), ("raw_aapl_bars", "table")):
        got = read_bars(spark, source, fmt)
        assert got.schema == BAR_SCHEMA, fmt
        assert got.first().C == Decimal("3.0000"), fmt
    # a catalog table with float prices is read with the declared decimal types
    spark.createDataFrame([(1, 1.5, 2.0, 1.0, 1.75, 10.0, 1.6, 3)], "T long, O double, H double, L double, "
                          "C double, V double, VW double, N int").createOrReplaceTempView("raw_float_bars")
    got = read_bars(spark, "raw_float_bars", "table")
    assert got.schema == BAR_SCHEMA and got.first().C == Decimal("1.7500")


def test_null_date_filter_reaches_scan(spark, tmp_path):
    from barsmith.operators.returns import stock_returns

    spark.createDataFrame([bar("AAPL", dt.date(2025, 1, 2), 3)], LANDED_SCHEMA).write.partitionBy("ticker").parquet(
        str(tmp_path / "landed")
    )
    from barsmith.sources.bars import read_landed

    plan = stock_returns(stage_landed(read_landed(spark, str(tmp_path / "landed"))))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(T)" in plan


def test_stage_landed_with_registry_table(spark):
    rows = [bar(t, dt.date(2025, 1, 2) + dt.timedelta(days=d), 10 + d) for t in TICKERS for d in range(2)]
    rows.append(bar("ZZZZ", dt.date(2025, 1, 2), 5))
    landed = spark.createDataFrame(rows, LANDED_SCHEMA)
    master = spark.createDataFrame(list(TICKERS.items()), "ticker string, company_name string")
    a, b = stage_landed(landed, master), stage_landed(landed)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
