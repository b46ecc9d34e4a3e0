import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from barsmith.catalog import stabilize
from barsmith.plans.daily_fact import daily_performance_fused
from barsmith.sources.bars import stage_landed
from barsmith.plans.portfolio import portfolio_performance
from barsmith.plans.summary import stock_summary
from barsmith.sources.schema import FACT_COLUMNS, PORTFOLIO_COLUMNS, STAGED_COLUMNS, SUMMARY_COLUMNS
from barsmith.paths import path_exists
from barsmith.plans.refresh import refresh_marts
from barsmith.streaming.incremental import (
    FACT, PORTFOLIO, REJECTS, SILVER, SUMMARY, affected_bars, incremental_fact, merge_bars, read_table, refresh_batch, start_refresh_stream,
)
from barsmith.warehouse import Warehouse
from conftest import LANDED_SCHEMA, bar, f2_bars, series_rows, staged_from

UPDATED = dt.datetime(2025, 1, 1)


def same(a, b):
    a, b = a.select(*FACT_COLUMNS), b.select(*FACT_COLUMNS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def expected(history, changes):
    full = daily_performance_fused(merge_bars(history, changes), updated_at=UPDATED)
    starts = changes.groupBy("ticker").agg(F.min("trade_date").alias("_from"))
    return full.join(starts, "ticker").where(F.col("trade_date") >= F.col("_from")).drop("_from")


def test_new_days_and_restated_bar(spark):
    stg = stage_landed(f2_bars(spark, tickers=(("AAPL", -1), ("MSFT", 1), ("SPY", 1))))
    history = stg.where(F.col("trade_date") < F.lit(dt.date(2025, 6, 1)))
    new_days = stg.where(F.col("trade_date") >= F.lit(dt.date(2025, 6, 1)))
    restated = stg.where((F.col("ticker") == "AAPL") & (F.col("trade_date") == F.lit(dt.date(2025, 3, 10)))).withColumn(
        "close_price", (F.col("close_price") + 1).cast("decimal(18,4)")
    )
    changes = new_days.unionByName(restated)
    got = incremental_fact(history, changes, updated_at=UPDATED)
    same(got, expected(history, changes))
    assert got.where("ticker = 'AAPL'").agg(F.min("trade_date")).first()[0] == dt.date(2025, 3, 10)


def test_short_or_gappy_history_falls_back_to_full_history(spark):
    old = series_rows("AAPL", list(range(100, 160)), start=dt.date(2020, 1, 1))  # 60 bars, years back
    mid = series_rows("AAPL", [150, None, 151] + list(range(140, 170)), start=dt.date(2024, 12, 1))
    hist = staged_from(spark, old + mid)
    changes = staged_from(spark, series_rows("AAPL", [171, 172, 170], start=dt.date(2025, 1, 10)))
    same(incremental_fact(hist, changes, updated_at=UPDATED), expected(hist, changes))


def test_new_ticker_without_history(spark):
    hist = staged_from(spark, series_rows("AAPL", list(range(100, 200))))
    changes = staged_from(spark, series_rows("MSFT", [10, 11, 12], start=dt.date(2025, 4, 1)))
    got = incremental_fact(hist, changes, updated_at=UPDATED)
    assert got.count() == 3
    same(got, expected(hist, changes))


def expected_tables(bars, as_of):
    full = daily_performance_fused(bars, updated_at=UPDATED)
    return {
        FACT: full, SILVER: bars.select(*STAGED_COLUMNS),
        SUMMARY: stock_summary(full, as_of=as_of, updated_at=UPDATED).select(*SUMMARY_COLUMNS),
        PORTFOLIO: portfolio_performance(full, updated_at=UPDATED).select(*PORTFOLIO_COLUMNS),
    }


@pytest.fixture
def db(spark, tmp_path):
    """A new catalog database in a folder of its own."""
    name = f"refresh_{uuid.uuid4().hex[:10]}"
    Warehouse(spark, name, str(tmp_path / "tables"))
    yield name
    spark.sql(f"DROP DATABASE `{name}` CASCADE")


def locations(spark, db, name):
    """Folder by month (or of the whole table) that the catalog points a table at."""
    w = Warehouse(spark, db)
    at = lambda part: spark.sql(f"DESCRIBE TABLE EXTENDED {w.name(name)} {part}").where("col_name = 'Location'").first().data_type
    return {m: at(f"PARTITION (trade_month = '{m}')") for m in w.months(name)} if w.partitioned(name) else {"": at("")}


def state(spark, db):
    w = Warehouse(spark, db)
    return {n: (locations(spark, db, n), w.properties(n)) for n in (SILVER, FACT, SUMMARY, PORTFOLIO, REJECTS) if w.exists(n)}


def assert_store(spark, root, bars, as_of="2025-06-15"):
    # float aggregates differ in the last bits with summation order: compare
    # them at 6 decimals (the oracle's convention), everything else exactly
    for name, want in expected_tables(bars, as_of).items():
        want, got = stabilize(want), stabilize(read_table(spark, root, name).select(*want.columns))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def apply(spark, root, batch, **kw):
    return refresh_batch(spark, batch, root, updated_at=UPDATED, as_of="2025-06-15", **kw)


def landed(spark, rows):
    return spark.createDataFrame(rows, LANDED_SCHEMA)


def test_streaming_refresh_equals_full_build(spark, tmp_path, db):
    landing, ckpt = (str(tmp_path / x) for x in ("landing", "ckpt"))
    bars = f2_bars(spark, tickers=(("AAPL", -1), ("MSFT", 1), ("SPY", 1), ("TSLA", -1)))
    cut = (dt.date(2025, 5, 1) - dt.date(1970, 1, 1)).days * 86_400_000
    bars.where(F.col("T") < cut).write.partitionBy("ticker").parquet(landing)
    stream = lambda: start_refresh_stream(spark, landing, db, ckpt, updated_at=UPDATED, as_of="2025-06-15").awaitTermination()
    stream()
    bars.where(F.col("T") >= cut).write.mode("append").partitionBy("ticker").parquet(landing)
    restate = landed(spark, [bar("AAPL", dt.date(2025, 2, 3), 123.45)])
    restate.write.mode("append").partitionBy("ticker").parquet(landing)
    stream()
    assert_store(spark, db, merge_bars(stage_landed(bars), stage_landed(restate)))


def test_bars_far_apart_over_two_refreshes(spark, db):
    """A ticker whose context reaches back over years, refreshed day by day."""
    old = series_rows("AAPL", list(range(100, 145)), start=dt.date(2020, 1, 1))
    mid = series_rows("AAPL", list(range(140, 190)), start=dt.date(2024, 12, 1))
    young = series_rows("MSFT", list(range(10, 60)), start=dt.date(2024, 12, 1))
    rows = old + mid + young
    apply(spark, db, landed(spark, rows))
    for day, close in ((dt.date(2025, 2, 10), 171), (dt.date(2025, 2, 11), 172)):
        new = [bar("AAPL", day, close), bar("MSFT", day, close)]
        apply(spark, db, landed(spark, new))
        rows = rows + new
    assert_store(spark, db, staged_from(spark, rows))


def test_duplicate_keys_fail_and_store_nothing(spark, db):
    rows = series_rows("AAPL", [10, 11, 12])
    apply(spark, db, landed(spark, rows))
    before = state(spark, db)
    day = dt.date(2025, 1, 9)
    with pytest.raises(ValueError, match="AAPL"):
        apply(spark, db, landed(spark, [bar("AAPL", day, 300), bar("AAPL", day, 400)]))
    assert state(spark, db) == before
    with pytest.raises(ValueError):
        incremental_fact(staged_from(spark, rows), staged_from(spark, [bar("AAPL", day, 3), bar("AAPL", day, 4)]))


def test_unregistered_tickers_are_kept_apart(spark, tmp_path, db):
    rows = series_rows("AAPL", [10, 11]) + series_rows("IBM", [5, 6, 7])
    done = apply(spark, db, landed(spark, rows))
    assert done["rejected"] == 3
    apply(spark, db, landed(spark, series_rows("IBM", [7, 8], start=dt.date(2025, 1, 3))))  # one of them again
    assert [r.T for r in read_table(spark, db, REJECTS).where("ticker = 'IBM'").orderBy("T").collect()] == [r[0] for r in series_rows("IBM", [1, 2, 3, 4])]
    assert_store(spark, db, staged_from(spark, rows[:2]))
    # the registry can be a table
    names = spark.createDataFrame([("IBM", "International Business Machines")], "ticker string, company_name string")
    assert apply(spark, f"{db}_other", landed(spark, rows), location=str(tmp_path / "other"), registry=names)["rejected"] == 2


def test_file_system_errors_are_raised(spark):
    with pytest.raises(Exception, match="(?i)filesystem|scheme"):
        path_exists(spark, "nosuchscheme://bucket/table")
    with pytest.raises(Exception, match="(?i)filesystem|scheme"):
        apply(spark, "nowhere", landed(spark, series_rows("AAPL", [1])), location="nosuchscheme://bucket/store")


def test_a_failure_anywhere_keeps_the_tables_readable_and_a_retry_completes(spark, db, monkeypatch):
    """A refresh fails at steps before, between and after the switches: nothing changes before
    the first, and after any of them the tables can be read and a redelivery is applied in full."""
    first = series_rows("AAPL", list(range(100, 140))) + series_rows("SPY", list(range(50, 90)))
    second = [bar("AAPL", dt.date(2025, 1, 20), 7), bar("SPY", dt.date(2025, 3, 3), 9), bar("IBM", dt.date(2025, 3, 3), 9)]
    apply(spark, db, landed(spark, first), batch_id=0)
    before = state(spark, db)
    want = merge_bars(staged_from(spark, first), staged_from(spark, second[:2]))
    real_stage, real_sql = Warehouse.stage, type(spark).sql
    early = late = 0
    for at in (1, 5, 6, 9, 12, 14, 999):  # 5 tables are written, then switched
        counted = {"steps": 0, "switches": 0}

        def step(switch):
            counted["steps"] += 1
            if counted["steps"] == at:
                raise OSError("lost")
            counted["switches"] += switch

        def stage(self, *a, **kw):
            step(0)
            return real_stage(self, *a, **kw)

        def sql(self, query, *a, **kw):
            if query.startswith(("ALTER TABLE", "CREATE TABLE")):
                step(1)
            return real_sql(self, query, *a, **kw)

        monkeypatch.setattr(type(spark), "sql", sql)
        monkeypatch.setattr(Warehouse, "stage", stage)
        try:
            apply(spark, db, landed(spark, second), batch_id=1)
        except OSError:
            monkeypatch.undo()
            early, late = early + (counted["switches"] == 0), late + (counted["switches"] > 0)
            if counted["switches"] == 0:
                assert state(spark, db) == before
            for n in (FACT, SILVER, SUMMARY, PORTFOLIO):
                assert read_table(spark, db, n).count() > 0
        finally:
            monkeypatch.undo()
    assert early == 3 and late == 3
    after = state(spark, db)
    assert apply(spark, db, landed(spark, second), batch_id=1) == {"applied": False, "rejected": 0, "fact_months": 0}
    assert state(spark, db) == after
    assert_store(spark, db, want)
    assert read_table(spark, db, REJECTS).count() == 1


def test_only_changed_months_are_switched(spark, db):
    rows = series_rows("AAPL", list(range(100, 500)), start=dt.date(2023, 1, 1)) + series_rows("SPY", list(range(50, 450)), start=dt.date(2023, 1, 1))
    apply(spark, db, landed(spark, rows))
    before = {n: locations(spark, db, n) for n in (FACT, SILVER)}
    restated = [bar("AAPL", dt.date(2023, 3, 15), 7)]
    done = apply(spark, db, landed(spark, restated))
    after = {n: locations(spark, db, n) for n in (FACT, SILVER)}
    changed = {m for m in after[FACT] if after[FACT][m] != before[FACT].get(m)}
    assert len(changed) == done["fact_months"] and min(changed) == "2023-03" and max(changed) <= "2023-07"
    assert {m for m in after[SILVER] if after[SILVER][m] != before[SILVER].get(m)} == {"2023-03"}
    assert_store(spark, db, merge_bars(staged_from(spark, rows), staged_from(spark, restated)))


def test_incremental_refresh_continues_a_full_one_by_the_catalog(spark, db):
    rows = series_rows("AAPL", list(range(100, 200))) + series_rows("QQQ", list(range(60, 160)))
    refresh_marts(spark, staged_from(spark, rows), db, as_of="2025-06-15", updated_at=UPDATED)
    assert_store(spark, db, staged_from(spark, rows))
    assert spark.table(f"{db}.{FACT}").count() == 200
    new = [bar("AAPL", dt.date(2025, 4, 20), 5), bar("AAPL", dt.date(2025, 1, 5), 6)]
    apply(spark, db, landed(spark, new))
    assert_store(spark, db, merge_bars(staged_from(spark, rows), staged_from(spark, new)))
    assert spark.table(f"{db}.{FACT}").count() == 201 and spark.table(f"{db}.int_stock_returns").count() == 201
    # a full refresh over less history replaces all months
    refresh_marts(spark, staged_from(spark, rows[:40]), db, as_of="2025-06-15", updated_at=UPDATED)
    assert_store(spark, db, staged_from(spark, rows[:40]))


def test_full_refresh_that_fails_leaves_the_old_tables(spark, db, monkeypatch):
    from barsmith.plans import refresh

    rows = series_rows("AAPL", list(range(100, 150))) + series_rows("MSFT", list(range(60, 110)))
    refresh_marts(spark, staged_from(spark, rows), db, as_of="2025-06-15", updated_at=UPDATED, ordered=True)
    before = state(spark, db)
    monkeypatch.setattr(refresh, "publish_all", lambda *a, **kw: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        refresh_marts(spark, staged_from(spark, rows[:70]), db, as_of="2025-06-15", updated_at=UPDATED, ordered=True)
    assert state(spark, db) == before
    assert_store(spark, db, staged_from(spark, rows))
    monkeypatch.undo()
    with pytest.raises(ValueError, match="ordered=True"):
        refresh_marts(spark, staged_from(spark, rows), db)
    with pytest.raises(ValueError, match="partitioned by month"):
        apply(spark, db, landed(spark, rows))


def test_files_of_the_fact_hold_disjoint_ranges_in_published_order(spark, db, tmp_path):
    import glob

    import pyarrow.parquet as pq

    tickers = ["AAPL", "MSFT", "AMZN", "GOOGL", "META", "NVDA", "QQQ", "SPY", "TSLA"]
    rows = [r for k, t in enumerate(tickers) for r in series_rows(t, [100 + (i * 7 + k) % 50 for i in range(300)])]
    key = lambda ticker, day: (ticker, -day.toordinal())

    def ordered_files(folder):
        files = sorted(glob.glob(f"{folder}/*.parquet"))
        ranges = []
        for f in files:
            t = pq.read_table(f, columns=["ticker", "trade_date"])
            keys = [key(a, b) for a, b in zip(t.column(0).to_pylist(), t.column(1).to_pylist())]
            assert keys == sorted(keys)
            ranges.append((keys[0], keys[-1]))
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))  # in the order of their names
        return len(files)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        refresh_marts(spark, staged_from(spark, rows), db, as_of="2025-06-15", updated_at=UPDATED, ordered=True)
        months = f"{db}_months"
        refresh_marts(spark, staged_from(spark, rows), months, str(tmp_path / "months"), as_of="2025-06-15", updated_at=UPDATED)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    strip = lambda x: x.removeprefix("file:").replace("%3D", "=")
    assert ordered_files(strip(locations(spark, db, FACT)[""])) > 1
    by_month = locations(spark, months, FACT)
    assert len(by_month) == 10 and sum(ordered_files(strip(at)) for at in by_month.values()) > 10


def test_stored_bars_are_cut_to_changed_tickers_before_the_shuffle(spark):
    history = staged_from(spark, series_rows("AAPL", list(range(100, 300))) + series_rows("MSFT", list(range(100, 300))))
    changes = staged_from(spark, [bar("AAPL", dt.date(2025, 6, 1), 5)])
    read = lambda low, high: history.where(F.col("trade_date") >= F.lit(low))
    bars = affected_bars(read, changes, dt.date(2025, 1, 1), lambda df: df)
    assert {r.ticker for r in bars.select("ticker").distinct().collect()} == {"AAPL"}
    assert bars.agg(F.min("trade_date")).first()[0] == dt.date(2025, 1, 1)
