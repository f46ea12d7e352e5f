"""Stored tables with many writers and readers, crashes, and what a commit knows of its rows."""

import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from market_helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import watermark
from tidemark.schemas import DATA_TYPES
from tidemark.sources import tables, versions

TRADES, FUNDING, KLINE = (DATA_TYPES[n] for n in ("agg_trades", "funding_rate", "kline"))
DAY = 86_400_000_000
JAN, FEB, MAR = 19_723 * DAY, 19_754 * DAY, 19_783 * DAY


def _trades(spark, rows_):
    return spark.createDataFrame([(i, p, 1.0, i, i, t, True, "Spot", s) for s, i, p, t in rows_], f"{TRADES.columns}, market string, symbol string")


def _klines(spark, symbol, first, n, price):
    df = spark.range(first, first + n).select((1000 + 1000 * F.col("id")).alias("open_time"), (1999 + 1000 * F.col("id")).alias("close_time"))
    rest = [F.lit(price).cast(f.dataType).alias(f.name) for f in KLINE.schema if f.name not in ("open_time", "close_time")]
    return df.select("*", *rest, F.lit("UsdFutures").alias("market"), F.lit(symbol).alias("symbol"))


def _fundings(spark, first, n):
    df = spark.range(first, first + n)
    return df.select((1000 * F.col("id")).alias("funding_time"), (F.col("id") / 1000).alias("rate"), (100000.0 + F.col("id")).alias("mark_price"), F.lit("UsdFutures").alias("market"), F.lit("BTCUSDT").alias("symbol"))


def _together(*jobs):
    """Run jobs at once; errors are raised."""
    start = threading.Barrier(len(jobs))

    def run(job):
        start.wait()
        job()

    with ThreadPoolExecutor(len(jobs)) as pool:
        list(pool.map(run, jobs))


def _log(path):
    return sorted(n for n in os.listdir(f"{path}/_log") if not n.startswith("."))


def test_symbols_written_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    _together(*(lambda s=s, i=i: tables.upsert_table(spark, _klines(spark, s, i, 2, 100), path, KLINE) for i, s in enumerate(("BTCUSDT", "ETHUSDT"))))
    assert rows(tables.read(spark, path, KLINE).groupBy("symbol").count()) == [("BTCUSDT", 2), ("ETHUSDT", 2)]


@pytest.mark.parametrize("existing", [False, True])
def test_one_partition_upserted_at_once_keeps_all_rows(spark, tmp_path, existing):
    path = str(tmp_path / "t")
    if existing:
        tables.replace(_klines(spark, "BTCUSDT", 40, 1, 1), path, KLINE)
    _together(*(lambda i=i: tables.upsert_table(spark, _klines(spark, "BTCUSDT", 20 * i, 20, 100 + i), path, KLINE) for i in range(2)))
    got = sorted(r.close_time for r in tables.read(spark, path, KLINE).collect())
    assert got == [1999 + 1000 * i for i in range(41 if existing else 40)]


def test_rounds_of_writers_stay_consistent(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(8):
        _together(*(lambda j=j, s=s: tables.upsert_table(spark, _klines(spark, s, 100 * k + 1000 * j, 12, 100 + k), path, KLINE) for j, s in enumerate(("BTCUSDT", "ETHUSDT", "SOLUSDT"))))
    assert rows(tables.read(spark, path, KLINE).groupBy("symbol").count()) == [("BTCUSDT", 96), ("ETHUSDT", 96), ("SOLUSDT", 96)]
    assert versions.snapshot(spark, path).version == 24


def test_watermark_beside_a_writer_is_always_in_range(spark, tmp_path):
    path, seen, done = str(tmp_path / "t"), [], threading.Event()

    def write():
        for k in range(10):
            tables.upsert_table(spark, _fundings(spark, 10 * k, 10), path, FUNDING)
        done.set()

    def read():
        while not done.is_set():
            seen.append(watermark.watermarks(tables.read(spark, path, FUNDING), ["symbol"], "funding_time").first())
            time.sleep(0.005)

    _together(write, read)
    last = watermark.watermarks(tables.read(spark, path, FUNDING), ["symbol"], "funding_time").first()
    marks = [r.watermark for r in seen if r]
    assert last.watermark == 99_000 and marks == sorted(marks) and all(m % 10_000 == 9_000 for m in marks)


def test_readers_beside_slow_writers(spark, tmp_path, monkeypatch):
    """A snapshot is whole whatever a writer does between its steps, and whatever it takes for each."""
    path = str(tmp_path / "t")
    tables.replace(_trades(spark, [("A", i, 1.0, JAN + i) for i in range(300)] + [("B", 1, 1.0, JAN)]), path, TRADES)
    put, write = versions.put_if_absent, tables._write
    monkeypatch.setattr(versions, "put_if_absent", lambda *a: (time.sleep(0.3), put(*a))[1])
    monkeypatch.setattr(tables, "_write", lambda *a: (time.sleep(0.3), write(*a), time.sleep(0.3))[1])
    held, counts, done = tables.read(spark, path, TRADES), [], threading.Event()

    def change():
        tables.replace(_trades(spark, [("A", i, 2.0, FEB + i) for i in range(500)]), path, TRADES)
        tables.upsert_table(spark, _trades(spark, [("A", i, 3.0, JAN + i) for i in range(100)]), path, TRADES)
        done.set()

    def read():
        while not done.is_set():
            counts.append(tuple(tables.read(spark, path, TRADES).agg(F.count("*"), F.countDistinct("agg_trade_id")).first()))

    _together(change, read)
    assert set(counts) <= {(301, 300), (500, 500)}
    assert held.count() == 301 and tables.read(spark, path, TRADES).count() == 500
    assert rows(tables.read(spark, path, TRADES).groupBy("price").count()) == [(2.0, 400), (3.0, 100)]


def test_a_key_that_two_writers_put_into_two_months_comes_once(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(_trades(spark, [("A", 0, 1.0, JAN)]), path, TRADES)
    _together(*(lambda t=t: tables.upsert_table(spark, _trades(spark, [("A", 7, 1.0, t)]), path, TRADES) for t in (JAN, FEB, MAR)))
    assert [r.agg_trade_id for r in tables.read(spark, path, TRADES).orderBy("agg_trade_id").collect()] == [0, 7]


def test_appends_tails_and_replacement_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(_trades(spark, [("A", 0, 1.0, JAN), ("B", 0, 1.0, JAN)]), path, TRADES)
    file = _trades(spark, [("B", 5, 1.0, JAN)]).withColumn("line", F.lit(1))
    _together(
        *(lambda i=i: tables.append(_trades(spark, [("A", 10 + i, 1.0, FEB)]), path, TRADES) for i in range(3)),
        lambda: tables.replace_tail_table(spark, file, path, TRADES, ["line"]),
    )
    assert rows(tables.read(spark, path, TRADES).select("symbol", "agg_trade_id")) == [("A", 0), ("A", 10), ("A", 11), ("A", 12), ("B", 5)]


def test_conflicts_end_in_an_error_and_leave_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.replace(_trades(spark, [("A", 0, 1.0, JAN)]), path, TRADES)
    monkeypatch.setattr(versions, "RETRIES", 2)
    write = tables._write

    def overtaken(df, *a):
        monkeypatch.setattr(tables, "_write", write)
        tables.upsert_table(spark, _trades(spark, [("A", 1, 1.0, JAN)]), path, TRADES)
        monkeypatch.setattr(tables, "_write", overtaken)
        return write(df, *a)

    monkeypatch.setattr(tables, "_write", overtaken)
    folders = len(os.listdir(path))
    with pytest.raises(versions.Conflict):
        tables.upsert_table(spark, _trades(spark, [("A", 2, 1.0, JAN)]), path, TRADES)
    assert len(os.listdir(path)) == folders + 2  # what the overtaking writers wrote
    assert rows(tables.read(spark, path, TRADES).select("agg_trade_id")) == [(0,), (1,)]


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.replace(_trades(spark, [("A", 1, 1.0, JAN)]), path, TRADES)

    def crash(*_):
        raise OSError("crash")

    with monkeypatch.context() as m:
        m.setattr(versions, "put_if_absent", crash)
        for job in (lambda: tables.replace(_trades(spark, [("A", 2, 1.0, JAN)]), path, TRADES), lambda: tables.upsert_table(spark, _trades(spark, [("A", 2, 1.0, JAN)]), path, TRADES)):
            with pytest.raises(OSError):
                job()
    assert rows(tables.read(spark, path, TRADES).select("agg_trade_id")) == [(1,)]
    # a writer that died without clearing up
    tables._write(_trades(spark, [("A", 9, 1.0, JAN)]), path, TRADES)
    assert tables.read(spark, path, TRADES).count() == 1
    assert tables.vacuum(spark, path, orphan_hours=1) == 0 and tables.vacuum(spark, path, orphan_hours=-1) == 1
    assert tables.read(spark, path, TRADES).count() == 1


def test_put_if_absent_lets_one_of_many_through(spark, tmp_path):
    won = []
    (tmp_path / "x").mkdir()
    _together(*(lambda i=i: versions.put_if_absent(spark, f"{tmp_path}/x/1", str(i)) and won.append(str(i)) for i in range(8)))
    assert len(won) == 1 and (tmp_path / "x" / "1").read_text() == won[0] and os.listdir(tmp_path / "x") == ["1"]


def test_rows_of_other_partitions_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="not rewritten"):
        tables.rewrite(_trades(spark, [("A", 1, 1.0, JAN)]), [("Spot", "A", "2024-02")], [], path, TRADES)
    assert os.listdir(path) == []


def test_incoming_rows_are_evaluated_once(spark, tmp_path):
    path = str(tmp_path / "t")
    unstable = _trades(spark, [("A", i, 1.0, JAN) for i in range(50)]).withColumn("agg_trade_id", F.col("agg_trade_id") * 1000 + F.floor(F.rand() * 1000).cast("long"))
    tables.replace(_trades(spark, [("A", i, 1.0, FEB) for i in range(50_000)]), path, TRADES)
    tables.upsert_table(spark, unstable, path, TRADES)
    got = tables.read(spark, path, TRADES)
    assert got.count() == got.select("agg_trade_id").distinct().count() and got.where("month = '2024-01'").count() == 50


def test_versions_states_and_vacuum(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "STATE_EVERY", 3)
    path = str(tmp_path / "t")
    for k in range(7):
        tables.upsert_table(spark, _trades(spark, [("A", k, 1.0, JAN), ("A", 100 + k, 1.0, FEB)] if k < 6 else [("A", 0, 9.0, JAN)]), path, TRADES)
    assert [n for n in _log(path) if n.endswith("state")] == [f"{v:020d}.state" for v in (3, 6)]
    for v in range(1, 8):
        assert tables.read(spark, path, TRADES, v).count() == min(2 * v, 12)
    with pytest.raises(ValueError):
        tables.read(spark, path, TRADES, 8)
    older = tables.read(spark, path, TRADES, 6)
    assert tables.vacuum(spark, path, keep=2) > 0
    assert older.count() == 12 and tables.read(spark, path, TRADES).count() == 12
    with pytest.raises(ValueError):
        tables.read(spark, path, TRADES, 5)
    tables.upsert_table(spark, _trades(spark, [("A", 1, 5.0, MAR)]), path, TRADES)
    assert tables.vacuum(spark, path) > 0 and tables.vacuum(spark, path) == 0
    live = {f.split("v=")[1].split("/")[0] for f in tables.read(spark, path, TRADES).inputFiles()}
    assert {n[2:] for n in os.listdir(path) if n.startswith("v=")} == live
    assert tables.read(spark, path, TRADES).count() == 12 and tables.vacuum(spark, str(tmp_path / "none")) == 0


def test_statistics_come_without_reading_data(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(_trades(spark, [("A", i, 1.0, JAN + i) for i in range(10)] + [("A", 50, 1.0, FEB), ("b", 3, 1.0, MAR)]), path, TRADES)
    tables.append(_trades(spark, [("A", 60, 1.0, FEB + 5)]), path, TRADES)
    stats = tables.partition_stats(spark, path)
    want = [("Spot", "A", "2024-01", 10, JAN, JAN + 9, 0, 9), ("Spot", "A", "2024-02", 1, FEB, FEB, 50, 50), ("Spot", "A", "2024-02", 1, FEB + 5, FEB + 5, 60, 60), ("Spot", "b", "2024-03", 1, MAR, MAR, 3, 3)]
    assert rows(stats) == want
    marks = tables.stored_watermarks(spark, path)
    assert rows(marks) == [("Spot", "A", FEB + 5, 12), ("Spot", "b", MAR, 1)]
    assert "Scan parquet" not in marks._jdf.queryExecution().executedPlan().toString()
    assert rows(marks.select("symbol", "watermark")) == rows(watermark.watermarks(tables.read(spark, path, TRADES), ["symbol"], "transact_time"))


def test_an_upsert_by_key_reads_only_what_may_hold_it(spark, tmp_path, monkeypatch):
    path, months = str(tmp_path / "t"), [JAN, FEB, MAR, MAR + 31 * DAY]
    tables.replace(_trades(spark, [("A", 1000 * k + i, 1.0, t + i) for k, t in enumerate(months) for i in range(1000)]), path, TRADES)
    seen, frame = [], tables._frame

    def watched(*a):
        df = frame(*a)
        seen.append({f.split("month=")[1][:7] for f in df.inputFiles()})
        return df

    monkeypatch.setattr(tables, "_frame", watched)
    tables.upsert_table(spark, _trades(spark, [("A", 1000 + i, 2.0, FEB + i) for i in range(100)]), path, TRADES)
    assert seen and all(s == {"2024-02"} for s in seen)
    seen.clear()
    tables.upsert_table(spark, _trades(spark, [("A", 3500, 2.0, JAN)]), path, TRADES)  # moves from April to January
    assert set().union(*seen) == {"2024-01", "2024-04"}
    monkeypatch.setattr(tables, "_frame", frame)
    assert rows(tables.read(spark, path, TRADES).groupBy("month").count()) == [("2024-01", 1001), ("2024-02", 1000), ("2024-03", 1000), ("2024-04", 999)]
