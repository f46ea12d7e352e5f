"""Archives as streams, failures in isolation, compaction, and steps that fail midway."""

import hashlib
import io
import os
import tracemalloc
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pyarrow.fs
import pytest
from market_helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.schemas import DATA_TYPES
from tidemark.sources import landed, tables, versions

TRADES = DATA_TYPES["agg_trades"]
DAY = 86_400_000_000
JAN, FEB = 19_723 * DAY, 19_754 * DAY


def _trades(spark, rows_):
    return spark.createDataFrame([(i, p, 1.0, i, i, t, True, "Spot", s) for s, i, p, t in rows_], f"{TRADES.columns}, market string, symbol string")


def test_a_large_entry_is_read_as_a_stream(tmp_path):
    path, line = tmp_path / "big.zip", "1234567,1.5,2.5,1,2,1700000000000,true\n"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("x/big.csv", "w") as f:
        for _ in range(200):
            f.write((line * 25_000).encode())  # 200 MB in all
    tracemalloc.start()
    n = sum(b.num_rows for b in landed.entry_lines(landed.open_file(str(path)), "big.zip", "x/big.csv"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 5_000_000 and peak < 40e6


def test_archives_in_other_stores(tmp_path):
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("a.csv", "x\ny")
    store = pyarrow.fs.LocalFileSystem()
    for name, want in (("none.zip", []), ("one.zip", ["a.csv"])):
        with io.BufferedReader(landed._Remote(store.open_input_file(str(tmp_path / name)))) as f, zipfile.ZipFile(f) as z:
            assert z.namelist() == want and [z.read(n) for n in want] == [b"x\ny"] * len(want)


def test_entries_are_dealt_over_tasks_and_digests_streamed(spark, tmp_path):
    for a in range(3):
        with zipfile.ZipFile(tmp_path / f"a {a}%.zip", "w") as z:
            for e in range(4):
                z.writestr(f"d/e{e}.csv", "".join(f"{a},{e},{i}\r\n" for i in range(1000)))
    got = landed.archive_lines(spark, str(tmp_path))
    assert got.count() == 12_000 and got.select(F.spark_partition_id()).distinct().count() > 1
    want = [(f"a {a}%.zip", f"e{e}.csv", i, f"{a},{e},{i}") for a in range(3) for e in range(4) for i in range(1000)]
    assert sorted(tuple(r) for r in got.select("archive", "name", "place.row", "line").collect()) == sorted(want)
    assert rows(landed.archive_entries(spark, str(tmp_path)).groupBy("size").count())[0][1] == 12
    digests = {r.name: r.sha256 for r in landed.file_digests(spark, str(tmp_path)).collect()}
    assert digests == {f"a {a}%.zip": hashlib.sha256((tmp_path / f"a {a}%.zip").read_bytes()).hexdigest() for a in range(3)}


def _report(spark, path, **kw):
    return {r.symbol: r for r in tables.integrity_report(spark, path, TRADES, F.col("price") < 0, **kw).collect()}


def test_unreadable_files_fail_their_symbol_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    many = [(s, i, float(i % 7), JAN + i * DAY // 50) for s in "ABCD" for i in range(3000)]
    tables.replace(_trades(spark, many), path, TRADES)
    assert not any(r.failed for r in _report(spark, path).values())
    files = {s: next(f.removeprefix("file://") for f in tables.read(spark, path, TRADES).inputFiles() if f"symbol={s}/" in f) for s in "ABC"}
    size = os.path.getsize(files["A"])
    os.truncate(files["A"], size - 100)  # no footer
    with open(files["B"], "r+b") as f:  # pages overwritten, footer whole
        f.seek(size // 10)
        f.write(os.urandom(size * 6 // 10))
    os.remove(files["C"])
    for f in files.values():
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    with pytest.raises(Exception):
        tables.read(spark, path, TRADES).agg(F.sum("price")).collect()
    got = _report(spark, path)
    assert {s for s, r in got.items() if r.failed} == set("ABC") and got["D"].n_rows == 3000 and not got["D"].has_issue
    assert quality.summary(tables.integrity_report(spark, path, TRADES, F.col("price") < 0)).first().n_failed == 3


def test_incremental_reports_read_new_parts_only(spark, tmp_path, monkeypatch):
    path, seen, frame = str(tmp_path / "t"), [], tables._frame
    tables.replace(_trades(spark, [(s, i, float(i % 5), JAN + i * DAY) for s in "AB" for i in range(50)]), path, TRADES)

    def watched(*a, **kw):
        df = frame(*a, **kw)
        if kw.get("data"):
            seen.append(sorted({f.split("symbol=")[1].split("/part")[0] for f in df.inputFiles()}))
        return df

    monkeypatch.setattr(tables, "_frame", watched)

    def both(**kw):
        args = (spark, path, TRADES, F.col("price") < 1)
        full, part = tables.integrity_report(*args, **kw), tables.incremental_report(*args, "r", **kw)
        assert rows(part) == rows(full.select(*part.columns))
        return part

    both()
    both()
    tables.upsert_table(spark, _trades(spark, [("A", 3, 0.0, JAN + 5), ("A", 900, 7.0, JAN + 9 * DAY)]), path, TRADES)
    both()
    tables.append(_trades(spark, [("B", 99, 0.0, FEB + 90 * DAY)]), path, TRADES)
    tables.drop_symbols(spark, spark.createDataFrame([("Spot", "a")], "market string, symbol string"), path)
    both()
    every = [f"{s}/month=2024-0{m}" for s in "AB" for m in (1, 2)]
    assert seen == [every, [], ["A/month=2024-01"], ["B/month=2024-05"]]
    file = next(f.removeprefix("file://") for f in tables.read(spark, path, TRADES).inputFiles() if "2024-05" in f)
    tables.append(_trades(spark, [("C", 1, 0.0, FEB)]), path, TRADES)
    broken = next(f.removeprefix("file://") for f in tables.read(spark, path, TRADES).inputFiles() if "symbol=C" in f)
    content = open(broken, "rb").read()
    os.remove(os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc"))
    os.truncate(broken, 10)
    assert [r.failed for r in both().orderBy("symbol").collect()] == [False, True] and os.path.exists(file)
    open(broken, "wb").write(content)  # mended: looked at again
    assert not any(r.failed for r in both().collect()) and seen[-2:] == [["C/month=2024-02"]] * 2


def test_reports_name_what_the_universe_lacks(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(_trades(spark, [("A", 1, 1.0, JAN)]), path, TRADES)
    universe = spark.createDataFrame([("Spot", "A"), ("Spot", "Z")], "market string, symbol string")
    got = _report(spark, path, universe=universe)
    assert got["Z"].is_empty and got["Z"].has_issue and not got["Z"].failed and not got["A"].is_empty
    assert _report(spark, str(tmp_path / "none")) == {}


def test_compaction_leaves_one_ordered_part(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        tables.append(_trades(spark, [("A", 10 * i + k, 1.0, JAN + 10 * i + k) for i in range(50)] + [("B", k, 1.0, FEB + k)] * (k < 2)), path, TRADES)
    tables.append(_trades(spark, [("C", 1, 1.0, JAN)]), path, TRADES)
    before = rows(tables.read(spark, path, TRADES))
    assert tables.compact_table(spark, path, TRADES, rows_at_once=1) == 2  # A and B, in commits of their own
    assert tables.compact_table(spark, path, TRADES) == 0 and rows(tables.read(spark, path, TRADES)) == before
    assert tables.partition_stats(spark, path).count() == 3
    times = tables.read(spark, path, TRADES).where("symbol = 'A'").select("transact_time", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    each = [r.transact_time for r in times.orderBy("f", "r").collect()]
    assert each == sorted(each)


def test_compaction_beside_writers_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        tables.append(_trades(spark, [("A", k, 1.0, JAN + k)]), path, TRADES)
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(tables.compact_table, spark, path, TRADES), pool.submit(tables.upsert_table, spark, _trades(spark, [("A", 1, 9.0, JAN)]), path, TRADES), pool.submit(tables.append, _trades(spark, [("A", 7, 1.0, JAN)]), path, TRADES)]
        [j.result() for j in jobs]
    assert rows(tables.read(spark, path, TRADES).select("agg_trade_id", "price")) == [(0, 1.0), (1, 9.0), (2, 1.0), (7, 1.0)]


def test_a_failed_copy_leaves_the_old_target(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS copies")
    spark.range(3).write.mode("overwrite").saveAsTable("copies.target")
    spark.sql("CREATE OR REPLACE VIEW copies.broken AS SELECT raise_error('no') AS id")
    with pytest.raises(Exception):
        tables.copy_table(spark, "copies.broken", "copies.target")
    assert spark.table("copies.target").count() == 3 and tables.table_names(spark, "copies") == ["broken", "target"]
    spark.range(5).write.mode("overwrite").saveAsTable("copies.source")
    assert tables.copy_table(spark, "copies.source", "copies.target") and spark.table("copies.target").count() == 5
    spark.sql("DROP DATABASE copies CASCADE")


def test_legacy_tables_are_taken_over_in_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SPLIT_TABLES", 2)
    spark.sql("CREATE DATABASE IF NOT EXISTS old")
    for k in range(5):
        _trades(spark, [("x", k, 1.0, JAN)]).drop("market", "symbol").write.mode("overwrite").saveAsTable(f"old.s{k}")
    path = str(tmp_path / "t")
    assert tables.split_shared(spark, [f"old.s{k}" for k in range(5)], "Spot", path, TRADES) == 5
    assert versions.snapshot(spark, path).version == 3 and tables.table_names(spark, "old") == []
    assert rows(tables.read(spark, path, TRADES).select("symbol", "agg_trade_id")) == [(f"S{k}", k) for k in range(5)]
    spark.sql("DROP DATABASE old CASCADE")
