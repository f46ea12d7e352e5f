import hashlib
import os
import zipfile

import pyarrow.parquet as pq
import pytest
from market_helpers import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import DATA_TYPES
from tidemark.sources import landed, scratch, tables
from tidemark.streaming import arrival

TRADES = DATA_TYPES["agg_trades"]


def _trade_lines(n, spot=False, header=True, scale=1000, first=1):
    head = "agg_trade_id,price,quantity,first_trade_id,last_trade_id,transact_time,is_buyer_maker" + ",is_best_match" * spot
    lines = [f"{i},{100 + i},{1.5 + i},{10 * i},{10 * i + 1},{scale * i},{i % 2 == 0}" + f",{i % 2 == 1}" * spot for i in range(first, first + n)]
    return "\n".join([head] * header + lines) + "\n"


def test_trades_csv(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "A-aggTrades-2024-12-01.csv").write_text("\n" + "\n".join(_trade_lines(3).splitlines()[1:]) + "\n\n")
    (tmp_path / "B-aggTrades-2024-12-01.csv").write_text(_trade_lines(2, header=False))
    lines = landed.csv_lines(spark, str(tmp_path), recursive=True)
    got = landed.accepted(landed.parse_trades(landed.without_header(lines, "AGG_TRADE_ID"), F.lit("UsdFutures"), F.lit("ms")))
    assert rows(got.select("name", "agg_trade_id", "transact_time", "is_buyer_maker"))[-1] == ("B-aggTrades-2024-12-01.csv", 2, 2_000_000, True)
    assert got.count() == 5


def test_many_trades_keep_their_order(spark, tmp_path):
    (tmp_path / "A-aggTrades-2024-12-01.csv").write_text(_trade_lines(100_001))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        lines = landed.csv_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 1
        got = landed.accepted(landed.parse_trades(landed.without_header(lines, "agg_trade_id"), F.lit("UsdFutures"), F.lit("ms")))
        assert tuple(got.agg(F.count("*"), F.min("agg_trade_id"), F.max("agg_trade_id"), F.max("transact_time")).first()) == (100_001, 1, 100_001, 100_001_000_000)
        ids = [r.agg_trade_id for r in got.orderBy("place").select("agg_trade_id").collect()]
        assert ids == sorted(ids)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_spot_fields_and_rejects(spark, tmp_path):
    (tmp_path / "x.csv").write_text(_trade_lines(3, spot=True) + "1,2,3\n")
    parsed = landed.parse_trades(landed.without_header(landed.csv_lines(spark, str(tmp_path)), "agg_trade_id"), F.lit("Spot"), F.lit("us"))
    good, bad = landed.quarantined(parsed)
    assert good.agg(F.max("transact_time")).first()[0] == 3000 and [r.reject for r in bad.collect()] == ["fields: 3"]
    with pytest.raises(Exception, match="bad record"):
        landed.accepted(parsed).collect()


def test_depth_csv(spark, tmp_path):
    lines = [f"2025-01-01 00:{i:02d}:00,{(i % 100) / 10},{1000 + i},{5000 + i},extra" for i in range(5)]
    (tmp_path / "d.csv").write_text("Timestamp,percentage,depth,notional\n" + "\n".join(lines))
    got = landed.accepted(landed.parse_depth(landed.without_header(landed.csv_lines(spark, str(tmp_path)), "timestamp")))
    assert tuple(got.agg(F.count("*"), F.min("snapshot_time"), F.max("snapshot_time")).first()) == (5, 1735689600000, 1735689600000 + 240_000)


def test_zip_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "A-aggTrades-2024-12.zip", "w") as z:
        z.writestr("dir/A-aggTrades-2024-12.csv", "a,b\r\n\r\nc,d")
        z.mkdir("empty")
    got = landed.archive_lines(spark, str(tmp_path))
    assert rows(got.select("archive", "name", "place.row", "line")) == [("A-aggTrades-2024-12.zip", "A-aggTrades-2024-12.csv", 0, "a,b"), ("A-aggTrades-2024-12.zip", "A-aggTrades-2024-12.csv", 1, ""), ("A-aggTrades-2024-12.zip", "A-aggTrades-2024-12.csv", 2, "c,d")]
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    with pytest.raises(Exception, match="holds no file"):
        landed.archive_lines(spark, str(tmp_path)).collect()


def test_manifest_and_file_order(spark):
    listing = spark.createDataFrame([("p/b.zip",), ("p/b.zip.CHECKSUM",), ("",), (None,), ("p/a.zip",)], "key string")
    assert [r.name for r in landed.manifest(listing).collect()] == ["a.zip", "b.zip"]
    files = spark.createDataFrame([("s", "odd.zip", "odd.csv"), ("s", "X-t-2024-02.zip", "X-t-2024-02.csv"), ("s", "X-t-2024-01.zip", "X-t-2024-01-02.csv"), ("s", "X-t-2024-01.zip", "X-t-2024-01-01.csv")], "symbol string, archive string, name string")
    assert [r.name for r in landed.with_file_order(files, ["symbol"]).orderBy("file_seq").collect()] == ["X-t-2024-01.zip".replace("01.zip", "01-01.csv"), "X-t-2024-01-02.csv", "X-t-2024-02.csv", "odd.csv"]


def test_checksums(spark, tmp_path):
    for name, side in (("ok.zip", hashlib.sha256(b"ok.zip").hexdigest().upper() + "  ok.zip"), ("bad.zip", "00 bad.zip"), ("empty.zip", " \n"), ("none.zip", None)):
        (tmp_path / name).write_bytes(name.encode())
        if side is not None:
            (tmp_path / f"{name}.CHECKSUM").write_text(side)
    checked = landed.checksums(spark, str(tmp_path))
    assert rows(checked.select("name", "status")) == [("bad.zip", "mismatch"), ("empty.zip", "empty"), ("none.zip", "missing"), ("ok.zip", "valid")]
    with pytest.raises(landed.BadRecord):
        landed.require_valid(checked)
    assert landed.landed_files(spark, str(tmp_path), "*.zip").count() == 4


def test_record_pages(spark, tmp_path):
    (tmp_path / "page-1.json").write_text('{"t": 1}\n{"t": 2}\n')
    (tmp_path / "page-2.json").write_text('{"t": 3}\n')
    got = landed.record_pages(spark, str(tmp_path), StructType.fromDDL("t long"))
    assert [r.t for r in got.orderBy("page_seq", "row_seq").collect()] == [1, 2, 3]


def _stored(spark, rows_):
    return spark.createDataFrame([(i, p, 1.0, i, i, t, True, "Spot", s) for s, i, p, t in rows_], f"{TRADES.columns}, market string, symbol string")


DAY = 86_400_000_000
JAN, FEB = 19_723 * DAY, 19_754 * DAY  # 2024-01-01 and 2024-02-01


def test_stored_table_upsert_and_tail(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(_stored(spark, [("A", 1, 1.0, JAN), ("A", 2, 2.0, FEB), ("B", 1, 1.0, JAN)]), path, TRADES)
    tables.upsert_table(spark, _stored(spark, [("A", 2, 9.0, JAN + 5)]), path, TRADES)  # moves to another month
    got = tables.read(spark, path, TRADES)
    assert rows(got.select("symbol", "agg_trade_id", "price", "month")) == [("A", 1, 1.0, "2024-01"), ("A", 2, 9.0, "2024-01"), ("B", 1, 1.0, "2024-01")]
    with pytest.raises(ValueError):
        tables.upsert_table(spark, _stored(spark, [("A", 5, 9.0, JAN), ("A", 5, 8.0, JAN)]), path, TRADES)
    tables.upsert_table(spark, got.drop("month").limit(0), path, TRADES)
    tables.append(_stored(spark, [("A", 7, 1.0, FEB)]), path, TRADES)
    file = _stored(spark, [("A", 8, 1.0, JAN + 5)]).withColumn("line", F.lit(1))
    tables.replace_tail_table(spark, file, path, TRADES, ["line"])
    assert rows(tables.read(spark, path, TRADES).select("symbol", "agg_trade_id", "month")) == [("A", 1, "2024-01"), ("A", 8, "2024-01"), ("B", 1, "2024-01")]
    assert rows(tables.discover(spark, path)) == [("Spot", "A"), ("Spot", "B")]
    assert tables.drop_symbols(spark, spark.createDataFrame([("Spot", "b")], "market string, symbol string"), path) == 1
    manifest = tables.export_snapshot(spark, path, str(tmp_path / "snap"), TRADES)
    assert all(len(r.sha256) == 64 and r.line.endswith(f" *{r.name}") for r in manifest.collect())
    for r in manifest.collect():
        (file,) = (tmp_path / "snap").rglob(r.name)
        assert r.sha256 == hashlib.sha256(file.read_bytes()).hexdigest().upper() and r.length == file.stat().st_size
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 2
    assert tables.export_snapshot(spark, str(tmp_path / "no"), str(tmp_path / "x"), TRADES) is None and tables.discover(spark, str(tmp_path / "no")) is None


def test_replace_keeps_old_rows_on_failure_and_clears_on_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    good = _stored(spark, [("A", 1, 1.0, JAN)])
    tables.replace(good, path, TRADES)
    with pytest.raises(ValueError):
        tables.replace(good.unionByName(good), path, TRADES)
    assert tables.read(spark, path, TRADES).count() == 1
    tables.replace(good.limit(0), path, TRADES)
    assert tables.read(spark, path, TRADES).count() == 0


def test_catalog_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS legacy")
    _stored(spark, [("x", 1, 1.0, JAN)]).drop("market", "symbol").write.mode("overwrite").saveAsTable("legacy.btcusdt")
    assert tables.table_names(spark, "legacy") == ["btcusdt"] and tables.table_names(spark, "nowhere") == []
    assert tables.copy_table(spark, "legacy.btcusdt", "legacy.copy") and not tables.copy_table(spark, "legacy.none", "legacy.copy")
    path = str(tmp_path / "t")
    assert tables.split_shared(spark, ["legacy.btcusdt", "legacy.none"], "Spot", path, TRADES) == 1
    assert rows(tables.read(spark, path, TRADES).select("market", "symbol", "agg_trade_id")) == [("Spot", "BTCUSDT", 1)]
    assert not tables.table_exists(spark, "legacy.btcusdt")
    tables.drop_table(spark, "legacy.copy")
    tables.drop_table(spark, "legacy.copy")


def test_arriving_files(spark, tmp_path):
    land, table, state = (str(tmp_path / n) for n in ("land", "table", "state"))
    (tmp_path / "land").mkdir()
    ms = 1_700_000_000_000
    (tmp_path / "land" / "BTC-aggTrades-2023-11-14.csv").write_text("".join(f"{i},1.0,1.0,1,1,{ms + i},true\n" for i in range(5)))
    arrival.start_ingestion(spark, land, table, "UsdFutures", state).awaitTermination()
    (tmp_path / "land" / "BTC-aggTrades-2023-11-15.csv").write_text(f"agg_trade_id,a,b,c,d,e,f\n9,2.0,1.0,1,1,{ms + 3},true\n")
    arrival.start_ingestion(spark, land, table, "UsdFutures", state).awaitTermination()
    want = [(0, ms * 1000), (1, ms * 1000 + 1000), (2, ms * 1000 + 2000), (9, ms * 1000 + 3000)]
    assert rows(tables.read(spark, table, TRADES).select("agg_trade_id", "transact_time")) == want
    again = arrival.arriving_lines(spark, land)
    assert again.isStreaming
    static = landed.csv_lines(spark, land).where(F.col("name").contains("-15"))
    arrival.ingest_trades(static, table, "UsdFutures")  # replay
    assert rows(tables.read(spark, table, TRADES).select("agg_trade_id", "transact_time")) == want


def _files(path):
    """The files of the table's version, and when they were written."""
    from pyspark.sql import SparkSession

    names = tables.read(SparkSession.getActiveSession(), str(path), TRADES).inputFiles()
    return {n: os.stat(n.removeprefix("file://")).st_mtime_ns for n in names}


def test_upsert_leaves_other_partitions_alone_and_keeps_the_layout(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "LARGE_GROUP_ROWS", 100)
    path = tmp_path / "t"
    many = [("A", i, 1.0, JAN + (7919 * i) % 997) for i in range(600)]
    tables.replace(_stored(spark, [*many, ("A", 9000, 1.0, FEB), ("B", 1, 1.0, JAN)]), str(path), TRADES)
    before = _files(path)
    tables.upsert_table(spark, _stored(spark, [("A", 5, 7.0, JAN + 3), ("A", 9001, 7.0, JAN + 4)]), str(path), TRADES)
    after = _files(path)
    assert {f for f in before if "2024-02" in f or "symbol=B" in f} <= {f for f, t in after.items() if before.get(f) == t}
    changed = [f for f in after if f not in before]
    assert changed and all("symbol=A/month=2024-01" in f for f in changed)
    for f in changed:
        f = f.removeprefix("file://")
        meta, times = pq.ParquetFile(f).metadata, pq.read_table(f, columns=["transact_time"], partitioning=None).column(0).to_pylist()
        assert all(meta.row_group(k).num_rows <= 100 for k in range(meta.num_row_groups)) and times == sorted(times)
    assert tables.read(spark, str(path), TRADES).count() == 603
    assert not [p for p in tmp_path.iterdir() if p.name != "t"]


def test_a_busy_partition_is_split(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        tables.replace(_stored(spark, [("A", i, float(i * 7919 % 4999), JAN + i) for i in range(5000)]), str(tmp_path / "t"), TRADES)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(_files(tmp_path / "t")) > 1


def test_split_twice_and_odd_symbols(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(_stored(spark, [("A:B%", 1, 1.0, JAN), ("C", 1, 1.0, JAN)]), path, TRADES)
    tables.upsert_table(spark, _stored(spark, [("A:B%", 1, 2.0, FEB)]), path, TRADES)
    assert rows(tables.read(spark, path, TRADES).select("symbol", "price", "month")) == [("A:B%", 2.0, "2024-02"), ("C", 1.0, "2024-01")]
    assert tables.drop_symbols(spark, spark.createDataFrame([("Spot", "a:b%")], "market string, symbol string"), path) == 1
    spark.sql("CREATE DATABASE IF NOT EXISTS legacy")
    for _ in range(2):
        _stored(spark, [("x", 8, 1.0, FEB)]).drop("market", "symbol").write.mode("overwrite").saveAsTable("legacy.c")
        tables.split_shared(spark, ["legacy.c"], "Spot", path, TRADES)
        assert rows(tables.read(spark, path, TRADES).select("symbol", "agg_trade_id", "month")) == [("C", 8, "2024-02")]


def test_scratch_folder(spark, monkeypatch):
    kept = scratch.stored(spark.range(5).toDF("x"), "five")
    path = kept.inputFiles()[0]
    assert "tidemark-" in path and kept.count() == 5
    scratch.release(kept, spark.range(1))
    with pytest.raises(Exception):
        spark.read.parquet(path.rsplit("/", 1)[0])

    def made():
        inner.append(scratch.stored(spark.range(3).toDF("x"), "inner"))
        return inner[0].withColumn("y", F.col("x") * 2)

    inner = []
    alone = scratch.stored_alone(made, "alone")
    assert rows(alone) == [(0, 0), (1, 2), (2, 4)] and not tables.path_exists(spark, inner[0].inputFiles()[0])

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://somewhere"

            class _jsc:
                sc = staticmethod(lambda: Cluster.Held)

    class Held:
        getCheckpointDir = staticmethod(lambda: Held)
        isDefined = staticmethod(lambda: False)

    Cluster.Held = Held
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch._base(Cluster)


def test_partitions_are_written_in_time_order_whatever_is_constant(spark, tmp_path):
    """Rows come in another order than that of their times; names that are constants take no sort away."""
    n = 2000
    shuffled = spark.range(n).select((F.col("id") * 7919 % n).alias("agg_trade_id"), F.lit(1.0).alias("price"), F.lit(1.0).alias("quantity"), F.lit(1).alias("first_trade_id"), F.lit(1).alias("last_trade_id"), F.lit(True).alias("is_buyer_maker"))
    shuffled = shuffled.withColumns({"transact_time": F.lit(1_704_067_200_000_000) + F.col("agg_trade_id"), "market": F.lit("Spot")})
    for name, symbol in (("one", F.lit("A")), ("two", F.when(F.col("agg_trade_id") % 2 == 0, "A").otherwise("B")), ("none", F.lit(None).cast("string"))):
        path = str(tmp_path / name)
        tables.replace(shuffled.withColumn("symbol", symbol), path, TRADES)
        files = list((tmp_path / name).rglob("*.parquet"))
        for f in files:
            times = pq.ParquetFile(f).read(columns=["transact_time"])["transact_time"].to_pylist()
            assert times == sorted(times)
        assert tables.read(spark, path, TRADES).where("market = 'Spot'").count() == n
        assert {r.symbol for r in tables.read(spark, path, TRADES).select("symbol").distinct().collect()} == {"one": {"A"}, "two": {"A", "B"}, "none": {None}}[name]


def test_a_line_is_split_once(spark, tmp_path):
    (tmp_path / "A-aggTrades-2024-12-01.csv").write_text(_trade_lines(3))
    got = landed.accepted(landed.parse_trades(landed.csv_lines(spark, str(tmp_path)), F.lit("UsdFutures"), F.lit("ms")))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
