"""Registered queries over landed files and stored tables: each writes the given tables to the scratch folder
in the form that the operator reads (CSV, JSON, partitioned Parquet, catalog tables) and reads its result."""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile
from collections.abc import Sequence

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scalars as S
from ..operators import merge, projections, quality, universe, watermark
from ..schemas import DATA_TYPES
from ..sources import landed, tables, versions
from ..sources.scratch import scratch_path, stored
from ..streaming import arrival
from .catalog import DAY_US, _ntz, _table, _trades, query

TRADES = DATA_TYPES["agg_trades"]


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return _trades(spark, d).withColumn("market", F.lit("Spot"))


def _written(spark: SparkSession, d: str, where: str = "true") -> str:
    path = scratch_path(spark, "trades")
    tables.replace(_rows(spark, d).where(where), path, TRADES)
    return path


def _id(k: int) -> Column:
    return F.col("agg_trade_id") % k


# --- stored tables ---

_MONTH = "strftime(make_timestamp(t::BIGINT), '%Y-%m') AS month"


@query(f"""
WITH x AS (SELECT event_type AS symbol, event_id AS agg_trade_id, CASE WHEN event_id % 3 = 0 THEN value * 2 ELSE value END AS price, epoch_us(ts) + CASE WHEN event_id % 3 = 0 THEN 10 * {DAY_US} ELSE 0 END AS t FROM events
  UNION ALL SELECT event_type, -1 - event_id, value, epoch_us(ts) FROM events WHERE event_id % 11 = 0)
SELECT symbol, agg_trade_id, price, t::BIGINT AS transact_time, {_MONTH} FROM x""")
def stored_upsert(spark: SparkSession, d: str) -> DataFrame:
    path = _written(spark, d)
    changed = _rows(spark, d).where(_id(3) == 0).withColumns({"price": F.col("price") * 2, "transact_time": F.col("transact_time") + 10 * DAY_US})
    added = _rows(spark, d).where(_id(11) == 0).withColumn("agg_trade_id", -1 - F.col("agg_trade_id"))
    tables.upsert_table(spark, changed.unionByName(added), path, TRADES)
    return tables.read(spark, path, TRADES).select("symbol", "agg_trade_id", "price", "transact_time", "month")


@query(f"""
WITH i AS (SELECT event_type AS symbol, event_id AS id, value * 3 AS price, epoch_us(ts) AS t FROM events WHERE event_id % 7 = 0 AND ts >= TIMESTAMP '2024-01-20' AND event_type <> 'click'),
m AS (SELECT symbol, min(t) AS f FROM i GROUP BY 1), o AS (SELECT event_type AS symbol, event_id AS id, value AS price, epoch_us(ts) AS t FROM events)
SELECT symbol, id AS agg_trade_id, price, t::BIGINT AS transact_time FROM i
UNION ALL SELECT symbol, id, price, t::BIGINT FROM o LEFT JOIN m USING (symbol) WHERE (f IS NULL OR t < f) AND NOT EXISTS (SELECT 1 FROM i WHERE i.symbol = o.symbol AND i.id = o.id)""")
def stored_tail(spark: SparkSession, d: str) -> DataFrame:
    path = _written(spark, d)
    late = _rows(spark, d).where((_id(7) == 0) & (F.col("symbol") != "click") & (F.col("transact_time") >= S.micros(_ntz("2024-01-20"))))
    tables.replace_tail_table(spark, late.withColumns({"price": F.col("price") * 3, "line": F.col("agg_trade_id")}), path, TRADES, ["line"])
    return tables.read(spark, path, TRADES).select("symbol", "agg_trade_id", "price", "transact_time")


@query("SELECT event_type AS symbol, count(*)::BIGINT AS n, sum(event_id)::BIGINT AS ids FROM events WHERE event_id % 2 = 0 GROUP BY 1")
def stored_replace(spark: SparkSession, d: str) -> DataFrame:
    path = _written(spark, d)
    tables.replace(_rows(spark, d).where(_id(2) == 0), path, TRADES)
    return tables.read(spark, path, TRADES).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("agg_trade_id").alias("ids"))


@query("SELECT event_type AS symbol, event_id AS agg_trade_id, value AS price FROM events UNION ALL SELECT event_type, event_id, value FROM events WHERE event_id % 5 = 0")
def stored_append(spark: SparkSession, d: str) -> DataFrame:
    path = _written(spark, d)
    tables.append(_rows(spark, d).where(_id(5) == 0), path, TRADES)
    return tables.read(spark, path, TRADES).select("symbol", "agg_trade_id", "price")


@query("SELECT event_type AS symbol, strftime(ts, '%Y-%m') AS month, count(*)::BIGINT AS n, 0::BIGINT AS n_out_of_order FROM events GROUP BY 1, 2")
def stored_order(spark: SparkSession, d: str) -> DataFrame:
    files = tables.read(spark, _written(spark, d), TRADES).select("symbol", "month", "transact_time", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    before = F.lag("transact_time").over(quality.Window.partitionBy("file").orderBy("row"))
    return files.withColumn("before", before).groupBy("symbol", "month").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") > F.col("transact_time")).alias("n_out_of_order"))


@query("SELECT DISTINCT 'market=Spot/symbol=' || event_type || '/month=' || strftime(ts, '%Y-%m') AS place FROM events")
def partition_paths(spark: SparkSession, d: str) -> DataFrame:
    files = tables.read(spark, _written(spark, d), TRADES).select(F.col("_metadata.file_path").alias("file"))
    return files.select(F.regexp_extract("file", "(market=[^/]*/symbol=[^/]*/month=[^/]*)/", 1).alias("place")).distinct()


@query("SELECT event_type AS symbol, count(*)::BIGINT AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1")
def dropped_symbols(spark: SparkSession, d: str) -> DataFrame:
    path = _written(spark, d)
    gone = _rows(spark, d).where("symbol IN ('click', 'view')").select("market", F.upper("symbol").alias("symbol"))
    tables.drop_symbols(spark, gone, path)
    left = tables.discover(spark, path)
    return left.select("symbol").join(tables.read(spark, path, TRADES), "symbol").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type AS symbol, count(*)::BIGINT AS n, true AS hashed FROM events GROUP BY 1")
def snapshot(spark: SparkSession, d: str) -> DataFrame:
    target = scratch_path(spark, "snapshot")
    manifest = tables.export_snapshot(spark, _written(spark, d), target, TRADES)
    hashed = manifest.agg(F.every(F.col("line").rlike(r"^[0-9A-F]{64} \*\S+\.parquet$") & (F.col("length") > 0)).alias("hashed"))
    return spark.read.parquet(target).groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(hashed))


def _database(spark: SparkSession) -> str:
    name = f"tidemark_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    return name


def _dropped(spark: SparkSession, db: str, result: DataFrame, name: str) -> DataFrame:
    """The result, written down, once nothing is left of its database."""
    held = stored(result, name)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return held


@query("SELECT 'copy' AS table_name, event_type AS symbol, count(*)::BIGINT AS n FROM events GROUP BY 2")
def copied_table(spark: SparkSession, d: str) -> DataFrame:
    db = _database(spark)
    _trades(spark, d).write.saveAsTable(f"{db}.trades")
    for _ in range(2):  # the second copy replaces the first
        tables.copy_table(spark, f"{db}.trades", f"{db}.copy")
    tables.copy_table(spark, f"{db}.none", f"{db}.nothing")
    tables.drop_table(spark, f"{db}.trades")
    tables.drop_table(spark, f"{db}.trades")
    (name,) = [n for n in tables.table_names(spark, db) if tables.table_exists(spark, f"{db}.{n}")]
    return _dropped(spark, db, spark.table(f"{db}.{name}").groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "symbol", "n"), "copied")


@query("SELECT 'Spot' AS market, upper(event_type) AS symbol, event_id AS agg_trade_id, value AS price FROM events")
def split_legacy(spark: SparkSession, d: str) -> DataFrame:
    db, path = _database(spark), scratch_path(spark, "trades")
    for r in _trades(spark, d).select("symbol").distinct().collect():  # one legacy table a symbol, as the old layout had it
        _trades(spark, d).where(F.col("symbol") == r.symbol).drop("symbol").write.saveAsTable(f"{db}.{r.symbol}")
    tables.split_shared(spark, [f"{db}.{n}" for n in (*tables.table_names(spark, db), "none")], "Spot", path, TRADES)
    return _dropped(spark, db, tables.read(spark, path, TRADES).select("market", "symbol", "agg_trade_id", "price"), "split")


@query("SELECT event_type AS symbol, CASE WHEN event_type <> 'click' THEN count(*) END::BIGINT AS n_rows, event_type = 'click' AS failed, count(*) FILTER (value < 5 AND event_type <> 'click')::BIGINT AS n_invalid, 1::BIGINT AS n_failed FROM events GROUP BY 1")
def failed_tables(spark: SparkSession, d: str) -> DataFrame:
    """A file of one symbol is cut short; the report goes on with the others."""
    path = _written(spark, d)
    broken = sorted(tables.read(spark, path, TRADES).where("symbol = 'click'").select(F.col("_metadata.file_path").alias("f")).distinct().collect())[0].f
    fs, file = versions.fs(spark, broken)
    fs.create(file, True).close()
    report = tables.integrity_report(spark, path, TRADES, F.col("price") < 5)
    total = quality.summary(report).select("n_failed")
    return report.select("symbol", F.when(~F.col("failed"), F.col("n_rows")).alias("n_rows"), "failed", "n_invalid").join(F.broadcast(total))


@query(f"""
WITH x AS (SELECT event_type AS symbol, CASE WHEN event_id % 9 = 0 THEN 0 ELSE value END AS price, event_id % 9 = 0 AS moved, ts FROM events),
y AS (SELECT symbol, price, epoch_us(ts) + CASE WHEN moved THEN 40 * {DAY_US} ELSE 0 END AS t FROM x), z AS (SELECT symbol, t // {DAY_US} AS day FROM y GROUP BY ALL)
SELECT symbol, count(*)::BIGINT AS n_rows, count(*) FILTER (price < 5)::BIGINT AS n_invalid, (SELECT max(day) - min(day) + 1 - count(*) FROM z WHERE z.symbol = y.symbol)::BIGINT AS n_missing FROM y GROUP BY 1""")
def incremental_report(spark: SparkSession, d: str) -> DataFrame:
    """The report again after an upsert: only the partitions that it has written are scanned."""
    path = _written(spark, d)
    tables.incremental_report(spark, path, TRADES, F.col("price") < 5, "daily")
    tables.upsert_table(spark, _rows(spark, d).where(_id(9) == 0).withColumns({"price": F.lit(0.0), "transact_time": F.col("transact_time") + 40 * DAY_US}), path, TRADES)
    return tables.incremental_report(spark, path, TRADES, F.col("price") < 5, "daily").select("symbol", "n_rows", "n_invalid", "n_missing")


@query("SELECT event_type AS symbol, strftime(ts, '%Y-%m') AS month, (count(*) + count(*) FILTER (event_id % 2 = 0) + count(*) FILTER (event_id % 3 = 0))::BIGINT AS n_rows, 1::BIGINT AS n_parts FROM events GROUP BY 1, 2")
def compacted(spark: SparkSession, d: str) -> DataFrame:
    """Appends leave parts that overlap; afterwards each partition is one part."""
    path = _written(spark, d)
    for k in (2, 3):
        tables.append(_rows(spark, d).where(_id(k) == 0), path, TRADES)
    tables.compact_table(spark, path, TRADES)
    tables.vacuum(spark, path)
    counted = tables.read(spark, path, TRADES).groupBy("symbol", "month").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(tables.partition_stats(spark, path).groupBy("symbol", "month").agg(F.count(F.lit(1)).alias("n_parts")), ["symbol", "month"])


@query("SELECT event_type AS symbol, epoch_us(max(ts))::BIGINT AS watermark, count(*)::BIGINT AS n_rows FROM events GROUP BY 1")
def stored_watermarks(spark: SparkSession, d: str) -> DataFrame:
    """From the table's log, without a scan of its data."""
    return tables.stored_watermarks(spark, _written(spark, d)).select("symbol", "watermark", "n_rows")


@query("SELECT event_type AS symbol, count(*)::BIGINT AS n, max(value) AS price FROM events GROUP BY 1")
def sql_over_views(spark: SparkSession, d: str) -> DataFrame:
    return tables.sql_over(spark, {"data": _trades(spark, d)}, "SELECT symbol, count(*) AS n, max(price) AS price FROM data GROUP BY symbol")


# --- landed files ---

_CSV = ["agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id", "transact_time", "is_buyer_maker"]


def _landed_trades(spark: SparkSession, d: str, more: dict[str, Column], parts: list[str]) -> str:
    path = scratch_path(spark, "csv")
    rows = _trades(spark, d).withColumn("transact_time", S.millis(S.from_micros(F.col("transact_time")))).withColumns(more)
    rows.select(*parts, *_CSV, *more).write.partitionBy(*parts).option("header", "true").csv(path) if parts else rows.repartitionByRange(4, "transact_time").select(*_CSV, *more).write.option("header", "true").csv(path)
    return path


@query("SELECT event_id AS agg_trade_id, value AS price, event_id + event_id % 3 AS last_trade_id, epoch_us(ts) // 1000 * 1000 AS transact_time, event_id % 2 = 0 AS is_buyer_maker FROM events")
def landed_trades(spark: SparkSession, d: str) -> DataFrame:
    path = _landed_trades(spark, d, {"is_best_match": _id(5) == 0}, ["symbol"])
    lines = landed.without_header(landed.csv_lines(spark, path, recursive=True), "agg_trade_id")
    return landed.accepted(landed.parse_trades(lines, F.lit("Spot"), F.lit("ms"))).select("agg_trade_id", "price", "last_trade_id", "transact_time", "is_buyer_maker")


@query("SELECT epoch_ms(date_trunc('second', ts)) AS snapshot_time, ((event_id % 500 - 250) / 100)::DECIMAL(10, 2) AS percentage, event_id::DOUBLE AS depth, value AS notional FROM events")
def landed_depth(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    cents = ((F.col("event_id") % 500 - 250).cast("decimal(12,0)") / F.lit(100)).cast("decimal(10,2)").cast("string")
    rows = _table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Timestamp"), cents.alias("percentage"), F.col("event_id").alias("depth"), F.col("value").alias("notional"), F.lit("x").alias("extra"))
    rows.write.option("header", "true").csv(path)
    lines = landed.without_header(landed.csv_lines(spark, path), "timestamp")
    return landed.accepted(landed.parse_depth(lines)).select("snapshot_time", "percentage", "depth", "notional")


def _zipped(rows: DataFrame, path: str, groups: Sequence[str]) -> None:
    """One archive a group, with a CSV file in a folder of its own and a checksum beside the archive."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        name, out = "-".join(map(str, key)), io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.mkdir("deep")
            z.writestr(f"deep/{name}.csv", frame.sort_values("agg_trade_id")[_CSV].to_csv(index=False))
        store = pyarrow.fs.LocalFileSystem()
        store.create_dir(path)
        for file, content in ((f"{name}.zip", out.getvalue()), (f"{name}.zip.CHECKSUM", f"{hashlib.sha256(out.getvalue()).hexdigest()}  {name}.zip".encode())):
            with store.open_output_stream(f"{path}/{file}") as f:
                f.write(content)
        return frame[:0][["agg_trade_id"]]

    rows.groupBy(*groups).applyInPandas(run, "agg_trade_id long").write.format("noop").mode("overwrite").save()


@query("""
SELECT event_type || '-aggTrades-' || strftime(ts, '%Y-%m-%d') || '.zip' AS archive, 'valid' AS status, event_id AS agg_trade_id, value AS price, epoch_us(ts) // 1000 * 1000 AS transact_time,
  row_number() OVER (PARTITION BY event_type, ts::DATE ORDER BY event_id)::BIGINT AS row FROM events""")
def landed_zip(spark: SparkSession, d: str) -> DataFrame:
    """Archives of each symbol and day, whose checksums hold, and the order of their lines after a header."""
    path = scratch_path(spark, "zips").removeprefix("file:")
    days = F.date_format(S.from_micros(F.col("transact_time")), "yyyy-MM-dd")
    rows = _trades(spark, d).withColumns({"kind": F.lit("aggTrades"), "day": days, "transact_time": S.millis(S.from_micros(F.col("transact_time")))})
    _zipped(rows.select("symbol", "kind", "day", *_CSV), path, ["symbol", "kind", "day"])
    lines = landed.without_header(landed.archive_lines(spark, path), "agg_trade_id", ("archive", "name"))
    trades = landed.accepted(landed.parse_trades(lines, F.lit("UsdFutures"), F.lit("ms")))
    checked = landed.checksums(spark, path).select(F.col("name").alias("archive"), "status")
    # Spark takes lines for as small as the archives' listing, and would send them all to the driver to broadcast them
    return trades.hint("merge").join(checked, "archive").select("archive", "status", "agg_trade_id", "price", "transact_time", F.col("place.row").alias("row"))


@query("SELECT event_id, event_type, value FROM events")
def landed_pages(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "pages")
    _table(spark, d, "events").select("event_id", "event_type", "value").write.json(path)
    return landed.record_pages(spark, path, StructType.fromDDL("event_id long, event_type string, value double")).orderBy("page_seq", "row_seq").drop("page_seq", "row_seq")


@query("SELECT 'p/' || o_orderkey || '.zip' AS key, o_orderkey || '.zip' AS name FROM orders WHERE o_orderkey % 5 NOT IN (1, 2, 3)")
def manifest(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    key = F.concat(F.lit("p/"), k.cast("string"), F.lit(".zip"))
    odd = F.when(k % 5 == 1, F.concat(key, F.lit(".CHECKSUM"))).when(k % 5 == 2, "  ").when(k % 5 == 3, F.lit(None)).otherwise(key)
    return landed.manifest(_table(spark, d, "orders").select(odd.alias("key")))


_CONTENT = "o_orderkey || ':' || o_orderpriority"


@query(f"""
SELECT o_orderkey::VARCHAR AS name, sha256({_CONTENT}) AS sha256, CASE o_orderkey % 4 WHEN 0 THEN sha256({_CONTENT}) WHEN 1 THEN '00' WHEN 2 THEN '' END AS expected,
  CASE o_orderkey % 4 WHEN 0 THEN 'valid' WHEN 1 THEN 'mismatch' WHEN 2 THEN 'empty' ELSE 'missing' END AS status FROM orders""")
def checksums(spark: SparkSession, d: str) -> DataFrame:
    o = _table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("name"), F.concat_ws(":", F.col("o_orderkey").cast("string"), "o_orderpriority").cast("binary").alias("content"))
    k = F.col("o_orderkey")
    value = F.when(k % 4 == 0, F.concat(F.upper(F.sha2("content", 256)), F.lit("  "), F.col("name"))).when(k % 4 == 1, "00\tname").otherwise(" \n")
    return landed.verified(o.select("name", "content"), o.where(k % 4 < 3).select("name", value.alias("value")))


@query("""
WITH o AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS day FROM orders),
f AS (SELECT o_custkey, date_trunc('month', day)::DATE AS a, CASE WHEN day(day) % 9 <> 0 THEN day END AS p,
  'C-' || strftime(day, '%Y-%m') || '.zip' AS archive, CASE WHEN day(day) % 9 = 0 THEN 'odd-' || strftime(day, '%d') ELSE 'C-t-' || strftime(day, '%Y-%m-%d') || '.csv' END AS name FROM o),
g AS (SELECT o_custkey, 'C-t-' || strftime(a, '%Y-%m') || '.zip' AS archive, name, a, p FROM f)
SELECT o_custkey, archive, name, row_number() OVER (PARTITION BY o_custkey ORDER BY a, coalesce(p, DATE '9999-12-31'), archive, name)::INTEGER AS file_seq FROM g""")
def file_order(spark: SparkSession, d: str) -> DataFrame:
    days = _table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day")).distinct()
    name = F.when(F.dayofmonth("day") % 9 == 0, F.concat(F.lit("odd-"), F.date_format("day", "dd"))).otherwise(F.concat(F.lit("C-t-"), F.date_format("day", "yyyy-MM-dd"), F.lit(".csv")))
    files = days.select("o_custkey", F.concat(F.lit("C-t-"), F.date_format("day", "yyyy-MM"), F.lit(".zip")).alias("archive"), name.alias("name"))
    return landed.with_file_order(files, ["o_custkey"])


def _named_files(spark: SparkSession, rows: DataFrame, path: str, names: Sequence[str], order: str, columns: Sequence[str]) -> None:
    """Land rows as CSV files below ``path``, one for each value of ``names`` (joined by '-'), in order."""
    name = F.concat_ws("-", *names)
    out = f"{path}-parts"
    rows.withColumn("__name", name).repartition("__name").sortWithinPartitions("__name", order).select("__name", *columns).write.partitionBy("__name").csv(out)
    fs, root = versions.fs(spark, out)
    fs.mkdirs(versions.fs(spark, path)[1])
    for folder in fs.globStatus(versions.fs(spark, f"{out}/__name=*")[1]):  # one file a name
        (part,) = fs.globStatus(versions.fs(spark, f"{folder.getPath()}/part-*")[1])
        fs.rename(part.getPath(), versions.fs(spark, f"{path}/{folder.getPath().getName().split('=', 1)[1]}.csv")[1])


@query("""
WITH e AS (SELECT event_type AS symbol, event_id % 6000 AS id, epoch_us(ts) // 1000 * 1000 AS t, value, event_id AS line,
  least((day(ts) - 1) // 8 + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END, 3) AS f FROM events),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY symbol, id ORDER BY f DESC, line DESC) = 1),
m AS (SELECT symbol, f, min(t) AS m FROM e GROUP BY 1, 2),
c AS (SELECT symbol, f, min(m) OVER (PARTITION BY symbol ORDER BY f ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS cut FROM m)
SELECT symbol, id AS agg_trade_id, value AS price, t::BIGINT AS transact_time FROM l JOIN c USING (symbol, f) WHERE cut IS NULL OR t < cut""")
def arrived_files(spark: SparkSession, d: str) -> DataFrame:
    """Four files a symbol, overlapping and with repeated keys; the second lands after the fourth."""
    path, table, state = (scratch_path(spark, n) for n in ("landing", "arrived", "stream"))
    f = F.least(F.call_function("div", F.dayofmonth("ts") - 1, F.lit(8)) + F.when(_id(50) == 0, 1).otherwise(0), F.lit(3))
    e = _table(spark, d, "events").withColumn("agg_trade_id", F.col("event_id"))
    rows = e.withColumns({"f": f, "day": F.concat(F.lit("2024-01-"), F.lpad((8 * f + 1).cast("string"), 2, "0")), "kind": F.lit("aggTrades")})
    rows = rows.select("f", "day", "kind", "event_id", F.col("event_type").alias("symbol"), (_id(6000)).alias("agg_trade_id"), F.col("value").alias("price"), F.lit(1.0).alias("quantity"), F.lit(1).alias("first_trade_id"), F.lit(1).alias("last_trade_id"), S.millis(F.col("ts")).alias("transact_time"), F.lit(True).alias("is_buyer_maker"))
    for landed_now in ("f != 1", "f = 1"):
        _named_files(spark, rows.where(landed_now), path if landed_now == "f != 1" else f"{path}/late", ["symbol", "kind", "day"], "event_id", _CSV)
        arrival.start_ingestion(spark, path, table, "UsdFutures", state).awaitTermination()
    return tables.read(spark, table, TRADES).select("symbol", "agg_trade_id", "price", "transact_time")


# --- incremental ---


@query("SELECT event_type AS symbol, max(ts) AS watermark FROM events WHERE value > 10 GROUP BY 1")
def watermark_timestamp(spark: SparkSession, d: str) -> DataFrame:
    return watermark.watermarks(_table(spark, d, "events").where("value > 10").withColumnRenamed("event_type", "symbol"), ["symbol"], "ts")


@query("""
WITH t AS (SELECT user_id, event_id AS id, value FROM events WHERE user_id % 3 = 0), l AS (SELECT user_id, event_id // 2 AS id, arg_max(value, event_id) * 2 AS value FROM events WHERE user_id % 3 <> 0 GROUP BY 1, 2)
SELECT * FROM t UNION ALL SELECT * FROM l""")
def legacy_backfill(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select("user_id", F.col("event_id").alias("id"), S.micros(F.col("ts")).alias("t"), "value")
    legacy = e.withColumns({"line": F.col("id"), "f": F.lit(1), "id": F.call_function("div", F.col("id"), F.lit(2)), "value": F.col("value") * 2})
    return merge.backfill(e.where("user_id % 3 = 0"), legacy, ["user_id"], ["id"], "t", "f", "line").select("user_id", "id", "value")


@query("""
WITH c AS (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0)
SELECT 'left' AS part, o_orderkey AS id FROM orders JOIN c ON o_custkey = c_custkey
UNION ALL SELECT 'gone', c_custkey FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'info', c_custkey FROM c""")
def universe_sync(spark: SparkSession, d: str) -> DataFrame:
    c = _table(spark, d, "customer").select(F.lit("m").alias("market"), F.col("c_name").alias("symbol"), "c_custkey", "c_acctbal")
    orders = _table(spark, d, "orders").join(c.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select("market", F.lower("symbol").alias("symbol"), "o_orderkey")
    info, gone, left = universe.sync_universe(c, c.where("c_acctbal >= 0"), {"orders": orders})
    parts = {"left": left["orders"].select(F.col("o_orderkey").alias("id")), "gone": gone.join(c, ["market", "symbol"]).select(F.col("c_custkey").alias("id")), "info": info.select(F.col("c_custkey").alias("id"))}
    return landed.concatenated([df.select(F.lit(n).alias("part"), "id") for n, df in parts.items()])


@query("SELECT o_orderkey::VARCHAR AS name, o_custkey FROM orders WHERE o_orderkey % 4 <> 0")
def reused_files(spark: SparkSession, d: str) -> DataFrame:
    o = _table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("name"), "o_custkey")
    return watermark.reuse_complete(o, checksums(spark, d))


@query("""
WITH c AS (SELECT user_id, min(ts) + to_hours((user_id % 700)::INTEGER) AS c FROM events GROUP BY 1),
l AS (SELECT c.user_id, c, max(ts) AS l FROM c LEFT JOIN events e ON e.user_id = c.user_id AND ts >= c AND value > 100 GROUP BY 1, 2),
n AS (SELECT user_id, CASE WHEN l IS NULL THEN c + INTERVAL 200 DAY ELSE greatest(l, c) + INTERVAL 5 MINUTE END AS c FROM l)
SELECT user_id, c AS cursor, c - INTERVAL 5 MINUTE AS window_start, least(c + INTERVAL 2495 MINUTE, TIMESTAMP '2024-08-01' + INTERVAL 5 MINUTE) AS window_end FROM n WHERE c < TIMESTAMP '2024-08-01'""")
def next_windows(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select("user_id", F.col("ts").alias("timestamp"), "value")
    cursors = e.groupBy("user_id").agg(F.min("timestamp").alias("cursor")).withColumn("cursor", F.timestamp_add("HOUR", F.col("user_id") % 700, F.col("cursor")))
    return watermark.next_windows(cursors, e.where("value > 100"), ["user_id"], _ntz("2024-08-01"))


#: Fixed values, written out beside the operator's own: a candle interval's name and its milliseconds.
_LENGTHS = {
    "OneSecond": 1000, "OneMinute": 60000, "ThreeMinutes": 180000, "FiveMinutes": 300000, "FifteenMinutes": 900000, "ThirtyMinutes": 1800000,
    "OneHour": 3600000, "TwoHour": 7200000, "FourHour": 14400000, "SixHour": 21600000, "EightHour": 28800000, "TwelveHour": 43200000,
    "OneDay": 86400000, "ThreeDay": 259200000, "OneWeek": 604800000, "OneMonth": 2678400000,
}


@query(f"SELECT event_id, [{', '.join(f'{ms}::BIGINT' for ms in _LENGTHS.values())}][event_id % {len(_LENGTHS)} + 1] AS ms FROM events")
def interval_lengths(spark: SparkSession, d: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, _LENGTHS)), (F.col("event_id") % len(_LENGTHS) + 1).cast("int"))
    return _table(spark, d, "events").select("event_id", S.interval_ms(name).alias("ms"))


@query("SELECT event_type AS symbol, count(*)::BIGINT AS n_rows, 0::BIGINT AS n_invalid, '' AS zero_columns, 0::BIGINT AS n_missing, false AS has_issue FROM events GROUP BY 1")
def checks_switched_off(spark: SparkSession, d: str) -> DataFrame:
    rows = _trades(spark, d).withColumn("price", F.lit(0.0))
    report = quality.integrity_report(rows, rows, ["symbol"], F.lit(True), TRADES.checked, TRADES.time, TRADES.units_per_day, 3, rows=False, zeros=False, days=False)
    return report.select("symbol", "n_rows", "n_invalid", "zero_columns", "n_missing", "has_issue")


# --- all columns of every projection ---

_ALWAYS, _SOME = "o_orderdate", "CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END"
_A, _B, _NULL = "o_custkey::DOUBLE", "(o_custkey % 7)::DOUBLE", "NULL::DOUBLE"
_SPARK = {_A: lambda: F.col("o_custkey").cast("decimal(20,8)"), _B: lambda: (F.col("o_custkey") % 7).cast("decimal(20,8)"), _NULL: lambda: F.lit(None).cast("decimal(20,8)"), _ALWAYS: lambda: F.col("o_orderdate"), _SOME: lambda: F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))}
_OHLC = {"open_time": _ALWAYS, "open_price": _A, "high_price": _B, "low_price": _A, "close_price": _B, "close_time": _ALWAYS}
_RATIOS = {"timestamp": _SOME, "long_short_ratio": _A, "long_account": _B, "short_account": _A}
#: Projection -> source columns; then what its result holds where that is not the source column of that name.
_PROJECTED = {
    "premium_index_kline": (projections.premium_index_klines, _OHLC, {}),
    "index_price_kline": (projections.index_price_klines, _OHLC, {}),
    "mark_price_kline": (projections.mark_price_klines, _OHLC, {}),
    "funding_rate": (projections.funding_rates, {"funding_time": _ALWAYS, "funding_rate": _A, "mark_price": _NULL}, {"rate": _A, "funding_rate": None}),
    "open_interest": (projections.open_interest, {"timestamp": _SOME, "sum_open_interest": _A, "sum_open_interest_value": _B}, {}),
    "top_position_ratio": (projections.top_position_ratios, _RATIOS, {}),
    "top_account_ratio": (projections.top_account_ratios, _RATIOS, {}),
    "global_account_ratio": (projections.global_account_ratios, _RATIOS, {}),
    "taker_ratio_usd": (projections.taker_ratios_usd, {"timestamp": _ALWAYS, "buy_sell_ratio": _A, "buy_volume": _B, "sell_volume": _A}, {"buy_volume_value": _NULL, "sell_volume_value": _NULL}),
    "taker_ratio_coin": (projections.taker_ratios_coin, {"timestamp": _SOME, "buy_volume": _A, "sell_volume": _B, "buy_volume_value": _B, "sell_volume_value": _A}, {"buy_sell_ratio": f"CASE WHEN {_B} <> 0 THEN round({_A} / {_B}, 18) END"}),
    "basis": (projections.basis, {"timestamp": _ALWAYS, "futures_price": _A, "index_price": _B, "basis_value": _A, "basis_rate": _B, "annualized_basis_rate": _NULL}, {}),
}


def _projection(name: str) -> None:
    project, source, other = _PROJECTED[name]
    result = {c: x for c, x in (source | other).items() if x is not None}
    columns = ", ".join(f"epoch_ms({x}) AS {c}" if x in (_ALWAYS, _SOME) else f"{x} AS {c}" for c, x in result.items())
    where = f" WHERE {_SOME} IS NOT NULL" if _SOME in source.values() else ""

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("symbol"), *(_SPARK[x]().alias(c) for c, x in source.items()))
        return project(rows, ["symbol"])

    run.__name__ = f"projection_{name}"
    query(f"SELECT o_orderkey::VARCHAR AS symbol, {columns} FROM orders{where}")(run)


for _name in _PROJECTED:
    _projection(_name)


def _symbols(spark: SparkSession, d: str, fields: tuple[str, ...], project) -> DataFrame:
    listed = F.split("p_name", " ")
    kinds = {
        **{f: listed for f in ("order_types", "permissions", "time_in_force", "underlying_sub_type")},
        **{f: _ntz("2024-01-01") for f in ("delivery_date", "listing_date")},
        **{f: F.col("p_retailprice").cast("decimal(20,8)") for f in ("liquidation_fee", "maint_margin_percent", "market_take_bound", "required_margin_percent", "trigger_protect")},
    }
    p = _table(spark, d, "part").select("p_partkey", *(kinds.get(f, F.concat(F.lit(f + ":"), F.col("p_brand"))).alias(f) for f in fields))
    return project(p, ["p_partkey"])


def _symbols_sql(fields: tuple[str, ...]) -> str:
    def column(f: str) -> str:
        if f in ("order_types", "permissions", "time_in_force", "underlying_sub_type"):
            return f"replace(p_name, ' ', '|') AS {f}"
        if f in ("delivery_date", "listing_date"):
            return f"1704067200000::BIGINT AS {f}"
        if f in ("liquidation_fee", "maint_margin_percent", "market_take_bound", "required_margin_percent", "trigger_protect"):
            return f"p_retailprice AS {f}"
        return f"'{f}:' || p_brand AS {f}"

    return f"SELECT p_partkey, {', '.join(map(column, fields))} FROM part"


@query(_symbols_sql(projections.SPOT_FIELDS))
def spot_symbols(spark: SparkSession, d: str) -> DataFrame:
    return _symbols(spark, d, projections.SPOT_FIELDS, projections.spot_symbols)


@query(_symbols_sql(projections.FUTURES_FIELDS))
def futures_symbols(spark: SparkSession, d: str) -> DataFrame:
    return _symbols(spark, d, projections.FUTURES_FIELDS, projections.futures_symbols)
