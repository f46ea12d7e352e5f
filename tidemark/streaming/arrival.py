"""Ingestion of arriving files: each micro-batch replaces the tails of the symbols it brings.

The table is always what applying all files seen so far in the order of their periods would give, whatever
order they landed in. A ledger beside the table names the files that have been applied, with the batch and
the first time of each. When a file lands whose period is before that of applied ones, those later files are
read again and applied after it: applying a file twice changes nothing, and what a late file must cut or may
not bring back follows from the later files' rows. A batch that is replayed after a failure therefore gives
the same table too. Landed files must stay where they are for as long as an earlier period may still land.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import file_period, source_unit
from ..schemas import DATA_TYPES, DataType
from ..sources import tables
from ..sources.landed import accepted, csv_lines, file_name, parse_trades, with_file_order, without_header
from ..sources.scratch import release, stored

LEDGER = "market string, symbol string, file string, name string, first_time long, batch long"
_FILES = ["market", "symbol", "file", "name"]


def arriving_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A stream of (file, name, block, line) from CSV files as they land below ``path``."""
    lines = spark.readStream.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), file_name().alias("name"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """(market, symbol, file, name, first_time, batch) of the files that a table's ingestion has applied; a
    file that was applied in several batches stands with the last."""
    path = f"{table.rstrip('/')}/_ledger"
    if not tables.path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(f"{path}/*")
    return rows.groupBy(*_FILES).agg(F.max_by("first_time", "batch").alias("first_time"), F.max("batch").alias("batch"))


def _parsed(lines: DataFrame, market: str) -> DataFrame:
    lines = lines.withColumns({"market": F.lit(market), "symbol": F.element_at(F.split("name", "-"), 1)})
    unit = source_unit(F.col("market"), file_period(F.col("name")))
    return accepted(parse_trades(without_header(lines, "agg_trade_id"), F.col("market"), unit))


def _ordered(files: DataFrame) -> DataFrame:
    return with_file_order(files.withColumn("archive", F.col("name")), ["market", "symbol"]).drop("archive")


def _later_files(new: DataFrame, applied: DataFrame) -> list[str]:
    """Applied files of the new files' symbols whose place is after a new one's."""
    old = applied.join(new.select("market", "symbol").distinct(), ["market", "symbol"], "left_semi").join(new, _FILES, "left_anti")
    both = _ordered(new.withColumn("new", F.lit(True)).unionByName(old.select(*_FILES).withColumn("new", F.lit(False))))
    first = both.where("new").groupBy("market", "symbol").agg(F.min("file_seq").alias("first"))
    late = both.join(first, ["market", "symbol"]).where("NOT new AND file_seq > first")
    return sorted(r.file for r in late.select("file").collect())  # names of files


def ingest_trades(lines: DataFrame, table: str, market: str, batch: int = 0) -> None:
    """Apply the files of a batch of trade lines (file, name, place, line) to a stored table; the symbol is
    what the file name begins with."""
    spark, kind = lines.sparkSession, DATA_TYPES["agg_trades"]
    rows = stored(_parsed(lines, market), "arrived")  # parsed once, whatever uses it
    try:
        # a file may have a line in many splits; a batch brings at most maxFilesPerTrigger files
        new = rows.groupBy(*_FILES).agg(F.min(kind.time).alias("first_time"))
        named = [tuple(r) for r in new.orderBy("file").collect()]
        if not named:
            return
        new = spark.createDataFrame([r[:4] for r in named], ", ".join(LEDGER.split(", ")[:4]))
        again = _later_files(new, ledger(spark, table))
        every, files = rows, new
        if again:
            old = _parsed(csv_lines(spark, [unquote(f) for f in again]), market)
            every = rows.unionByName(old.select(*rows.columns))
            files = new.unionByName(old.select(*_FILES).distinct())
        _apply(spark, every, files, table, kind)
        mark = hashlib.sha256("\n".join(r[2] for r in named).encode()).hexdigest()[:24]
        done = spark.createDataFrame([(*r, batch) for r in named], LEDGER)
        done.coalesce(1).write.mode("overwrite").parquet(f"{table.rstrip('/')}/_ledger/batch-{mark}")  # a replay writes the same folder
    finally:
        release(rows)


def _apply(spark: SparkSession, rows: DataFrame, files: DataFrame, table: str, kind: DataType) -> None:
    seq = _ordered(files).select("file", "file_seq")
    tables.replace_tails_table(spark, rows.join(seq, "file"), table, kind, "file_seq", "place")


def start_ingestion(spark: SparkSession, path: str, table: str, market: str, checkpoint: str, on_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """Ingest what has landed since the last call, then stop (trigger availableNow)."""

    def batch(df: DataFrame, number: int) -> None:
        df = df.withColumn("place", F.struct("block", F.monotonically_increasing_id().alias("row"))).drop("block")
        ingest_trades(df, table, market, number)
        if on_batch:
            on_batch(number)

    return arriving_lines(spark, path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
