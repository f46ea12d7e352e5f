"""Scans of landed files: CSV lines with their order, archives, manifests, checksums and record pages."""

from __future__ import annotations

import hashlib
import io
import itertools
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..functions import scalars as S


class BadRecord(ValueError):
    """A landed line does not have its declared form."""


def file_name() -> Column:
    """A file's own name; Spark gives names as parts of an address, with odd characters escaped."""
    return F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), r"\+", "%2B"))


def csv_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """(file, name, place, line) of text files, with ``place`` ordering the lines of a file.

    A split knows where it begins in its file, and rows of a split are numbered in order: together they
    order the lines of a file that many tasks read.
    """
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", str(recursive).lower())
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), file_name().alias("name"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("place"), F.col("value").alias("line"))
    return lines.withColumn("line", F.regexp_replace("line", r"\r$", ""))


def without_header(lines: DataFrame, first_field: str, files: tuple[str, ...] = ("file",)) -> DataFrame:
    """Lines less the blank ones, and less a file's first line if its first field is the given name in any
    case. One row a file is joined back; finding it reads the same columns as the lines themselves, so that
    both scans are cut, and their rows numbered, alike."""
    first = lines.where("place.block = 0").groupBy(*files).agg(F.min("place.row").alias("__first"), F.max(F.octet_length("line")).alias("__longest"))
    header = F.lower(F.trim(F.element_at(F.split("line", ","), 1))) == first_field.lower()
    is_first = (F.col("place.block") == 0) & (F.col("place.row") == F.col("__first")) & (F.col("__longest") >= 0)
    # a header's line becomes null by a joined column: no later filter on the line can then run before this
    line = F.when(F.coalesce(is_first, F.lit(False)) & header, F.lit(None)).otherwise(F.col("line"))
    return lines.join(first, list(files), "left").withColumn("line", line).drop("__first", "__longest").where(F.trim("line") != "")


def _at(k: int) -> Column:
    return F.try_element_at(F.col("__f"), F.lit(k + 1))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is made once a row: a filter on a plain column is carried below it, and makes
    its value anew for each use."""
    return df.withColumn(name, F.explode(F.array(value)))


def parse_trades(lines: DataFrame, market: Column, unit: Column) -> DataFrame:
    """Trade columns, times in microseconds, and ``reject`` (why a line is refused, else null). Spot lines
    have 8 fields, of which the last is dropped, others 7; nothing is quoted."""
    df = _once(lines, "__f", F.split("line", ",")).withColumn("__n", F.when(market == "Spot", 8).otherwise(7))
    parsed = {
        "agg_trade_id": S.strict_long(_at(0)),
        "price": S.strict_double(_at(1)),
        "quantity": S.strict_double(_at(2)),
        "first_trade_id": S.strict_long(_at(3)),
        "last_trade_id": S.strict_long(_at(4)),
        "transact_time": S.scaled_micros(S.strict_long(_at(5)), unit),
        "is_buyer_maker": S.strict_bool(_at(6)),
    }
    df = _once(df, "__p", F.struct(*(v.alias(c) for c, v in parsed.items()))).withColumns({c: F.col(f"__p.{c}") for c in parsed})
    reject = F.when(F.size("__f") != F.col("__n"), F.concat(F.lit("fields: "), F.size("__f")))
    for c in parsed:
        reject = reject.when(F.col(c).isNull(), F.lit(c))
    return df.withColumn("reject", reject).drop("__f", "__n", "__p")


def parse_depth(lines: DataFrame) -> DataFrame:
    """Order-book columns, times in milliseconds, and ``reject``. Further fields are ignored."""
    df = _once(lines, "__f", F.split("line", ","))
    parsed = {"snapshot_time": S.exact_millis(_at(0)), "percentage": S.strict_decimal(_at(1), 10, 2), "depth": S.strict_double(_at(2)), "notional": S.strict_double(_at(3))}
    df = _once(df, "__p", F.struct(*(v.alias(c) for c, v in parsed.items()))).withColumns({c: F.col(f"__p.{c}") for c in parsed})
    reject = F.when(F.lit(False), "")
    for c in parsed:
        reject = reject.when(F.col(c).isNull(), F.lit(c))
    return df.withColumn("reject", reject).drop("__f", "__p")


def accepted(parsed: DataFrame) -> DataFrame:
    """The parsed rows; a refused line fails the job, naming the line."""
    wrong = F.raise_error(F.concat(F.lit("bad record ("), F.col("reject"), F.lit("): "), F.coalesce("line", F.lit("null")))).cast("boolean")
    return parsed.where(F.when(F.col("reject").isNull(), True).when(F.trim("line") != "", wrong).otherwise(False)).drop("reject", "line")


def quarantined(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, refused lines with the reason), without failing."""
    return parsed.where("reject IS NULL").drop("reject", "line"), parsed.where("reject IS NOT NULL").select(*(c for c in parsed.columns if c in ("file", "name", "place", "line", "reject")))


def with_file_order(files: DataFrame, groups: list[str], archive: str = "archive", name: str = "name") -> DataFrame:
    """``file_seq``: files in the order of the archive's period, then of their own; unreadable periods last,
    then by name."""
    far = F.lit("9999-12-31").cast("date")
    order = [F.coalesce(S.file_period(F.col(archive)), far), F.coalesce(S.file_period(F.col(name)), far), F.col(archive), F.col(name)]
    return files.withColumn("file_seq", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))


Opener = Callable[[str], BinaryIO]


class _Remote(io.RawIOBase):
    """An Arrow file as Python's own files are: a seek that is out of place is an OSError."""

    def __init__(self, file: pa.NativeFile):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self._file.seek(offset, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def tell(self) -> int:
        return self._file.tell()

    def readinto(self, buffer) -> int:
        return self._file.readinto(buffer)

    def close(self) -> None:
        self._file.close()
        super().close()


def open_file(path: str) -> BinaryIO:
    """A seekable file by its address: a local path, or what Arrow's file systems can open."""
    if path.startswith("file:") or ":" not in path.split("/")[0]:
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")  # noqa: SIM115
    system, name = pyarrow.fs.FileSystem.from_uri(path)
    return io.BufferedReader(_Remote(system.open_input_file(name)))


def _dealt(files: DataFrame) -> DataFrame:
    """Rows that each stand for much work, dealt over the session's tasks."""
    return files.repartition(max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), files.sparkSession.sparkContext.defaultParallelism))


def archive_entries(spark: SparkSession, path: str, opener: Opener = open_file) -> DataFrame:
    """(path, entry, size) of every file in the .zip archives, from their directories alone; an archive
    without files fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with opener(archive) as f, zipfile.ZipFile(f) as z:
                    entries = [e for e in z.infolist() if not e.is_dir()]
                if not entries:
                    raise BadRecord(f"{archive} holds no file")
                yield pa.RecordBatch.from_pydict({"path": [archive] * len(entries), "entry": [e.filename for e in entries], "size": [e.file_size for e in entries]})

    return _dealt(landed_files(spark, path, "*.zip").select("path")).mapInArrow(run, "path string, entry string, size long")


def entry_lines(file: BinaryIO, archive: str, entry: str, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """The lines of one file of an archive, in batches, decompressed as they are read."""
    with zipfile.ZipFile(file) as z, z.open(entry) as f:
        lines, at = io.TextIOWrapper(f, "utf-8", newline=None), 0
        while part := [x.rstrip("\n") for x in itertools.islice(lines, rows)]:
            n = len(part)
            yield pa.RecordBatch.from_arrays([pa.array([archive] * n), pa.array([entry] * n), pa.array(range(at, at + n), pa.int64()), pa.array(part)], names=["path", "entry", "row", "line"])
            at += n


def archive_lines(spark: SparkSession, path: str, opener: Opener = open_file) -> DataFrame:
    """(archive, name, place, line) of every file in the .zip archives, names flattened to their last part.
    A task reads one file of an archive at a time, as a stream, so that neither an archive nor a file in it
    must fit in memory; an archive without files fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, entry in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with opener(archive) as f:
                    yield from entry_lines(f, archive, entry)

    entries = _dealt(archive_entries(spark, path, opener)).select("path", "entry")
    out = entries.mapInArrow(run, "path string, entry string, row long, line string")

    def last(c: str) -> Column:
        return F.element_at(F.split(c, "/"), -1)

    return out.select(last("path").alias("archive"), last("entry").alias("name"), F.struct(F.lit(0).cast("long").alias("block"), "row").alias("place"), "line")


def file_digests(spark: SparkSession, path: str, glob: str = "*.zip", opener: Opener = open_file) -> DataFrame:
    """(name, sha256) of landed files, each read as a stream by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                with opener(file) as f:
                    while part := f.read(1 << 20):
                        digest.update(part)
                yield pa.RecordBatch.from_pydict({"name": [file.rsplit("/", 1)[-1]], "sha256": [digest.hexdigest()]})

    return _dealt(landed_files(spark, path, glob).select("path")).mapInArrow(run, "name string, sha256 string")


def manifest(listing: DataFrame, key: str = "key") -> DataFrame:
    """(key, name) of a landed bucket listing, without blank keys and checksum sidecars, in the order of names."""
    rows = listing.where(F.trim(F.coalesce(F.col(key), F.lit(""))) != "").where(~F.endswith(F.col(key), F.lit(".CHECKSUM")))
    return rows.select(F.col(key).alias("key"), F.element_at(F.split(key, "/"), -1).alias("name")).orderBy("name")


def landed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(name, path, length, modified) of landed files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length", F.col("modificationTime").alias("modified"))


def checksums(spark: SparkSession, path: str, glob: str = "*.zip", opener: Opener = open_file) -> DataFrame:
    """(name, sha256, expected, status) of landed files and their sidecars, as ``judged`` gives them."""
    sides = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.CHECKSUM").option("recursiveFileLookup", "true").text(path)
    return judged(file_digests(spark, path, glob, opener), sides.select(F.regexp_replace(file_name(), r"\.CHECKSUM$", "").alias("name"), "value"))


def verified(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """``judged`` for files (name, content). Contents are hashed before the join, so that only names and
    digests are shuffled."""
    return judged(files.select("name", F.sha2("content", 256).alias("sha256")), sidecars)


def judged(hashed: DataFrame, sidecars: DataFrame) -> DataFrame:
    """(name, sha256, expected, status) of files (name, sha256) by sidecars (name, value): 'valid',
    'mismatch', 'empty' or 'missing' by the first word of the sidecar, in any case."""
    sides = sidecars.select("name", F.lower(F.element_at(F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " "), 1)).alias("expected"), F.lit(True).alias("found"))
    status = F.when(F.col("found").isNull(), "missing").when(F.col("expected") == "", "empty").when(F.col("expected") == F.col("sha256"), "valid").otherwise("mismatch")
    return hashed.join(sides, "name", "left").select("name", "sha256", "expected", status.alias("status"))


def require_valid(checked: DataFrame) -> DataFrame:
    """``checked``, once every file is known to be valid; else an error."""
    wrong = checked.where("status != 'valid'").head(1)
    if wrong:
        raise BadRecord(f"checksum of {wrong[0].name}: {wrong[0].status}")
    return checked


def record_pages(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Landed JSON pages (one record a line) with ``page_seq``, the page's file name, and ``row_seq``: the
    order in which records were requested."""
    return spark.read.schema(schema).json(path).withColumns({"page_seq": F.col("_metadata.file_name"), "row_seq": F.monotonically_increasing_id()})


def concatenated(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, by column name."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
