"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames; a seek table ends each bundle (the public seekable
format: a skippable frame of compressed and raw frame sizes); an index maps record identifiers to
offsets inside a frame, so one record is read by inflating one frame.

An archive is a Parquet table with one row per bundle: its name, its bytes exactly as a ``.warc.zst``
file holds them, and the index of its records. Spark's own commit protocol thus makes the archive
whole or absent, on any store, when tasks are retried; ``export_bundles`` gives plain files.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored

#: Fixed values of the public seekable Zstandard format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
#: A frame is closed at so many raw bytes, a bundle at so many compressed ones.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 8 << 20
#: Revisit profile of the WARC standard for equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:tidemark:page:"
_INDEX = "array<struct<record_id:string,page_id:long,frame:int,offset:long,length:long>>"
_FIELDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    """Rows that repeat a page id (or have none) are told apart by their payload's digest; only rows that
    repeat both, which are the same record, share it."""
    return f"{_URN}{'none' if page_id is None else page_id}:{digest}"


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """The bytes of one record. A revisit (payload None) keeps the HTTP headers of the full response."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: <{record_id(page_id, digest)}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if payload is None:
        head += [f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:stop].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines)
    end = stop + 4 + int(head["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    return head, data[stop + 4 : end], end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def frames(content: bytes) -> list[tuple[int, int]]:
    """(offset, compressed size) of each frame, from the seek table at the bundle's end."""
    n, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("the bundle does not end in a seek table")
    out, at = [], 0
    for size, _ in struct.iter_unpack("<II", content[-9 - 8 * n : -9]):
        out.append((at, size))
        at += size
    if at + 17 + 8 * n != len(content):
        raise ValueError("the seek table does not cover the bundle")
    return out


class Bundle:
    """A bundle that is being written."""

    def __init__(self, level: int):
        self.zip, self.out, self.sizes, self.index, self.raw = zstandard.ZstdCompressor(level=level), bytearray(), [], [], bytearray()

    def add(self, page_id: int | None, digest: str, data: bytes) -> None:
        self.index.append({"record_id": record_id(page_id, digest), "page_id": page_id, "frame": len(self.sizes), "offset": len(self.raw), "length": len(data)})
        self.raw += data
        if len(self.raw) >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.raw:
            frame = self.zip.compress(bytes(self.raw))
            self.sizes.append((len(frame), len(self.raw)))
            self.out += frame
            self.raw.clear()

    def close(self) -> bytes:
        self.close_frame()
        return bytes(self.out) + seek_table(self.sizes)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def plan_records(pages: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """Pages with payload, SHA-1 and the page that their record refers to (null: a response)."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    base = base.withColumn("sha1", F.sha1("payload"))
    # written first: both sides of the join are then plain exchanges, so a hot payload can be split
    heads = stored(base.groupBy("sha1").agg(F.max("page_id").alias("first")), "payload-heads")
    joined = base.join(heads, "sha1")
    revisit = ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= min_payload_bytes)
    return joined.select("page_id", "url", "sha1", F.octet_length("payload").cast("long").alias("size"), F.when(~revisit, F.col("payload")).alias("payload"), F.when(revisit, F.col("first")).alias("refers_to"))


def write_archive(pages: DataFrame, path: str, min_payload_bytes: int = 0, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to the archive at ``path``.

    Of records with equal payloads of at least ``min_payload_bytes``, that with the largest page_id is
    the response and the others revisit it. A null html is an empty payload; a null url is left out; a
    null page_id sorts below all others; rows that repeat the largest page_id of a payload are all
    responses; an empty table gives an archive without bundles; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, bundle = TaskContext.get().partitionId(), 0, Bundle(level)

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"bundle": f"part-{part:05d}-{made:05d}.warc.zst", "content": bundle.close(), "records": bundle.index}], schema)

        for batch in batches:
            for page, url, sha, size, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digest = base32(sha)
                bundle.add(page, digest, record(page, url, payload, size, digest, refers, date))
                if len(bundle.out) >= BUNDLE_BYTES:
                    yield closed()
                    bundle, made = Bundle(level), made + 1
        if bundle.index:
            yield closed()

    entry = pa.struct([("record_id", pa.string()), ("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
    schema = pa.schema([("bundle", pa.string()), ("content", pa.binary()), ("records", pa.list_(entry))])
    plan_records(pages, min_payload_bytes).mapInArrow(run, f"bundle string, content binary, records {_INDEX}").write.option("compression", "none").parquet(path)


def _row(head: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{head['WARC-Record-ID']} does not match its digest")
    number = lambda name: int(x) if (x := head.get(name, "").strip("<>").removeprefix(_URN).split(":")[0]).lstrip("-").isdigit() else None
    return number("WARC-Record-ID"), head.get("WARC-Target-URI"), kind, size, digest, number("WARC-Refers-To"), payload if with_payload and kind == "response" else None


_ROWS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROWS, strict=True)], schema=_ROWS)


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archive, its digest verified: (page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, payload); payload is null for revisits or if not asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for content in (x.as_py() for x in batch.column(0)):
                for at, size in frames(content):
                    raw, end, rows = unzip.decompress(content[at : at + size]), 0, []
                    while end < len(raw):
                        head, block, end = parse(raw, end)
                        rows.append(_row(head, block, with_payload))
                    yield _batch(rows)

    return spark.read.parquet(path).select("content").mapInArrow(run, _FIELDS)


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """(bundle, record_id, page_id, frame, offset, length); the bundles' bytes are not read."""
    return spark.read.parquet(path).select("bundle", F.inline("records"))


def read_records(spark: SparkSession, path: str, pages: DataFrame) -> DataFrame:
    """The records of the page ids in ``pages`` (column page_id), inflating only the frames they are in."""
    wanted = archive_index(spark, path).join(pages.select(F.col("page_id").cast("long")).distinct(), "page_id", "left_semi").groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset", "length")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for content, places in zip(batch.column(0), batch.column(1), strict=True):
                content, table, rows, held = content.as_py(), None, [], (-1, b"")
                table = frames(content)
                for p in sorted(places.as_py(), key=lambda p: (p["frame"], p["offset"])):
                    if held[0] != p["frame"]:
                        at, size = table[p["frame"]]
                        held = p["frame"], unzip.decompress(content[at : at + size])
                    rows.append(_row(*parse(held[1], p["offset"])[:2], True))
                yield _batch(rows)

    return spark.read.parquet(path).select("bundle", "content").join(wanted, "bundle").select("content", "places").mapInArrow(run, _FIELDS)


def export_bundles(archive: DataFrame, folder: str) -> int:
    """Write bundles as plain .warc.zst files to a folder of the driver, one at a time; gives their number."""
    n = 0
    for row in archive.select("bundle", "content").toLocalIterator():
        Path(folder, row.bundle).write_bytes(row.content)
        n += 1
    return n
