"""Removal of repeated passages with a log-structured fingerprint index.

A window is ``length`` consecutive words. Every window is represented in the index by the least hash of
the short word runs inside it (its anchor): equal windows have equal anchors, and neighbouring windows
share one, so a run holds about one row for seven windows and still misses none. The index is a log of
immutable runs, one for each batch, in buckets sorted by fingerprint. A batch's fingerprints are
merge-joined with the buckets of each run, which are not shuffled; what repeated fingerprints stand for is
then verified by 128-bit BLAKE2 digests of the very words: first of all words that an anchor's windows
span, and where these differ, of each window. The words of earlier batches come from texts that the log
keeps, in buckets by id and CRC: what is to be verified goes to them, and they are not shuffled again.
``compact`` merges runs.

How hot passages are met: fingerprints are counted with partial sums, the join with repeated ones has
one row a fingerprint on one side, which lets Spark split the other, and equal stretches of one batch of
rows are settled there, so that a hot passage leaves it once. A run of the log gets equal stretches of a
slice of texts once, since the first serves later batches as well as all; a fingerprint's rows beyond
``HOT_ROWS`` of one batch of rows go to buckets of their own.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Words, delete_path, forget_plans, mix, runs_hash, scratch_path, slices, stored, stored_alone, text_buffers

#: Words of the runs that anchor a window.
ANCHOR = 6
#: Rows that are settled at once: they bound a task's arrays.
SETTLED_ROWS = 1 << 19


def _window_anchors(w: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash of each run, starts of the windows that lie in one document, word of each one's anchor)"""
    n, k = len(w.hashes), min(ANCHOR, length)
    span = length - k + 1
    ends = np.repeat(w.first[1:], np.diff(w.first))
    starts = np.flatnonzero(np.arange(n) + length <= ends)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    runs = runs_hash(w.hashes, k)
    low, width = runs, 1
    while 2 * width <= span:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    at = np.zeros(len(low), np.int64)
    for o in range(span - 1, -1, -1):  # the leftmost of equal hashes
        at[runs[o : o + len(low)] == low] = o
    return runs, starts, starts + at[starts]


def _first_alike(w: Words, runs: np.ndarray, starts: np.ndarray, anchor: np.ndarray, length: int) -> np.ndarray:
    """The anchors without those whose windows span the very words that an earlier anchor's windows span."""
    head = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))  # an anchor's windows start at neighbouring words
    begin, end, at = starts[head], starts[np.append(head[1:], len(starts)) - 1] + length, anchor[head]
    _, group, count = np.unique(runs[at], return_inverse=True, return_counts=True)
    alike = np.flatnonzero(count[group] > 1)
    if not len(alike):
        return at
    d1, d2 = _digests(*w.joined(), begin[alike], end[alike])
    order = np.lexsort((d2, d1))  # stable
    again = np.append(False, (d1[order][1:] == d1[order][:-1]) & (d2[order][1:] == d2[order][:-1]))
    return np.delete(at, alike[order[again]])


def fingerprints(docs: DataFrame, length: int, once: bool = False) -> DataFrame:
    """(fp, id, crc, pos): the anchors of each text's windows. ``docs`` has id and text; crc is the text's
    CRC-32, which tells rows of one id apart. With ``once``, of anchors in a slice of texts whose windows span
    the same words only the first is given: it stands for all to those that come later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                w = Words(data, offsets[a : b + 1])
                runs, starts, anchor = _window_anchors(w, length)
                anchor = _first_alike(w, runs, starts, anchor, length) if once and len(starts) else np.unique(anchor)
                row = np.searchsorted(w.first, anchor, "right") - 1
                crc = np.array([zlib.crc32(data[offsets[i] : offsets[i + 1]]) for i in range(a, b)], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(runs[anchor].view(np.int64)), batch.column(0).take(pa.array(row + a)), pa.array(crc[row]), pa.array((anchor - w.first[row]).astype(np.int32))], ["fp", "id", "crc", "pos"])

    return docs.select("id", "text").mapInArrow(run, "fp long, id long, crc long, pos int")


#: Rows of one fingerprint, in a batch of rows, that go to one bucket of a run.
HOT_ROWS = 1000
_ANCHORS, _TEXTS = "key long, fp long, id long, crc long, pos int, batch long, salt int", "key long, id long, text string, crc long"


def _with_crc(docs: DataFrame) -> DataFrame:
    """``docs`` with the CRC-32 of ``text`` (null: of the empty text), which tells rows of one id apart."""
    return docs.withColumn("crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))


def _key(fp: Column, salt: Column) -> Column:
    return F.when(salt == 0, fp).otherwise(F.xxhash64(fp, salt))


def _salted(anchors: DataFrame) -> DataFrame:
    """Anchors with ``salt``, which counts a fingerprint's rows in each batch of rows by ``HOT_ROWS``, and the
    ``key`` that follows from both."""
    most = HOT_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            order = np.argsort(fp, kind="stable")
            new = np.append(True, fp[order][1:] != fp[order][:-1]) if len(fp) else np.zeros(0, bool)
            at = np.arange(len(fp))
            salt = np.empty(len(fp), np.int32)
            salt[order] = (at - np.maximum.accumulate(np.where(new, at, 0))) // most
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(salt)], ["fp", "id", "crc", "pos", "batch", "salt"])

    rows = anchors.select("fp", "id", "crc", "pos", "batch").mapInArrow(run, "fp long, id long, crc long, pos int, batch long, salt int")
    # a key that is the fingerprint is not written twice
    own = F.when(F.col("salt") > 0, F.col("fp")).alias("fp")
    return rows.select(_key(F.col("fp"), F.col("salt")).alias("key"), own, "id", "crc", "pos", "batch", "salt")


class FingerprintIndex:
    """The log: folders run-00000-B, run-00001-B, ... under ``path``, where B is the number of buckets. Each
    holds anchors, in buckets by key and sorted by it, and the names of its batches; merging runs rewrites
    these alone. Folders texts-N-B hold the texts of batch N, in buckets by a key made from their id and CRC, and stay
    as they are. A batch's own rows never count as earlier ones, and a batch that the log holds is
    not added again, so that sending a batch twice, as after a failure, gives the same result."""

    def __init__(self, spark: SparkSession, path: str, length: int = 20, most_runs: int = 8, buckets: int | None = None):
        self.spark, self.path, self.length, self.most_runs = spark, path, length, most_runs
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[str]:
        """Complete runs, oldest first: their anchors are written last."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = [s.getPath() for s in fs.listStatus(path(self.path))] if fs.exists(path(self.path)) else []
        return sorted(p.toString() for p in done if p.getName().startswith("run-") and fs.exists(path(p, "anchors/_SUCCESS")))

    def batches(self) -> set[int]:
        """The batches of all runs: one number a batch that was ever sent."""
        runs = self.runs()
        return {r.batch for r in self.spark.read.schema("batch long").parquet(*(f"{r}/batches" for r in runs)).collect()} if runs else set()

    def _read(self, folder: str, buckets: int, columns: str) -> DataFrame:
        """A folder of the log with its buckets, which only a catalog table makes known; it is dropped once read,
        and its files stay."""
        name = f"tidemark_log_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{folder}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _anchors(self, run: str) -> DataFrame:
        return self._read(f"{run}/anchors", int(run.rsplit("-", 1)[1]), _ANCHORS)

    def _write(self, rows: DataFrame, folder: str) -> None:
        name = f"tidemark_log_{uuid.uuid4().hex[:12]}"
        try:
            rows.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key").option("path", folder).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _add(self, anchors: DataFrame, batches: set[int]) -> None:
        runs = self.runs()
        run = f"{self.path}/run-{int(runs[-1].rsplit('-', 2)[1]) + 1 if runs else 0:05d}-{self.buckets}"
        delete_path(self.spark, run)  # what a crash may have left of it
        self.spark.createDataFrame([(b,) for b in sorted(batches)], "batch long").coalesce(1).write.parquet(f"{run}/batches")
        self._write(anchors, f"{run}/anchors")

    def append(self, docs: DataFrame, anchors: DataFrame, batch: int) -> None:
        """Add a batch (id, text) and its anchors (fp, id, crc, pos) as a run, unless the log has it."""
        if batch not in self.batches():
            texts = f"{self.path}/texts-{batch}-{self.buckets}"
            delete_path(self.spark, texts)
            self._write(_with_crc(docs.select("id", "text")).select(F.xxhash64("id", "crc").alias("key"), "id", "text", "crc"), texts)
            self._add(_salted(anchors.select("*", F.lit(batch).cast("long").alias("batch"))), {batch})

    def matches(self, fps: DataFrame, batch: int) -> DataFrame:
        """(fp, id, crc, pos) of the anchors, of other batches than ``batch``, of the distinct fingerprints
        ``fps`` (fp). Runs are read bucket by bucket, in place; only ``fps`` is dealt to the buckets."""
        found = []
        for run in self.runs():
            rows = self._anchors(run).where(F.col("batch") != batch)
            # rows are only kept or not, never joined; the same exchange of the batch serves all runs
            found.append(rows.where("salt = 0").drop("fp").join(fps.select(F.col("fp").alias("key")).hint("merge"), "key", "left_semi").withColumnRenamed("key", "fp"))
            more = rows.where("salt > 0")
            if not more.isEmpty():
                hot = more.groupBy("fp").agg(F.max("salt").alias("most"))
                wanted = fps.join(hot, "fp").select(F.col("fp").alias("wanted"), F.explode(F.sequence(F.lit(1), "most")).alias("s"))
                wanted = wanted.select(_key(F.col("wanted"), F.col("s")).alias("wanted_key"), "wanted").hint("merge")
                # an equality as such would become a key of the join, which the buckets do not serve
                found.append(more.join(wanted, (F.col("key") == F.col("wanted_key")) & (F.col("fp").bitwiseXOR(F.col("wanted")) == 0), "left_semi"))
        return reduce(DataFrame.unionByName, [x.select("fp", "id", "crc", "pos") for x in found])

    def with_texts(self, lists: DataFrame, batch: int) -> list[DataFrame]:
        """For each batch of the log but ``batch``: the rows of ``lists`` (pid, pcrc and others; one a text) that belong to
        a text of that batch, with it (id, text). Texts are read bucket by bucket, in place; only ``lists`` is dealt
        to the buckets."""
        wanted = lists.withColumn("key", F.xxhash64("pid", "pcrc"))
        known = {str(b) for b in self.batches()} - {str(batch)}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName().split("-") for s in fs.listStatus(path(self.path))]
        folders = [(f"{self.path}/{'-'.join(n)}", int(n[2])) for n in names if n[0] == "texts" and n[1] in known]
        # two texts may share a key by chance; equalities as such would become keys of the join, which the buckets do not serve
        same = ((F.col("id").isNull() & F.col("pid").isNull()) | (F.col("id").bitwiseXOR(F.col("pid")) == 0)) & (F.col("crc").bitwiseXOR(F.col("pcrc")) == 0)
        return [self._read(folder, buckets, _TEXTS).join(wanted.hint("merge"), "key").where(same) for folder, buckets in folders]

    def compact(self) -> None:
        """Merge the anchors of all runs into one run. Old runs go once the new one is complete; a run that a crash leaves behind
        repeats rows, which changes no result."""
        runs = self.runs()
        if len(runs) > 1:
            self._add(reduce(DataFrame.unionByName, map(self._anchors, runs)), self.batches())
            for run in runs:
                delete_path(self.spark, run)


_PLACED = "fp long, d1 long, d2 long, age int, id long, loc long, n int"


def _digests(joined: bytes, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit BLAKE2 digests (two rows) of the words begin .. end - 1, one space between them."""
    words, hashed, out = memoryview(joined), blake2b, bytearray()
    for k in range(0, len(begin), 8192):
        for a, b in zip(at[begin[k : k + 8192]].tolist(), (at[end[k : k + 8192]] - 1).tolist(), strict=True):
            out += hashed(words[a:b], digest_size=16).digest()
    return np.frombuffer(out, "<i8").reshape(-1, 2).T


def _read(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(Words, row of each listed place, the places, ids, nulls, ages, CRCs of the texts) for slices of a
    batch of (id, text, age, places)."""
    data, offsets = text_buffers(batch.column(1))
    ids, null = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
    ages, lists = batch.column(2).to_numpy(), batch.column(3)
    values, bounds = lists.values, lists.offsets.to_numpy()
    for a, b in slices(offsets):
        w = Words(data, offsets[a : b + 1])
        row = np.repeat(np.arange(b - a), np.diff(bounds[a : b + 1]))
        crc = np.array([zlib.crc32(data[offsets[i] : offsets[i + 1]]) for i in range(a, b)], np.int64)
        yield w, row, values.slice(bounds[a], bounds[b] - bounds[a]), ids[a:b], null[a:b], ages[a:b], crc


def _units(docs: DataFrame, length: int) -> DataFrame:
    """The windows behind the anchors in ``pos``, all of an anchor as one unit: fingerprint, 128-bit digest
    of the words that its windows span, and place. loc is the first window's word number times 2**32 plus
    the text's CRC, which tells rows of one id apart; n is the number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for w, row, pos, ids, null, ages, crc in _read(batch):
                runs, starts, anchor = _window_anchors(w, length)
                word = w.first[row] + pos.to_numpy()
                wanted = np.zeros(len(w.hashes), bool)
                wanted[word[word < w.first[row + 1]]] = True
                if not len(starts):
                    continue
                # an anchor's windows start at neighbouring words
                head = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)))
                n = np.diff(np.append(head, len(starts)))
                head, n = head[wanted[anchor[head]]], n[wanted[anchor[head]]]
                begin, at = starts[head], anchor[head]
                end, shift = begin + n + length - 1, (at - begin).astype(np.uint64)
                d1, d2 = _digests(*w.joined(), begin, end)
                d1 = mix(d1.view(np.uint64) + shift).view(np.int64)
                r = np.searchsorted(w.first, begin, "right") - 1
                parts.append((runs[at].view(np.int64), d1, d2, ages[r], ids[r], null[r], ((begin - w.first[r]) << 32) | crc[r], n))
                if sum(len(x[0]) for x in parts) > SETTLED_ROWS:
                    yield _settled(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                    parts = []
            if parts:
                yield _settled(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    return docs.select("id", "text", "age", "pos").mapInArrow(run, _PLACED)


def _windows(docs: DataFrame, length: int) -> DataFrame:
    """The single windows of the units in ``units`` (loc, n), in the form of ``_units``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for w, row, units, ids, null, ages, crc in _read(batch):
                loc, n = (units.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                mine = (loc & 0xFFFFFFFF) == crc[row]
                row, loc, n = row[mine], loc[mine], n[mine]
                begin = np.repeat(w.first[row] + (loc >> 32), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                r = np.repeat(row, n)
                d1, d2 = _digests(*w.joined(), begin, begin + length)
                parts.append((d1, d1, d2, ages[r], ids[r], null[r], ((begin - w.first[r]) << 32) | crc[r], np.ones(len(r), np.int64)))
                if sum(len(x[0]) for x in parts) > SETTLED_ROWS:
                    yield _settled(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                    parts = []
            if parts:
                yield _settled(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    # other columns come along unread, so that the texts' exchange can serve another join too
    return docs.select("id", "text", "age", "units", *(c for c in docs.columns if c == "rest")).mapInArrow(run, _PLACED)


def _first_place(new: np.ndarray, age: np.ndarray, ids: np.ndarray, null: np.ndarray, loc: np.ndarray) -> np.ndarray:
    """Of rows sorted within groups that begin at ``new``: whether a row starts where its group's first does."""
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return (age == age[first]) & (ids == ids[first]) & (null == null[first]) & ((loc >> 32) == (loc[first] >> 32))


def _settled(fp: np.ndarray, d1: np.ndarray, d2: np.ndarray, age: np.ndarray, ids: np.ndarray, null: np.ndarray, loc: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """The rows of a batch, in which those that an earlier row of the batch equals are settled: neighbours
    become one row, n becomes negative, and they are dealt by their place instead of their words."""
    order = np.lexsort((loc, ids, ~null, age, d2, d1, fp))
    fp, d1, d2, age, ids, null, loc, n = (x[order] for x in (fp, d1, d2, age, ids, null, loc, n))
    new = np.ones(len(fp), bool)
    new[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]) | (fp[1:] != fp[:-1])
    again = ~_first_place(new, age, ids, null, loc)
    left = ~again
    again &= age > 0
    i, z, p, m = ids[again], null[again], loc[again], n[again]
    order = np.lexsort((p >> 32, p & 0xFFFFFFFF, i, z))
    i, z, p, m = i[order], z[order], p[order], m[order]
    if len(i):
        apart = np.append(True, (i[1:] != i[:-1]) | (z[1:] != z[:-1]) | (p[1:] != p[:-1] + (m[:-1] << 32)))
        m = np.add.reduceat(m, np.flatnonzero(apart))
        i, z, p = i[apart], z[apart], p[apart]
    zero = np.zeros(len(i), np.int64)
    spread = mix(p.view(np.uint64) ^ mix(i.view(np.uint64))).view(np.int64)
    both = [np.concatenate(x) for x in ((fp[left], spread), (d1[left], zero), (d2[left], zero), (age[left], zero + 1), (ids[left], i), (null[left], z), (loc[left], p), (n[left], -m))]
    fp, d1, d2, age, ids, null, loc, n = both
    return pa.RecordBatch.from_arrays([pa.array(fp), pa.array(d1), pa.array(d2), pa.array(age.astype(np.int32)), pa.array(ids, mask=null), pa.array(loc), pa.array(n.astype(np.int32))], ["fp", "d1", "d2", "age", "id", "loc", "n"])


def _judged(placed: DataFrame) -> DataFrame:
    """(id, age, loc, n, deep) from rows of ``_units`` or ``_windows``: with ``deep`` false, the batch's rows
    that equal an earlier one; with ``deep`` true, the first row of each digest where a fingerprint has
    several digests (never for single windows, whose fingerprint is their digest).

    Rows come sorted by fingerprint, digest and place; only the first rows of the fingerprint and of the
    digest that a stream's batch ended in are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        told = False  # whether the held fingerprint's first row has been given
        for batch in batches:
            if not batch.num_rows:
                continue
            fp, d1, d2, age, loc, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 3, 5, 6))
            ids, null = batch.column(4).fill_null(0).to_numpy(), batch.column(4).is_null().to_numpy(zero_copy_only=False)
            columns = [np.concatenate([np.array(x, y.dtype), y]) for x, y in zip(zip(*held, strict=True) if held else [()] * 8, (fp, d1, d2, age, ids, null, loc, n), strict=True)]
            fp, d1, d2, age, ids, null, loc, n = columns
            old = len(held)
            settled = n < 0
            new_fp = np.append(True, (fp[1:] != fp[:-1]) | settled[1:] | settled[:-1])
            new = new_fp | np.append(True, (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))
            again = (settled | ~_first_place(new, age, ids, null, loc)) & (age > 0)
            again[:old] = False
            group = np.cumsum(new_fp) - 1
            several = np.bincount(group, new) > 1
            deep = new & several[group] & ~settled
            if old:  # the first may have got company; the second has been given
                deep[0] &= not told
                deep[1:old] = False
            last_fp, last = np.flatnonzero(new_fp)[-1], np.flatnonzero(new)[-1]
            told = bool(several[-1])
            held = [tuple(c[k] for c in columns) for k in dict.fromkeys((last_fp, last))]
            out = np.flatnonzero(again | deep)
            yield pa.RecordBatch.from_arrays([pa.array(ids[out], mask=null[out]), pa.array(age[out].astype(np.int32)), pa.array(loc[out]), pa.array(np.abs(n[out]).astype(np.int32)), pa.array(deep[out])], ["id", "age", "loc", "n", "deep"])

    order = [F.col("d1"), F.col("d2"), F.col("age"), F.col("id").asc_nulls_first(), F.col("loc")]
    dealt = placed.repartition("fp").sortWithinPartitions("fp", F.col("n") < 0, *order)
    return dealt.mapInArrow(run, "id long, age int, loc long, n int, deep boolean")


#: A word with the white space before it.
_SPACED = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")


def _without(docs: DataFrame, length: int, spaced: bool) -> DataFrame:
    """(id, n_words, n_removed, kept_text, rest) from documents with the places of their repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                total, gone, kept = [], [], []
                valid = batch.column(2).is_valid().to_pylist()
                for i in range(a, b):
                    text = data[offsets[i] : offsets[i + 1]].tobytes()
                    words, removed = text.split(), 0
                    n = len(words)
                    if valid[i]:
                        loc, runs = (batch.column(2)[i].values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                        mine = (loc & 0xFFFFFFFF) == zlib.crc32(text)
                        at, runs = loc[mine] >> 32, runs[mine]
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + runs + length - 1, -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        removed = n - int(stay.sum())
                        if removed:
                            words = [x for x, s in zip(_SPACED.findall(text) if spaced else words, stay.tolist(), strict=True) if s]
                    total.append(n)
                    gone.append(removed)
                    kept.append((text if not removed else b"".join(words)).decode() if spaced else b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), batch.column(3).slice(a, b - a)], ["id", "n_words", "n_removed", "kept_text", "rest"])

    source = docs.select("id", "text", "locs", "rest")
    return source.mapInArrow(run, T.StructType().add("id", "long").add("n_words", "long").add("n_removed", "long").add("kept_text", "string").add(source.schema["rest"]))


def batch_number(name: str) -> int:
    """The number by which the log knows a batch."""
    return int.from_bytes(hashlib.sha256(name.encode()).digest()[:7])


def remove_repeats(docs: DataFrame, length: int = 20, index: FingerprintIndex | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), spaced: bool = False, batch_name: str | None = None, add: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_text) and the columns ``keep``: each row of ``docs`` without the words covered by a window
    whose word sequence also starts earlier: in a document of an earlier batch that ``index`` has seen, in
    one of a smaller id, or further to the front of the same document. Windows are judged on the input.
    kept_text has one space between words or, if ``spaced``, the white space that stood before them.

    The batch's fingerprints are written as a run, and merged with themselves and with the runs of
    ``index``, if one is given; it is compacted first when it has too many runs, and then keeps the batch for
    later ones, unless ``add`` is false and the caller appends it once the result is written. ``batch_name``
    makes a batch that is sent again the same batch: without one, every call is a new batch. A null, empty or wordless text has 0 words and an empty kept_text; a null id is
    smaller than all others; rows that repeat an id are one document, and none of them is earlier than
    another at the same word; texts with fewer than ``length`` words stay whole; an empty table gives an
    empty result; other columns are not read. Ids are read as bigint.
    """
    if index is not None and index.length != length:
        raise ValueError(f"the index holds windows of {index.length} words")

    number = batch_number(batch_name or uuid.uuid4().hex)
    if index and len(index.runs()) >= index.most_runs:
        index.compact()
        forget_plans(docs.sparkSession)
    old = index.runs() if index else []
    rest = F.struct(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.lit(1).alias("one")).alias("rest")
    batch = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *([rest] if keep else []))
    # each task sorts what it has read: nothing is shuffled to write the batch's run
    run = stored(fingerprints(batch, length).sortWithinPartitions("fp"), "fingerprints")
    every = run.withColumn("age", F.lit(1))
    if old:
        earlier = stored(index.matches(run.select("fp").distinct(), number), "matches")
        every = every.unionByName(earlier.withColumn("age", F.lit(0)))
    if index and add:
        index.append(batch.select("id", "text"), fingerprints(batch, length, once=True), number)
    # at least one occurrence must be new for anything to be removed
    repeated = stored(every.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.max("age").alias("newest")).where("n > 1 AND newest = 1").select("fp"), "repeated-fingerprints")
    forget_plans(docs.sparkSession)
    batch = _with_crc(batch)
    at = F.col("id").eqNullSafe(F.col("pid")) & (F.col("crc") == F.col("pcrc"))

    def listed(rows: DataFrame, item: Column, crc: Column, name: str) -> DataFrame:
        # a list belongs to one text of an id, and repeated rows of that text share it: it never outgrows the text
        return rows.groupBy(F.col("id").alias("pid"), crc.alias("pcrc")).agg(F.collect_set(item).alias(name))

    def with_texts(new: DataFrame, earlier: DataFrame, carried: tuple[str, ...]) -> DataFrame:
        """Lists of the batch and of earlier ones, each with its text and age."""
        parts = [batch.join(new, at).withColumn("age", F.lit(1))]
        parts += [x.withColumn("age", F.lit(0)) for x in (index.with_texts(earlier, number) if old else [])]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (x.select(*(c for c in ("id", "text", "age", *carried) if c in x.columns)) for x in parts))

    places = [listed(rows.join(repeated, "fp"), F.col("pos"), F.col("crc"), "pos") for rows in (run, earlier if old else run)]
    # written: what is left to do reads it three times, and the exchanges behind it may go
    units = stored(_judged(_units(with_texts(*places, ("pos",)), length)), "units")
    forget_plans(docs.sparkSession)
    loc = F.col("loc").bitwiseAND(F.lit((1 << 32) - 1)), "units"
    deep = [listed(units.where(F.col("deep") & (F.col("age") == age)), F.struct("loc", "n"), *loc) for age in (1, 0)]
    # the texts' exchange serves this join and the last one: it has the same columns in both
    single = _judged(_windows(with_texts(*deep, ("units", "rest")), length))
    repeats = listed(units.where("NOT deep").unionByName(single.where("NOT deep")), F.struct("loc", "n"), loc[0], "locs")
    marked = batch.join(repeats, at, "left")
    out = _without(marked if keep else marked.withColumn("rest", rest), length, spaced)
    out = out.select("id", "n_words", "n_removed", "kept_text", *(F.col(f"rest.k{i}").alias(f"__k{i}") for i in range(len(keep))))
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_text", *(F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)))


def remove_repeats_in_batches(docs: DataFrame, length: int = 20, batches: int = 3, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), spaced: bool = False, digest: bool = False) -> DataFrame:
    """``remove_repeats`` of a whole table through an index of its own: ranges of ids of about equal size go
    in as batches, smaller ids first, so that earlier batches hold the earlier documents. The index is
    compacted before the last batch, which is not added to it. With ``digest``, kept_text is replaced by its SHA-256 (kept_sha256).

    Null ids are in the first batch, and all rows of an id in one. Each batch's result is written down; its
    intermediate tables, and the index at the end, go again."""
    spark = docs.sparkSession
    index = FingerprintIndex(spark, scratch_path(spark, "fingerprint-index"), length, most_runs=max(batches - 1, 1))
    id_ = F.col(f"`{id_col}`").cast("long")
    cuts = docs.agg(F.percentile_approx(id_, [k / batches for k in range(1, batches)], 10_000).alias("q")).first().q if batches > 1 else []
    bounds, done = sorted(set(cuts or [])), []
    for k in range(len(bounds) + 1):
        low = (id_ > bounds[k - 1]) if k else F.lit(True)
        high = (id_ <= bounds[k]) if k < len(bounds) else F.lit(True)
        part = docs.where((low & high) | (id_.isNull() if k == 0 else F.lit(False)))

        def batch(part: DataFrame = part, k: int = k) -> DataFrame:
            out = remove_repeats(part, length, index, id_col, text_col, keep, spaced, f"batch {k}", add=False)
            return out.withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text") if digest else out

        done.append(stored_alone(batch, "batch"))
        forget_plans(spark)
        if k < len(bounds):  # nothing is looked up once the last batch is done
            plain = part.select(id_.alias("id"), F.col(f"`{text_col}`").alias("text"))
            index.append(plain, fingerprints(plain, length, once=True), batch_number(f"batch {k}"))
            forget_plans(spark)
    delete_path(spark, index.path)
    return reduce(DataFrame.unionByName, done)
