"""MinHash near-duplicates: many universal hash minima with banding, signature verification, a check on
full shingle sets, and connected components by alternating large-star and small-star.

How hot groups are met: texts of equal words are one class from the start; within a bucket of
equal band minima every class is first compared with one leader only (the class that meets most others),
and only pairs whose classes are then still in different components are compared further, in blocks of
bounded size. No link that would join two components is left out, and no group is expanded into pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import LOWER, SPACE, Words, forget_plans, mix, runs_hash, slices, sorted_groups, stored, stored_alone, text_buffers, word_bounds

#: Rows of one side of a comparison block.
BLOCK = 512
_STEP, _STEP_2 = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


@dataclass(frozen=True)
class Scheme:
    """Bands of ``rows`` minima; so many that a pair at the threshold shares none with probability ``miss``."""

    shingle: int
    percent: int
    miss: float = 1e-5

    @property
    def rows(self) -> int:
        return 6 if self.percent >= 85 else 5

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def agreeing(self) -> int:
        """Equal minima that a linked pair has, but for about one in ten million at the threshold."""
        n, t = self.rows * self.bands, self.percent / 100
        return math.floor(n * t - 5.3 * math.sqrt(n * t * (1 - t)))


def _shingles(column: pa.Array, k: int) -> Iterator[tuple[np.ndarray, bytes | None]]:
    """The distinct shingle hashes of each text, sorted, and the BLAKE2 digest of all its words."""
    data, offsets = text_buffers(column)
    for at, to in slices(offsets):
        w = Words(data, offsets[at : to + 1], lower=True)
        every, (words, place) = runs_hash(w.hashes, k), w.joined()
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            if b == a:
                yield np.zeros(0, np.uint64), None
            else:  # fewer words than k: their whole sequence
                yield np.unique(every[a : b - k + 1]) if b - a >= k else runs_hash(w.hashes[a:b], b - a), blake2b(memoryview(words)[place[a] : place[b]], digest_size=16).digest()


def _exact_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted numbers that stand for their very words: equal shingles
    of any two of these texts have equal numbers, and no others have."""
    data, offsets = text_buffers(texts)
    low, offsets = LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
    begin, end = word_bounds(low, offsets)
    bounds = np.append(0, np.cumsum(end - begin))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(low[~SPACE[low]])]).dictionary_encode()
    code = word = words.indices.to_numpy().astype(np.int64)
    for j in range(1, k):
        code = pd.factorize(code[:-1] * len(words.dictionary) + word[j:])[0].astype(np.int64)
    first, short, out = np.searchsorted(begin, offsets), {}, []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k or b == a:
            out.append(np.unique(code[a : max(a, b - k + 1)]))
        else:
            out.append(np.array([-1 - short.setdefault(tuple(word[a:b].tolist()), len(short))]))
    return out


def _signatures(sets: list[np.ndarray], scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """(band hashes, a byte of each minimum) of non-empty sets."""
    n, r, b = len(sets), scheme.rows, scheme.bands
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    a = mix(np.arange(1, r * b + 1, dtype=np.uint64)) | np.uint64(1)
    c = mix(np.arange(1, r * b + 1, dtype=np.uint64) * _STEP)
    low, hashed = np.empty((r * b, n), np.uint64), np.empty_like(flat)
    for i in range(r * b):
        np.multiply(flat, a[i], out=hashed)
        np.add(hashed, c[i], out=hashed)
        low[i] = np.minimum.reduceat(hashed, starts)
    low = mix(low)
    bands = np.zeros((b, n), np.uint64)
    for i in range(r):
        bands = (bands ^ low[i::r][:b]) * _STEP + np.uint64(i + 1)
    return mix(bands + np.arange(1, b + 1, dtype=np.uint64)[:, None] * _STEP_2).T.copy(), (low & np.uint64(255)).astype(np.uint8).T.copy()


def _lists(matrix: np.ndarray) -> pa.Array:
    n, k = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(matrix.reshape(-1).view(np.int64)))


def features(docs: DataFrame, scheme: Scheme, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, digest, bands, sig) per row; digest is that of the text's words, and the last three
    are null where there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for size, found in _chunks(_shingles(batch.column(1), scheme.shingle)):
                full = [s for s, _ in found if len(s)]
                n = np.array([len(s) for s, _ in found], np.int64)
                bands = sig = pa.nulls(size)
                if full:
                    has = n > 0
                    b, s = _signatures(full, scheme)
                    where = pa.array(np.where(has, np.cumsum(has) - 1, 0), mask=~has)
                    bands, sig = _lists(b).take(where), pa.FixedSizeBinaryArray.from_buffers(pa.binary(s.shape[1]), len(s), [None, pa.py_buffer(s)]).cast(pa.binary()).take(where)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, size), pa.array(n), pa.array([d for _, d in found], pa.binary()), bands.cast(pa.list_(pa.int64())), sig.cast(pa.binary())], ["id", "n_shingles", "digest", "bands", "sig"])
                at += size

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "id long, n_shingles long, digest binary, bands array<long>, sig binary")


def _chunks(found: Iterator[tuple[np.ndarray, bytes | None]]) -> Iterator[tuple[int, list]]:
    """Runs of texts of about 400,000 shingles."""
    held, size = [], 0
    for x in found:
        held.append(x)
        size += len(x[0]) + 1
        if size > 400_000:
            yield len(held), held
            held, size = [], 0
    if held:
        yield len(held), held


def _leader_pairs(members: DataFrame) -> DataFrame:
    """(u, v): each class with the leader of each of its buckets, the class that meets most others."""
    met = members.groupBy("rep").agg(F.sum("m").alias("met"))
    leaders = stored(members.join(met, "rep").groupBy("key").agg(F.max(F.struct("met", (-F.col("rep")).alias("r"))).alias("best")).select("key", (-F.col("best.r")).alias("leader")), "minhash-leaders")
    return members.join(leaders, "key").where("rep != leader").select(F.col("rep").alias("u"), F.col("leader").alias("v")).distinct()


def _likely(pairs: DataFrame, reps: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs whose signatures agree often enough."""
    sigs = reps.select("rep", "sig")
    both = pairs.join(sigs.select(F.col("rep").alias("u"), F.col("sig").alias("su")), "u").join(sigs.select(F.col("rep").alias("v"), F.col("sig").alias("sv")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = scheme.rows * scheme.bands
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, width) for i in (2, 3))
                yield batch.select(["u", "v"]).filter(pa.array((a == b).sum(1) >= scheme.agreeing))

    return both.select("u", "v", "su", "sv").mapInArrow(run, "u long, v long")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on whole sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirm(pairs: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs that are linked by their full sets, compared word by word."""
    both = pairs.join(texts.select(F.col("rep").alias("u"), F.col("text").alias("tu")), "u").join(texts.select(F.col("rep").alias("v"), F.col("text").alias("tv")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = pa.compute.dictionary_encode(batch.column(3))
            size = pa.compute.binary_length(batch.column(2)).to_numpy().astype(np.int64)
            for a, b in slices(np.append(0, np.cumsum(size))):
                part, at = batch.slice(a, b - a), right.indices.to_numpy()[a:b]
                used, at = np.unique(at, return_inverse=True)
                sets = _exact_sets(pa.concat_arrays([part.column(2), right.dictionary.take(pa.array(used))]), scheme.shingle)
                keep = [_linked(s, sets[b - a + k], scheme.percent) for s, k in zip(sets[: b - a], at.tolist(), strict=True)]
                yield part.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return both.select("u", "v", "tu", "tv").mapInArrow(run, "u long, v long")


def _cross_links(members: DataFrame, parts: DataFrame, reps: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """Links between classes of one bucket that are in different components.

    A bucket's rows are dealt to blocks, and each pair of blocks is one group of at most 2 * BLOCK rows.
    A pair is looked at in the first bucket that it shares, and not at all once a chain of links found in
    the group joins its ends. Signatures are compared first; texts are sent only for the rows of a group
    that are likely to have a link there.
    """
    rows = members.where("m > 2").join(parts, members["rep"] == parts["id"], "left").select("key", "rep", "m", F.coalesce("component_id", "rep").alias("part"))
    rows = stored(rows, "minhash-parts")
    mixed = stored(rows.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a != b").select("key"), "minhash-mixed")
    rows = rows.join(mixed, "key").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep", "key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", "rep", "part", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = rows.join(reps.select("rep", "bands", "sig"), "rep")
    keys = ["key", "low", "high"]
    kept = ["key", "low", "high", "own", "rep", "part", "bands", "sig"]

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, keys):
            some = sorted({k for _, i, j in _likely_pairs(group, scheme) for k in (i, j)})
            if some:
                yield from group.take(some).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, keys):
            found = _group_links(group, scheme)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["u", "v"])

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys, "part", "rep")

    rows = rows.select(*kept)
    some = stored(dealt(rows).mapInArrow(sift, rows.schema), "minhash-likely")
    return dealt(some.join(texts, "rep")).select(*kept, "text").mapInArrow(run, "u long, v long").distinct()


def _likely_pairs(group: pa.Table, scheme: Scheme) -> list[tuple[int, int, int]]:
    """(minus the number of equal minima, row, row) for rows of different components whose signatures agree
    often enough, in the first bucket that the two share."""
    key, low, high = (group.column(k)[0].as_py() for k in ("key", "low", "high"))
    part, own = (group.column(k).to_numpy() for k in ("part", "own"))
    if len(part) < 2 or (part == part[0]).all():
        return []
    bands = np.array(group.column("bands").combine_chunks().flatten()).reshape(len(part), -1)
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(part), -1)
    likely = []
    for i in range(len(part)):
        other = np.arange(i + 1, len(part))
        other = other[part[i + 1 :] != part[i]]
        if low != high:
            other = other[own[other] != own[i]]
        if len(other):
            agree = (sig[other] == sig[i]).sum(1)
            other, agree = other[agree >= scheme.agreeing], agree[agree >= scheme.agreeing]
        if len(other):
            equal = bands[other] == bands[i]
            mine = bands[i][equal.argmax(1)] == key
            likely += [(-n, i, j) for n, j in zip(agree[mine].tolist(), other[mine].tolist(), strict=True)]
    return sorted(likely)  # the likeliest first: they join most


def _group_links(group: pa.Table, scheme: Scheme) -> list[tuple[int, int]]:
    rep, part = (group.column(k).to_numpy() for k in ("rep", "part"))
    texts, sets, root = group.column("text").combine_chunks(), {}, {p: p for p in part.tolist()}

    def set_of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = next(_shingles(texts.slice(i, 1), scheme.shingle))[0]
        return sets[i]

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    out = []
    for _, i, j in _likely_pairs(group, scheme):
        a, b = find(int(part[i])), find(int(part[j]))
        # hashes first; what they link is compared word by word
        if a != b and _linked(set_of(i), set_of(j), scheme.percent) and _linked(*_exact_sets(texts.take(pa.array([i, j])), scheme.shingle), scheme.percent):
            root[a] = b
            out.append((int(rep[i]), int(rep[j])))
    return out


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Texts are linked where 100 * intersection >= percent * union of their sets of distinct shingles of
    ``shingle`` words (A-Z lowered); fewer words are one shingle. Null, empty and wordless texts have an
    empty set and are linked with nothing; so is a row with a null id, whose component is null. Rows that
    repeat an id are one document: they share its component, and where their texts differ, links of either
    text count. An empty table gives an empty result; other columns are not read. ``kept`` marks
    the smallest id of each component. Ids are read as bigint.
    """
    scheme = Scheme(shingle, percent)
    rows = stored(features(docs, scheme, id_col, text_col), "minhash-features")
    full = rows.where("id IS NOT NULL AND n_shingles > 0")
    reps = stored(full.groupBy("digest").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "minhash-classes")
    banded = reps.select("rep", F.explode("bands").alias("key"))
    buckets = stored(banded.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "minhash-buckets")
    members = stored(banded.join(buckets, "key"), "minhash-members")
    forget_plans(docs.sparkSession)
    pairs = stored(_likely(_leader_pairs(members), reps, scheme), "minhash-pairs")
    near = members.where("m > 2").select("rep").unionByName(pairs.select(F.col("u").alias("rep"))).unionByName(pairs.select(F.col("v").alias("rep"))).distinct()
    texts = stored(docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).where("text IS NOT NULL").join(near, "rep", "left_semi").dropDuplicates(["rep", "text"]), "minhash-texts")
    links = stored(_confirm(pairs, texts, scheme), "minhash-links")
    forget_plans(docs.sparkSession)
    parts = connected_components(links)
    more = _cross_links(members, stored(parts, "minhash-components"), reps, texts, scheme)
    links = links.unionByName(more)
    forget_plans(docs.sparkSession)
    # an id that stands for several classes, or repeats with several texts, ties them together
    repeated = full.join(reps, "digest").select(full["id"].alias("u"), reps["rep"].alias("v")).where("u != v").distinct()
    parts = connected_components(links.unionByName(repeated))
    out = rows.join(parts, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose document is kept by ``near_duplicates``."""
    gone = stored_alone(lambda: near_duplicates(docs, shingle, percent, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("__gone")).distinct(), "minhash-gone")
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
