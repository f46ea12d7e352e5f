"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots), in order. Inverted lists by label and
pivot bring together the descriptions of vectors that share a pivot, and the shared ones are counted; only
vectors of pairs that share enough are then fetched, and verified by the exact cosine. Each pair is looked
at in one list only: that of the least pivot they share.

How hot groups are met: equal vectors of one label are one class with a weight; a long list is dealt to
blocks, and every pair of blocks is one group of bounded size, which gives link counts and a spanning
forest instead of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .shared import sorted_groups, stored

#: Rows of one side of a comparison block.
BLOCK = 1024
#: Pivots are at most so many, and of so many bytes (they are broadcast, and their sample is read by the
#: driver); no two are closer than this. Beyond 67 million vectors lists grow with their number.
MOST_PIVOTS, MOST_PIVOT_BYTES, APART = 32_768, 64 << 20, 0.9
#: Similarities of vectors and pivots that are held at once.
SIMILARITIES = 4 << 20


def _usable(vector: str) -> F.Column:
    """No null, infinite or NaN component, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Unit vectors in double precision; shorter lists end in zeros, which change no cosine. Components are
    scaled by the largest first: the squares of very large and very small ones then neither overflow nor
    vanish."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    x = np.zeros((len(column), width))
    x[np.arange(width) < lengths[:, None]] = flat
    x /= np.abs(x).max(1, initial=0)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def choose_pivots(classes: DataFrame, n: int, width: int, per_root: float = 4.0) -> np.ndarray:
    """Up to ``per_root * sqrt(n)`` pivots, at most ``MOST_PIVOTS``: a bounded sample of the vectors in the
    order of a hash of their ids, of which those too close to an earlier one are left out."""
    most = min(MOST_PIVOTS, max(1, MOST_PIVOT_BYTES // (4 * width)))
    wanted = int(min(most, max(16, math.ceil(per_root * math.sqrt(n)))))
    rows = classes.select("rep", "vector").orderBy(F.xxhash64("rep"), "rep").limit(2 * wanted).select("vector").toArrow()
    x = _matrix(rows.column(0).combine_chunks(), width)
    free = np.ones(len(x), bool)
    chosen = []
    for i in range(len(x)):
        if free[i]:
            chosen.append(i)
            free[i + 1 :] &= x[i + 1 :] @ x[i] < APART
            if len(chosen) == wanted:
                break
    return x[chosen]


def _described(classes: DataFrame, pivots: np.ndarray, nearest: int) -> DataFrame:
    """``classes`` with ``near``: the numbers of its nearest pivots, nearest first."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        k, step = min(nearest, len(p)), max(16, SIMILARITIES // len(p))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                sims = _matrix(batch.column(3), p.shape[1]).astype(np.float32) @ p.T
                np.negative(sims, out=sims)
                top = np.argpartition(sims, k - 1, axis=1)[:, :k]
                top = np.take_along_axis(top, np.argsort(np.take_along_axis(sims, top, 1), axis=1, kind="stable"), 1).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, top.size + 1, k, dtype=np.int32)), pa.array(top.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(4), lists], ["rep", "label", "size", "weight", "near"])

    rows = classes.select("rep", "label", "size", "vector", "weight")
    return rows.mapInArrow(run, "rep long, label string, size int, weight long, near array<int>")


_LIST = ["label", "size", "pivot", "low", "high"]


def _verified(classes: DataFrame, described: DataFrame, threshold: float, shared_pivots: int) -> DataFrame:
    """(rep, links, root) of every class with links in a group; a class may come up in several groups."""
    posted = described.select("label", "size", F.explode("near").alias("pivot"), "rep", "weight", "near")
    sizes = stored(posted.groupBy("label", "size", "pivot").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "pivot-lists")
    rows = posted.join(sizes, ["label", "size", "pivot"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep", "pivot"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    kept = [*_LIST, "own", "rep", "weight", "near"]
    rows = rows.select("label", "size", "pivot", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "rep", "weight", "near")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, _LIST):
            if group.num_rows > 1:
                some = np.flatnonzero(_sharing(group, shared_pivots).any(1))
                if len(some):
                    yield from group.take(pa.array(some)).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, _LIST):
            found = _group_links(group, threshold, shared_pivots)
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["rep", "links", "root"])

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(*_LIST).sortWithinPartitions(*_LIST, "rep")

    rows = rows.select(*kept)
    likely = stored(dealt(rows).mapInArrow(sift, rows.schema), "pivot-likely")
    whole = likely.join(classes.select("rep", "vector"), "rep")
    return dealt(whole).select(*kept, "vector").mapInArrow(run, "rep long, links long, root long")


def _sharing(group: pa.Table, shared_pivots: int) -> np.ndarray:
    """For each two rows of a list's group: whether they share enough pivots, none less than the list's."""
    pivot, low, high = (group.column(k)[0].as_py() for k in ("pivot", "low", "high"))
    own = group.column("own").to_numpy()
    near = group.column("near").combine_chunks().flatten().to_numpy().reshape(len(own), -1)
    names, column = np.unique(near, return_inverse=True)
    has = np.zeros((len(own), len(names)), np.float32)
    has[np.arange(len(own))[:, None], column.reshape(near.shape)] = 1
    less = has[:, names < pivot]
    out = (has @ has.T >= shared_pivots) & (less @ less.T == 0)
    if low != high:  # pairs within a block are met in the group of that block with itself
        out &= own[:, None] != own[None, :]
    np.fill_diagonal(out, False)
    return out


def _group_links(group: pa.Table, threshold: float, shared_pivots: int) -> tuple[np.ndarray, ...]:
    rep, weight = (group.column(k).to_numpy() for k in ("rep", "weight"))
    linked = _sharing(group, shared_pivots)
    if linked.any():
        x = group.column("vector").combine_chunks()
        x = _matrix(x, len(x[0]))
        linked &= x @ x.T >= threshold
    some = np.flatnonzero(linked.any(1))
    linked, rep = linked[np.ix_(some, some)], rep[some]
    links = linked @ weight[some]
    root, before = rep.copy(), None
    top = np.iinfo(np.int64).max
    while len(rep) and (before is None or (root != before).any()):
        before = root
        root = np.minimum(root, np.where(linked, root[None, :], top).min(1))
    return rep, links.astype(np.int64), root


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, nearest: int = 8, shared_pivots: int = 3, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Rows are linked where their labels are equal and not null and their cosine, in double precision, is at
    least ``threshold``. A vector that is null, empty, zero or holds a null or non-finite component, and a
    row with a null id, is linked with nothing (component: its id). Rows that repeat an id count as vectors
    of their own in n_links; if their vectors differ, they share their links. Vectors of different lengths are
    never linked. An empty table gives an empty result; other columns are not read. Ids are read as bigint.

    The index is approximate: a linked pair is found if the two share at least ``shared_pivots`` of their
    ``nearest`` pivots. All rows are indexed; only the choice of pivots rests on a sample.
    """
    single = vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType(), vectors.schema[vector_col].dataType.containsNull)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"), F.col(label_col).cast("string").alias("label"))
    usable = rows.where("id IS NOT NULL AND label IS NOT NULL").where(_usable("vector"))
    classes = usable.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    classes = stored(classes.withColumn("size", F.size("vector")), "vector-classes")
    n, width = classes.agg(F.count(F.lit(1)), F.max("size")).first()
    if not n:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    pivots = choose_pivots(classes, n, width)
    found = _verified(classes, _described(classes, pivots, nearest), threshold, min(shared_pivots, len(pivots)))
    found = stored(found, "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")).where("u != v"))
    known = classes.join(links, "rep", "left").join(parts, classes["rep"] == parts["id"], "left")
    known = stored(known.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")), "vector-results")
    marked = rows.withColumn("ok", F.col("id").isNotNull() & F.col("label").isNotNull() & _usable("vector"))
    known = known.withColumnsRenamed({"label": "l", "vector": "v"}).withColumn("good", F.lit(True))
    out = marked.join(known, (F.col("ok") == F.col("good")) & (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
