"""Target-distribution importance resampling over hashed word features.

A document's weight is the mean gain of its features, looked up in an array with one gain a bucket. Keys
perturbed by a fixed draw of each id are then cut at the requested share: a quantile sketch brackets the
cutoff, exact counts outside the bracket validate or widen it, and only the bracket is sorted to find it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import chain, pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SLICE_BYTES, release, stored

BUCKETS = 10_000
#: Fixed value: words of the lower-cased UTF-8 bytes.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: A sketch's rank error is a share of 1 / ACCURACY of the rows; the first bracket is twice as wide on either side.
ACCURACY = 10_000


def feature_hashes(text: str | None) -> Iterator[np.ndarray]:
    """CRC-32 of every word and every pair of neighbouring words, slice by slice of a whole text."""
    data, at, last = (text or "").encode(), 0, []
    while at < len(data):
        cut = _BREAK.search(data, min(at + SLICE_BYTES, len(data)))
        to = cut.start() if cut else len(data)
        words = WORD.findall(data[at:to].lower())
        pairs = map(b" ".join, pairwise(chain(last, words)))
        yield np.fromiter(map(crc32, chain(words, pairs)), np.uint32)
        at, last = to, words[-1:] or last


def _bucket_counts(df: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts by bucket; each task sends one row a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for hashes in feature_hashes(text.as_py()):
                    total += np.bincount(hashes % buckets, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in df.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of each bucket's log ratio, with one feature more in every bucket of both sides."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    ratio = (target + 1.0) * (s + float(n)) / ((source + 1.0) * (t + float(n)))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def _weighed(df: DataFrame, text: str, gains: np.ndarray) -> DataFrame:
    """``df`` with n_features and weight in place of its text. The array of gains goes to the tasks; it has
    one number a bucket, whatever the input."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, value in enumerate(batch.column(at)):
                for hashes in feature_hashes(value.as_py()):
                    n[i] += len(hashes)
                    total[i] += gains[hashes % len(gains)].sum()
            rest = batch.remove_column(at)
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(n), pa.array(total // np.maximum(n, 1))], names=[*rest.schema.names, "n_features", "weight"])

    schema = df.drop(text).schema.add("n_features", "long").add("weight", "long")
    return df.mapInArrow(weigh, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Floored thousandths of a Gumbel variable, fixed by the seed and the id (a null id: the empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _numbered(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows, written in the order of falling score and rising id, with ``pos`` 1, 2, 3... in that order,
    and the table to release. Rows are sorted by ranges; a range's rows are numbered where they are, and one
    small row a range says how many come before it."""
    at = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(F.desc("score"), F.asc_nulls_last("__id")).sortWithinPartitions(F.desc("score"), F.asc_nulls_last("__id"))
    held = stored(ranged.withColumn("__at", at).withColumns({"__part": F.shiftright("__at", 33), "__nth": F.col("__at").bitwiseAND((1 << 33) - 1)}).drop("__at"), name)
    sizes = held.groupBy("__part").agg(F.max("__nth").alias("n")).orderBy("__part").collect()  # one row a partition
    before, starts = 0, []
    for row in sizes:
        starts.append((row["__part"], before))
        before += row.n + 1
    offsets = df.sparkSession.createDataFrame(starts, "__part long, __before long")
    return held.join(F.broadcast(offsets), "__part").withColumn("pos", F.col("__before") + F.col("__nth") + 1).drop("__part", "__nth", "__before"), held


def cutoff_score(rows: DataFrame, n: int, k: int, accuracy: int = ACCURACY) -> int:
    """The k-th highest score of the n rows (score, __id), 1 <= k <= n."""
    width = 2 / accuracy
    while True:
        share = 1 - k / n
        low, high = rows.agg(F.percentile_approx("score", [max(share - width, 0.0), min(share + width, 1.0)], accuracy).alias("q")).first().q
        if share - width <= 0:
            low = rows.agg(F.min("score")).first()[0]
        if share + width >= 1:
            high = rows.agg(F.max("score")).first()[0]
        above, reached = rows.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") >= low)).first()
        if above < k <= reached:
            break
        width *= 4  # the exact counts say that the sketch's bracket misses the cutoff
    numbered, held = _numbered(rows.where(F.col("score").between(low, high)).select("score", "__id"), "bracket")
    found = numbered.where(F.col("pos") == k - above).first().score
    release(held)
    return found


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS, text_col: str = "text", id_col: str = "doc_id", keep: Sequence[str] = ("doc_id",), target_text: str = "text") -> DataFrame:
    """``keep``, n_features, weight, score and rank (all long) for every row of ``docs``; rank is null for rows
    that are not drawn.

    Features are all words and pairs of neighbouring words of whole texts, counted with repeats; drawn are
    ``percent`` of 100 of the rows with ``least_words`` words or more, highest score first, ties by smaller
    id (null ids last). Null, empty and wordless texts have weight 0 and are never drawn; repeated rows count
    each, and equal ids with equal scores take neighbouring ranks in any order; without rows the result is
    empty; without target texts every bucket's target count is 0. Other columns are not read. Counts and the
    sketch cover all rows; texts are read twice and never shuffled.
    """
    kept = [f"__kept_{i}" for i in range(len(keep))]
    df = docs.select(F.col(f"`{text_col}`").alias("__text"), F.col(f"`{id_col}`").alias("__id"), *(F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)))
    gains = bucket_gains(_bucket_counts(df.select("__text"), buckets), _bucket_counts(target.select(F.col(f"`{target_text}`")), buckets))
    scored = stored(_weighed(df, "__text", gains).withColumn("score", F.col("weight") + gumbel(F.col("__id"), seed)), "resample-scores")
    fit = F.col("n_features") >= max(2 * least_words - 1, 0)  # w words have 2 w - 1 features
    rows = scored.where(fit)
    n = rows.count()
    k = percent * n // 100
    columns = [*(F.col(c).alias(name) for c, name in zip(kept, keep, strict=True)), "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    chosen = fit & (F.col("score") >= cutoff_score(rows.select("score", "__id"), n, k))
    ranked, _ = _numbered(scored.where(chosen), "resample-drawn")
    drawn = ranked.select(*columns, F.when(F.col("pos") <= k, F.col("pos")).alias("rank"))
    return drawn.unionByName(scored.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank")))
