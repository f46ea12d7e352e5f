"""Quality classification by naive Bayes support vectors: n-gram indicators are scaled by class log-count
ratios, and a linear hinge-loss model is fitted to them by dual coordinate descent.

The n-grams are single words and pairs of words, pairs of word shapes (case, digits, symbols, last
character), and runs of eight marks that say of each word triple whether the text held it before. All are
hashed to buckets.

Class counts, and so the ratios, cover all labelled training texts. The support vector model is fitted on
the driver to a bounded sample of them (``sample_docs``), taken in the order of a hash of their ids; rows
beyond that number are left out even if they share an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Words, list_rows, mix, release, runs_hash, slices, stored, text_buffers

BUCKETS = 1 << 17
#: Training texts that the support vector model is fitted to; a fifth of them sets the scale of its scores.
SAMPLE_DOCS = 6000
#: Weight of the hinge losses against the norm, and passes of the descent at most.
COST, PASSES = 1.0, 30

_UPPER, _LOWER, _DIGIT = (np.zeros(256, np.int32) for _ in range(3))
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58] = 1, 1, 1
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[33:127] = 1
_SYMBOL -= _UPPER + _LOWER + _DIGIT


def _shapes(data: np.ndarray, w: Words) -> np.ndarray:
    """The shape of each word."""

    def held(table: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=total[1:])
        return total[w.end] - total[w.begin]

    upper, lower, digit, symbol = map(held, (_UPPER, _LOWER, _DIGIT, _SYMBOL))
    last = data[w.end - 1].astype(np.int64) if len(w.end) else np.zeros(0, np.int64)
    last = np.where(_SYMBOL[last] > 0, last, 0)
    shape = np.minimum(upper, 3) | np.minimum(lower, 1) << 2 | np.minimum(digit, 1) << 3 | np.minimum(symbol, 3) << 4 | last << 6
    return mix(shape.astype(np.uint64) + np.uint64(1))


#: Marks of one run.
MARKS = 8


def _again(triples: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each value whether an earlier place between the same two ``bounds`` holds it."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((triples, text))  # stable: of equal values the first place comes first
    t, x = text[order], triples[order]
    same = np.append(False, (t[1:] == t[:-1]) & (x[1:] == x[:-1])) if len(order) else np.zeros(0, bool)
    out = np.empty(len(order), bool)
    out[order] = same
    return out


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct buckets of each whole text (null: empty), sorted."""
    data, offsets = text_buffers(column)
    top = np.uint64(BUCKETS - 1)

    def runs(values: np.ndarray, k: int) -> np.ndarray:
        return (runs_hash(values, k) & top).astype(np.int32)

    for a, b in slices(offsets):
        w = Words(data, offsets[a : b + 1], lower=True)
        shape = _shapes(data[offsets[a] : offsets[b]], w)
        three = np.append(runs_hash(w.hashes, 3), np.zeros(min(2, len(w.hashes)), np.uint64))
        marks = mix(_again(three, w.first).astype(np.uint64) + np.uint64(77))
        kinds = ((runs(w.hashes, 1), 1), (runs(w.hashes, 2), 2), (runs(shape, 1), 1), (runs(shape, 2), 2), (runs(marks, MARKS), MARKS + 2))
        for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            yield np.unique(np.concatenate([x[lo : max(lo, hi - k + 1)] for x, k in kinds]))


def dual_coordinate_descent(examples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, passes: int = PASSES, tolerance: float = 0.01) -> np.ndarray:
    """Weights (the last is the bias) of the linear model with the least half squared norm plus weighted
    hinge losses: each dual variable in turn is set to its best value within [0, cost]."""
    w = np.zeros(BUCKETS + 1)
    alpha = np.zeros(len(y))
    square = np.array([x @ x + 1.0 for _, x in examples])
    rng = np.random.default_rng(11)
    for _ in range(passes):
        worst = 0.0
        for i in rng.permutation(len(y)):
            at, x = examples[i]
            g = y[i] * (x @ w[at] + w[-1]) - 1.0
            best = min(max(alpha[i] - g / square[i], 0.0), cost[i])
            step = (best - alpha[i]) * y[i]
            if step:
                worst = max(worst, abs(g))
                alpha[i] = best
                w[at] += step * x
                w[-1] += step
        if worst < tolerance:
            break
    return w


def sigmoid_scale(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """(a, b) for which 1 / (1 + exp(-(a * margin + b))) has the least log loss, by Newton's method, with
    targets drawn in from 0 and 1 as far as the counts warrant."""
    up, down = positive.sum(), (~positive).sum()
    target = np.where(positive, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([d @ margins + 1e-3 * (a - 1), d.sum()])
        hess = np.array([[h @ margins**2 + 1e-3, h @ margins], [h @ margins, h.sum() + 1e-6]])
        move = np.linalg.solve(hess, grad)
        move *= min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    return max(a, 1e-3), b


@dataclass(frozen=True)
class QualityModel:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    a: float
    b: float

    def score(self, at: np.ndarray) -> float:
        r = self.ratio[at]
        margin = r @ self.weight[at] / max(float(np.sqrt(r @ r)), 1e-9) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.a * margin + self.b, -35, 35))))


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    """Log of each indicator's smoothed share among those of label 1 over that of label 0."""
    p, q = counts[1] + 1, counts[0] + 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def _scaled(at: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    r = ratio[at]
    return r / max(float(np.sqrt(r @ r)), 1e-9)


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "quality", id_col: str = "doc_id", rows: Column | None = None, sample_docs: int = SAMPLE_DOCS) -> QualityModel:
    """A model of ``labels`` (id, 0 or 1) joined to ``docs``; ``rows``, over the id, says which ids may be
    learned from. Null labels, null ids and labels without a document teach nothing. With no row of one
    class every score is the smoothed share of label 1; a fifth of the sample, which the descent does not
    see, sets the scale of the scores."""
    keep = F.lit(True) if rows is None else rows
    known = labels.where(keep).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)")
    h = F.xxhash64(F.col("__id").cast("string"))
    last = known.select(h.alias("h")).orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    if last is None:
        return QualityModel(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, 0.0)
    known = known.withColumn("h", h).withColumn("sampled", F.col("h") <= last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n, rows = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64), []
        for batch in batches:
            for at, label, sampled, h, crc in zip(indicators(batch.column(0)), *(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True):
                counts[label, at] += 1
                n[label] += 1
                if sampled:
                    rows.append((h, label, crc, at))
            if len(rows) > 2 * sample_docs:  # ids may repeat
                rows = sorted(rows, key=lambda r: r[:3])[:sample_docs]
        rows = sorted(rows, key=lambda r: r[:3])[:sample_docs]
        if rows:
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(rows), f.type) for f in list(schema)[:3]), *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[3:], strict=True))], schema=schema)
        some = np.append(np.flatnonzero(counts.sum(0)), -1)
        low, high = np.append(counts[0], n[0])[some], np.append(counts[1], n[1])[some]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(low), pa.array(high), *(pa.nulls(len(some), f.type) for f in list(schema)[3:])], schema=schema)

    schema = pa.schema([("bucket", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("h", pa.int64()), ("label", pa.int32()), ("crc", pa.int64()), ("at", pa.list_(pa.int32()))])
    # both sides are always shuffled by id: a broadcast of the labels would have no size bound
    joined = docs.where(keep).select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(known.hint("merge"), "__id").select("text", "label", "sampled", "h", F.coalesce(F.crc32("text"), F.lit(-1)).alias("crc"))
    made = stored(joined.mapInArrow(run, "bucket long, low long, high long, h long, label int, crc long, at array<int>"), "quality-training")
    counts, classes = np.zeros((2, BUCKETS)), np.zeros(2)
    found = made.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).toArrow()
    at, both = found.column(0).to_numpy(), np.stack([found.column(1).to_numpy(), found.column(2).to_numpy()])
    counts[:, at[at >= 0]], classes[:] = both[:, at >= 0], both[:, at < 0].sum(1)
    sample = made.where("label IS NOT NULL").select("h", "label", "crc", "at").orderBy("h", "label", "crc").limit(sample_docs).toArrow()
    release(made)
    if not classes.all():
        return QualityModel(np.zeros(BUCKETS), np.zeros(BUCKETS), float(np.log((classes[1] + 1) / (classes[0] + 1))), 1.0, 0.0)
    ratio = log_count_ratios(counts)
    y = np.where(sample.column(1).to_numpy() > 0, 1.0, -1.0)
    examples = [(at, _scaled(at, ratio)) for at in list_rows(sample.column(3))]
    order = np.random.default_rng(5).permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    share = {s: max(1, int((y[used] == s).sum())) for s in (-1.0, 1.0)}
    cost = np.array([COST * len(used) / (2 * share[s]) for s in y[used]])
    w = dual_coordinate_descent([examples[i] for i in used], y[used], cost)
    margins = np.array([x @ w[at] + w[-1] for at, x in (examples[i] for i in held)])
    a, b = sigmoid_scale(margins, y[held] > 0)
    return QualityModel(ratio, w[:-1], float(w[-1]), a, b)


def classify(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, score (likelihood of label 1) and predicted (1 if score >= 0.5) for every whole text.

    Null and empty texts have no n-gram: they are scored by the model's bias; rows are judged one by one, so null ids, ties
    and repeats are kept as they are; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores = pa.array([m.score(at) for at in indicators(batch.column(len(names)))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], [*names, "score"])

    source = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), F.col(text_col).alias("__text"))
    out = source.mapInArrow(run, source.drop("__text").schema.add("score", "double"))
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def filter_documents(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model predicts to be of label 1."""
    keep = tuple(docs.columns)
    names = tuple(f"c{i}" for i in range(len(keep)))
    out = classify(docs.toDF(*names), model, names[keep.index(text_col)], names)
    return out.where("predicted = 1").select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)))
