"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, trained
with follow-the-regularised-leader and elastic-net penalties, then calibrated by a temperature.

Document frequencies are counted over all training texts. The regression itself is fitted on the driver
to a bounded sample of labelled texts (``sample_docs``), taken in the order of a hash of their ids; rows
beyond that number are left out even if they share an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import list_rows

#: Buckets that n-grams of 1 to GRAMS characters are hashed to.
BUCKETS, GRAMS = 1 << 15, 3
#: Training texts that the regression is fitted to; a fifth of them calibrates the temperature.
SAMPLE_DOCS = 4000
UNDETERMINED = "und"
#: Characters of one slice of a text; n-grams run on across slices.
_SLICE = 1 << 18
_STEPS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> itself in lower case, or a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a whole text, slice by slice. Other characters than letters are spaces."""
    points = _letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]]).astype(np.uint32)
    for a in range(0, len(points), _SLICE):
        part = points[max(0, a - GRAMS + 1) : a + _SLICE]
        skip = min(a, GRAMS - 1)
        hashed = np.zeros(len(part), np.uint32)
        for k in range(GRAMS):
            n = len(part) - k
            if n <= 0:
                break
            hashed = hashed[: len(part)] if k == 0 else hashed[:n]
            hashed = (hashed + (part[k:] + np.uint32(k + 1)) * _STEPS[k]) * np.uint32(0x27D4EB2F)
            # n-grams that end in this slice
            yield ((hashed ^ (hashed >> np.uint32(15)))[max(0, skip - k) :] % np.uint32(BUCKETS)).astype(np.int32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _counts(text: str) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for g in _grams(text):
        total += np.bincount(g, minlength=BUCKETS)
    return total


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """(texts with a letter, how many of them hold each bucket), over all rows. Each task sends one row a
    bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = 0, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if has_letter(text):
                    n += 1
                    held = np.zeros(BUCKETS, bool)
                    for g in _grams(text):
                        held[g] = True
                    found += held
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(found[some], n))], ["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total, out = 0, np.zeros(BUCKETS, np.int64)
    for r in rows:
        if r.bucket < 0:
            total = r.n
        else:
            out[r.bucket] = r.n
    return total, out


def training_vectors(docs: DataFrame, text_col: str, label_col: str, order: Column, most: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(label, buckets, counts) of the ``most`` first rows in the order of ``order``, label and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, label, h, crc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if has_letter(text):
                    total = _counts(text)
                    some = np.flatnonzero(total)
                    rows.append((label, some, total[some], h, crc))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.int64()), strict=True)], ["label", "buckets", "counts", "h", "crc"])

    source = docs.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"), order.alias("h"), F.crc32(text_col).alias("crc"))
    made = source.mapInArrow(run, "label string, buckets array<int>, counts array<long>, h long, crc long")
    rows = made.orderBy("h", "label", "crc").limit(most).toArrow()
    return list(zip(rows.column(0).to_pylist(), list_rows(rows.column(1)), [c.astype(np.float64) for c in list_rows(rows.column(2))], strict=True))


@dataclass
class FTRL:
    """Follow the regularised leader, proximal, with one adaptive rate a coordinate and an elastic net."""

    classes: int
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02

    def __post_init__(self) -> None:
        self.z = np.zeros((BUCKETS, self.classes))
        self.n = np.zeros((BUCKETS, self.classes))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1.0
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, found on a fine grid."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(25.0), 200))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


@dataclass(frozen=True)
class LanguageModel:
    """``table`` has a row a bucket: IDF times weights over temperature."""

    labels: tuple[str, ...]
    table: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not has_letter(text):
            return UNDETERMINED, 0.0
        logits, n = np.zeros(len(self.labels)), 0
        for g in _grams(text):
            logits += self.table[g].sum(0, dtype=np.float64)
            n += len(g)
        p = softmax(logits / n)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


#: Term frequencies are shares of the text's n-grams, scaled to about one.
_SCALE = 50.0


def train(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS, epochs: int = 3) -> LanguageModel:
    """A model of the labels of ``docs``. Rows with a null label or without a letter teach nothing; with no
    others the model answers ``und``."""
    docs = docs.where(F.col(label_col).isNotNull())
    total, frequency = document_frequencies(docs, text_col)
    if not total:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32))
    order = F.xxhash64(F.col(id_col).cast("string"))
    # the sample's rows are those up to the hash of its last id: only hashes are sorted
    last = docs.select(order.alias("h")).orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    rows = training_vectors(docs.where(order <= last), text_col, label_col, order, sample_docs)
    labels = tuple(sorted({r[0] for r in rows}))
    code = {x: i for i, x in enumerate(labels)}
    idf = np.log((1.0 + total) / (1.0 + frequency)) + 1.0
    examples = [(b, _SCALE * idf[b] * c / c.sum(), code[a]) for a, b, c in rows]
    rng = np.random.default_rng(7)
    order_of = rng.permutation(len(examples))
    held = order_of[: len(examples) // 5]
    model = FTRL(len(labels))
    for _ in range(epochs):
        for i in rng.permutation(order_of[len(held) :]):
            model.learn(*examples[i])
    w = model.weights()
    logits = np.array([x @ w[b] for b, x, _ in (examples[i] for i in held)]).reshape(len(held), len(labels))
    t = temperature(logits, np.array([examples[i][2] for i in held], int))
    return LanguageModel(labels, (_SCALE * idf[:, None] * w / t).astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, lang_pred and score (the calibrated probability of lang_pred) for every whole text.

    A null or empty text, or one without a letter, is ``und`` with score 0; rows are judged one by one, so
    null ids, ties and repeats are kept as they are; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = [m.predict(t) for t in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*names, "lang_pred", "score"])

    source = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), F.col(text_col).alias("__text"))
    schema = source.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    out = source.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)), "lang_pred", "score")


def filter_documents(docs: DataFrame, model: LanguageModel, languages: tuple[str, ...] | None = None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, in one of the languages (default: any learned one)
    with at least the given score."""
    keep = tuple(docs.columns)
    names = tuple(f"c{i}" for i in range(len(keep)))
    out = identify(docs.toDF(*names), model, names[keep.index(text_col)], names)
    wanted = list(model.labels if languages is None else languages)
    return out.where(F.col("lang_pred").isin(wanted) & (F.col("score") >= least)).select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)))
