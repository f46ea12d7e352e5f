"""The learned operators' parts against literal versions, what they may learn from, and whole long texts."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import components, words
from pyspark.sql import functions as F
from test_dedup_and_models import EN, FR, _prose, _without_repeats

from tidemark.llm import embedding_dedup, language_id, minhash, quality_classifier, quality_rules, queries, substring_dedup
from tidemark.llm.shared import SLICE_BYTES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_ftrl_equals_a_literal_loop():
    rng = np.random.default_rng(1)
    model, k = language_id.FTRL(3), 6
    z, n = np.zeros((k, 3)), np.zeros((k, 3))
    for _ in range(200):
        at = np.sort(rng.choice(k, 3, replace=False))
        x, label = rng.random(3), int(rng.integers(3))
        w = np.zeros((3, 3))
        for i in range(3):
            for c in range(3):
                if abs(z[at[i], c]) > model.l1:
                    w[i, c] = -(z[at[i], c] - np.sign(z[at[i], c]) * model.l1) / ((model.beta + np.sqrt(n[at[i], c])) / model.alpha + model.l2)
        logits = [sum(x[i] * w[i, c] for i in range(3)) for c in range(3)]
        p = np.exp(logits) / np.exp(logits).sum()
        for i in range(3):
            for c in range(3):
                g = x[i] * (p[c] - (c == label))
                sigma = (np.sqrt(n[at[i], c] + g * g) - np.sqrt(n[at[i], c])) / model.alpha
                z[at[i], c] += g - sigma * w[i, c]
                n[at[i], c] += g * g
        model.learn(at, x, label)
    assert np.allclose(model.z[:k], z) and np.allclose(model.n[:k], n) and (model.weights()[k:] == 0).all()


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(2)
    labels = rng.integers(3, size=400)
    logits = rng.normal(size=(400, 3)) * 6
    logits[np.arange(400), labels] += 3
    loss = lambda t: -np.log(language_id.softmax(logits / t)[np.arange(400), labels]).mean()
    t = language_id.temperature(logits, labels)
    assert all(loss(t) <= loss(s) + 1e-4 for s in np.linspace(0.3, 20, 400)) and language_id.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_descent_meets_the_conditions_of_the_optimum():
    rng = np.random.default_rng(3)
    examples = [(np.sort(rng.choice(12, 4, replace=False)), rng.normal(size=4)) for _ in range(60)]
    y, cost = np.where(rng.random(60) < 0.5, 1.0, -1.0), rng.uniform(0.2, 1.0, 60)
    w = quality_classifier.dual_coordinate_descent(examples, y, cost, passes=4000, tolerance=1e-8)
    x = np.zeros((60, 13))
    for row, (at, v) in zip(x, examples, strict=True):
        row[at], row[12] = v, 1.0
    full = np.append(w[:12], w[-1])
    value = lambda v: v @ v / 2 + cost @ np.maximum(0, 1 - y * (x @ v))
    # no step lowers the primal value, which is convex
    assert all(value(full) <= value(full + s * d) + 1e-6 for s in (1e-3, 1e-2, 0.1) for d in rng.normal(size=(200, 13)))
    margin = y * (x @ full)
    inside = cost @ np.where(margin < 1 - 1e-6, 1.0, 0.0)
    assert 0 < inside < cost.sum()


def test_sigmoid_has_the_least_loss():
    rng = np.random.default_rng(4)
    margins = rng.normal(size=500)
    positive = rng.random(500) < 1 / (1 + np.exp(-(2 * margins - 0.5)))
    a, b = quality_classifier.sigmoid_scale(margins, positive)
    up, down = positive.sum(), (~positive).sum()
    target = np.where(positive, (up + 1) / (up + 2), 1 / (down + 2))

    def loss(a, b):
        p = 1 / (1 + np.exp(-(a * margins + b)))
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).sum()

    assert all(loss(a, b) <= loss(a + i / 20, b + j / 20) + 0.01 for i in range(-20, 21) for j in range(-20, 21))
    assert quality_classifier.sigmoid_scale(np.zeros(0), np.zeros(0, bool)) == (1.0, 0.0)


def test_ratios_and_indicators():
    counts = np.zeros((2, quality_classifier.BUCKETS))
    counts[0, 3], counts[1, 3], counts[1, 5] = 4, 1, 7
    r = quality_classifier.log_count_ratios(counts)
    n = quality_classifier.BUCKETS
    assert np.isclose(r[3], np.log(2 / (n + 8)) - np.log(5 / (n + 4))) and np.isclose(r[5], np.log(8 / (n + 8)) - np.log(1 / (n + 4)))
    one, two, *rest = quality_classifier.indicators(pa.array(["some words here", "some words here", None, "", "x", "some  words\nhere"]))
    assert (one == two).all() and [len(x) == 0 for x in rest] == [True, True, False, False] and (rest[3] == one).all()
    again = quality_classifier._again(np.array([1, 2, 1, 1, 2, 1], np.uint64), np.array([0, 4, 6]))
    assert again.tolist() == [False, False, True, True, False, False]


def _labelled(n=160):
    docs = [(i, _prose(i, EN if i % 2 else FR), "en" if i % 2 else "fr") for i in range(n)]
    return docs, [(i, i % 2) for i, *_ in docs]


def test_models_learn_from_their_own_rows_alone(spark):
    rows, marks = _labelled()
    schema = "doc_id long, text string, lang string"
    keep = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    other = [(i, "quite other text", "xx") if zlib.crc32(str(i).encode()) % 4 == 2 else (i, t, x) for i, t, x in rows]
    one, two = (language_id.train(spark.createDataFrame(r, schema).where(keep % 4 != 2)) for r in (rows, other))
    assert one.labels == two.labels and (one.table == two.table).all()
    other = [(i, "quite other text", "xx") if zlib.crc32(str(i).encode()) % 3 == 1 else (i, t, x) for i, t, x in rows]
    flipped = [(i, 1 - q) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, q) for i, q in marks]
    one, two = (quality_classifier.train(spark.createDataFrame(r, schema), spark.createDataFrame(q, "doc_id long, quality int"), rows=keep % 3 != 1) for r, q in ((rows, marks), (other, flipped)))
    assert (one.weight == two.weight).all() and (one.ratio == two.ratio).all() and (one.a, one.b, one.bias) == (two.a, two.b, two.bias)


def test_one_class_and_repeated_ids(spark):
    rows, marks = _labelled(40)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = quality_classifier.train(docs, spark.createDataFrame([(i, 1) for i, _ in marks], "doc_id long, quality int"))
    assert {round(r.score, 9) for r in quality_classifier.classify(docs, model).collect()} == {round(41 / 42, 9)}
    # one id stands for most rows: the sample keeps to its bound
    hot = spark.createDataFrame([(7, t, x) for _, t, x in rows] * 5 + rows, "doc_id long, text string, lang string")
    order = F.xxhash64(F.col("doc_id").cast("string"))
    assert len(language_id.training_vectors(hot, "text", "lang", order, 30)) == 30
    model = language_id.train(hot, sample_docs=60)
    assert language_id.train(hot.repartition(5), sample_docs=60).labels == model.labels
    assert quality_classifier.classify(docs, quality_classifier.train(hot, spark.createDataFrame(marks, "doc_id long, quality int"), sample_docs=20)).count() == 40


def test_a_language_seen_once(spark):
    rows, _ = _labelled(60)
    model = language_id.train(spark.createDataFrame([*rows, (999, "ζωή και φως", "el")], "doc_id long, text string, lang string"))
    assert model.labels == ("el", "en", "fr")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()}
    assert np.mean([got[i] == x for i, _, x in rows]) > 0.9


@needs_tables
def test_held_out_rows_of_the_queries(spark):
    for name, k, left in (("op4_language_id", 4, 2), ("op5_quality_classifier", 3, 1)):
        got = queries.QUERIES[name](spark, SF).select("doc_id", "held_out", "score").collect()
        assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % k == left) and 0 <= r.score <= 1 for r in got)


# --- texts beyond a slice ---


def _long_texts():
    """Two texts beyond a slice, one a copy with a word more, and short ones around them in one batch."""
    long = " ".join(words(5, 230_000, 10**7))
    assert len(long) > 1.5 * SLICE_BYTES
    passage = " ".join(words(6, 30))
    return [(1, f"{passage} a b c"), (2, long), (3, f"{long} one"), (4, "d e f"), (5, f"x {passage}")]


def test_long_texts_are_treated_whole(spark):
    rows = _long_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want, _ = _without_repeats(rows, 20)
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(docs, 20).collect()}
    assert got == {d: (n, gone) for d, n, gone, _ in want}
    near = {r.doc_id: r for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert {d: r.component_id for d, r in near.items()} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 1}  # 28 of 32 shingles
    assert near[3].n_shingles == near[2].n_shingles + 1
    measures = {r.doc_id: (r.n_words, r.word_chars) for r in quality_rules.measured(docs, ("n_words", "word_chars"), "text", ("doc_id",)).collect()}
    assert measures == {d: (len(t.split()), len(t.replace(" ", ""))) for d, t in rows}
    whole = list(quality_classifier.indicators(pa.array([t for _, t in rows])))
    single = [next(quality_classifier.indicators(pa.array([t]))) for _, t in rows]
    assert all((a == b).all() for a, b in zip(whole, single, strict=True))


# --- vectors ---


def test_vectors_of_extreme_components(spark):
    rows = [(1, [1e-200, 0.0], "x"), (2, [2e-200, 0.0], "x"), (3, [1e200, 1e200], "x"), (4, [3e200, 3e200], "x"), (5, [5e-324, 0.0], "x"), (6, [1e-200, 0.0], "y")]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(1, 2, 1), (2, 2, 1), (5, 2, 1), (3, 1, 3), (4, 1, 3), (6, 0, 6)}


@needs_tables
@pytest.mark.parametrize("folder", [SF, SF.replace("0.001", "0.01")])
def test_recall_against_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    good = [r for r in rows if r.label is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)]
    x = np.array([r.embedding for r in good], float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    label, ids = np.array([r.label for r in good]), np.array([r.vec_id for r in good])
    found = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(found, False)
    links = list(zip(*(ids[k].tolist() for k in np.nonzero(found)), strict=True))
    got = embedding_dedup.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet")).collect()
    assert 0.9 * len(links) <= sum(r.n_links for r in got) <= len(links)
    if sum(r.n_links for r in got) == len(links):
        want = components(ids.tolist(), links)
        assert all(r.component_id == want.get(r.vec_id, r.vec_id) for r in got)


def test_random_repeats_equal_brute_force(spark):
    rng = random.Random(8)
    for vocabulary in (2, 5, 40):
        rows = [(i, " ".join(words(rng.randrange(10**6), rng.randrange(60), vocabulary))) for i in range(40)]
        want, _ = _without_repeats(rows, 6)
        got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 6).collect()
        assert {r.doc_id: r.n_removed for r in got} == {d: gone for d, _, gone, _ in want}
