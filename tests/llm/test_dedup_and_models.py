import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from llm_helpers import components, edited, words
from pyspark.sql import functions as F

from tidemark.llm import components as cc
from tidemark.llm import embedding_dedup, language_id, minhash, quality_classifier, substring_dedup, warc

# --- components ---


@pytest.mark.parametrize("small", [cc.SMALL, 0])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(cc, "SMALL", small)
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(200, 200), (None, 3), (5, None), (300, 301), (301, 300)]
    got = {r.id: r.component_id for r in cc.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = components({x for e in edges for x in e if x is not None and e[0] != e[1] and None not in e}, [e for e in edges if None not in e])
    assert got == want
    assert cc.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


# --- near duplicates ---


def _shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = low.encode().split()
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else ({tuple(ws)} if ws else set())


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_minhash_equals_brute_force(spark, docs, clashing, k, percent):
    rows = docs.collect()
    sets = [(r.doc_id, _shingles(r.text, k)) for r in rows]
    links = [(a, b) for a, s in sets for b, t in sets if None not in (a, b) and a != b and s and 100 * len(s & t) >= percent * len(s | t)]
    want = components({d for d, _ in sets if d is not None}, links)
    got = minhash.near_duplicates(docs, k, percent).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((d, len(s)) for d, s in sets)
    assert all(r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id == r.component_id) for r in got)
    left = minhash.deduplicate(clashing, k, percent)
    assert left.columns == clashing.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert minhash.near_duplicates(docs.limit(0), k, percent).collect() == []


def test_minhash_links_across_blocks(spark, monkeypatch):
    """A large group in which nothing is near the leader: found by blocks of a few rows."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = words(1, 150, 10**6)
    texts = [(i, " ".join(edited(base, i, 0.02 + 0.002 * i))) for i in range(60)]
    sets = [(i, _shingles(t, 3)) for i, t in texts]
    want = components({i for i, _ in sets}, [(a, b) for a, s in sets for b, t in sets if a != b and 100 * len(s & t) >= 85 * len(s | t)])
    got = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) > 3


def test_minhash_repeated_ids_with_other_texts(spark):
    a, b = " ".join(words(1, 80)), " ".join(words(2, 80))
    df = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b)], "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(df, 3, 85).collect()} == {1}


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_long_words_that_polynomial_hashes_confuse_stay_apart(spark):
    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([one, *words(1, 19)])), (2, " ".join([two, *words(1, 19)])), (3, one), (4, two), (5, " ".join([one, *words(1, 19)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 20}
    # of 18 three-word shingles two texts share 17
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 95).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_exact_sets_are_those_of_words():
    texts = [" ".join(words(i, n, 6)) for i, n in enumerate((0, 1, 2, 2, 3, 9, 40, 40, 4))] + ["A b", "a  B", None]
    for k in (1, 2, 3, 5):
        sets, want = minhash._exact_sets(pa.array(texts), k), [_shingles(t, k) for t in texts]
        for s, x in zip(sets, want, strict=True):
            assert len(s) == len(x)
            for t, y in zip(sets, want, strict=True):
                assert len(np.intersect1d(s, t)) == len(x & y)


def test_band_scheme_misses_little():
    for percent in (80, 85, 95):
        s = minhash.Scheme(3, percent)
        assert (1 - (percent / 100) ** s.rows) ** s.bands <= 1e-5


# --- passages ---


def _without_repeats(docs, length, seen=()):
    seen, out = set(seen), []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        ws, gone = (t or "").encode().split(), set()
        for i in range(len(ws) - length + 1):
            w = tuple(ws[i : i + length])
            if w in seen:
                gone.update(range(i, i + length))
            seen.add(w)
        out.append((d, len(ws), len(gone), b" ".join(x for i, x in enumerate(ws) if i not in gone).decode()))
    return out, seen


def _result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("length", [20, 7, 5])
def test_repeats_equal_brute_force(spark, docs, clashing, length):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    once = list(dict.fromkeys(rows))  # rows that repeat an id are one document
    want, _ = _without_repeats(once, length)
    assert sorted(set(_result(substring_dedup.remove_repeats(docs, length))), key=repr) == sorted(want, key=repr)
    assert len(rows) == substring_dedup.remove_repeats(docs, length).count()
    out = substring_dedup.remove_repeats(clashing, length, keep=("id", "lang", "kept", "age"), spaced=True)
    assert out.columns[4:] == ["id", "lang", "kept", "age"]
    spaced = {r.doc_id: r.kept_text for r in out.collect()}
    texts = dict(once)
    for d, n, gone, kept in want:
        assert spaced[d].split() == kept.split() and (gone or spaced[d] == (texts[d] or ""))
    assert substring_dedup.remove_repeats(docs.limit(0), length).collect() == []


def _batches():
    passage = words(9, 40)
    docs = [(i, " ".join(words(i, 30 + i) + (passage if i % 3 == 0 else []) + words(100 + i, 10))) for i in range(30)]
    docs[17] = (17, docs[2][1])
    docs.append((None, docs[5][1]))
    return [docs[:10], docs[10:20], docs[20:]]


@pytest.mark.parametrize("hot", [1000, 2])
def test_batches_against_the_index(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_ROWS", hot)
    index = substring_dedup.FingerprintIndex(spark, f"file://{tmp_path}/index", 20, most_runs=2)
    seen = ()
    for k, batch in enumerate(_batches()):
        want, seen = _without_repeats(batch, 20, seen)
        df = spark.createDataFrame(batch, "doc_id long, text string")
        assert _result(substring_dedup.remove_repeats(df, 20, index)) == sorted(want, key=repr)
        assert len(index.runs()) == min(k + 1, 2)  # compacted before the third
    # another session's index, its tables no longer known to the catalog
    again = substring_dedup.FingerprintIndex(spark, f"file://{tmp_path}/index", 20)
    got = _result(substring_dedup.remove_repeats(df, 20, again))
    assert all(n == gone for _, n, gone, _ in got)
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(df, 19, index)
    assert not [t for t in spark.catalog.listTables() if "tidemark" in t.name]


def test_a_batch_that_is_sent_again_gives_the_same_result(spark, tmp_path):
    index, seen = substring_dedup.FingerprintIndex(spark, f"file://{tmp_path}/index", 20, most_runs=2), ()
    for k, batch in enumerate(_batches()):
        want, seen = _without_repeats(batch, 20, seen)
        df = spark.createDataFrame(batch, "doc_id long, text string")
        for _ in range(2):  # the third batch meets a compacted run, and so does its replay
            assert _result(substring_dedup.remove_repeats(df, 20, index, batch_name=f"b{k}")) == sorted(want, key=repr)
    first, _ = _without_repeats(_batches()[0], 20)
    index.compact()
    assert len(index.batches()) == 3 and len(index.runs()) == 1
    # the first batch once more sees only the others: what repeats there is new to it, but now comes later
    got = _result(substring_dedup.remove_repeats(spark.createDataFrame(_batches()[0], "doc_id long, text string"), 20, index, batch_name="b0"))
    assert [x[:2] for x in got] == [x[:2] for x in sorted(first, key=repr)] and len(index.batches()) == 3


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_whole_tables_go_through_a_compacted_index(spark, docs, monkeypatch, batches):
    compacted, compact = [], substring_dedup.FingerprintIndex.compact
    monkeypatch.setattr(substring_dedup.FingerprintIndex, "compact", lambda self: (compacted.append(len(self.runs())), compact(self)))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, _ = _without_repeats(list(dict.fromkeys(rows)), 20)
    got = substring_dedup.remove_repeats_in_batches(docs, 20, batches)
    assert sorted(set(_result(got)), key=repr) == sorted(want, key=repr) and got.count() == len(rows)
    assert compacted == ([batches - 1] if batches > 1 else [])
    digests = {(r.doc_id, r.kept_sha256) for r in substring_dedup.remove_repeats_in_batches(docs, 20, batches, digest=True).collect()}
    assert digests == {(d, hashlib.sha256(kept.encode()).hexdigest()) for d, _, _, kept in want}
    assert substring_dedup.remove_repeats_in_batches(docs.limit(0), 20, batches).count() == 0


def test_thousands_of_rows_of_one_id(spark):
    """Each text of an id has its own list, and repeated rows of a text share one."""
    passage = " ".join(words(3, 40))
    texts = [" ".join(words(1000 + i, 150, 10**6)) + (" " + passage if i % 2 else "") for i in range(2500)]
    df = spark.createDataFrame([(None, t) for t in texts] + [(None, texts[1])] * 2500 + [(7, passage)], "doc_id long, text string").repartition(4)
    got = {}
    for r in substring_dedup.remove_repeats(df).collect():
        got.setdefault((r.doc_id, r.n_words), set()).add(r.n_removed)
    assert got == {(None, 150): {0}, (None, 190): {0}, (7, 40): {40}}


def test_the_index_gets_equal_stretches_of_a_slice_once(spark, tmp_path):
    """2,000 copies, some with words of their own after them, leave the anchors of a few texts in a run."""
    index, passage = substring_dedup.FingerprintIndex(spark, f"file://{tmp_path}/index", 20), words(5, 60)
    batch = [(i, " ".join(passage + (words(7000 + i, 4, 10**6) if i < 40 else []))) for i in range(2000)]
    df = spark.createDataFrame(batch, "doc_id long, text string").coalesce(1)
    every = substring_dedup.fingerprints(df.selectExpr("doc_id AS id", "text"), 20).count()
    want, seen = _without_repeats(batch, 20)
    assert _result(substring_dedup.remove_repeats(df, 20, index)) == sorted(want, key=repr)
    assert every > 2000 * 3 and index._anchors(index.runs()[0]).count() < 200
    later = [(i, " ".join(words(8000 + i, 5, 10**6) + passage[i:] + words(7000 + i, 4, 10**6))) for i in range(40)]
    want, _ = _without_repeats(later, 20, seen)
    got = substring_dedup.remove_repeats(spark.createDataFrame(later, "doc_id long, text string"), 20, index)
    assert _result(got) == sorted(want, key=repr) and any(gone for _, _, gone, _ in want)


def test_the_last_batch_of_a_table_is_not_indexed(spark, monkeypatch):
    added, append = [], substring_dedup.FingerprintIndex.append
    monkeypatch.setattr(substring_dedup.FingerprintIndex, "append", lambda self, docs, anchors, batch: (added.append(batch), append(self, docs, anchors, batch)))
    rows = [(i, " ".join(words(i % 7, 30))) for i in range(60)]
    got = substring_dedup.remove_repeats_in_batches(spark.createDataFrame(rows, "doc_id long, text string"), 20)
    assert _result(got) == sorted(_without_repeats(rows, 20)[0], key=repr)
    assert added == [substring_dedup.batch_number(f"batch {k}") for k in range(2)]


def test_a_batch_does_not_shuffle_the_index(spark, tmp_path):
    """Shuffled bytes follow the batch, not the runs it is merged with."""
    index, spent = substring_dedup.FingerprintIndex(spark, f"file://{tmp_path}/index", 20), []
    total = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    for k in range(4):
        docs = spark.createDataFrame([(1000 * k + i, " ".join(words(1000 * k + i, 300, 10**6))) for i in range(200)], "doc_id long, text string")
        before = total()
        substring_dedup.remove_repeats(docs, 20, index).collect()
        spent.append(total() - before)
    assert max(spent[1:]) < 1.3 * min(spent[1:])


def test_overlapping_windows_within_one_text(spark):
    for text in ("x " * 100, "a b c " * 40, " ".join(words(1, 50, 3))):
        want, _ = _without_repeats([(1, text)], 20)
        assert _result(substring_dedup.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string"))) == want


# --- vectors ---


def _vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows, centres = [], rng.normal(size=(12, 16))
    for i in range(400):
        v = centres[i % 12] + rng.normal(size=16) * (0.05 if i % 3 else 0.4)
        rows.append((i, [float(np.float32(x)) for x in v], i % 12 % 3))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(20)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] * 16, 1), (2004, [1.0] * 16, None), (2005, [float("inf")] * 16, 1), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (None, rows[0][1], rows[0][2])]
    return rows


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"rep": F.lit(1), "vector": F.lit("x"), "id": F.lit(2)}).repartition(5)
    good = [(i, np.array(v, np.float32).astype(float), y) for i, v, y in rows if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [(i, j) for i, v, y in good for j, w, z in good if i != j and y == z and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.98]
    want, degree = components({i for i, *_ in rows if i is not None}, links), Counter(i for i, _ in links)
    got = embedding_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got)
    assert found >= 0.9 * len(links)  # the index's recall; here it is whole
    assert all((r.n_links, r.component_id) == (degree[r.vec_id], want.get(r.vec_id)) for r in got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_vectors_of_many_lengths_and_double_precision(spark):
    rows = [(100 * k + i, [1.0 + (j % 7) * i / 1000 for j in range(k)], "x") for k in range(1, 80) for i in range(2)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, 1, i // 100 * 100) for i, *_ in rows}
    # told apart in double precision alone: in single precision both are one vector
    near = [(1, [1.0, 0.0], "x"), (2, [1.0, 1e-9], "x"), (3, [1.0 + 1e-9, 1e-9], "x")]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(near, "vec_id long, embedding array<double>, label string")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(1, 2, 1), (2, 2, 1), (3, 2, 1)}


# --- archives ---


def test_warc_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 600)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 1500)
    big = "<p>" + "".join(random.Random(2).choices("abcdefgh é\r\n", k=60_000)) + "</p>"
    rows = [(1, "http://a/é b", "<html>x</html>"), (2, None, None), (3, "u\nv", ""), (4, "http://b", "<html>x</html>"), (5, "http://c", big), (5, "http://c", big), (None, "n", "<html>x</html>"), (None, "m", "y"), (5, "http://c", "y"), (6, "x", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit("clash")).repartition(3)
    path = f"file://{tmp_path}/archive"
    warc.write_archive(pages, path)
    got = warc.read_archive(spark, path).collect()
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    last = {}
    for i, _, h in rows:
        last[digest(h)] = max(last.get(digest(h), -1), -1 if i is None else i)
    want = Counter((i, len((h or "").encode()), digest(h), "response" if i == last[digest(h)] else "revisit", None if i == last[digest(h)] else last[digest(h)]) for i, _, h in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {(r.page_id, bytes(r.payload).decode()) for r in got if r.payload is not None} == {(i, h or "") for i, _, h in rows if i == last[digest(h)]}
    some = warc.read_records(spark, path, spark.createDataFrame([(1,), (5,), (99,)], "page_id long")).collect()
    assert sorted((r.page_id, r.record_type) for r in some) == [(1, "revisit"), (5, "response"), (5, "response"), (5, "response")]
    index = warc.archive_index(spark, path).collect()
    # of the rows only two repeat both their id and their payload
    assert len(index) == len(rows) and len({r.record_id for r in index}) == len(rows) - 1
    assert warc.export_bundles(spark.read.parquet(path), str(tmp_path)) >= 1
    for file in tmp_path.glob("*.warc.zst"):  # any Zstandard reader takes the frames and skips the table
        whole = zstandard.ZstdDecompressor().stream_reader(file.read_bytes(), read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1") and whole.endswith(b"\r\n\r\n")
    empty = f"file://{tmp_path}/empty"
    warc.write_archive(pages.limit(0), empty)
    assert warc.read_archive(spark, empty).collect() == []
    warc.write_archive(pages, f"file://{tmp_path}/large-only", min_payload_bytes=1000)
    assert Counter(r.record_type for r in warc.read_archive(spark, f"file://{tmp_path}/large-only", False).collect()) == {"response": len(rows)}


# --- learned models ---

EN, FR = "the of and to in that was with for".split(), "le la des est une dans pour que avec".split()


def _prose(seed, vocabulary, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "s", "x"]) for _ in range(n))


def test_language_id(spark):
    rows = [(i, _prose(i, EN if i % 2 else FR), "en" if i % 2 else "fr") for i in range(240)]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, " 12 !!", "fr"), (902, _prose(5, EN), None), (903, "", None)], "doc_id long, text string, lang string").withColumns({"lang_pred": F.lit("clash"), "k0": F.lit(1)})
    model = language_id.train(docs.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) != 2))
    assert model.labels == ("en", "fr")
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in held]) > 0.97
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 903))
    assert all(0 <= r.score <= 1 for r in got.values()) and got[902].lang_pred == "en"
    left = language_id.filter_documents(docs, model)
    assert left.columns == docs.columns and not {900, 901, 903} & {r.doc_id for r in left.collect()}
    assert language_id.filter_documents(docs, model, ("fr",)).where("lang = 'en'").count() <= 3
    none = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"} and language_id.identify(docs.limit(0), model).collect() == []


def test_long_texts_are_read_whole():
    text = "ab " * 5
    whole = language_id._counts(text * 1000)
    old, language_id._SLICE = language_id._SLICE, 64
    try:
        assert (language_id._counts(text * 1000) == whole).all()
    finally:
        language_id._SLICE = old


def test_quality_classifier(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        ws = [w + "***" if bad and rng.random() < 0.5 else w for w in _prose(i, EN, 80).split()]
        rows.append((i, " ".join(ws)))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "x")], "doc_id long, text string").withColumns({"score": F.lit(1), "label": F.lit(0)})
    marks = spark.createDataFrame([*labels, (901, None), (None, 1), (7777, 0)], "doc_id long, quality int")
    rule = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    model = quality_classifier.train(docs, marks, rows=rule)
    got = {r.doc_id: r for r in quality_classifier.classify(docs, model).collect()}
    held = [(i, q) for i, q in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 50 and np.mean([got[i].predicted == q for i, q in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values()) and len(got) == 303
    left = quality_classifier.filter_documents(docs, model)
    assert left.columns == docs.columns and left.count() == sum(r.predicted for r in got.values())
    again = quality_classifier.train(docs.repartition(7), marks, rows=rule)
    assert (again.weight == model.weight).all()
    assert quality_classifier.classify(docs, quality_classifier.train(docs, marks.limit(0))).count() == 303
    assert quality_classifier.classify(docs.limit(0), model).collect() == []


def test_earlier_texts_that_match_stay_in_place(spark, tmp_path):
    """What is to be verified goes to the texts in the log: their length does not count in the shuffle."""
    total = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    spent = []
    for length in (50, 5000):
        index = substring_dedup.FingerprintIndex(spark, f"file://{tmp_path}/index-{length}", 20)
        first = [(i, " ".join(words(i, length, 10**6) + words(5000 + i, 30, 10**6))) for i in range(100)]
        substring_dedup.remove_repeats(spark.createDataFrame(first, "doc_id long, text string"), 20, index).collect()
        second = [(1000 + i, " ".join(words(5000 + i, 30, 10**6) + ["end"])) for i in range(100)]
        before = total()
        out = substring_dedup.remove_repeats(spark.createDataFrame(second, "doc_id long, text string"), 20, index, add=False).collect()
        spent.append(total() - before)
        assert all(r.n_removed == 30 for r in out)
    assert spent[1] < 1.5 * spent[0]
