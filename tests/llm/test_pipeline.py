"""The pipeline's stages on a small fixture, each held against brute force on its own input."""

from collections import Counter

import public_tokenizers
from llm_helpers import components, edited, words
from test_dedup_and_models import EN, FR, _prose, _shingles, _without_repeats
from tokenizers import Tokenizer

import corpus_pipeline


def test_pipeline(spark, tmp_path):
    texts = [_prose(i, EN if i % 2 else FR, 70) for i in range(120)]
    passage = " ".join(words(77, 60))
    base = words(5, 120)
    texts += [texts[3], texts[3], " ".join(base), " ".join(edited(base, 1, 0.01)), f"{texts[4]}\n{passage}", f"{texts[7]}\n{passage} and then"]
    texts += [" ".join(f"{w}***" for w in _prose(500 + i, EN, 70).split()) for i in range(30)]
    rows = [(i, t, "fr" if i % 2 == 0 and i < 120 else "en", "s", len(t)) for i, t in enumerate(texts)] + [(999, "", "en", "s", 0), (998, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    quality = [(i, int("***" not in t)) for i, t in enumerate(texts) if i % 3 or i > 125]
    spark.createDataFrame(quality, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")

    kept, sets = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.collect()
        kept = spark.createDataFrame(stage(spark, kept, str(tmp_path)).collect(), docs.schema)
        assert kept.columns == docs.columns
        sets.append((before, kept.collect()))
    ids = [{r.doc_id for r in after} for _, after in sets]
    assert ids[0] & set(range(120)) == set(range(120)) and not ids[0] & set(range(126, 156))
    assert not ids[1] & {998, 999} and ids[1] & set(range(120)) == set(range(120))
    before, after = sets[2]
    shingles = {r.doc_id: _shingles(r.text, 5) for r in before}
    links = [(a, b) for a, s in shingles.items() for b, t in shingles.items() if a != b and s and 100 * len(s & t) >= 80 * len(s | t)]
    assert ids[2] == {d for d, c in components(set(shingles), links).items() if d == c} and not {120, 121} & ids[2]
    before, after = sets[3]
    want, _ = _without_repeats([(r.doc_id, r.text) for r in before], 20)
    assert {r.doc_id: r.text.split() for r in after} == {d: k.split() for d, _, _, k in want} and any(n for _, _, n, _ in want)
    assert all(r.n_chars == len(r.text) for r in after)

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = Counter({r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in after})
    got = Counter()
    for r in out:
        got[r.doc_id] += r.length
    assert got == tokens and all(r.offset + r.length <= 2048 for r in out)
    empty = f"{tmp_path}/empty"
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert {n for n in entry.oracle_sql() if n.startswith("op")} == {"op1_quality_rules", "op2_substring_dedup", "op7_minhash", "op9_embedding_dedup", "op10_warc", "op11_lexical_search", "op12_secret_scan", "op13_importance_resampling"}
