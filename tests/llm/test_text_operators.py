import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, quality_rules, sentencepiece_fst, token_counts
from tidemark.llm.shared import text_buffers

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["", " ", "a  b\n\n c <|endoftext|> x<|endoftext|>", "  lead", "trail  ", "\n x", "x y  　z", "don't WE'LL 12a\t\tb \r\n", "漢字 かな ▁ x▁y ▁▁", "<0x0A> <unk> </s>", "aaaaaaaaa bbb", "😀 é é İ Σίσυφος ΣΑΣ", "x\x00y\x1fz", "<|STARTOFTEXT|> <|startoftext|>a", "# * !!"]
TEXT = st.lists(st.sampled_from([*"ab cé \n.'<|>▁0Σß", "<|endoftext|>", "  "]), max_size=40).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_tokenisers_equal_the_libraries(text):
    assert token_counts.byte_merges(BYTE).count(text) == len(_byte().encode(text, add_special_tokens=False).ids)
    fst = sentencepiece_fst.transducer(PIECE)
    ids = _piece().encode(text)
    assert fst.encode(text) == ids and fst.decode(ids) == _piece().decode(ids)
    assert _word_ids([text]) == [_word().encode(text, add_special_tokens=False).ids]


def _word_ids(texts):
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    ids, bounds = packing.word_ids(WORD).ids(data, offsets, 1)
    found = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert all(x[-1] == 1 for x in found)
    return [x[:-1] for x in found]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab'stvelrdm'19!-\u00e9\u00c9\u0130\u03a3\u00a0\u6f22\x01 \n", "'re", "'s", "<|endoftext|>", "<|ENDOFTEXT|>"]), max_size=20).map("".join), max_size=5))
def test_word_ids_equal_the_library(texts):
    assert _word_ids(texts) == [_word().encode(t, add_special_tokens=False).ids for t in texts]


_cache = {}


def _byte():
    return _cache.setdefault("b", Tokenizer.from_file(BYTE))


def _word():
    return _cache.setdefault("w", Tokenizer.from_file(WORD))


def _piece():
    return _cache.setdefault("p", sentencepiece.SentencePieceProcessor(model_file=PIECE))


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    test_tokenisers_equal_the_libraries.hypothesis.inner_test(text)


def test_token_counts(spark, docs, clashing):
    got = token_counts.count_tokens(docs, BYTE, 100).collect()
    assert len(got) == docs.count()
    want = Counter((r.doc_id, len((r.text or "").encode()), len(_byte().encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert Counter(token_counts.count_tokens(clashing, BYTE, 100).collect()) == Counter(got)
    assert token_counts.count_tokens(docs.limit(0), BYTE).collect() == []
    with pytest.raises(ValueError):
        token_counts.ByteMerges(WORD)


def test_sentencepiece(spark, docs, clashing):
    encoded = sentencepiece_fst.encode(clashing, PIECE)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in encoded.collect():
        assert r.ids == _piece().encode(texts[r.doc_id])
    assert all(r.text == texts[r.doc_id] for r in sentencepiece_fst.decode(encoded, PIECE).collect())
    assert all(r.restored for r in sentencepiece_fst.round_trip(docs, PIECE).collect())
    assert sentencepiece_fst.encode(docs.limit(0), PIECE).collect() == []


def _message(*fields):
    """A protocol buffer message of (number, value): int, float or bytes."""

    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def _model(kind, byte_fallback, rule):
    """A hand-made .model: no training, pieces and scores as listed."""
    special = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256) if byte_fallback]
    # of a BPE model the score is minus the rank of the merge
    pieces = [("\u2581", -2.5), ("a", -3.0), ("b", -3.25), ("ab", -4.0), ("abb", -9.0), ("\u2581a", -4.5), ("bab", -5.0), ("c", -3.5), ("\u2581ab", -6.0), ("1", -4.0), ("fi", -4.25), ("f", -5.0), ("i", -5.25), ("\u2581\u2581", -3.75), ("ca", -6.5)]
    rows = [(1, _message((1, p.encode()), (2, float(s)), *(((3, k),) if k else ()))) for p, s, k in [*special, *((p, s, 0) for p, s in pieces)]]
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    normaliser = dict(sentencepiece_fst._fields(spec))[3]
    return _message(*rows, (2, _message((3, kind), (35, int(byte_fallback)))), (3, normaliser))


@pytest.mark.parametrize("kind", [1, 2])
@pytest.mark.parametrize("byte_fallback", [False, True])
@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc_cf"])
def test_models_of_other_kinds_equal_the_library(tmp_path, kind, byte_fallback, rule):
    path = tmp_path / "x.model"
    path.write_bytes(_model(kind, byte_fallback, rule))
    fst, library = sentencepiece_fst.Transducer(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    rng = random.Random(3)
    odd = [*"aaabbbcfi1  x", "\ufb01", "\u3000", "\uff21", "\u2460", "\u00a8", "e\u0301", "\t", "\n", "\u00ad", "\uac00", "\u1100\u1161", "\u0130", "\u2581", "A", "\u00df"]
    for _ in range(400):
        text = "".join(rng.choice(odd) for _ in range(rng.randrange(14)))
        assert fst.normalised(text).replace(" ", "\u2581") == normaliser.normalize(text).removeprefix("\u2581" if fst.dummy_prefix else "")
        assert fst.encode(text) == library.encode(text), text


def test_packing(spark, docs, clashing):
    window = 64
    got = packing.pack(clashing, WORD, window, 1).collect()
    ids = {}
    for r in docs.select("doc_id", "text").distinct().collect():
        ids[r.doc_id] = [*_word().encode(r.text or "", add_special_tokens=False).ids, 1]
    per_doc, sequences = {}, {}
    for r in got:
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        per_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, pieces in per_doc.items():
        pieces = sorted(set(pieces)) if d == 2 else sorted(pieces)  # id 2 stands in two equal rows
        assert [s for s, _ in pieces] == np.cumsum([0, *(n for _, n in pieces[:-1])]).tolist() and sum(n for _, n in pieces) == len(ids[d])
    for pieces in sequences.values():
        pieces.sort()
        assert [s for s, _ in pieces] == np.cumsum([0, *(n for _, n in pieces[:-1])]).tolist() and sum(n for _, n in pieces) <= window
    tokens = sum(r.length for r in got)
    assert tokens == sum(len(ids[r.doc_id]) for r in docs.collect()) and tokens > 0.93 * window * len(sequences)
    assert packing.pack(docs.limit(0), WORD).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_takes_the_tightest_window(lengths):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    at, offset = packing.best_fit_decreasing(lengths, 40)
    room = []
    for n, w, o in zip(lengths.tolist(), at.tolist(), offset.tolist(), strict=True):
        fits = [c for c in room if c >= n]
        if fits:
            assert room[w] == min(fits)
        else:
            assert w == len(room)
            room.append(40)
        assert o == 40 - room[w]
        room[w] -= n


def _measures(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(zip(ws, ws[1:], ws[2:]))
    covered = {i + k for i in range(len(ws) - 2) if seen[ws[i], ws[i + 1], ws[i + 2]] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, docs, clashing):
    got = quality_rules.apply_rules(docs).collect()
    want = Counter((r.doc_id, *_measures(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.rejected_by is None) and not (r.base_failed and r.kept)
    kept = Counter(r.doc_id for r in got if r.kept)
    left = quality_rules.filter_documents(clashing)
    assert left.columns == clashing.columns and Counter(r.doc_id for r in left.collect()) == kept
    assert quality_rules.apply_rules(docs.limit(0)).collect() == []


def test_quality_rules_use_no_python_and_order_does_not_matter(spark, docs):
    plan = quality_rules.apply_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    want = {(r.doc_id, r.kept) for r in quality_rules.apply_rules(docs, order=quality_rules.RULES).collect()}
    for order in (quality_rules.RULES[::-1], quality_rules.RULES[3:] + quality_rules.RULES[:3]):
        assert {(r.doc_id, r.kept) for r in quality_rules.apply_rules(docs, order=order).collect()} == want
        left = quality_rules.filter_documents(docs, order=order)
        assert {r.doc_id for r in left.collect()} == {d for d, kept in want if kept}
    estimates = quality_rules.estimate(docs, quality_rules.RULES, 50, 1)
    assert {e.rule for e in estimates} == set(quality_rules.RULES) and all(e.seconds >= 0 and 0 <= e.rejected <= 1 for e in estimates)
    free = quality_rules.estimate(docs, quality_rules.RULES, 50, 1, made=quality_rules.REPORTED)
    assert all(e.seconds == 0 for e in free if set(e.rule.measures) <= set(quality_rules.REPORTED))


def test_a_rejection_spares_the_later_measures(spark, monkeypatch):
    """A measure that fails wherever it is made is not made for texts that an earlier rule rejects."""
    monkeypatch.setitem(quality_rules._STEPS[4], "n_trap", lambda: F.raise_error(F.col("text")).cast("long"))
    monkeypatch.setitem(quality_rules._NEEDS, "n_trap", ["text"])
    trap = quality_rules.Rule("trap", "n_trap > 0", ("n_trap",))
    short = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    first = (quality_rules.BASE_RULES[0], trap)
    assert [r.rejected_by for r in quality_rules.apply_rules(short, order=first).collect()] == ["few_words"] * 2
    assert quality_rules.filter_documents(short, order=first).collect() == []
    with pytest.raises(Exception, match="one two"):
        quality_rules.apply_rules(short.where("doc_id = 1"), order=first[::-1]).collect()


def test_junk_goes_and_clean_text_stays(spark):
    clean = " ".join(f"Word{i} thing{i} of" for i in range(40))
    junk = ["same " * 80, " ".join(f"w{i}***" for i in range(80)), clean.upper() + "!!", "\n".join(["A line of words that comes again"] * 3 + ["other"]) * 5, "short"]
    df = spark.createDataFrame([(0, clean), *enumerate(junk, 1)], "doc_id long, text string")
    assert [r.doc_id for r in quality_rules.apply_rules(df).where(F.col("kept")).collect()] == [0]
