"""Packing of documents into fixed windows of token ids by best-fit decreasing.

A segment tree indexed by remaining capacity finds the tightest open window for each piece; overlong
documents are first cut into full windows. Only piece lengths travel: the ids stay where they were
made, as each piece's bounds are known before it is placed.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import LOWER, SPACE, slices, stored, text_buffers, word_bounds

#: Pieces of one packing shard, which one task packs, on average; more input means more shards.
SHARD_PIECES = 65_536
#: A worker remembers the ids of the parts of words that it met last: at least so many, at most twice as
#: many, none longer than so many bytes (speed only).
REMEMBERED, REMEMBERED_BYTES = 250_000, 64
#: Texts are taken in slices of about so many bytes, whose distinct parts are looked up once.
SLICE_BYTES = 4 << 20
#: Parts that the library encodes in one call.
_TOGETHER = 64

#: Fixed value: how the supported files split text. Digits stand alone; letters, and what is neither letter
#: nor digit, stand together; a contraction is a part of its own.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of lower-case printable ASCII are split by arrays of bytes; other Latin ones by the same pattern for
#: characters whose lowering and composing is one for one; the library splits the rest.
_LATIN = re.compile(r"[!-~À-ÖØ-öø-įıĲ-ňŊ-ž]+")
_LATIN_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-z0-9ß-öø-ž]+")
#: A part that is split already; words in which a special string stands are not lowered, or hold ``<|``.
_PLAIN = re.compile(r"'?[a-z]+|[0-9]|[!-/:-@\[-`{-~]+")
_LETTER, _DIGIT, _OTHER, _ODD = 1, 2, 3, 4
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _OTHER
_KIND[97:123], _KIND[48:58], _KIND[65:91] = _LETTER, _DIGIT, _ODD
_KIND[SPACE] = 0
_AFTER_QUOTE = np.isin(np.arange(256), list(b"stmd"))
_TWO_AFTER_QUOTE = np.array([int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")])


def part_starts(low: np.ndarray, begin: np.ndarray, end: np.ndarray, whole: list[tuple[int, int]]) -> np.ndarray:
    """Byte positions where parts of words start. Words with other bytes than lower-case printable ASCII,
    and those in the spans ``whole``, are one part."""
    n, kind = len(low), _KIND[low]
    for a, b in whole:
        kind[a:b][kind[a:b] > 0] = _ODD
    first, inner = np.zeros(n, bool), kind == _DIGIT
    first[begin] = True
    inner[1:] |= kind[1:] != kind[:-1]
    quote = np.flatnonzero((low == 39) & (kind == _OTHER))
    quote = quote[first[quote] | (kind[quote - 1] != _OTHER)]
    if len(quote):
        padded = np.append(low, np.zeros(3, np.uint8)).astype(np.int64)
        size = np.where(_AFTER_QUOTE[padded[quote + 1]], 2, np.where(np.isin(padded[quote + 1] << 8 | padded[quote + 2], _TWO_AFTER_QUOTE), 3, n + 1))
        stop = end[np.searchsorted(begin, quote, "right") - 1]
        fits = quote + size <= stop
        quote, size, stop = quote[fits], size[fits], stop[fits]
        inner[quote + 1] = False
        inner[(quote + size)[quote + size < stop]] = True
    odd = np.zeros(n + 1, np.int32)
    np.cumsum(kind == _ODD, out=odd[1:])
    odd = odd[end] > odd[begin]
    if odd.any():
        edge = np.zeros(n + 1, np.int8)
        edge[begin[odd]] += 1
        edge[end[odd]] -= 1
        inner &= np.cumsum(edge[:-1], dtype=np.int8) == 0
    return np.flatnonzero(first | (inner & (kind > 0)))


class WordIds:
    """Ids of whole texts by the `tokenizers` library, found once for each distinct part of a slice.

    Usable for vocabularies that drop white space and never merge across it: the ids of a text are
    then those of its white-space-separated words, and these words' parts, in order.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core already
        import json

        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.load(open(path, encoding="utf-8"))
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        suffix = spec["model"].get("end_of_word_suffix")
        split = splits[0].get("behavior") == "Removed" and splits[0].get("pattern", {}).get("Regex") == PATTERN and [x["type"] for x in splits[1:]] == ["ByteLevel"]
        if not suffix or not split or kinds != ["NFC", "Replace", "Lowercase"] or any(t["lstrip"] or t["rstrip"] or re.search(r"\s|[A-Z]", t["content"]) for t in spec["added_tokens"]):
            raise ValueError(f"{path} does not tokenise word by word")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        # parts need neither normalising nor splitting: they go to the merges alone, many in one call with
        # white space between them, and the last id of each has the suffix of a word's end
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.last = np.zeros(self.merges.get_vocab_size(), bool)
        self.last[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _merged(self, parts: list[str]) -> list[bytes]:
        groups, found = [parts[a : a + _TOGETHER] for a in range(0, len(parts), _TOGETHER)], []
        for e in self.merges.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False):
            ids = np.array(e.ids, "<u4")
            ends, flat = (4 * np.flatnonzero(self.last[ids]) + 4).tolist(), ids.tobytes()
            found += [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        return found

    def _odd(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not of lower-case printable ASCII."""
        out: list[bytes] = [b""] * len(words)
        latin = {k: _LATIN_PART.findall(w.lower()) for k, w in enumerate(words) if _LATIN.fullmatch(w) and not any(s.decode() in w for s in self.special)}
        parts = list({x for row in latin.values() for x in row})
        ids = dict(zip(parts, self._merged(parts), strict=True))
        for k, row in latin.items():
            out[k] = b"".join([ids[x] for x in row])
        rest = [k for k in range(len(words)) if k not in latin]
        for a in range(0, len(rest), 4096):
            for k, e in zip(rest[a : a + 4096], self.tokenizer.encode_batch_fast([words[k] for k in rest[a : a + 4096]], add_special_tokens=False), strict=True):
                out[k] = np.array(e.ids, "<u4").tobytes()
        return out

    def of_parts(self, parts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of distinct parts."""
        young, old = self.young, self.old
        out = [young.get(x) or old.get(x) for x in parts]
        todo = [k for k, x in enumerate(out) if x is None]
        texts = [parts[k].decode("utf-8", "replace") for k in todo]
        odd = [_PLAIN.fullmatch(x) is None for x in texts]
        plain, other = self._merged([x for x, o in zip(texts, odd, strict=True) if not o]), self._odd([x for x, o in zip(texts, odd, strict=True) if o])
        plain.reverse()
        other.reverse()
        for k, o in zip(todo, odd, strict=True):
            out[k] = (other if o else plain).pop()
        if len(young) + len(parts) > REMEMBERED:
            self.old, self.young = young, {}
        self.young.update((x, ids) for x, ids in zip(parts, out, strict=True) if len(x) < REMEMBERED_BYTES)
        return out

    def ids(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, each text's followed by ``end_id``; the n + 1 bounds of the texts)."""
        offsets = offsets - offsets[0]
        # ASCII case folding leaves the ids as they are unless it makes a special string
        low, spans = LOWER[data], []
        whole = low.tobytes()
        special = [s for s in self.special if s in whole]
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) if special else ():
            if any(s in whole[a:b] for s in special):
                low[a:b] = data[a:b]
                spans.append((a, b))
        starts = part_starts(low, *word_bounds(low, offsets), spans)
        ink = ~SPACE[low]
        place = np.zeros(len(low) + 1, np.int64)
        np.cumsum(ink, out=place[1:])
        bounds, letters = np.append(place[starts], place[-1]), low[ink]
        every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode()
        _, at, raw = every.dictionary.buffers()
        at, raw = np.frombuffer(at, np.int64)[: len(every.dictionary) + 1].tolist(), raw.to_pybytes() if raw else b""
        found = [*self.of_parts([raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]), np.array([end_id], "<u4").tobytes()]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(found), "<u4")
        ends = np.searchsorted(starts, offsets[1:])  # parts before the end of each text
        part = np.insert(every.indices.to_numpy().astype(np.int64), ends, len(found) - 1)
        n = size[part]
        total = np.zeros(len(part) + 1, np.int64)
        np.cumsum(n, out=total[1:])
        ids = flat[np.repeat(first[part] - total[:-1], n) + np.arange(total[-1])]
        return ids, np.append(0, total[ends + np.arange(1, len(ends) + 1)])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class CapacityTree:
    """Open windows by remaining capacity, under a segment tree that counts them."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        i = self.base + capacity
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest open window that holds ``need``."""
        count, i = self.count, self.base + need
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.base
        while i:
            count[i] -= 1
            i >>= 1
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset there) of each piece; ``lengths`` must be in decreasing order."""
    tree, opened = CapacityTree(window), 0
    at, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, n in enumerate(lengths.tolist()):
        found = tree.take(n) if n < window else None
        if found is None:
            found, opened = (window, opened), opened + 1
        at[k], offset[k] = found[1], window - found[0]
        if found[0] > n:
            tree.add(found[0] - n, found[1])
    return at, offset


def cut_documents(docs: DataFrame, tokenizer_path: str, window: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens) of every piece: full windows, then the remainder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_ids(tokenizer_path)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets, SLICE_BYTES):
                ids, bounds = tokens.ids(data[offsets[a] : offsets[b]], offsets[a : b + 1], end_id)
                total = np.diff(bounds)
                count = -(-total // window)
                row = np.repeat(np.arange(b - a), count)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * window
                length = np.minimum(window, total[row] - start)
                begin, flat = bounds[row] + start, memoryview(ids.view(np.uint8))
                crcs = [zlib.crc32(flat[4 * p : 4 * q]) for p, q in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + a)), *(pa.array(x, pa.int64()) for x in (start, length, crcs, total[row]))], ["id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Pieces are dealt in turn to so many shards that ``SHARD_PIECES`` come to each, and each shard is packed on
    its own; dealing starts anew in each partition, so a shard may hold as many pieces more as there are
    partitions. The shard is the high part of ``sequence_id``. A null or empty text
    has the end id alone; null ids and repeated rows are packed like any other row; an empty table
    gives an empty result; other columns are not read.
    """
    pieces = stored(cut_documents(docs, tokenizer_path, window, end_id, id_col, text_col), "pieces")
    shards = max(1, -(-pieces.count() // SHARD_PIECES))
    kind = docs.schema[id_col].dataType.simpleString()

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id", "start"], ascending=[False, True, True], kind="stable")
        at, offset = best_fit_decreasing(pdf["length"].to_numpy(), window)
        return pdf.assign(sequence_id=(pdf["shard"].to_numpy(np.int64) << 32) + at, offset=offset).drop(columns="shard")

    dealt = pieces.withColumn("shard", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(shards)).cast("long"))
    out = dealt.groupBy("shard").applyInPandas(place, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
