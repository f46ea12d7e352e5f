"""Token counts by heap-and-linked-list byte-pair merging.

The pair of adjacent symbols with the lowest merge rank is popped from a heap again and again; a
doubly linked list holds the symbols. The count is the number of initial symbols less the number of
merges: no identifiers are made.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the public byte-level pattern that splits text before any merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A worker remembers the counts of so many distinct chunks, then begins anew (speed only).
REMEMBERED = 1_000_000


def _byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: printable Latin-1 bytes
    stand for themselves, the rest take the code points from 256 on in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class ByteMerges:
    """The merges of a byte-level BPE file of the `tokenizers` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        plain = pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and spec["normalizer"] is None
        if not plain or model["type"] != "BPE" or model.get("ignore_merges") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        vocab = model["vocab"]
        self.of_byte = [vocab[s] for s in _byte_symbols()]
        #: (left id, right id) in one integer -> rank and new id in one integer
        self.pairs: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs.setdefault(vocab[a] << 32 | vocab[b], rank << 32 | vocab[a + b])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def count_piece(self, piece: bytes) -> int:
        """Symbols left of one piece when no more pair can be merged."""
        of, pairs = self.of_byte, self.pairs
        ids = [of[b] for b in piece]
        n = left = len(ids)
        if n < 2:
            return n
        heap = [(rank, i) for i in range(n - 1) if (rank := pairs.get(ids[i] << 32 | ids[i + 1], -1)) >= 0]
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            found, i = heappop(heap)
            j = after[i]
            # a popped pair is stale if either of its symbols has been merged meanwhile
            if j >= n or ids[i] < 0 or pairs.get(ids[i] << 32 | ids[j], -1) != found:
                continue
            ids[i], ids[j] = found & 0xFFFFFFFF, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := pairs.get(ids[i] << 32 | ids[k], -1)) >= 0:
                    heappush(heap, (rank, i))
            if (h := before[i]) >= 0 and (rank := pairs.get(ids[h] << 32 | ids[i], -1)) >= 0:
                heappush(heap, (rank, h))
        return left

    def _chunk(self, chunk: str) -> int:
        known, n = self.known, 0
        if len(known) >= REMEMBERED:
            known.clear()
        for piece in self.split.findall(chunk):
            m = known.get(piece)
            if m is None:
                m = self.count_piece(piece.encode())
                if len(piece) < 100:
                    known[piece] = m
            n += m
        if len(chunk) < 100:
            known[chunk] = n
        return n

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings. A space followed by a non-space always starts a
        piece, so what lies between two such places is counted on its own, and remembered."""
        if not text:
            return 0
        head, *rest = text.split(" ")
        if "" in rest or not head:  # runs of spaces belong together
            head, *rest = regex.split(r" (?=\S)", text)
        n, get = self._chunk(head) if head else 0, self.known.get
        for c in rest:
            c = " " + c
            n += get(c) or self._chunk(c)
        return n

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


@lru_cache(maxsize=4)
def byte_merges(path: str) -> ByteMerges:
    return ByteMerges(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``, without a shuffle.

    Whole texts are counted, special strings inside them as one token each, as the library does by
    default. Null and empty texts have 0 bytes and 0 tokens; null ids and repeated rows are kept as
    they are; an empty table gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = byte_merges(tokenizer_path)
        for batch in batches:
            counts = [merges.count(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
