"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Normaliser, pieces and byte fallback are compiled into states and arcs that read one character each. The
normaliser's arcs come from the model's character map; it reads the longest key that it can, and writes its
replacement. The pieces' arcs form a tree, whose final states write a piece's id (or, for a character that is
no piece, its bytes' ids) and lead back to the start. Composed with an input, normaliser first, this is a
lattice over positions; the encoding is its shortest path in the tropical semiring (weights add along a
path, the least total wins).

- Unigram models: an arc weighs minus the piece's log probability.
- BPE models: an arc also remembers the piece before it and weighs 0 if the two pieces may stand side by
  side (merging the text of both gives back exactly the two), else infinity. A sequence of pieces whose
  neighbours may all stand side by side is the BPE encoding, and there is just one, also of every prefix:
  so one state a position is enough.

No piece crosses from a non-space to a space, so the lattice falls apart there; the paths of recurring
parts are remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the public model format: piece types, model types, the visible space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
#: An unknown character weighs so much more than the worst piece (unigram models; fixed value).
UNKNOWN_PENALTY = 10.0
INFINITE = float("inf")
#: A worker remembers so many parts, and so many pairs, then begins anew (speed only).
REMEMBERED = 800_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


def character_map(blob: bytes) -> dict:
    """A model's character map as a tree of characters; where a key ends, the state's arc "" holds its
    replacement. The public form is the size of a double array of 32-bit units over the keys' bytes, the
    array (a unit has a label, whether a value follows, and the exclusive-or of its children's places), and
    the replacements, each ended by a zero byte."""
    root: dict = {}
    if not blob:
        return root
    (size,) = struct.unpack_from("<I", blob)
    units, texts = np.frombuffer(blob, "<u4", size // 4, 4), blob[4 + size :]
    labels, bytes_ = units & np.uint32(0x800000FF), np.arange(256, dtype=np.int64)

    def children(place: int) -> int:
        unit = int(units[place])
        return place ^ ((unit >> 10) << ((unit & (1 << 9)) >> 6))

    todo = [(b"", children(0))]
    while todo:
        key, base = todo.pop()
        places = base ^ bytes_[1:]
        places = places[places < len(units)]
        for place in places[labels[places] == (base ^ places)].tolist():
            longer, below = key + bytes([base ^ place]), children(place)
            if units[place] >> np.uint32(8) & np.uint32(1):
                at = int(units[below]) & 0x7FFFFFFF
                node = root
                for c in longer.decode():
                    node = node.setdefault(c, {})
                node[""] = texts[at : texts.index(b"\0", at)].decode()
            todo.append((longer, below))
    return root


class Transducer:
    """A compiled .model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = f.read()
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        kind_of_model, byte_fallback = UNIGRAM, False
        self.dummy_prefix = self.trim = escape = True
        charsmap = b""
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
                kind_of_model, byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                norm = dict(_fields(value))
                charsmap, self.dummy_prefix, self.trim, escape = norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1))
        if not escape or kind_of_model not in (UNIGRAM, BPE) or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError(f"{path}: only plain unigram or BPE pieces with visible spaces are compiled")
        self.map = character_map(charsmap)
        self.mapped = re.compile("[" + "".join(map(re.escape, self.map)) + "]") if self.map else None
        self.bpe = kind_of_model == BPE
        self.unknown = self.kinds.index(UNKNOWN)
        #: text of a piece -> (weight, id); the arcs of the transducer
        self.arcs = {p: (-s, i) for i, (p, s, k) in enumerate(zip(self.pieces, scores, self.kinds, strict=True)) if k == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.arcs):
            raise ValueError(f"{path}: a piece crosses from a non-space to a space")
        #: the tree: a state is its arcs by character; the arc "" of a final one holds the weight and the piece
        self.root: dict = {}
        for p, (w, _) in self.arcs.items():
            node = self.root
            for c in p:
                node = node.setdefault(c, {})
            node[""] = (w, p)
        self.inside = {p[k - 1 : k + 1] for p in self.arcs for k in range(1, len(p))}
        self.unknown_weight = max((w for w, _ in self.arcs.values()), default=0.0) + UNKNOWN_PENALTY
        byte_of = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.byte_arcs = [byte_of[b] for b in range(256)] if byte_fallback and len(byte_of) == 256 else None
        self.byte_value = {i: b for b, i in byte_of.items()}
        self.known: dict[str, tuple[int, ...]] = {}
        #: piece -> the pieces asked for after it, and whether they may stand there
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0

    # --- weights of pairs (BPE) ---

    def _merged(self, text: str) -> list[str]:
        """Merge the best-scored adjacent pair, leftmost first, until none is a piece."""
        parts, arcs = list(text), self.arcs
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = arcs.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found[0] < best):
                    best, at = found[0], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _side_by_side(self, left: str, right: str) -> bool:
        return self._merged(left + right) == ([left, right] if left else [right])

    # --- composition with an input, and its shortest path ---

    def normalised(self, text: str) -> str:
        """What the normaliser writes for a text."""
        if self.mapped is not None:
            out, at, n = [], 0, len(text)
            while at < n:
                found = self.mapped.search(text, at)
                if found is None:
                    break
                begin = end = found.start()
                out.append(text[at:begin])
                node, k, written = self.map, begin, None
                while k < n and (node := node.get(text[k])) is not None:
                    k += 1
                    if "" in node:
                        end, written = k, node[""]
                out.append(text[begin] if written is None else written)
                at = max(end, begin + 1)
            out.append(text[at:])
            text = "".join(out)
        if self.trim:
            text = text.lstrip(" ").rstrip(" " + SPACE)  # at the end, visible spaces go as well
            while "  " in text:
                text = text.replace("  ", " ")
        return text

    def _path(self, part: str) -> list[str]:
        """The pieces on the shortest path through the lattice of ``part``."""
        n, root, bpe, unknown = len(part), self.root, self.bpe, self.unknown_weight
        best: list[float] = [0.0] + [INFINITE] * n
        last = [""] * (n + 1)
        for i in range(n):
            here, left = best[i], last[i]
            fits = self.pairs.get(left)
            if fits is None:
                fits = self.pairs[left] = {}
            node, j = root, i
            while j < n:
                node = node.get(part[j])
                j += 1
                final = node.get("") if node is not None else None
                if final is None:
                    if j > i + 1:
                        if node is None:
                            break
                        continue
                    final = unknown, part[i]  # a character that is no piece has a final state of its own
                weight, piece = final
                if bpe:
                    if best[j] == INFINITE:
                        fit = fits.get(piece)
                        if fit is None:
                            fit = fits[piece] = self._side_by_side(left, piece)
                            self.n_pairs += 1
                        if fit:
                            best[j], last[j] = here, piece
                elif here + weight < best[j]:
                    best[j], last[j] = here + weight, piece
                if node is None:
                    break
        if self.n_pairs > REMEMBERED:
            self.pairs, self.n_pairs = {}, 0
        out, j = [], n
        while j:
            out.append(last[j])
            j -= len(last[j])
        return out[::-1]

    def _ids(self, part: str) -> tuple[int, ...]:
        ids: list[int] = []
        unknown = False
        for piece in self._path(part):
            arc = self.arcs.get(piece)
            if arc is not None:
                ids.append(arc[1])
            elif self.byte_arcs is not None:
                ids.extend(self.byte_arcs[b] for b in piece.encode())
            elif not unknown:  # a run of unknown characters is one token
                ids.append(self.unknown)
            unknown = arc is None
        return tuple(ids)

    def _part(self, chunk: str) -> tuple[int, ...]:
        """Ids of a chunk. Where no piece has two neighbouring characters next to each other, no arc of
        the lattice crosses, and the parts on both sides are dealt with, and remembered, on their own."""
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        inside, begin, ids = self.inside, 0, ()
        cuts = [k for k in range(1, len(chunk)) if chunk[k - 1 : k + 1] not in inside] if self.byte_arcs is not None else []
        for end in [*cuts, len(chunk)]:
            part = chunk[begin:end]
            found = self.known.get(part)
            if found is None:
                found = self._ids(part)
                if len(part) < 64:
                    self.known[part] = found
            ids, begin = ids + found if begin else found, end
        if len(chunk) < 64:
            self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        text = self.normalised(text)
        if not text:
            return []
        text = text.replace(SPACE, " ")  # a visible space in the input is the same symbol
        if self.dummy_prefix:
            text = " " + text
        head, *rest = text.split(" ")
        ids: list[int] = []
        if head:
            ids += self._part(head)
        known, run = self.known, 1
        for i, chunk in enumerate(rest):
            if not chunk and i < len(rest) - 1:  # a longer run of spaces belongs to what follows it
                run += 1
                continue
            part = SPACE * run + chunk
            run = 1
            ids += known.get(part) or self._part(part)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The inverse transducer: pieces to text, runs of bytes to characters, visible spaces to spaces."""
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_value:
                held.append(self.byte_value[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if self.kinds[i] == NORMAL:
                out.append(self.pieces[i].replace(SPACE, " "))
            elif self.kinds[i] == UNKNOWN:
                out.append(" ⁇ ")
        if held:
            out.append(held.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the piece ids of each whole text, as the library gives them without begin or end ids.

    Null and empty texts have an empty list; null ids and repeated rows are kept as they are; an empty
    table gives an empty result; other columns are not read; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fst.encode(t or "") for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from (id, ids). A null list gives an empty text; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fst.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, text, restored): the encoding of each text, what its decoding gives, and whether that is
    the text again (null counts as empty), in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids = [fst.encode(t) for t in texts]
                back = [fst.decode(x) for x in ids]
                same = [a == b for a, b in zip(texts, back, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string()), pa.array(same, pa.bool_())], ["id", "ids", "text", "restored"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>, text string, restored boolean").withColumnRenamed("id", id_col)
