"""What several operators share: written intermediate tables, vectorised word hashing, sorted groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.scratch import clear_scratch, delete_path, forget_plans, release, scratch_path, scratch_root, stored, stored_alone  # noqa: F401

#: Texts are hashed in slices of about so many bytes, which bounds the temporary arrays of a task.
SLICE_BYTES = 1 << 20
def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids give bucket 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def list_rows(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    """The rows of a list column without nulls, as views of its values."""
    if isinstance(column, pa.ChunkedArray):
        return [row for chunk in column.chunks for row in list_rows(chunk)]
    values, bounds = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


# --- words -----------------------------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Multipliers and seeds of the hashes (arbitrary fixed numbers).
_LEFT, _RIGHT, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
#: Masks of the first 0 to 8 bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left * _LEFT + right) * _RIGHT ^ right)


def runs_hash(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values: result[i] covers values[i : i + k]. Runs are joined from runs of
    half their length by a step that is linear in neither, so no pattern of values cancels out."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, width = None, 0, values, 1
    while True:
        if k & width:
            out = power[:n] if out is None else _joined(out[:n], power[done : done + n])
            done += width
        if 2 * width > k:
            return mix(out + np.uint64(k))
        power, width = _joined(power[:-width], power[width:]), 2 * width


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where the words of some texts begin and end; the texts' offsets start at 0."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    word = np.zeros(n + 2, bool)
    word[1:-1] = ~SPACE[data]
    return np.flatnonzero(word[1:] & (edge | ~word[:-1])), np.flatnonzero(word[:-1] & (edge | ~word[1:]))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null is the empty text."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), offsets


class Words:
    """The words (runs of bytes other than ASCII white space) of some documents, hashed to 64 bits.

    ``hashes`` holds all words in order, ``first[d] : first[d + 1]`` are those of document d, and
    ``begin``/``end`` are their byte positions in ``data``. A word's hash is the sum of its 8-byte parts,
    each mixed with its place.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        data = data[int(offsets[0]) : int(offsets[-1])]
        offsets = offsets - offsets[0]
        self.data = LOWER[data] if lower else data
        self.begin, self.end = word_bounds(data, offsets)
        self.first = np.searchsorted(self.begin, offsets)
        parts = (self.end - self.begin + 7) >> 3
        at = np.cumsum(parts) - parts
        place = np.arange(int(parts.sum())) - np.repeat(at, parts)
        begin = np.repeat(self.begin, parts) + 8 * place
        padded = np.append(self.data, np.zeros(8, np.uint8))
        eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))[begin] & _FIRST_BYTES[np.minimum(np.repeat(self.end, parts) - begin, 8)]
        eight = mix(mix(eight + _PLACE) + place.astype(np.uint64) * _RIGHT)
        self.hashes = mix(np.add.reduceat(eight, at) + (self.end - self.begin).astype(np.uint64)) if len(at) else np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.first) - 1

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words with one space after each, and the position of each word there (and the end)."""
        size = self.end - self.begin + 1
        at = np.append(0, np.cumsum(size))
        out = np.full(int(at[-1]), 32, np.uint8)
        inside = np.ones(len(out), bool)
        inside[at[1:] - 1] = False
        out[inside] = self.data[~SPACE[self.data]]
        return out.tobytes(), at


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text has a range of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


# --- sorted groups ---------------------------------------------------------------------------


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of equal ``keys`` in a stream of batches that is sorted by them (null equals null)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        new = np.zeros(n, bool)
        first = tuple(c[0].as_py() for c in columns)
        new[0] = bool(held) and first != last
        for c in columns:
            values = (pa.compute.fill_null(c, "" if pa.types.is_string(c.type) else 0) if c.null_count else c).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
            if c.null_count:
                null = c.is_null().to_numpy(zero_copy_only=False)
                new[1:] |= null[1:] != null[:-1]
        last, at = tuple(c[n - 1].as_py() for c in columns), 0
        for cut in [*np.flatnonzero(new).tolist(), n]:
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if cut < n and held:
                yield pa.Table.from_batches(held)
                held = []
            at = cut
    if held:
        yield pa.Table.from_batches(held)
