"""Words of many texts at once, with numpy, for use inside tasks.

A batch of texts is one run of bytes.  Words, their places and their 64-bit hashes come from
whole-array operations, so no Python statement runs per word.  Equal words have equal hashes;
different words share one with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK = 1 << 20

#: Bytes between words: white space, or every ASCII byte that is neither a digit nor a letter.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
MARKS = np.zeros(256, bool)
MARKS[:0x30] = MARKS[0x3A:0x41] = MARKS[0x5B:0x61] = MARKS[0x7B:0x80] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd ``base`` and of its inverse modulo 2**64, at least ``n`` of each."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.full(size, np.uint64(b))
            out[0] = 1
            made.append(np.cumprod(out, dtype=np.uint64))
        have = _powers[base] = tuple(made)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _runs(values: np.ndarray, base: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of ``values[first:last]`` for many runs, independent of where a run lies."""
    up, down = _table(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=sums[1:])
    return (sums[last] - sums[first]) * down[first]


@dataclass
class Words:
    """Words of ``len(bounds) - 1`` texts; word ``i`` is ``data[start[i]:end[i]]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Text ``d`` has the words ``bounds[d]`` to ``bounds[d + 1]``.
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all words with one space between those of a text, and each word's start and end there."""
        keep = np.zeros(len(self.data) + 1, bool)
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.start] += 1
        edge[self.end] -= 1
        keep[:] = np.cumsum(edge) > 0
        gap = self.end[~keep[self.end] & (self.end < len(self.data))]
        keep[gap] = True
        place = np.cumsum(keep) - 1
        out = self.data[keep[:-1]]
        out = out.copy() if out.base is not None else out
        out[place[gap]] = 32
        return out, place[self.start], place[self.end - 1] + 1

    def hashes(self) -> np.ndarray:
        values = self.data.astype(np.uint64) + np.uint64(1)
        return mix(_runs(values, _BYTE_BASE, self.start, self.end) + (self.end - self.start).astype(np.uint64))


def grams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``n`` words that lies in one text."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = np.ones(len(hashes), bool)
    for back in range(1, n):
        cut = bounds[1:] - back
        ok[cut[cut >= bounds[:-1]]] = False
    first = np.flatnonzero(ok)
    return first, mix(_runs(hashes, _WORD_BASE, first, first + n))


def split(data: np.ndarray, offsets: np.ndarray, lower: bool = False, between: np.ndarray = SPACE) -> Words:
    """Words of the texts ``data[offsets[d]:offsets[d + 1]]``: runs of bytes not in ``between``; ``lower`` turns A-Z to a-z."""
    offsets = offsets.astype(np.int64)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    size = len(data)
    inside = ~between[data]
    opens, closes = inside.copy(), inside.copy()
    if size:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        at = offsets[:-1][offsets[:-1] < size]
        opens[at] = inside[at]
        at = offsets[1:][offsets[1:] > 0] - 1
        closes[at] = inside[at]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null texts are empty."""
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows again, in slices of about ``size`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def words_of(batch: pa.RecordBatch, lower: bool = False, column: str = "text", between: np.ndarray = SPACE) -> Words:
    return split(*text_buffers(batch.column(column)), lower=lower, between=between)


def string_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts from bytes and offsets."""
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])
