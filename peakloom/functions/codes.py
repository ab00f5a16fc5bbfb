"""Sequences of an Arrow batch as arrays of base codes (helpers used inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Code of each byte: A, C, G, T are 0 to 3 in either case, everything else is 4.
CODES = np.full(256, 4, np.uint8)
for _i, _b in enumerate("ACGT"):
    CODES[ord(_b)] = CODES[ord(_b.lower())] = _i


def slices(batch: pa.RecordBatch, bases: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first column, start offsets, bytes of the second column) of runs of about ``bases`` letters."""
    ids = batch.column(0)
    if ids.null_count and pa.types.is_integer(ids.type):
        # Masked, as numbers beside nulls would become floats.
        ids = np.ma.masked_array(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
    else:
        ids = ids.to_numpy(zero_copy_only=False)
    text = batch.column(1).cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(ids):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + bases, "right")) - 1)
        yield ids[at:to], offsets[at:to + 1] - offsets[at], data[offsets[at]:offsets[to]]
        at = to


def pieces(batch: pa.RecordBatch, overlap: int, bases: int = 1 << 21) -> Iterator[tuple[np.ndarray, ...]]:
    """As :func:`slices`, a sequence longer than ``bases`` in several pieces that share ``overlap`` letters.

    Yields (first column, start offsets, bytes, place of each piece in its sequence, number of starts that
    belong to the piece, length of the whole sequence).
    """
    for ids, offsets, data in slices(batch, bases):
        size = np.diff(offsets)
        if len(ids) > 1 or offsets[-1] <= bases:
            yield ids, offsets, data, np.zeros_like(size), size, size
            continue
        for at in range(0, len(data), bases):
            part = data[at:at + bases + overlap]
            yield ids, np.array([0, len(part)]), part, np.array([at]), np.array([bases]), size


def kmer_codes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, canonical k-mer as a base-4 number) of every clean window; k is at most 31."""
    codes = CODES[data]
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    clean = np.arange(n) + k <= offsets[1:][owner]
    word, back = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(k):
        letters = codes[j:j + n].astype(np.int64)
        clean &= letters < 4
        word = word * 4 + letters
        back += (3 - letters) << (2 * j)
    return owner[clean], np.minimum(word, back)[clean]
