"""Benchmark passages in documents, by SimHash of item-sized windows.

A window has as many words as a benchmark item (a shorter document is one window).  Similarity is that of
weighted shingles: five words each, weighted by how often they occur in the window,
sum of minima / sum of maxima; a window at ``threshold`` or above is a leak.

1. A similar window shares at least 2t / (1 + t) of an item's shingles.  Tasks hash the shingles of whole
   texts and count those of items in every window; windows with enough are fingerprinted.
2. A window's SimHash is compared with the item's through an index of Hamming blocks: of eight blocks of
   eight bits, fingerprints within ``RADIUS`` bits have one that differs by at most RADIUS // 8 bits.
   So all within the radius are found.  Fingerprints of sets at similarity 0.8 differ by 10 of 64 bits on
   average with a deviation of 3; the radius is four deviations further out.
3. What is within the radius is verified by exact weighted similarity.

The benchmark is broadcast in slices of at most ``SLICE_CHARS`` characters, one pass over the documents
each, so what a worker holds is bounded.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters.  Null and empty texts have no
words; an item without words leaks nowhere, an item of fewer than five words is one shingle of that many.  Rows are
looked at one by one, so repeated rows give repeated results and null ids stay null.  Items that share
an id are taken one by one.  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_rows
from .words import MARKS, chunks, grams, mix, split, text_buffers, words_of

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 22
SLICE_CHARS = 4 << 20
_BLOCKS = 8
LEAKS = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"


def _shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the shingle that starts at each word; the last words start none, a short run is one."""
    if not len(hashes):
        return hashes
    return grams(hashes, np.array([0, len(hashes)]), min(size, len(hashes)))[1]


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1).view(">u8")[..., 0].astype(np.uint64)


def _signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's hash."""
    bits = np.unpackbits(mix(shingles).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    top = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return top / (sum(a.values()) + sum(b.values()) - top)


class Items:
    """A slice of the benchmark: shingles, fingerprints and the block index."""

    def __init__(self, rows: list[tuple], size: int, threshold: float, radius: int):
        self.size, self.threshold, self.radius = size, threshold, radius
        self.ids, self.lengths, self.sets = [], [], []
        owners: dict[int, set] = defaultdict(set)
        prints = []
        for item_id, text in rows:
            data, offsets = text_buffers(pa.array([text or ""], pa.string()))
            hashes = split(data, offsets, lower=True, between=MARKS).hashes()
            shingles = _shingles(hashes, size)
            if not len(shingles):
                continue
            for s in shingles.tolist():
                owners[s].add(len(self.ids))
            self.ids.append(item_id)
            self.lengths.append(len(hashes))
            self.sets.append(Counter(shingles.tolist()))
            prints.append(_fingerprints(_signs(shingles).sum(0)))
        #: Lengths of shingles: of an item shorter than a shingle, its own.
        self.sizes = sorted({min(size, n) for n in self.lengths})
        self.prints = np.array(prints, np.uint64)
        self.shingles = np.array(sorted(owners), np.uint64)
        listed = [sorted(owners[s]) for s in self.shingles.tolist()]
        self.first = np.r_[0, np.cumsum([len(x) for x in listed])].astype(np.int64)
        self.owner = np.array([i for x in listed for i in x], np.int64)
        #: Which of 2**16 values of the low bits some shingle has.
        self.marked = np.zeros(1 << 16, bool)
        self.marked[(self.shingles & np.uint64(0xFFFF)).astype(np.int64)] = True
        # near[b][v] tells for each item whether its block b is within the radius' share of value v.
        blocks = (self.prints[:, None] >> (np.arange(_BLOCKS) * 8).astype(np.uint64)) & np.uint64(0xFF)
        apart = np.bitwise_count(np.arange(256, dtype=np.uint64)[:, None, None] ^ blocks[None])
        self.near = (apart <= radius // _BLOCKS).transpose(2, 0, 1) if len(self.ids) else None

    def shingle(self, item: int) -> int:
        """Words of the item's shingles."""
        return min(self.size, self.lengths[item])

    def within(self, prints: np.ndarray, item: int) -> np.ndarray:
        """Distances of fingerprints to an item's, or -1 beyond the radius: first by blocks, then by all bits."""
        met = np.zeros(len(prints), bool)
        for b in range(_BLOCKS):
            met |= self.near[b][((prints >> np.uint64(8 * b)) & np.uint64(0xFF)).astype(np.int64), item]
        out = np.full(len(prints), -1, np.int64)
        at = np.flatnonzero(met)
        far = np.bitwise_count(prints[at] ^ self.prints[item]).astype(np.int64)
        out[at[far <= self.radius]] = far[far <= self.radius]
        return out

    def hits(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose shingle some item has, and its number among the items' shingles."""
        if not len(self.shingles):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.marked[(shingles & np.uint64(0xFFFF)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.shingles, shingles[at]), len(self.shingles) - 1)
        ok = self.shingles[found] == shingles[at]
        return at[ok], found[ok]

    def leaks(self, hashes: np.ndarray, item: int, at: np.ndarray) -> tuple[int, int, int, float] | None:
        """The most similar window (start, words, distance, similarity) of a text for an item, if any leaks.

        ``hashes`` are the text's words and ``at`` the places of its shingles that the item has.
        """
        wide = min(self.lengths[item], len(hashes))
        size = self.shingle(item)
        inside = wide - size + 1
        item_size = sum(self.sets[item].values())
        need = max(1, math.ceil(self.threshold / (1 + self.threshold) * (inside + item_size) - 1e-9))
        starts = np.arange(max(0, int(at[0]) - inside + 1), min(int(at[-1]), len(hashes) - wide) + 1)
        starts = starts[np.searchsorted(at, starts + inside) - np.searchsorted(at, starts) >= need]
        if not len(starts):
            return None
        lo, hi = int(starts[0]), int(starts[-1]) + wide
        shingles = _shingles(hashes[lo:hi], size)
        best = None
        # Long stretches in steps, so that sums of signs stay small.
        for a in range(0, len(starts), 8192):
            part = starts[a : a + 8192] - lo
            here = shingles[part[0] : part[-1] + inside]
            sums = np.zeros((len(here) + 1, 64), np.int32)
            np.cumsum(_signs(here), axis=0, out=sums[1:])
            rel = part - part[0]
            distances = self.within(_fingerprints(sums[rel + inside] - sums[rel]), item)
            for s, d in zip(part[distances >= 0].tolist(), distances[distances >= 0].tolist()):
                sim = similarity(Counter(shingles[s : s + inside].tolist()), self.sets[item])
                if sim >= self.threshold - 1e-12 and (best is None or sim > best[3]):
                    best = (s + lo, wide, d, sim)
        return best


def _slices(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The benchmark's items, in portions of bounded size."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = rows.agg(F.sum(F.char_length("text")).alias("n")).first()["n"] or 0
    parts = math.ceil(chars / SLICE_CHARS)
    for p in range(parts):
        mine = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p) if parts > 1 else rows
        yield [(r["item_id"], r["text"]) for r in mine.collect()]


def _leaks(batch: pa.RecordBatch, items: Items) -> list[tuple]:
    """(row, item, start, words, distance, similarity) of the best leaking windows of a batch."""
    words = words_of(batch, lower=True, between=MARKS)
    hashes = words.hashes()
    places, numbers = [], []
    for n in items.sizes:
        at, shingles = grams(hashes, words.bounds, n)
        hit, number = items.hits(shingles)
        places.append(at[hit])
        numbers.append(number)
    place, number = np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(numbers or [np.zeros(0, np.int64)])
    count = items.first[number + 1] - items.first[number]
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    item = items.owner[np.repeat(items.first[number], count) + step]
    place = np.repeat(place, count)
    doc = np.searchsorted(words.bounds, place, "right") - 1
    order = np.lexsort((place, item, doc))
    place, item, doc = place[order], item[order], doc[order]
    cuts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else doc
    out = []
    for a, z in zip(cuts, np.r_[cuts[1:], len(doc)]):
        d, i = int(doc[a]), int(item[a])
        lo, hi = int(words.bounds[d]), int(words.bounds[d + 1])
        # Fewer hits than any window needs: the usual case of a shared common phrase.
        if z - a < items.threshold * (min(items.lengths[i], hi - lo) - items.shingle(i) + 1) / (1 + items.threshold):
            continue
        best = items.leaks(hashes[lo:hi], i, place[a:z] - lo)
        if best:
            out.append((d, items.ids[i], *best))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, start_word, n_words, distance, similarity: for each row of ``docs`` and item that has a
    window at ``threshold`` or above, the most similar one (of equals the first)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = rows.limit(0).mapInArrow(lambda batches: iter(()), LEAKS)
    for n, part in enumerate(_slices(benchmark)):
        shared = spark.sparkContext.broadcast(Items(part, size, threshold, radius))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches):
                c = list(zip(*_leaks(batch, shared.value))) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(c[0], pa.int64())), *(pa.array(x, t) for x, t in zip(c[1:], (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())))],
                    ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"])

        leaks = rows.mapInArrow(run, LEAKS)
        found = found.unionByName(leaks) if n else leaks
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; nothing is shuffled."""
    spark = docs.sparkSession
    for part in _slices(benchmark):
        shared = spark.sparkContext.broadcast(Items(part, size, threshold, radius))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches):
                clean = np.ones(batch.num_rows, bool)
                clean[[x[0] for x in _leaks(batch, shared.value)]] = False
                yield batch.filter(pa.array(clean))

        docs = map_rows(docs, run)
    return docs
