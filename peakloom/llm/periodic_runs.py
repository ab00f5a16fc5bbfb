"""Periodic runs of words: stretches that repeat with a small period, found through Lyndon roots.

A run with smallest period q holds, under one of an order of the words and its reverse, a Lyndon word of
length q at each of its root places, and that word is the longest Lyndon prefix of the rest of the text.
Both Lyndon arrays come from the first phase of Baier's suffix sorter: suffixes start in groups by first
word, groups are taken from the greatest to the least, and those who stand before members of the group at
hand move up, those before more members in a row higher.  In the end a group holds the suffixes with equal
longest Lyndon prefixes, so equal neighbours one prefix apart are a repetition without another look at the
words.  Chains of these are extended to both sides by longest common extensions.

Words that no run can hold are set aside first: every word of a run of enough length and exponent stands in
a run of ``gram`` words that occurs again inside that run (see :func:`_gram`).  So only stretches covered
by repeated grams are sorted, and what is found in them is what would be found in the whole text.

A text is handled in the task that reads it, in time and memory linear in its words; nothing is shuffled.
A null text has no words and no runs.  Repeated rows and null ids give a row each.  Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import release_worker, trim_worker
from .words import chunks, grams, mix, words_of

RUN = "struct<start:long,length:long,period:long>"


def _gram(least: int, ratio: int) -> int:
    """Words whose repetition every place of a run shows.

    In a run [s, e) of period q a gram of g words at i occurs again at i + q if i + q + g <= e and at i - q
    if i - q >= s.  One of both holds everywhere if e - s >= 2q + g - 1; as e - s >= max(least, ratio * q),
    that is so for g <= least * (ratio - 2) / ratio + 1.
    """
    return max(1, least * (ratio - 2) // ratio)


def lyndon_groups(ranks: list[int]) -> tuple[list[int], list[int]]:
    """Length of the longest Lyndon prefix of each suffix, and a group number: equal for equal prefixes.

    Phase one of Baier's sorter.  ``after`` and ``before`` link the suffixes whose group is not yet done; the
    context of a suffix reaches up to the next of them.
    """
    n = len(ranks)
    kinds = sorted(set(ranks))
    number = {r: g for g, r in enumerate(kinds)}
    group = [number[r] for r in ranks]
    members: list[list[int]] = [[] for _ in kinds]
    for i, g in enumerate(group):
        members[g].append(i)
    # Groups from low to high as a list with links; new ones open just above the one they leave.
    low = list(range(-1, len(kinds) - 1))
    high = [*range(1, len(kinds)), -1]
    top = len(kinds) - 1
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    group.append(-1)
    length = [0] * n
    while top >= 0:
        now = top
        moves: dict[tuple[int, int], list[int]] = {}
        for i in members[now]:
            if group[i] != now or length[i]:
                continue
            first = before[i]
            while first >= 0 and group[first] == now:
                i = first
                first = before[i]
            count = 0
            while group[i] == now:
                following = after[i]
                length[i] = following - i
                count += 1
                i = following
            before[i] = first
            if first >= 0:
                after[first] = i
                moves.setdefault((count, group[first]), []).append(first)
        members[now] = []
        top = low[now]
        if top >= 0:
            high[top] = -1
        for count, old in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            moved = moves[count, old]
            new = len(members)
            members.append(moved)
            for j in moved:
                group[j] = new
            above = high[old]
            low.append(old)
            high.append(above)
            high[old] = new
            if above >= 0:
                low[above] = new
            else:
                top = new
    group.pop()
    return length, group


def _extend(x: np.ndarray, i: int, j: int) -> int:
    """Longest common extension to the right of places i < j."""
    n, at, step = len(x), 0, 16
    while j + at < n:
        size = min(step, n - j - at)
        differ = x[i + at : i + at + size] != x[j + at : j + at + size]
        if differ.any():
            return at + int(differ.argmax())
        at += size
        step *= 2
    return at


def runs_of(ids: list[int], least: int = 24, ratio: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run with length >= max(least, ratio * period), by start and period.

    ``ids`` are words as numbers, equal for equal words only; their order is one of the two.
    """
    x = np.array(ids, np.int64)
    mirror = x[::-1]
    n = len(x)
    found = set()
    for ranks in (ids, [-v for v in ids]):
        length, group = lyndon_groups(ranks)
        reach, kind = np.array(length, np.int64), np.array(group, np.int64)
        goes_on = np.arange(n) + reach
        linked = goes_on < n
        linked[linked] = kind[goes_on[linked]] == kind[linked]
        came = np.zeros(n, bool)
        came[goes_on[linked]] = True
        # Only equal groups are linked and a group has one length, so a chain keeps its period.  A run of
        # three periods holds two roots in a row, one of two periods may hold one.
        heads = linked & ~came if ratio > 2 else ~came
        for i in np.flatnonzero(heads).tolist():
            period, count, last = length[i], 1, i
            while linked[last]:
                last += period
                count += 1
            # Under the run's own order less than a root is left on either side.
            if count < ratio - 1 or count * period + 2 * (period - 1) < max(least, ratio * period):
                continue
            end = last + period + _extend(x, last, last + period)
            start = i - _extend(mirror, n - (i + period), n - i)
            if end - start >= max(least, ratio * period):
                found.add((start, end - start, period))
    return sorted(found)


def _islands(keys: np.ndarray, edges: np.ndarray, size: int, least: int) -> np.ndarray:
    """Bounds (rows of first, last) of stretches of at least ``least`` words covered by grams that occur again
    in the same piece; pieces lie between ``edges``, which include both ends."""
    first, gram = grams(keys, edges, size)
    if not len(first):
        return np.zeros((0, 2), np.int64)
    piece = np.searchsorted(edges, first, "right") - 1
    gram = gram ^ mix(piece.astype(np.uint64) + np.uint64(1))
    order = np.argsort(gram)
    ranked = gram[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(first), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    step = np.zeros(len(keys) + 1, np.int64)
    at = first[again]
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    covered = np.cumsum(step[:-1]) > 0
    opens, closes = covered.copy(), covered.copy()
    opens[1:] &= ~covered[:-1]
    closes[:-1] &= ~covered[1:]
    # Pieces that touch are still two.
    inner = edges[(edges > 0) & (edges < len(keys))]
    opens[inner] = covered[inner]
    closes[inner - 1] = covered[inner - 1]
    out = np.stack([np.flatnonzero(opens), np.flatnonzero(closes) + 1], axis=1)
    return out[out[:, 1] - out[:, 0] >= least]


def batch_runs(batch: pa.RecordBatch, least: int, ratio: int) -> tuple[np.ndarray, list[list[tuple[int, int, int]]], list[bytes]]:
    """Words, runs and the text that is left of each text of a batch."""
    words = words_of(batch)
    bounds = words.bounds
    size = _gram(least, ratio)
    keys = words.hashes()
    edges = np.unique(bounds)
    islands = _islands(keys, edges, size, least)
    if len(islands):
        # Once more inside each island: a passage that stands twice far apart is no run.
        islands = _islands(keys, np.union1d(edges, islands), size, least)
        docs = np.searchsorted(bounds, islands[:, 0], "right") - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    raw = words.data.tobytes()
    for k, (a, z) in enumerate(islands.tolist()):
        known: dict[bytes, int] = {}
        ids = [known.setdefault(raw[s:e], len(known)) for s, e in zip(words.start[a:z].tolist(), words.end[a:z].tolist())]
        d = int(docs[k])
        runs[d] += [(a - int(bounds[d]) + s, n, p) for s, n, p in runs_of(ids, least, ratio)]
    joined, first, last = words.joined()
    held = joined.tobytes()
    left = []
    for d, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if not runs[d]:
            left.append(held[int(first[a]) : int(last[z - 1])] if z > a else b"")
            continue
        step = np.zeros(z - a + 1, np.int64)
        for s, n, p in runs[d]:
            step[s + p] += 1
            step[s + n] -= 1
        kept = np.flatnonzero(np.cumsum(step[:-1]) == 0) + a
        left.append(b" ".join([held[s:e] for s, e in zip(first[kept].tolist(), last[kept].tolist())]))
    return np.diff(bounds), runs, left


def find_runs(docs: DataFrame, least: int = 24, ratio: int = 3) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period) and collapsed of every row.

    A run is a stretch of consecutive words with smallest period q and length >= max(least, ratio * q) that
    no neighbouring word extends.  ``collapsed`` is the text without the words that a run contains after its
    first q, joined by one space.  ``ratio`` is 2 or more.
    """
    if ratio < 2 or least < 2:
        raise ValueError("a run has two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in chunks(batches):
            n, runs, left = batch_runs(batch, least, ratio)
            flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
            ends = np.cumsum([0, *map(len, runs)])
            rows = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows), pa.array(left, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )
        trim_worker()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, exactly; of equal ones the first.  Null without any."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(better(best, r), r).otherwise(best))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in a tenth of the texts (by crc32 of the id) the words from some place on repeat with a period.

    With h the crc32, h % 10 = 0, g = h // 10 and n words, each word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) // (3 + g % 8).  Texts of null ids stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    place = "g % size(words)"
    period = f"(1 + (size(words) - {place}) div (3 + g % 8))"
    changed = F.expr(f"array_join(transform(words, (w, i) -> if(i < {place}, w, words[int({place} + (i - {place}) % {period})])), ' ')")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), h.alias("h"))
    plain = rows.filter(F.coalesce(F.col("h") % 10 != 0, F.lit(True))).select("doc_id", "text")
    tailed = rows.filter(F.col("h") % 10 == 0).select("doc_id", F.floor(F.col("h") / 10).alias("g"), F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w != '')").alias("words"))
    return plain.unionByName(tailed.select("doc_id", F.when(F.size("words") > 0, changed).alias("text")))


def runs_sql(least: int = 24, ratio: int = 3) -> str:
    """The rows of the registered query, by all pairs of equal grams of a text."""
    size = _gram(least, ratio)
    return rf"""
WITH RECURSIVE crc(doc_id, name, k, c) AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, name, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT doc_id, name, k, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(name[k // 8 + 1]) AS BIGINT)) ELSE c END AS x FROM crc WHERE k < 8 * len(name))
),
hashed AS (SELECT doc_id, xor(c, 4294967295) AS h FROM crc WHERE k = 8 * len(name)),
plain AS (
  SELECT doc_id, coalesce(h, 1) AS h, coalesce(h, 1) // 10 AS g, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents LEFT JOIN hashed USING (doc_id)
),
sized AS (
  SELECT doc_id, h, w, len(w) AS n, CASE WHEN len(w) > 0 THEN g % len(w) ELSE 0 END AS a,
    CASE WHEN len(w) > 0 THEN 1 + (len(w) - g % len(w)) // (3 + g % 8) ELSE 1 END AS p FROM plain
),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM sized),
grams AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + {size}], ' ') AS gram FROM (SELECT doc_id, n, w, unnest(range(n - {size - 1})) AS i FROM d WHERE n >= {least})),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND b.i > a.i AND {ratio} * (b.i - a.i) <= a.n),
steps AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + {size - 1} + q AS l FROM steps GROUP BY doc_id, q, island),
long AS (SELECT * FROM stretches WHERE l >= greatest({least}, {ratio} * q)),
runs AS (
  SELECT * FROM long WHERE NOT EXISTS (
    SELECT 1 FROM long o WHERE o.doc_id = long.doc_id AND o.q < long.q AND o.s <= long.s AND o.s + o.l >= long.s + long.l)
),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines, list(struct_pack(a := s + q, z := s + l)) AS gone
  FROM runs GROUP BY doc_id
),
best AS (
  SELECT doc_id, s, l, q FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (o.l * r.q > r.l * o.q OR (o.l * r.q = r.l * o.q AND (o.s < r.s OR (o.s = r.s AND o.q < r.q)))))
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(n), lambda i: len(list_filter(gone, lambda x: i >= x.a AND i < x.z)) = 0), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256,
  CAST(n AS BIGINT) AS n_words
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id)
"""
