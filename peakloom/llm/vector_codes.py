"""Product codes of vectors: integer parts, codebooks by a few rounds of means, nearest entries by a trie.

Components become integers floor(scale * x) and vectors are cut into equal consecutive parts.  To find the
nearest codebook entry of many parts at once, the distinct ones of a portion are put in lexicographic order,
which is a trie: parts that agree in their first dimensions share a path.  A depth-first walk carries, for
each node, the vector of squared distances of its prefix to all entries; a child adds its own dimension to
that of its parent, so what prefixes share is summed once.  Sub-tries of at most ``BLOCK`` leaves are walked
a level at a time as whole arrays.  Leaves take the nearest entry (the lowest index of equal ones) and add
their weight, the number of vectors with that part, to its count and weighted component sums.

A round is one pass over the vectors: portions (Arrow batches) leave one row a codebook entry that they used,
which Spark adds up.  Nothing else is shuffled, whatever vectors or parts repeat, and the driver gets as many
rows as the codebooks have entries.  All sums are whole numbers, so the order of tasks does not matter.

Rows whose vector is null, empty or holds null or non-finite components are dropped, and so are those that
have not the length of the first vector (smallest vec_id, then components).  A length that does not divide
into the parts is filled up with zeros at the end.  Components are kept within the bound at which squared
distances fit 64 bits: |floor(256 * x)| up to 2**27 for 64 components.  Null vec_ids come last; rows that
repeat a vec_id are rows of their own.  Fewer vectors than entries give smaller codebooks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from .common import cut_lineage, release_worker, trim_worker

#: Leaves of a sub-trie that is walked as arrays.
BLOCK = 1 << 13


def usable(column: str = "embedding") -> Column:
    """Whether a vector has components, all of them finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    vector = F.col(column).cast("array<double>")
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def integers(column: pa.ListArray, dim: int, parts: int, scale: int) -> np.ndarray:
    """Parts of each vector: vectors x parts x components, whole numbers."""
    bound = math.isqrt((1 << 62) // dim) // 2
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(_matrix(column, dim) * scale), -bound, bound).astype(np.int64)
    wide = -(-dim // parts) * parts
    if wide > dim:
        whole = np.pad(whole, ((0, 0), (0, wide - dim)))
    return whole.reshape(len(whole), parts, -1)


def nearest(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest row of ``book`` for distinct ``leaves`` in lexicographic order."""
    entry = np.empty(len(leaves), np.int64)
    distance = np.empty(len(leaves), np.int64)
    depth_of = leaves.shape[1]
    pending = [(0, len(leaves), 0, np.zeros(len(book), np.int64))]
    while pending:
        low, high, depth, carried = pending.pop()
        if high - low <= BLOCK or depth == depth_of:
            _expand(leaves[low:high], book, depth, carried, entry[low:high], distance[low:high])
            continue
        heads = low + np.flatnonzero(np.r_[True, leaves[low + 1 : high, depth] != leaves[low : high - 1, depth]])
        for a, z in reversed(list(zip(heads.tolist(), [*heads[1:].tolist(), high]))):
            pending.append((a, z, depth + 1, carried + (leaves[a, depth] - book[:, depth]) ** 2))
    return entry, distance


def _expand(leaves: np.ndarray, book: np.ndarray, depth: int, carried: np.ndarray, entry: np.ndarray, distance: np.ndarray) -> None:
    """Walk a sub-trie whose prefix of ``depth`` components has the distances ``carried``, a level at a time."""
    sums = carried[None, :]
    node = np.zeros(len(leaves), np.int64)
    opens = np.zeros(len(leaves), bool)
    opens[0] = True
    for d in range(depth, leaves.shape[1]):
        opens[1:] |= leaves[1:, d] != leaves[:-1, d]
        heads = np.flatnonzero(opens)
        sums = sums[node[heads]] + (leaves[heads, d][:, None] - book[:, d][None, :]) ** 2
        node = np.cumsum(opens) - 1
    best = sums.argmin(axis=1)
    entry[:] = best[node]
    distance[:] = sums[np.arange(len(sums)), best][node]


def _trie(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, how often each stands there, and the place of every row."""
    order = np.lexsort(part.T[::-1])
    ranked = part[order]
    opens = np.r_[True, (ranked[1:] != ranked[:-1]).any(axis=1)]
    place = np.empty(len(part), np.int64)
    place[order] = np.cumsum(opens) - 1
    heads = np.flatnonzero(opens)
    return ranked[heads], np.diff(np.r_[heads, len(part)]), place


class Codebooks:
    """Entries of each part position: positions x entries x components."""

    def __init__(self, entries: np.ndarray, dim: int, scale: int):
        self.entries, self.dim, self.scale = entries, dim, scale

    def digest(self) -> str:
        """sha256 of all components as decimal numbers by position, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _vectors(table: DataFrame, *more: str) -> DataFrame:
    return table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), *more).where(usable())


def train(table: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks | None:
    """Codebooks that start as the parts of the ``entries`` smallest vec_ids, after ``rounds`` rounds of means.

    A round assigns each part of each vector to its nearest entry and replaces an entry by the floor of the
    mean of its parts; entries without parts stay.  None for a table without vectors.
    """
    vectors = _vectors(table)
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(1).collect()
    if not first:
        return None
    dim = len(first[0]["embedding"])
    vectors = vectors.where(F.size("embedding") == dim)
    start = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    seen = integers(pa.array([r["embedding"] for r in start], pa.list_(pa.float64())), dim, parts, scale)
    books = seen.transpose(1, 0, 2).copy()
    width = books.shape[2]
    sums = [f"s{k}" for k in range(width)]

    for _ in range(rounds):
        held = books

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_worker()
            for batch in batches:
                if not batch.num_rows:
                    continue
                cut = integers(batch.column(0), dim, parts, scale)
                out = []
                for p in range(parts):
                    leaves, weight, _ = _trie(cut[:, p])
                    entry, _ = nearest(leaves, held[p])
                    total = np.zeros((held.shape[1], width + 1), np.int64)
                    np.add.at(total, entry, np.column_stack([weight, leaves * weight[:, None]]))
                    used = np.flatnonzero(total[:, 0])
                    out.append(np.column_stack([np.full(len(used), p), used, total[used]]))
                rows = np.concatenate(out)
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, c]) for c in range(rows.shape[1])], ["position", "entry", "n", *sums])
            trim_worker()

        partial = vectors.select("embedding").mapInArrow(run, ", ".join(f"{c} long" for c in ["position", "entry", "n", *sums]))
        whole = partial.groupBy("position", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in sums))
        books = books.copy()
        for r in whole.collect():  # one row an entry at most
            books[r["position"], r["entry"]] = [int(r[s]) // r["n"] for s in sums]
    return Codebooks(books, dim, scale)


def encode(table: DataFrame, books: Codebooks | None, *more: str) -> DataFrame:
    """vec_id, ``more``, codes (an entry a part) and error (squared distances over all parts) of the vectors that are kept."""
    vectors = _vectors(table, *more)
    schema = vectors.drop("embedding").schema.add("codes", ArrayType(IntegerType())).add("error", LongType())
    if books is None:
        return table.sparkSession.createDataFrame([], schema)
    held, dim, scale = books.entries, books.dim, books.scale
    parts = len(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = integers(batch.column("embedding"), dim, parts, scale)
            codes = np.empty((len(cut), parts), np.int32)
            error = np.zeros(len(cut), np.int64)
            for p in range(parts):
                leaves, _, place = _trie(cut[:, p])
                entry, distance = nearest(leaves, held[p])
                codes[:, p] = entry[place]
                error += distance[place]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(cut) + 1) * parts, pa.int32()), pa.array(codes.ravel()))
            rest = [batch.column(c) for c in ("vec_id", *more)]
            yield pa.RecordBatch.from_arrays([*rest, lists, pa.array(error)], ["vec_id", *more, "codes", "error"])
        trim_worker()

    return vectors.where(F.size("embedding") == dim).mapInArrow(run, schema)


def compress(table: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """vec_id, label, codes, error, label_error (the errors of all vectors with that label; null labels are one) and codebooks_sha256."""
    books = train(table, parts, entries, rounds, scale)
    coded = cut_lineage(encode(table, books, "label"))
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as long)").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    return joined.withColumn("codebooks_sha256", F.lit(books.digest() if books else hashlib.sha256(b"").hexdigest()))


def codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, width: int = 4) -> str:
    """Codes, errors and digest for vectors of ``parts`` x ``width`` components, by all distances."""
    places = range(1, width + 1)
    xs = ", ".join(f"x{k}" for k in places)
    cut = ", ".join(f"CAST(floor({scale} * CAST(embedding[p * {width} + {k}] AS DOUBLE)) AS BIGINT) AS x{k}" for k in places)
    apart = " + ".join(f"(v.x{k} - b.x{k}) * (v.x{k} - b.x{k})" for k in places)
    means = ", ".join(f"CAST(floor(sum(x{k}) / count(*)) AS BIGINT) AS x{k}" for k in places)
    new = ", ".join(f"coalesce(m.x{k}, b.x{k}) AS x{k}" for k in places)
    steps = []
    for r in range(rounds + 1):
        far = f"SELECT vec_id, label, v.p, entry, {apart} AS d, {', '.join(f'v.x{k}' for k in places)} FROM v JOIN b{r} b USING (p)"
        best = f"arg_min(entry, struct_pack(d := d, e := entry)) AS entry, min(d) AS d, {', '.join(f'any_value(x{k}) AS x{k}' for k in places)}"
        steps.append(f"a{r} AS (SELECT vec_id, label, p, {best} FROM ({far}) GROUP BY vec_id, label, p)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT p, entry, {means} FROM a{r} GROUP BY p, entry)")
            steps.append(f"b{r + 1} AS (SELECT b.p, b.entry, {new} FROM b{r} b LEFT JOIN m{r} m USING (p, entry))")
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE len(embedding) = {parts * width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
v AS (SELECT vec_id, label, p, {cut} FROM kept, range({parts}) t(p)),
b0 AS (SELECT p, entry, {xs} FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept) USING (vec_id) WHERE entry < {entries}),
{', '.join(steps)},
sha AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, entry, k)) AS s FROM (SELECT p, entry, unnest([{', '.join(f'{k}' for k in places)}]) AS k, unnest([{xs}]) AS x FROM b{rounds})),
whole AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', entry), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
by_label AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM whole GROUP BY label)
SELECT vec_id, code, error, label_error, s AS codebooks_sha256
FROM whole JOIN by_label ON whole.label IS NOT DISTINCT FROM by_label.label, sha
"""
