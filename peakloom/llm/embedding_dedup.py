"""Near-duplicate vectors by p-stable hashing.

Normalised vectors are projected on random normal directions, shifted and cut into steps of ``width``;
``size`` such numbers are a table's key.  Vectors whose cosine is at least ``least`` lie within the distance
sqrt(2 - 2 * least) and share a key with a chance that follows from it; the number of tables is set so that a
pair exactly at the threshold is met with the chance ``recall``, nearer pairs more surely, and ``size`` from
the number of vectors, so that unrelated vectors seldom share a key (:func:`plan`).  Pairs that meet are
compared by exact cosine in double precision.

No bucket is left out or cut:

* Equal vectors are one class with a count before anything is compared.
* Vectors within half the angle of one pivot are within the whole angle of each other.  Those of crowded
  buckets are compared with the least member of their buckets; those near it form a clump, whose members
  are linked without being compared, and a bucket that holds one clump needs no comparison at all.
* Of a mixed bucket, the members of its largest clump meet the others only.  Both sides are dealt to blocks
  of ``block`` rows and a task compares two blocks by matrix products, so no task holds a bucket.
* A pair is counted in the first table where it meets, which both rows' keys show; blocks leave a count a row
  and a spanning forest of their links, not pairs.

Null, empty and zero vectors and those with null or non-finite components link with nothing.  Vectors of
different lengths do not link.  A row that repeats another is a vector of its own, linked with it.  Null
vec_ids take part and name no component unless all ids of it are null.  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, release_worker, trim_worker
from .graphs import components
from .vector_codes import usable
from .words import mix

SEED = 20
#: Step of a projection; near the best of log p1 / log p2 for thresholds about 0.95.
WIDTH = 2.0
#: Chance to meet a pair whose cosine is the threshold.
RECALL = 0.95
#: Unrelated vectors that a vector may meet in a table, on average.
STRANGERS = 0.25
#: Groups of at most this many rows are compared all at once with others.
SMALL = 16
#: Cosines this near the threshold are computed anew by one fixed formula.
DOUBT = 1e-9


def chance(distance: float, width: float) -> float:
    """That two vectors so far apart fall in one step of a random projection."""
    r = width / distance
    normal = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, least: float, recall: float = RECALL, width: float = WIDTH) -> tuple[int, int]:
    """Projections a key and tables for ``n`` vectors."""
    far = chance(math.sqrt(2), width)
    near = chance(math.sqrt(max(2 - 2 * least, 1e-12)), width)
    size = max(1, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    return size, max(1, math.ceil(math.log(1 - recall) / math.log1p(-(near**size))))


def _padded(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, scaled by a power of two and filled up with zeros, and their lengths."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    wide = int(lengths.max()) if len(lengths) else 0
    if (lengths == wide).all():
        rows = flat.reshape(len(lengths), wide).copy()
    else:
        rows = np.zeros((len(lengths), wide))
        rows[np.arange(wide) < lengths[:, None]] = flat
    _, exponent = np.frexp(np.abs(rows).max(axis=1, initial=0.0))
    return np.ldexp(rows, -exponent[:, None]), lengths


def _units(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(norms > 0, norms, 1)[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the row of ``b``."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def signatures(classes: DataFrame, size: int, tables: int, width: float = WIDTH, seed: int = SEED) -> DataFrame:
    """``classes`` (c, copies, vector) with ``keys``, one a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        drawn: dict[int, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, lengths = _padded(batch.column("vector"))
            units = _units(rows)
            keys = np.empty((len(rows), tables), np.uint64)
            for dim in np.unique(lengths).tolist():
                if dim not in drawn:
                    draw = np.random.default_rng([seed, dim])
                    drawn[dim] = (
                        draw.standard_normal((dim, size * tables)), draw.random(size * tables) * width,
                        draw.integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, tables, np.uint64),
                    )
                directions, shift, odd, own = drawn[dim]
                mine = np.flatnonzero(lengths == dim)
                for a in range(0, len(mine), 2048):
                    some = mine[a : a + 2048]
                    steps = np.floor((units[some, :dim] @ directions + shift) / width).astype(np.int64).astype(np.uint64)
                    keys[some] = mix((steps.reshape(len(some), tables, size) * odd).sum(axis=2, dtype=np.uint64) + own)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * tables, pa.int32()), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("c", "copies", "vector")), lists], ["c", "copies", "vector", "keys"])
        trim_worker()

    return classes.select("c", "copies", "vector").mapInArrow(run, f"c long, copies long, vector {classes.schema['vector'].dataType.simpleString()}, keys array<long>")


def _clumps(met: DataFrame, signed: DataFrame, least: float, crowd: int) -> DataFrame:
    """``c`` and ``clump`` (a pivot within half the threshold's angle) of members of crowded buckets."""
    half = math.sqrt((1 + least) / 2) + DOUBT
    pivots = met.where(F.col("n") > crowd).groupBy("c").agg(F.min("first").alias("clump"))
    pairs = pivots.join(signed.select("c", "vector"), "c").join(signed.select(F.col("c").alias("clump"), F.col("vector").alias("other")), "clump")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = cosines(_padded(batch.column("vector"))[0], _padded(batch.column("other"))[0]) >= half
                yield batch.select(["c", "clump"]).filter(pa.array(near))
        trim_worker()

    return pairs.select("c", "clump", "vector", "other").mapInArrow(run, "c long, clump long")


def _blocks(met: DataFrame, block: int) -> DataFrame:
    """Which two blocks of which bucket each row goes to: c, table, key, i, j, side.

    Blocks of a bucket are those of its rest and behind them those of its largest clump, which meets the rest
    only.  A bucket of one block is not split in two kinds.
    """
    kinds = met.groupBy("key", "g").agg(F.count("*").alias("n"))
    whole = kinds.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "g")).alias("most"), F.count("*").alias("kinds"))
    whole = whole.where("kinds > 1").select(
        "key", F.when(F.col("n") > block, F.col("most.g")).alias("heavy"), F.when(F.col("n") > block, F.ceil(F.col("most.n") / block)).otherwise(0).alias("back"),
        F.when(F.col("n") > block, F.ceil((F.col("n") - F.col("most.n")) / block)).otherwise(1).alias("front"),
    )
    rows = met.select("c", "g", "table", "key").join(whole, "key")
    is_heavy = F.coalesce(F.col("g") == F.col("heavy"), F.lit(False))
    own = F.when(is_heavy, F.col("front") + F.expr("pmod(xxhash64(c), greatest(back, 1))")).otherwise(F.expr("pmod(xxhash64(c), front)"))
    meets = F.when(is_heavy, F.sequence(F.lit(0).cast("long"), F.col("front") - 1)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("front") + F.col("back") - 1))
    placed = rows.withColumn("own", own).withColumn("with", F.explode(meets))
    return placed.select(
        "c", "g", "table", "key", F.least("own", "with").cast("int").alias("i"), F.greatest("own", "with").cast("int").alias("j"),
        (F.col("own") > F.col("with")).cast("int").alias("side"),
    )


class _Found:
    """Counts and links that blocks leave."""

    def __init__(self) -> None:
        self.a, self.b, self.links = [], [], []

    def count(self, c: np.ndarray, links: np.ndarray) -> None:
        some = links > 0
        self.a.append(c[some])
        self.b.append(np.full(int(some.sum()), -1, np.int64))
        self.links.append(links[some])

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.links.append(np.zeros(len(a), np.int64))

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (self.a, self.b, self.links)], ["a", "b", "links"])
        self.__init__()
        return out


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (row, column) of a spanning forest of the rows and columns that ``linked`` connects."""
    rows_left, columns_left = linked.any(axis=1), np.ones(linked.shape[1], bool)
    out_r, out_c = [], []
    for root in np.flatnonzero(rows_left).tolist():
        if not rows_left[root]:
            continue
        rows_left[root] = False
        frontier = np.array([root])
        while len(frontier):
            part = linked[frontier]
            fresh = np.flatnonzero(part.any(axis=0) & columns_left)
            if not len(fresh):
                break
            columns_left[fresh] = False
            out_r.append(frontier[part[:, fresh].argmax(axis=0)])
            out_c.append(fresh)
            part = linked[:, fresh]
            frontier = np.flatnonzero(part.any(axis=1) & rows_left)
            rows_left[frontier] = False
            out_r.append(frontier)
            out_c.append(fresh[part[frontier].argmax(axis=1)])
    if not out_r:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_r), np.concatenate(out_c)


class _Rows:
    """Rows of buckets as arrays."""

    def __init__(self, batch: pa.RecordBatch):
        get = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
        self.c, self.g, self.copies, self.table, self.side = (get(n) for n in ("c", "g", "copies", "table", "side"))
        self.rows, _ = _padded(batch.column("vector"))
        self.units = _units(self.rows)
        keys = batch.column("keys")
        self.keys = keys.flatten().to_numpy().reshape(len(keys), -1)

    def linked(self, p: np.ndarray, q: np.ndarray, least: float) -> np.ndarray:
        """Which pairs of rows are linked, of different clumps, and meet here first."""
        near = np.zeros(len(p), bool)
        for a in range(0, len(p), 1 << 15):
            part = slice(a, a + (1 << 15))
            near[part] = np.einsum("ij,ij->i", self.units[p[part]], self.units[q[part]]) >= least - DOUBT
        at = np.flatnonzero(near)
        near[at] = (cosines(self.rows[p[at]], self.rows[q[at]]) >= least) & (self.g[p[at]] != self.g[q[at]])
        at = at[near[at]]
        earlier = np.arange(self.keys.shape[1]) < self.table[p[at]][:, None]
        near[at] = ~((self.keys[p[at]] == self.keys[q[at]]) & earlier).any(axis=1)
        return near

    def block(self, left: np.ndarray, right: np.ndarray, least: float, found: _Found) -> None:
        """Compare two blocks; one block with itself if they are the same."""
        same = left is right
        table = int(self.table[left[0]])
        linked = np.zeros((len(left), len(right)), bool)
        for a in range(0, len(left), 256):
            some = left[a : a + 256]
            cos = self.units[some] @ self.units[right].T
            near = cos >= least + DOUBT
            doubt = np.argwhere(np.abs(cos - least) < DOUBT)
            if len(doubt):
                near[doubt[:, 0], doubt[:, 1]] = cosines(self.rows[some[doubt[:, 0]]], self.rows[right[doubt[:, 1]]]) >= least
            near &= self.g[some][:, None] != self.g[right][None, :]
            for t in range(table):
                if not near.any():
                    break
                near &= self.keys[some, t][:, None] != self.keys[right, t][None, :]
            linked[a : a + len(some)] = near
        found.count(self.c[left], linked @ self.copies[right])
        if not same:
            found.count(self.c[right], self.copies[left] @ linked)
        r, k = _forest(linked)
        found.link(self.c[left[r]], self.c[right[k]])


def _compare(least: float):
    """Compares the rows of each bucket and pair of blocks, which come together and in order."""
    def done(batch: pa.RecordBatch, heads: np.ndarray, found: _Found) -> None:
        rows = _Rows(batch)
        sizes = np.diff(np.r_[heads, batch.num_rows])
        two = np.add.reduceat(rows.side, heads) > 0
        small = np.flatnonzero(~two & (sizes > 1) & (sizes <= SMALL))
        for n in np.unique(sizes[small]).tolist():
            x, y = np.triu_indices(n, 1)
            at = heads[small[sizes[small] == n]]
            p, q = (at[:, None] + x).ravel(), (at[:, None] + y).ravel()
            hit = rows.linked(p, q, least)
            p, q = p[hit], q[hit]
            found.count(rows.c[p], rows.copies[q])
            found.count(rows.c[q], rows.copies[p])
            found.link(rows.c[p], rows.c[q])
        for k in np.flatnonzero(two | (sizes > SMALL)).tolist():
            mine = np.arange(heads[k], heads[k] + sizes[k])
            left = mine[rows.side[mine] == 0]
            if not two[k]:
                rows.block(left, left, least, found)
            elif len(left):
                rows.block(left, mine[rows.side[mine] == 1], least, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        found = _Found()
        kept: list[pa.RecordBatch] = []

        def open_group(batch: pa.RecordBatch) -> np.ndarray:
            parts = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "i", "j")]
            return np.flatnonzero(np.r_[True, np.any([x[1:] != x[:-1] for x in parts], axis=0)])

        for batch in batches:
            if not batch.num_rows:
                continue
            if kept and any(kept[-1].column(n)[-1] != batch.column(n)[0] for n in ("key", "i", "j")):
                whole = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                done(whole, open_group(whole), found)
                kept = []
            heads = open_group(batch)
            cut = int(heads[-1])
            if cut:  # the last group may go on in the next batch
                whole = pa.Table.from_batches([*kept, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
                done(whole, open_group(whole), found)
                kept = []
            kept.append(batch.slice(cut))
            yield found.batch()
        if kept:
            whole = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            done(whole, open_group(whole), found)
            yield found.batch()
        trim_worker()

    return run


def near_duplicates(table: DataFrame, least: float = 0.95, recall: float = RECALL, crowd: int = 256, block: int = 4096, seed: int = SEED) -> DataFrame:
    """vec_id, n_links (other vectors of cosine >= ``least`` that were found), component_id (the smallest vec_id reachable) and kept of every row.

    ``crowd`` is the size from which a bucket's members are looked through for clumps, ``block`` that of the
    blocks; neither changes the links.
    """
    if not 0 < least < 1:
        raise ValueError("least is a cosine above 0 and below 1")
    kind = "array<float>" if table.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    fit = usable() & F.exists(F.col("embedding").cast("array<double>"), lambda x: x != 0)
    rows = table.select(F.col("vec_id").cast("long"), F.when(fit, F.col("embedding").cast(kind)).alias("vector"))
    named = rows.select("vec_id", F.md5(F.col("vector").cast("string").cast("binary")).alias("digest"), "vector")
    classes = named.where("vector is not null").groupBy("digest", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = cut_lineage(classes.withColumn("c", F.monotonically_increasing_id()))
    size, tables = plan(classes.count(), least, recall)
    signed = cut_lineage(signatures(classes, size, tables, WIDTH, seed))

    keyed = signed.select("c", F.posexplode("keys").alias("table", "key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("c").alias("first")).where("n > 1")
    met = cut_lineage(keyed.join(shared, "key"))
    clumps = cut_lineage(_clumps(met, signed, least, crowd))
    grouped = met.join(clumps, "c", "left").withColumn("g", F.coalesce("clump", "c"))
    places = _blocks(cut_lineage(grouped.select("c", "g", "table", "key")), block)
    per = places.groupBy("c", "g").agg(F.collect_list(F.struct("table", "key", "i", "j", "side")).alias("places"))
    full = per.join(signed, "c").select("c", "g", "copies", "vector", "keys", F.inline("places"))
    dealt = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    found = cut_lineage(dealt.mapInArrow(_compare(least), "a long, b long, links long"))

    # Clumps: members are linked with each other and, for components, with their pivot.
    copies = signed.select("c", "copies")
    inside = clumps.join(copies, "c")
    # An unassigned pivot belongs to its own clump.
    heads = clumps.select("clump").distinct().join(clumps.select("c"), F.col("clump") == F.col("c"), "left_anti")
    heads = heads.select(F.col("clump").alias("c"), "clump").join(copies, "c")
    inside = inside.select("c", "clump", "copies").unionByName(heads.select("c", "clump", "copies"))
    sizes = inside.groupBy("clump").agg(F.sum("copies").alias("all"))
    in_clump = inside.join(sizes, "clump").select("c", (F.col("all") - F.col("copies")).alias("links"))
    in_blocks = found.where("b = -1").select(F.col("a").alias("c"), "links")
    degree = in_blocks.unionByName(in_clump).groupBy("c").agg(F.sum("links").alias("links"))
    edges = found.where("b >= 0").select("a", "b").unionByName(clumps.select(F.col("c").alias("a"), F.col("clump").alias("b")))
    roots = components(edges)

    known = classes.select("c", "digest", "least", "copies").join(degree, "c", "left")
    known = known.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = cut_lineage(known.join(names, "root").select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    linked = named.where("digest is not null").select("vec_id", "digest").join(known, "digest").select("vec_id", "n_links", "component_id")
    alone = named.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def near_duplicates_sql(least: float = 0.95) -> str:
    """All pairs by exact cosine, for small tables with one row a vec_id."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fit AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {least}
),
reach(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM reach r JOIN p ON r.b = p.a),
root AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(root.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(root.b, vec_id)) AS kept
FROM v LEFT JOIN root ON root.a = vec_id LEFT JOIN degree ON degree.a = vec_id
"""
