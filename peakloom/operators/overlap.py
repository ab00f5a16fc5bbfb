"""Interval joins and the aggregates built on them.

Two ways to relate intervals, chosen by what the caller needs:

* *counting* (count, semi, anti): an interval ``[s, e)`` meets as many others as have
  started before ``e`` minus those that have ended by ``s``.  Both are running counts
  over positions, so nothing is paired and a pile-up of reads at one spot collapses to
  one row before the shuffle;
* *pairing*: both sides are cut into bins, joined on ``(chrom, bin)`` and each pair is
  kept only in the first bin the two share, so no duplicate removal is needed.  Bins
  that hold too many rows are split, with the other side copied to each part.  Where the
  pairs themselves are the result, one side is joined in runs of neighbours, so that rows that
  follow each other are alike and take little room when they are written;
* *highest*: where only the highest overlapping segment is wanted, each position of a tile keeps the
  highest that covers it and a region looks up the highest of its positions, so nothing is paired.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..runtime import cut_lineage
from .points import counts_in
from .scans import tiled_scan

#: Width in bp of a join bin; a power of two near the usual interval length.
BIN = 4096
#: Width in bp of a scan tile.
TILE = 1 << 16
#: A bin with more rows than this is split before it is joined.
HOT_ROWS = 1_000_000
#: Neighbours that are joined as one where the pairs are the result.
RUN = 64
#: Intervals a task joins in runs: their numbers fit the dictionary of a column that is written.
TASK_ROWS = 1 << 16

COORDS = ["chrom", "start", "end"]


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.sequence(F.floor(start / width), F.floor((end - 1) / width))


def _split_hot(many: DataFrame, others: DataFrame, part: str, by: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Deal out the rows of bins with more than ``hot_rows`` of ``many`` to parts, with ``others`` copied to each."""
    by = list(by)
    # At most rows/hot_rows bins are hot, so this table is small whatever the data.
    hot = F.broadcast(
        many.groupBy(*by).count().where(F.col("count") > hot_rows)
        .select(*by, F.ceil(F.col("count") / hot_rows).cast("int").alias("_parts"))
    )
    dealt = F.pmod(F.xxhash64(*[c for c in many.columns if c not in by]), F.col("_parts")).cast("int")
    many = many.join(hot, by, "left").withColumn(part, F.when(F.col("_parts").isNotNull(), dealt).otherwise(F.lit(0))).drop("_parts")
    others = others.join(hot, by, "left").withColumn(
        part, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0))))
    ).drop("_parts")
    return many, others


def _met_in_runs(left: DataFrame, right: DataFrame, columns: Sequence[str], keys: Sequence[str], tasks: int | None) -> DataFrame:
    """Rows of ``left`` (its ``columns``) beside those of ``right`` with equal ``keys``, among them all that overlap.

    Up to :data:`RUN` neighbours of ``left`` meet a row of ``right`` as one list that is set out after the join, so a
    row of ``right`` comes that often in turn and the next one brings the same list again.
    """
    if tasks:
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    place = F.row_number().over(W.partitionBy(*keys).orderBy("start", "end"))
    runs = left.withColumn("_run", F.floor((place - 1) / RUN)).groupBy(*keys, "_run").agg(
        F.min("start").alias("_low"), F.max("end").alias("_high"), F.collect_list(F.struct(*columns)).alias("_rows")
    )
    # Merged, as a side that is broadcast grows with its table.
    met = runs.hint("merge").join(right, list(keys)).where("_low < b_end AND b_start < _high")
    return met.select(*right.columns, F.inline("_rows"))


def overlap_join(
    a: DataFrame,
    b: DataFrame,
    how: str = "inner",
    min_frac_a: float | None = None,
    min_frac_b: float | None = None,
    bin_width: int = BIN,
    hot_rows: int = HOT_ROWS,
    in_runs: bool = False,
    merged: bool = False,
) -> DataFrame:
    """Pairs of overlapping intervals with the shared length as ``overlap``.

    Columns of ``b`` other than ``chrom`` get the prefix ``b_``.  ``how='left'`` keeps
    unmatched rows of ``a`` with null ``b_`` columns and overlap 0.  ``in_runs`` is for pairs that are written as they
    are: the same rows, with neighbours of ``a`` one after the other for each ``b``.  It counts the rows of ``a`` first.
    ``merged`` keeps the planner from broadcasting a side that looks small where it is read, as written columns do.
    """
    left = a.withColumn("_bin", F.explode(_bins(F.col("start"), F.col("end"), bin_width)))
    right = b.select(
        "chrom", *[F.col(c).alias(f"b_{c}") for c in b.columns if c != "chrom"]
    ).withColumn("_bin", F.explode(_bins(F.col("b_start"), F.col("b_end"), bin_width)))
    theirs = [c for c in right.columns if c.startswith("b_")]
    right, left = _split_hot(right, left, "_part", ["chrom", "_bin"], hot_rows)
    if in_runs:
        left, right = _split_hot(left, right, "_side", ["chrom", "_bin", "_part"], hot_rows)
        # Few rows are left to the planner, which merges small tasks.
        rows, usual = a.count(), int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(usual, -(-rows // TASK_ROWS)) if rows > 16 * TASK_ROWS else None
        met = _met_in_runs(left, right, [c for c in a.columns if c != "chrom"], ["chrom", "_bin", "_part", "_side"], tasks)
    else:
        met = left.join(right.hint("merge") if merged else right, ["chrom", "_bin", "_part"])
    first = F.floor(F.greatest("start", "b_start") / bin_width)
    pairs = (
        met.where((F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end")))
        .where(F.col("_bin") == first)
        .withColumn("overlap", F.least("end", "b_end") - F.greatest("start", "b_start"))
    )
    if min_frac_a is not None:
        pairs = pairs.where(F.col("overlap") >= (F.col("end") - F.col("start")) * min_frac_a)
    if min_frac_b is not None:
        pairs = pairs.where(F.col("overlap") >= (F.col("b_end") - F.col("b_start")) * min_frac_b)
    pairs = pairs.select(*a.columns, *theirs, "overlap")
    if how == "inner":
        return pairs
    if how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    if min_frac_a is None and min_frac_b is None:
        lone = overlap_anti(a, b)
    else:
        lone = a.join(pairs.select(*COORDS).distinct(), COORDS, "left_anti")
    return pairs.unionByName(
        lone.withColumn("overlap", F.lit(0).cast("long")), allowMissingColumns=True
    )


def count_many_in_regions(
    regions: DataFrame, reads: DataFrame, weights: Mapping[str, Column], keys: Sequence[str] = ("chrom",)
) -> DataFrame:
    """Add, for each named weight, the total weight of the reads that overlap each region.

    One pass serves all weights, e.g. one per sample.  ``keys`` are the columns both sides
    must agree on.  Reads are reduced to positions first, so equal ones collapse before
    the shuffle.  Each distinct region adds two rows that read off the running totals:
    one before everything at its end, one after everything at its start.
    """
    keys, names = list(keys), list(weights)
    place = [*keys, "start", "end"]
    edges = reads.select(
        *keys, *[weights[n].alias(f"_w{i}") for i, n in enumerate(names)],
        F.explode(
            F.array(
                F.struct(F.col("start").alias("pos"), F.lit(True).alias("opens")),
                F.struct(F.col("end").alias("pos"), F.lit(False).alias("opens")),
            )
        ).alias("e"),
    )
    edges = edges.groupBy(*keys, F.col("e.pos").alias("pos")).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("e.opens") == opens, F.col(f"_w{i}"))), F.lit(0)).alias(f"_{side}{i}")
            for i in range(len(names)) for side, opens in (("in", True), ("out", False))
        ]
    ).withColumn("_rank", F.lit(1))
    asked = regions.select(*place).distinct().select(
        *place,
        F.explode(
            F.array(
                F.struct(F.col("end").alias("pos"), F.lit(0).alias("_rank")),
                F.struct(F.col("start").alias("pos"), F.lit(2).alias("_rank")),
            )
        ).alias("q"),
    ).select(*place, "q.pos", "q._rank")
    # What a region needs at its end is what has started, at its start what has ended.
    counted = tiled_scan(
        edges.unionByName(asked, allowMissingColumns=True),
        keys,
        [F.col("pos"), F.col("_rank")],
        F.floor(F.col("pos") / TILE),
        running={
            f"_all_{side}{i}": ("sum", F.coalesce(f"_{side}{i}", F.lit(0))) for i in range(len(names)) for side in ("in", "out")
        },
    ).where("_rank <> 1")
    at = lambda rank, c: F.max(F.when(F.col("_rank") == rank, F.col(c)))
    answers = counted.groupBy(*place).agg(
        *[(at(0, f"_all_in{i}") - at(2, f"_all_out{i}")).alias(f"_n{i}") for i in range(len(names))]
    )
    return regions.join(answers, place).select(
        *regions.columns, *[F.col(f"_n{i}").alias(n) for i, n in enumerate(names)]
    )


def count_in_regions(
    regions: DataFrame, reads: DataFrame, name: str = "n", weight: Column | None = None, keys: Sequence[str] = ("chrom",)
) -> DataFrame:
    """Add the number (or weight) of reads that overlap each region; zeros are kept."""
    w = F.lit(1).cast("long") if weight is None else weight
    return count_many_in_regions(regions, reads, {name: w}, keys)


def overlap_semi(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that overlap at least one ``b``, each once."""
    return count_in_regions(a, b, "_hits").where("_hits > 0").drop("_hits")


def overlap_anti(a: DataFrame, b: DataFrame, min_frac: float | None = None) -> DataFrame:
    """Rows of ``a`` that overlap no ``b`` (by at least ``min_frac`` of ``a`` if given)."""
    if min_frac is None:
        return count_in_regions(a, b, "_hits").where("_hits = 0").drop("_hits")
    met = overlap_join(a.select(*COORDS).distinct(), b.select(*COORDS), min_frac_a=min_frac)
    return a.join(met.select(*COORDS).distinct(), COORDS, "left_anti")


def subtract_whole(a: DataFrame, b: DataFrame) -> DataFrame:
    """Remove every ``a`` that touches any ``b``."""
    return overlap_anti(a, b)


def _leading(b: DataFrame) -> DataFrame:
    """Intervals that can be the best for some other one: those within none that starts earlier.

    What a longer one from further left covers shares no more with anything, and loses ties by its start.
    Empty intervals stay.
    """
    proper = b.where(F.col("start") < F.col("end"))
    tops = proper.groupBy("chrom", "start").agg(F.max("end").alias("_top")).select("chrom", "start", "_top", F.lit(1).alias("_rank"))
    scanned = tiled_scan(
        proper.withColumn("_rank", F.lit(0)).unionByName(tops, allowMissingColumns=True),
        ["chrom"], [F.col("start"), F.col("_rank"), F.col("end")], F.floor(F.col("start") / TILE),
        running={"_far": ("max", F.col("_top"))},
    )
    lead = scanned.where("_rank = 0 AND (_far IS NULL OR _far < end)").select(*b.columns)
    return lead.unionByName(b.where(F.col("start") >= F.col("end")))


def best_overlap(a: DataFrame, b: DataFrame, payload: Sequence[str], min_frac_a: float | None = None) -> DataFrame:
    """For each ``a`` the ``b`` that shares most with it; nulls and overlap 0 without one.

    Ties go to the smallest ``b`` start, then end, then payload.  Of ``b`` only those count that lie within
    none from further left; their ends are in the order of their starts, so the first that ends at or after
    an ``a`` is its answer if it holds the whole of it.  Only what lies in no single ``b`` is paired.
    """
    spans = a.select(*COORDS).distinct().where("chrom IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL")
    found, names = best_of_spans(spans, b, payload, min_frac_a), [f"b_{c}" for c in payload if c != "chrom"]
    # Merged, as a side that is broadcast grows with its table.
    return a.join(found.hint("merge"), COORDS, "left").select(
        *a.columns,
        F.col("m.b_start"),
        F.col("m.b_end"),
        *[F.col(f"m.{n}") for n in names],
        F.coalesce(-F.col("m.o"), F.lit(0)).alias("overlap"),
    )


def best_of_spans(spans: DataFrame, b: DataFrame, payload: Sequence[str], min_frac_a: float | None = None) -> DataFrame:
    """What :func:`best_overlap` finds for different ``spans`` without nulls: ``chrom, start, end, m`` of those that overlap any.

    ``m`` has ``o``, the shared length below zero, ``b_start``, ``b_end`` and the payload.
    """
    values = F.struct(*[F.col(c).alias(f"b_{c}") for c in dict.fromkeys(["start", "end", *payload]) if c != "chrom"])
    known = b.where("chrom IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL")
    one = known.groupBy(*COORDS).agg(F.min(F.struct(*payload) if payload else F.lit(1)).alias("_p"))
    others = [c for c in dict.fromkeys(payload) if c not in COORDS]
    slim = cut_lineage(_leading(one.select(*COORDS, *[F.col("_p")[c].alias(c) for c in others])))
    ends = slim.where(F.col("start") < F.col("end")).select("chrom", "start", "end", F.lit(0).alias("_rank"), values.alias("_b"))
    found = tiled_scan(
        spans.withColumn("_rank", F.lit(1)).unionByName(ends, allowMissingColumns=True),
        ["chrom"], [-F.col("end"), F.col("_rank"), F.col("start")], F.floor(-F.col("end") / TILE), filled={"_holds": F.col("_b")},
    )
    held = (F.col("_holds.b_start") <= F.col("start")) & (F.col("start") < F.col("end"))
    asked = cut_lineage(found.where("_rank = 1").select(*COORDS, F.when(held, F.col("_holds")).alias("_holds")))
    names = [f"b_{c}" for c in payload if c != "chrom"]
    whole = asked.where("_holds IS NOT NULL").select(
        *COORDS, F.struct((F.col("start") - F.col("end")).alias("o"), "_holds.b_start", "_holds.b_end", *[f"_holds.{n}" for n in names]).alias("m")
    )
    if min_frac_a is not None:
        whole = whole.where(-F.col("m.o") >= (F.col("end") - F.col("start")) * min_frac_a)
    pairs = overlap_join(asked.where("_holds IS NULL").select(*COORDS), slim, min_frac_a=min_frac_a, merged=True)
    parted = pairs.groupBy(*COORDS).agg(
        F.min(F.struct((-F.col("overlap")).alias("o"), "b_start", "b_end", *names)).alias("m")
    )
    return whole.unionByName(parted)


def points_in_intervals(points: DataFrame, intervals: DataFrame, bin_width: int = BIN) -> DataFrame:
    """Pairs of a point (``chrom, pos`` 0-based) and the intervals that hold it."""
    spans = points.withColumn("start", F.col("pos")).withColumn("end", F.col("pos") + 1)
    return overlap_join(spans, intervals, bin_width=bin_width).drop("start", "end", "overlap")


#: Least width in bp of a tile of points whose values are looked up.
POINT_TILE = 1 << 13


def count_points_in_regions(regions: DataFrame, points: DataFrame, name: str = "n") -> DataFrame:
    """Add the number of points (``chrom, pos`` 0-based) in each region; zeros are kept.

    A region counts in the packed list of each tile that it touches (see :mod:`.points`), so a point costs a byte or
    less of the shuffle and no point is paired with a region.
    """
    answers = counts_in(regions, points, TILE)
    return regions.join(answers, COORDS).select(*regions.columns, F.col("_n").alias(name))


def count_contained(regions: DataFrame, reads: DataFrame, scale: float = 1.0, name: str = "n") -> DataFrame:
    """Reads that lie fully inside each region, times ``scale``; zeros are kept.

    Equal reads are counted once with their multiplicity before the join.
    """
    stacked = reads.groupBy(*COORDS).agg(F.count(F.lit(1)).alias("copies"))
    pairs = overlap_join(regions.select(*COORDS).distinct(), stacked, min_frac_b=1.0)
    inside = pairs.groupBy(*COORDS).agg(F.sum("b_copies").alias("_n"))
    return regions.join(inside, COORDS, "left").select(
        *regions.columns, (F.coalesce("_n", F.lit(0)) * F.lit(scale)).alias(name)
    )


def map_signal(regions: DataFrame, signal: DataFrame, aggs: Mapping[str, str]) -> DataFrame:
    """Aggregate the values of the segments that overlap each region, one vote per segment.

    ``aggs`` maps an output column to ``max``, ``mean``, ``min``, ``sum`` or ``count``;
    regions without signal get null (count 0).
    """
    pairs = overlap_join(regions.select(*COORDS).distinct(), signal.select(*COORDS, "value"))
    stats = pairs.groupBy(*COORDS).agg(
        *[getattr(F, fn)("b_value").alias(name) for name, fn in aggs.items()]
    )
    out = regions.join(stats, COORDS, "left")
    for name, fn in aggs.items():
        if fn == "count":
            out = out.withColumn(name, F.coalesce(name, F.lit(0)))
    return out.select(*regions.columns, *aggs)


def signal_area(regions: DataFrame, signal: DataFrame, norm: str = "none", name: str = "area") -> DataFrame:
    """Sum of value x shared length; ``norm`` is ``none``, ``cpm`` (/bp) or ``rpkm`` (x1000/bp)."""
    pairs = overlap_join(regions.select(*COORDS).distinct(), signal.select(*COORDS, "value"))
    sums = pairs.groupBy(*COORDS).agg(F.sum(F.col("b_value") * F.col("overlap")).alias("_area"))
    area = F.coalesce("_area", F.lit(0.0))
    size = F.col("end") - F.col("start")
    scaled = {"none": area, "cpm": area / size, "rpkm": area * 1000 / size}[norm]
    return regions.join(sums, COORDS, "left").select(*regions.columns, scaled.alias(name))


def _highest(begin: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each span ``[left, right)`` of a tile the last of the segments ``[begin, end)`` that overlap it, -1 without one."""
    best, wide = np.full(TILE, -1, np.int32), np.full(TILE, -1, np.int32)
    point = end - begin == 1
    np.maximum.at(best, begin[point], np.flatnonzero(point).astype(np.int32))
    long = np.flatnonzero(~point)
    size = end[long] - begin[long]
    if size.sum() <= 16 * TILE:
        at = np.repeat(begin[long] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        np.maximum.at(wide, at, np.repeat(long, size).astype(np.int32))
    else:
        for k in long.tolist():
            wide[begin[k]:end[k]] = k
    best = np.maximum(best, wide)
    out, level = np.empty(len(left), np.int32), np.frexp((right - left).astype(float))[1] - 1
    for k in range(int(level.max(initial=-1)) + 1):
        mine = np.flatnonzero(level == k)
        out[mine] = np.maximum(best[left[mine]], best[right[mine] - (1 << k)])
        best = np.maximum(best[:-(1 << k)], best[1 << k:])
    return out


def highest_overlap(regions: DataFrame, segments: DataFrame, by: str | None = None) -> DataFrame:
    """For each distinct region the overlapping segment with the highest ``value``, one for each value of ``by`` if told.

    Rows ``chrom, start, end[, by], b_start, b_end, b_value``; regions that nothing overlaps are left out.  Ties go
    to the smallest start, then end.  Tiles with more than ``HOT_ROWS`` rows are dealt out.
    """
    more = [by] if by else []
    known = "chrom IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL"
    # Columns of their own: both sides may come from one table.
    asked = regions.where(known).select(*[F.col(c).alias(c) for c in COORDS]).distinct()
    slim = segments.where(known).groupBy(*COORDS, *more).agg(F.max("value").alias("value"))
    proper = F.col("start") < F.col("end")
    tiled = lambda df: df.where(proper).withColumn("_tile", F.explode(_bins(F.col("start"), F.col("end"), TILE)))
    ask, segment = tiled(asked), tiled(slim)
    place = ["chrom", "_tile"]
    hot = lambda df, name: F.broadcast(df.groupBy(*place).count().where(F.col("count") > HOT_ROWS).select(*place, F.ceil(F.col("count") / HOT_ROWS).cast("int").alias(name)))
    parts = [hot(ask, "_asks"), hot(segment, "_segments")]
    dealt = lambda name: F.pmod(F.xxhash64("start", "end"), F.coalesce(name, F.lit(1))).cast("int")
    copied = lambda name: F.explode(F.sequence(F.lit(0), F.coalesce(name, F.lit(1)) - 1))
    ask, segment = (df.join(parts[0], place, "left").join(parts[1], place, "left") for df in (ask, segment))
    ask = ask.withColumn("_mine", dealt("_asks")).withColumn("_other", copied("_segments")).drop("_asks", "_segments")
    segment = segment.withColumn("_other", dealt("_segments")).withColumn("_mine", copied("_asks")).drop("_asks", "_segments")
    # Null, number, NaN: the order of Spark.
    kind = F.when(F.col("value").isNull(), 0).when(F.isnan(F.col("value").cast("double")), 2).otherwise(1)
    segment = segment.withColumn("_kind", kind)
    types = {f.name: f.dataType.simpleString() for f in slim.schema}
    names = [*COORDS, *more, "b_start", "b_end", "b_value"]
    schema = ", ".join(f"`{n}` {types[n.removeprefix('b_') if n.startswith('b_') and n not in more else n]}" for n in names)

    def find(some: pa.Table, table: pa.Table) -> pa.Table:
        low = (some if len(some) else table).column("_tile")[0].as_py() * TILE
        table = table.take(pc.sort_indices(table, [("_kind", "ascending"), ("value", "ascending"), ("start", "descending"), ("end", "descending")]))
        side = lambda t, c: np.clip(t.column(c).to_numpy() - low, 0, TILE)
        left, right, begin, end = side(some, "start"), side(some, "end"), side(table, "start"), side(table, "end")
        groups = table.column(by).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy() if by else np.zeros(len(table), int)
        asks, found = [np.zeros(0, int)], [np.zeros(0, int)]
        for g in np.unique(groups):
            mine = np.flatnonzero(groups == g)
            top = _highest(begin[mine], end[mine], left, right)
            hit = np.flatnonzero(top >= 0)
            asks.append(hit)
            found.append(mine[top[hit]])
        here, there = some.take(pa.array(np.concatenate(asks))), table.take(pa.array(np.concatenate(found)))
        return pa.table([*[here.column(c) for c in COORDS], *[there.column(c) for c in [*more, "start", "end", "value"]]], names=names)

    keys = [*place, "_mine", "_other"]
    found = ask.groupBy(*keys).cogroup(segment.groupBy(*keys)).applyInArrow(find, schema)
    # Intervals without bases have no positions to look up; they are paired.
    for a, b in ((asked.where(~proper), slim), (asked.where(proper), slim.where(~proper))):
        if not (a if b is slim else b).isEmpty():
            found = found.unionByName(overlap_join(a, b).select(*COORDS, *[F.col(f"b_{c}").alias(c) for c in more], "b_start", "b_end", "b_value"))
    answer = F.max_by(F.struct("b_start", "b_end", "b_value"), F.struct("b_value", -F.col("b_start"), -F.col("b_end"))).alias("m")
    return found.groupBy(*COORDS, *more).agg(answer).select(*COORDS, *more, "m.b_start", "m.b_end", "m.b_value")


def argmax_position(regions: DataFrame, signal: DataFrame) -> DataFrame:
    """Midpoint and value of the highest segment in each region (first one on ties)."""
    mid = F.floor((F.col("b_start") + F.col("b_end")) / 2)
    top = highest_overlap(regions, signal).select(*COORDS, mid.alias("_mid"), F.col("b_value").alias("_top"))
    return regions.join(top, COORDS).select(*regions.columns, F.col("_mid").alias("position"), F.col("_top").alias("max_value"))
