"""Train/test splits, matched negatives and re-mixed libraries.

Random choices are ordered by a hash of the row key and the seed, so they do not depend
on partitioning and a recomputed task makes the same choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import cut_lineage
from .overlap import best_overlap, overlap_anti, overlap_join
from .scans import draw, row_index
from .segments import make_bins
from .sequences import extract_sequences, with_gc
from .transport import cheapest_transport

#: Annotation types in the order in which composite types give one up.
TYPE_ORDER = ["intergenic", "3UTR", "5UTR", "exon", "intron", "promoter"]


def _shuffled(df: DataFrame, keys: Sequence[str], seed: int, id_col: str, name: str) -> DataFrame:
    tagged = df.withColumn("_draw", draw(seed, F.col(id_col)))
    return row_index(
        tagged, keys, [F.col("_draw"), F.col(id_col)], F.shiftright(F.col("_draw"), 36), name
    ).drop("_draw")


def split_top(df: DataFrame, n: int, by: str, id_col: str, top: int | None = None, reuse_train: bool = False) -> DataFrame:
    """Best ``n`` rows to learn from and the rest (or the next ``top``) to test on.

    With ``reuse_train`` (for small sets) the learning rows also serve for testing.  Returns
    the rows with ``part``; a row used twice appears twice.
    """
    best = df.orderBy(F.desc(by), F.col(id_col)).limit(n)
    learn = best.withColumn("part", F.lit("train"))
    rest = df.join(best.select(id_col), id_col, "left_anti")
    if top is not None:
        rest = rest.orderBy(F.desc(by), F.col(id_col)).limit(top)
    test = best.unionByName(rest) if reuse_train else rest
    return learn.unionByName(test.withColumn("part", F.lit("test")).select(*learn.columns))


def split_percent(df: DataFrame, percent: float, seed: int, id_col: str, strata: Sequence[str] = ()) -> DataFrame:
    """Seeded shuffle, then ``percent`` % of each class to ``train`` and the rest to ``test``."""
    strata = list(strata)
    ranked = _shuffled(df, strata, seed, id_col, "_rank")
    total = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    both = ranked.join(total, strata) if strata else ranked.crossJoin(F.broadcast(total))
    cut = F.floor(F.col("_n") * percent / 100)
    return both.withColumn("part", F.when(F.col("_rank") <= cut, "train").otherwise("test")).select(*df.columns, "part")


def split_fixed(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` rows along an order column, and the rest."""
    first = df.orderBy(order).limit(n).select(order).withColumn("part", F.lit("train"))
    return df.join(first, order, "left").withColumn("part", F.coalesce("part", F.lit("test")))


def simplify_types(bins: DataFrame, column: str = "type", min_bins: int = 1000, max_parts: int = 3) -> DataFrame:
    """Table of types to use: frequent ones stay, others give up one part at a time.

    Returns ``(type, simple)`` for each type present in ``bins``; the type vocabulary is
    at most 63 combinations of six classes.
    """
    # Read twice, so written: it is a row for each type, and the bins may be long in the making.
    counts = cut_lineage(bins.groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    kept = counts.where((F.col("n") >= min_bins) & (F.size(F.split(column, ";")) <= max_parts))
    allowed = kept.agg(F.coalesce(F.collect_set(column), F.array()).alias("_ok"))
    # A composite has at most six parts, so six rounds settle every type.
    state = counts.select(F.col(column), F.col(column).alias("simple")).crossJoin(F.broadcast(allowed))
    for _ in range(6):
        state = state.withColumn("simple", _simplify(F.col("simple"), F.col("_ok")))
    return state.select(column, "simple")


def _simplify(kind: Column, allowed: Column) -> Column:
    parts = F.split(kind, ";")
    without = lambda drop: F.array_join(F.array_remove(parts, drop), ";")
    step = F.lit(None).cast("string")
    for drop in reversed(TYPE_ORDER[:-1]):
        step = F.when(F.array_contains(parts, drop), without(drop)).otherwise(step)
    for drop in reversed(TYPE_ORDER):
        step = F.when(
            F.array_contains(parts, drop) & F.array_contains(allowed, without(drop)), without(drop)
        ).otherwise(step)
    return (
        F.when(F.array_contains(allowed, kind), kind)
        .when(F.size(parts) <= 1, F.lit("intergenic"))
        .otherwise(step)
    )


def genome_bin_library(
    sizes: DataFrame, annotation: DataFrame, genome: DataFrame, length: int,
    positives: DataFrame | None = None, simple: bool = True, chunk: int | None = None,
) -> DataFrame:
    """Bins of ``length`` bp with annotation type, GC and length, away from the positives.

    A type counts when it covers a tenth of the bin; ``simple`` keeps the largest one,
    otherwise types are joined with ``;``.
    """
    # Sizes, bins and types are read several times and may be long in the making.
    bins = make_bins(cut_lineage(sizes), length).where(F.col("end") - F.col("start") == length)
    if positives is not None:
        near = positives.select("chrom", F.greatest(F.col("start") - 1, F.lit(0)).alias("start"), (F.col("end") + 1).alias("end"))
        bins = cut_lineage(overlap_anti(bins, near))
    if simple:
        typed = best_overlap(bins, annotation, ["type"], min_frac_a=0.10).select(
            "chrom", "start", "end", F.coalesce("b_type", F.lit("intergenic")).alias("type")
        )
    else:
        pairs = overlap_join(bins, annotation.select("chrom", "start", "end", "type"), "left", min_frac_a=0.10)
        typed = pairs.groupBy("chrom", "start", "end").agg(
            F.array_join(F.array_sort(F.collect_set(F.coalesce("b_type", F.lit("intergenic")))), ";").alias("type")
        )
    typed = cut_lineage(typed)
    seqs = extract_sequences(typed, genome, chunk) if chunk else extract_sequences(typed, genome)
    return with_gc(seqs, 2).select("chrom", "start", "end", "type", "gc", F.lit(length).alias("length"))


#: Widest difference of the wide GC steps, in tenths.
WIDE_STEPS = 4
#: A place in GC: hundredths * GC_CELL + tenths, both rounded.
GC_CELL = 1000


def _gc_cell(gc: Column) -> Column:
    known = F.when(~F.isnan(gc), gc)
    return F.coalesce((F.round(known * 100) * GC_CELL + F.round(known * 10)).cast("int"), F.lit(-1))


def allot_strata(counts: DataFrame, steps: int) -> DataFrame:
    """Which ranks of each stratum of positives take which ranks of which stratum of bins.

    ``counts`` is ``(type, cell, asked, offered)``.  Within a type three transports follow each other,
    each on what the one before left: GC within ``steps`` hundredths, within ``WIDE_STEPS`` tenths, any.
    Each moves as many as can be moved, as near as that allows.  A type has at most some hundred cells,
    however many rows they hold.  Returns ``(type, cell, first, n, bin_cell, bin_first, round)``.
    """
    import numpy as np
    import pandas as pd

    names = ["type", "cell", "first", "n", "bin_cell", "bin_first", "round"]

    def allot(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cell")
        asked, offered = (group[group[c] > 0][["cell", c]].to_numpy(np.int64) for c in ("asked", "offered"))
        (want, left), (have, room) = asked.T, offered.T
        known = (want[:, None] >= 0) & (have >= 0)
        gap = np.abs(want[:, None] // GC_CELL - have // GC_CELL).astype(float)
        wide = np.abs(want[:, None] % GC_CELL - have % GC_CELL).astype(float)
        rounds = [
            (np.where(known & (gap <= steps), gap, np.inf), lambda i, j: f"gc{gap[i, j]:.0f}"),
            (np.where(known & (wide <= WIDE_STEPS), wide, np.inf), lambda i, j: f"tenth{wide[i, j]:.0f}"),
            (np.where(known, gap, 100.0), lambda i, j: "type"),
        ]
        taken, given, out = np.zeros_like(left), np.zeros_like(room), []
        for cost, name in rounds:
            flow = cheapest_transport(left - taken, room - given, cost)
            for i, j in zip(*np.nonzero(flow)):
                out.append((group["type"].iloc[0], want[i], taken[i], flow[i, j], have[j], given[j], name(i, j)))
                taken[i] += flow[i, j]
                given[j] += flow[i, j]
        return pd.DataFrame(out, columns=names)

    return counts.groupBy("type").applyInPandas(
        allot, "type string, cell int, first long, n long, bin_cell int, bin_first long, round string"
    )


def matched_negatives(
    positives: DataFrame, library: DataFrame, seed: int, delta_gc: float = 0.03, id_col: str = "id", sets: int = 1
) -> DataFrame:
    """For each positive a library bin of the same type with near GC, each bin used once per set.

    Positives need ``type`` and ``gc``; the library ``type, gc`` and coordinates.  Inside a type as many
    positives as possible get a bin within ``delta_gc`` (in 0.01 steps, the total difference as small as
    that allows), of the others as many as possible one within 0.4 (in 0.1 steps), then any bin of the
    type; last comes any bin at all.  How many go from where to where is settled on the counts of the
    strata (:func:`allot_strata`); which row it is follows from its rank in a seeded order.  A missing
    GC fits a type, a missing type the last round.  Positives beyond the number of bins stay, without a
    place and with ``none`` as their round.
    Returns ``(set_no, id, chrom, start, end, type, gc, pos_gc, round)``.
    """
    set_no = F.explode(F.sequence(F.lit(1), F.lit(sets))).alias("set_no")
    # Both are read for the counts, for each ranking and for what is left over, so they are made once.
    offered = cut_lineage(library.select("chrom", "start", "end", "type", "gc", _gc_cell(F.col("gc")).alias("bin_cell")))
    asked = cut_lineage(positives.select(id_col, F.col("type").alias("ptype"), F.col("gc").alias("pos_gc"), _gc_cell(F.col("gc")).alias("cell")))
    both = asked.select(F.col("ptype").alias("type"), "cell", F.lit(1).alias("a"), F.lit(0).alias("o")).unionByName(
        offered.select("type", F.col("bin_cell").alias("cell"), F.lit(0).alias("a"), F.lit(1).alias("o"))
    )
    counts = both.where("type IS NOT NULL").groupBy("type", "cell").agg(F.sum("a").alias("asked"), F.sum("o").alias("offered"))
    shares = cut_lineage(allot_strata(counts, round(delta_gc * 100)))

    bins = offered.select("*", set_no).withColumn("bin_id", F.concat_ws(":", "chrom", "start", "end", "set_no"))
    wanted = asked.select("*", set_no).withColumn("_pid", F.concat_ws(":", F.col(id_col).cast("string"), "set_no"))
    place = ["chrom", "start", "end", "type", "gc"]
    out = ["set_no", id_col, "_pid", "pos_gc", "bin_id", *place, "round"]
    typed = wanted.where("ptype IS NOT NULL").withColumnRenamed("ptype", "type")
    left = _shuffled(typed, ["set_no", "type", "cell"], seed, "_pid", "_rank")
    sent = left.join(shares, ["type", "cell"]).where("_rank > first AND _rank <= first + n").select(
        "set_no", id_col, "_pid", "pos_gc", "type", "bin_cell", (F.col("_rank") - F.col("first") + F.col("bin_first")).alias("_at"), "round"
    )
    right = _shuffled(bins.where("type IS NOT NULL"), ["set_no", "type", "bin_cell"], seed, "bin_id", "_at")
    near = cut_lineage(sent.join(right, ["set_no", "type", "bin_cell", "_at"]).select(*out))

    rest = wanted.join(near.select("_pid"), "_pid", "left_anti")
    free = bins.join(near.select("bin_id"), "bin_id", "left_anti")
    left = _shuffled(rest, ["set_no"], seed + 1, "_pid", "_rank")
    right = _shuffled(free, ["set_no"], seed + 1, "bin_id", "_rank").select("set_no", "_rank", "bin_id", *place)
    last = left.join(right, ["set_no", "_rank"], "left").withColumn(
        "round", F.when(F.col("bin_id").isNull(), "none").otherwise("any")
    )
    return near.unionByName(last.select(*out)).drop("_pid", "bin_id")


def n_negative_sets(positives: DataFrame, library: DataFrame, k: int, seed: int, **options) -> DataFrame:
    """``k`` negative sets drawn independently; a bin is used once inside a set."""
    return matched_negatives(positives, library, seed, sets=k, **options)


def remix_samples(treat: DataFrame, control: DataFrame, seed: int, id_col: str, equal: bool = False) -> DataFrame:
    """Pool two read sets, shuffle, and split again at the first set's size or in halves."""
    pool = treat.withColumn("_from", F.lit("t")).unionByName(control.withColumn("_from", F.lit("c")))
    pool = pool.withColumn("_uid", F.concat_ws(":", "_from", F.col(id_col).cast("string")))
    ranked = _shuffled(pool, [], seed, "_uid", "_rank")
    size = F.floor(F.count(F.lit(1)) / 2) if equal else F.count_if(F.col("_from") == "t")
    cut = pool.agg(size.alias("_cut"))
    return ranked.crossJoin(F.broadcast(cut)).withColumn(
        "remix", F.when(F.col("_rank") <= F.col("_cut"), "treatment").otherwise("control")
    ).drop("_from", "_uid", "_rank", "_cut")
