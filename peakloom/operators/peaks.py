"""Peak calling, replicate concordance, consensus and merging of peak sets."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.tails import chi2_even_p, poisson_sf
from ..runtime import cut_lineage
from .chains import WIDTHS, choosers
from .normalise import p_adjust
from .overlap import COORDS, TILE, highest_overlap, map_signal, overlap_anti, overlap_join
from .scans import ranked, tiled_scan, value_bucket
from .segments import cluster_intervals, combine_tracks, pileup, scale_track

#: Largest summit distance and its share of the region length.
SUMMIT_DISTANCE, SUMMIT_SHARE = 300, 2 / 5


# --- calling ---------------------------------------------------------------


def local_background(control: DataFrame, sizes: DataFrame, d: int = 200, slocal: int = 500, llocal: int = 5000) -> DataFrame:
    """Largest of the control pile-ups with windows ``d``, ``slocal`` and ``llocal``, each scaled to ``d``."""
    tracks = None
    for width in (d, slocal, llocal):
        centre = F.floor((F.col("start") + F.col("end")) / 2)
        spread = control.select(
            "chrom", F.greatest(centre - width // 2, F.lit(0)).alias("start"), (centre + width // 2).alias("end")
        )
        track = scale_track(pileup(spread), d / width).withColumn("track", F.lit(f"w{width}"))
        tracks = track if tracks is None else tracks.unionByName(track)
    return combine_tracks(cut_lineage(tracks), [f"w{w}" for w in (d, slocal, llocal)], "max")


def call_peaks(
    treat: DataFrame, control: DataFrame, sizes: DataFrame, q: float = 0.05, min_len: int = 100, d: int = 200,
    max_gap: int = 0,
) -> DataFrame:
    """Regions where the treatment depth exceeds the local background (Poisson, BH over segments).

    The summit is the middle of the highest segment.  Libraries are scaled to the treatment.
    """
    depth = pileup(treat).withColumn("track", F.lit("treat"))
    lam = local_background(control, sizes, d).withColumn("track", F.lit("control"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    genome = sizes.agg(F.sum("length").alias("_g"))
    facts = count(treat, "_t").crossJoin(F.broadcast(count(control, "_c"))).crossJoin(F.broadcast(genome))
    # Segments on the common breakpoints with both values.
    pair = _pair_tracks(cut_lineage(depth), cut_lineage(lam)).crossJoin(F.broadcast(facts))
    base = F.col("_t") * d / F.col("_g")
    rate = F.greatest(F.col("control") * F.col("_t") / F.col("_c"), base)
    scored = pair.where("treat > 0").select(*COORDS, "treat", rate.alias("lambda"))
    scored = cut_lineage(scored.withColumn("p", poisson_sf(F.col("treat"), F.col("lambda"))))
    tested = p_adjust(scored, "p", "BH", name="q")
    hot = cut_lineage(tested.where(F.col("q") < q))
    isles = cluster_intervals(hot, max_gap)
    top = F.max_by(F.floor((F.col("start") + F.col("end")) / 2), F.struct("treat", -F.col("start")))
    return (
        isles.groupBy("chrom", "cluster_start", "cluster_end")
        .agg(F.max("treat").alias("height"), F.min("q").alias("q"), top.alias("summit"), F.max(F.col("treat") / F.col("lambda")).alias("signal_value"))
        .withColumnsRenamed({"cluster_start": "start", "cluster_end": "end"})
        .where(F.col("end") - F.col("start") >= min_len)
    )


def _pair_tracks(treat: DataFrame, control: DataFrame) -> DataFrame:
    edges = treat.unionByName(control).select(
        "chrom", "track",
        F.explode(F.array(
            F.struct(F.col("start").alias("pos"), F.col("value").alias("v")),
            F.struct(F.col("end").alias("pos"), F.lit(-1.0).alias("v")),
        )).alias("e"),
    )
    level = lambda t: F.max(F.when(F.col("track") == t, F.col("e.v")))
    points = edges.groupBy("chrom", F.col("e.pos").alias("pos")).agg(level("treat").alias("t"), level("control").alias("c"))
    held = tiled_scan(
        points, ["chrom"], [F.col("pos")], F.floor(F.col("pos") / TILE),
        following={"end": F.col("pos")}, filled={"treat": F.col("t"), "control": F.col("c")},
    ).where("end is not null")
    flat = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0)).alias(c)
    return held.select("chrom", F.col("pos").alias("start"), "end", flat("treat"), flat("control"))


def filter_vs_control(peaks: DataFrame, sample: DataFrame, control: DataFrame, k: float = 3.0) -> DataFrame:
    """Keep peaks whose max and mean sample coverage both exceed ``k`` times the control's."""
    both = map_signal(
        map_signal(peaks, control, {"_cmax": "max", "_cmean": "mean"}), sample, {"_smax": "max", "_smean": "mean"}
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return both.where((zero("_cmax") * k < zero("_smax")) & (zero("_cmean") * k < zero("_smean"))).select(*peaks.columns)


def replicate_concordance(
    peaks: DataFrame, weak: float = 1e-4, strong: float = 1e-8, min_reps: int = 2, rep: str = "replicate"
) -> DataFrame:
    """Regions supported by enough replicates with a strong combined p-value.

    Peaks below ``weak`` form islands; the best p-value of each replicate is combined by
    Fisher's method.  ``neg_log10_p`` holds the evidence of a peak.
    """
    fit = peaks.where(F.col("neg_log10_p") >= F.lit(-1.0) * F.log10(F.lit(weak)))
    best = (
        cluster_intervals(fit).groupBy("chrom", "cluster_start", "cluster_end", rep)
        .agg(F.max("neg_log10_p").alias("_best"))
    )
    ln10 = F.log(F.lit(10.0))
    joint = best.groupBy("chrom", "cluster_start", "cluster_end").agg(
        F.count(F.lit(1)).alias("replicates"), F.sum(2 * ln10 * F.col("_best")).alias("fisher")
    )
    joint = joint.withColumn("combined_p", chi2_even_p(F.col("fisher"), F.col("replicates")))
    return joint.where((F.col("replicates") >= min_reps) & (F.col("combined_p") <= strong)).withColumnsRenamed(
        {"cluster_start": "start", "cluster_end": "end"}
    )


def peak_evidence(
    peaks: DataFrame, weak: float = 1e-4, strong: float = 1e-8, min_reps: int = 2, alpha: float = 0.05,
    rule: str = "technical", rep: str = "replicate",
) -> DataFrame:
    """Each replicate's peak judged with those that it overlaps in the other replicates, a row a peak.

    Peaks below ``weak`` count, as ``strong`` or ``weak`` ones (``kind``).  A peak's test joins it with the
    best overlapping peak of each other replicate (of equal ones the first): it passes if ``min_reps``
    replicates take part and Fisher's combined p-value is at most ``strong``.  A peak takes part in its own
    test and in the tests of peaks that picked it, where enough replicates met.  It is ``confirmed`` if all
    of these pass (``technical`` replicates) or any does (``biological``), else ``discarded``.  ``fdr`` is
    Benjamini-Hochberg over the confirmed peaks of a replicate and ``kept`` tells whether it is at most
    ``alpha``.  Rows with equal place and replicate are one peak with the best evidence.
    """
    if rule not in ("technical", "biological"):
        raise ValueError("rule must be 'technical' or 'biological'")
    me = [*COORDS, rep]
    fit = peaks.where(F.col("neg_log10_p") >= F.lit(-1.0) * F.log10(F.lit(weak)))
    fit = cut_lineage(fit.groupBy(*me).agg(F.max("neg_log10_p").alias("neg_log10_p")))
    met = highest_overlap(fit, fit.select(*COORDS, F.col(rep).alias("_rep"), F.col("neg_log10_p").alias("value")), "_rep")
    best = cut_lineage(fit.select(*me).join(met, COORDS).where(F.col(rep) != F.col("_rep")).select(
        *me, "_rep", F.col("b_start").alias("_start"), F.col("b_end").alias("_end"), F.col("b_value").alias("_best")
    ))
    ln10 = F.log(F.lit(10.0))
    others = best.groupBy(*me).agg(F.count(F.lit(1)).alias("_n"), F.sum("_best").alias("_sum"))
    tests = fit.join(others, me, "left").select(
        *me, "neg_log10_p", (F.coalesce("_n", F.lit(0)) + 1).alias("replicates"),
        (2 * ln10 * (F.col("neg_log10_p") + F.coalesce("_sum", F.lit(0.0)))).alias("fisher"),
    )
    tests = tests.withColumn("combined_p", chi2_even_p(F.col("fisher"), F.col("replicates")))
    enough = F.col("replicates") >= min_reps
    tests = cut_lineage(tests.withColumn("_pass", enough & (F.col("combined_p") <= strong)))
    asked = best.join(tests.where(enough).select(*me, "_pass"), me).groupBy(
        "chrom", F.col("_start").alias("start"), F.col("_end").alias("end"), F.col("_rep").alias(rep)
    ).agg(F.every("_pass").alias("_all"), F.some("_pass").alias("_any"))
    joined = tests.join(asked, me, "left")
    passed = F.col("_pass") & F.coalesce("_all", F.lit(True)) if rule == "technical" else F.col("_pass") | F.coalesce("_any", F.lit(False))
    judged = cut_lineage(joined.select(
        *me, "neg_log10_p", F.when(F.col("neg_log10_p") >= F.lit(-1.0) * F.log10(F.lit(strong)), "strong").otherwise("weak").alias("kind"),
        "replicates", "fisher", "combined_p", F.when(passed, "confirmed").otherwise("discarded").alias("verdict"),
        F.when(passed, F.pow(F.lit(10.0), -F.col("neg_log10_p"))).alias("_p"),
    ))
    return p_adjust(judged, "_p", "BH", [rep], "fdr").drop("_p").withColumn("kept", F.coalesce(F.col("fdr") <= alpha, F.lit(False)))


def confirmed_regions(evidence: DataFrame, top: int | None = None, rep: str = "replicate") -> DataFrame:
    """Regions of overlapping kept peaks with their replicates and best combined evidence, the ``top`` best ones if told."""
    islands = cluster_intervals(evidence.where("kept"))
    out = islands.groupBy("chrom", "cluster_start", "cluster_end").agg(
        F.count_distinct(rep).alias("replicates"), F.max("fisher").alias("fisher"), F.count(F.lit(1)).alias("peaks")
    ).withColumnsRenamed({"cluster_start": "start", "cluster_end": "end"})
    return out if top is None else top_n_peaks(out, top, "fisher")


# --- consensus -------------------------------------------------------------


def consensus_summits(
    regions: DataFrame, summits: DataFrame, replicates: Sequence[str], phs: int = 200, min_reps: int = 2, rescue: bool = True
) -> DataFrame:
    """One narrow peak per group of replicate summits inside each consensus region.

    ``summits`` has the replicate peaks (``chrom, start, end, summit, replicate``).  Replicates
    are taken in the given order: the first opens a cluster at each summit, a later summit
    joins the nearest cluster centre within min(2/5 of the region, 300) unless a nearer
    summit of the same replicate does, and opens its own cluster otherwise.  Clusters with
    ``min_reps`` summits give mean summit +- ``phs``, mean start and end and the
    replicates; with ``rescue`` two weaker ones closer than ``phs`` are merged if their
    joint replicates suffice.

    The fold is over replicates (a short list), every step is a keyed join.
    """
    area = ["chrom", "region_start", "region_end"]
    spots = (
        overlap_join(regions.select(*COORDS).distinct(), summits.select(*COORDS, "summit", "replicate"))
        .select(
            "chrom", F.col("start").alias("region_start"), F.col("end").alias("region_end"), F.col("b_summit").alias("summit"),
            F.col("b_start").alias("peak_start"), F.col("b_end").alias("peak_end"), F.col("b_replicate").alias("replicate"),
        )
        .groupBy(*area, "replicate", "summit").agg(F.min("peak_start").alias("peak_start"), F.min("peak_end").alias("peak_end"))
    )
    spots = cut_lineage(spots)
    # A spread that no region exceeds, so that near centres share a bin or sit in the next one.
    width = SUMMIT_DISTANCE
    near = F.least((F.col("region_end") - F.col("region_start")) * SUMMIT_SHARE, F.lit(float(SUMMIT_DISTANCE)))
    opened = None
    members = None
    for name in replicates:
        mine = spots.where(F.col("replicate") == name)
        if opened is None:
            joined = mine.withColumn("centre", F.col("summit"))
            opened = mine.select(*area, F.col("summit").alias("centre"))
            members = joined
            continue
        a = mine.withColumn("_bin", F.explode(F.array(*[F.floor(F.col("summit") / width) + i for i in (-1, 0, 1)])))
        b = opened.withColumn("_bin", F.floor(F.col("centre") / width))
        gap = F.abs(F.col("summit") - F.col("centre"))
        choice = (
            a.join(b, [*area, "_bin"]).where(gap <= near)
            .groupBy(*area, "summit").agg(F.min(F.struct(gap.alias("gap"), "centre")).alias("m"))
            .select(*area, "summit", F.col("m.gap").alias("gap"), F.col("m.centre").alias("centre"))
        )
        kept = choice.groupBy(*area, "centre").agg(F.min(F.struct("gap", "summit")).alias("m")).select(
            *area, "centre", F.col("m.summit").alias("summit")
        )
        placed = cut_lineage(mine.join(kept, [*area, "summit"], "left").withColumn("centre", F.coalesce("centre", "summit")))
        members = members.unionByName(placed)
        fresh = placed.where(F.col("centre") == F.col("summit")).select(*area, "centre")
        opened = opened.unionByName(fresh).distinct()
    clusters = members.groupBy(*area, "centre").agg(
        F.count(F.lit(1)).alias("nb"), F.sum("summit").alias("s"), F.sum("peak_start").alias("ps"),
        F.sum("peak_end").alias("pe"), F.collect_set("replicate").alias("reps"),
    )
    strong = clusters.where(F.col("nb") >= min_reps)
    if rescue:
        weak = clusters.where(F.col("nb") < min_reps).withColumn("mean", F.floor(F.col("s") / F.col("nb")))
        strong = strong.unionByName(_rescue(weak, area, phs, min_reps))
    mean = F.floor(F.col("s") / F.col("nb"))
    return strong.select(
        "chrom", (mean - phs).alias("start"), (mean + phs).alias("end"), F.floor(F.col("ps") / F.col("nb")).alias("mean_start"),
        F.floor(F.col("pe") / F.col("nb")).alias("mean_end"), F.array_join(F.array_sort("reps"), ",").alias("replicates"),
    )


def _rescue(weak: DataFrame, area: Sequence[str], phs: int, min_reps: int) -> DataFrame:
    """Merge pairs of weak clusters that are each other's nearest acceptable partner."""
    a = weak.withColumn("_bin", F.explode(F.array(*[F.floor(F.col("mean") / phs) + i for i in (-1, 0, 1)])))
    b = weak.select(
        *area, F.floor(F.col("mean") / phs).alias("_bin"), *[F.col(c).alias(f"{c}_2") for c in ("centre", "nb", "s", "ps", "pe", "reps", "mean")]
    )
    gap = F.abs(F.col("mean") - F.col("mean_2"))
    pairs = (
        a.join(b, [*area, "_bin"]).where((F.col("centre") != F.col("centre_2")) & (gap < phs))
        .withColumn("joint", F.array_union("reps", "reps_2")).where(F.size("joint") >= min_reps)
    )
    first = pairs.groupBy(*area, "centre").agg(F.min(F.struct(gap.alias("g"), "centre_2")).alias("m")).select(
        *area, "centre", F.col("m.centre_2").alias("centre_2")
    )
    back = first.select(*area, F.col("centre").alias("centre_2"), F.col("centre_2").alias("centre"))
    mutual = first.join(back, [*area, "centre", "centre_2"]).where("centre < centre_2")
    return pairs.drop("_bin").join(mutual, [*area, "centre", "centre_2"]).select(
        *area, "centre", *[(F.col(c) + F.col(f"{c}_2")).alias(c) for c in ("nb", "s", "ps", "pe")], F.col("joint").alias("reps")
    )


def peak_max_per_replicate(peaks: DataFrame, tracks: DataFrame, names: Sequence[str], by: str = "track") -> DataFrame:
    """Highest coverage of each replicate in each peak (0 without any) and the mean of these.

    Each position of a tile keeps its highest segment, so peaks and segments are not paired (see :func:`highest_overlap`).
    """
    # Read several times, and long in the making where it is a pile-up.
    wanted = cut_lineage(tracks.where(F.col(by).isin(*names)).select(*COORDS, "value", by))
    found = highest_overlap(peaks.select(*COORDS), wanted, by)
    wide = found.groupBy(*COORDS).agg(
        *[F.max(F.when(F.col(by) == n, F.col("b_value"))).alias(f"max_{n}") for n in names]
    )
    out = peaks.join(wide, COORDS, "left").na.fill(0.0, [f"max_{n}" for n in names])
    total = sum((F.col(f"max_{n}") for n in names[1:]), F.col(f"max_{names[0]}"))
    return out.withColumn("mean_max", total / len(names)).select(*peaks.columns, *[f"max_{n}" for n in names], "mean_max")


def sd_outlier_filter(df: DataFrame, columns: Sequence[str], width: float = 2.0) -> DataFrame:
    """Drop rows where at least half the replicates lie outside mean +- ``width`` sd."""
    n = len(columns)
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    mean = total / n
    squares = sum(((F.col(c) - mean) ** 2 for c in columns[1:]), (F.col(columns[0]) - mean) ** 2)
    sd = F.sqrt(squares / n)
    away = sum(
        ((F.abs(F.col(c) - mean) > width * sd).cast("int") for c in columns[1:]),
        (F.abs(F.col(columns[0]) - mean) > width * sd).cast("int"),
    )
    return df.where(away < n / 2)


def simple_clusters(peaks: DataFrame, size: int = 3) -> DataFrame:
    """Islands with exactly ``size`` members, with the mean of their summits."""
    return (
        cluster_intervals(peaks).groupBy("chrom", "cluster_start", "cluster_end")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("summit").alias("mean_summit"))
        .where(F.col("n") == size).drop("n").withColumnsRenamed({"cluster_start": "start", "cluster_end": "end"})
    )


def split_complex_clusters(peaks: DataFrame, size: int = 200, members: int = 3) -> DataFrame:
    """Islands with more than ``members`` peaks, cut into windows around their summits.

    Along the summits, one joins the last centre if within ``size`` and opens a new one
    otherwise; each centre gives mean summit +- ``size``.  Equal summits are counted first.  A tile
    tells for every centre that may reach into it which centre leaves it (at most ``size`` + 2 rows);
    these are followed from tile to tile, then tiles are walked on their own.
    """
    clustered = cluster_intervals(peaks)
    big = (
        clustered.groupBy("chrom", "cluster_start", "cluster_end").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > members).drop("n")
    )
    spots = clustered.join(big, ["chrom", "cluster_start", "cluster_end"]).groupBy("chrom", "cluster_start", "summit").agg(
        F.count(F.lit(1)).alias("copies")
    )
    spots = cut_lineage(spots)
    keys = ["chrom", "cluster_start"]
    tile = F.floor(F.col("summit") / TILE)
    tiles = spots.withColumn("tile", tile)

    def passages(frame: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(frame["summit"].to_numpy())
        follow = np.searchsorted(at, at + size, "right")
        leaves = at.copy()
        for i in range(len(at) - 1, -1, -1):
            if follow[i] < len(at):
                leaves[i] = leaves[follow[i]]
        # A centre before the tile reaches less far than one at its first summit.
        n = min(int(follow[0]), len(at) - 1) + 1
        out = frame[["chrom", "cluster_start", "tile"]].iloc[:1].merge(pd.DataFrame({"summit": at[:n], "leaves": leaves[:n]}), how="cross")
        out["last"] = at[-1]
        return out

    def follow_tiles(frame: pd.DataFrame) -> pd.DataFrame:
        centre, came = None, []
        groups = sorted(frame.groupby("tile"), key=lambda g: g[0])
        for _, rows in groups:
            came.append(centre)
            summits = np.sort(rows["summit"].to_numpy())
            reached = -1 if centre is None else np.searchsorted(summits, centre + size, "right")
            if centre is None or centre + size < rows["last"].iloc[0]:
                centre = int(rows.set_index("summit")["leaves"][summits[max(reached, 0)]])
        out = frame[["chrom", "cluster_start"]].iloc[:1].merge(pd.DataFrame({"tile": [t for t, _ in groups]}), how="cross")
        out["came"] = pd.array(came, "Int64")
        return out

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("summit")
        came = frame["came"].iloc[0]
        centre, centres = None if pd.isna(came) else int(came), []
        for s in frame["summit"]:
            if centre is None or s - centre > size:
                centre = s
            centres.append(centre)
        frame["centre"] = centres
        return frame[["chrom", "cluster_start", "summit", "copies", "centre"]]

    through = tiles.groupBy(*keys, "tile").applyInPandas(
        passages, "chrom string, cluster_start long, tile long, summit long, leaves long, last long"
    )
    # Rows here are bounded by the length of the cluster, not by the peaks in it.
    entered = through.groupBy(*keys).applyInPandas(follow_tiles, "chrom string, cluster_start long, tile long, came long")
    walked = tiles.join(entered, [*keys, "tile"]).groupBy(*keys, "tile").applyInPandas(
        walk, "chrom string, cluster_start long, summit long, copies long, centre long"
    )
    mean = F.floor(F.sum(F.col("summit") * F.col("copies")) / F.sum("copies"))
    return walked.groupBy("chrom", "cluster_start", "centre").agg(mean.alias("m"), F.sum("copies").alias("support")).select(
        "chrom", F.greatest(F.col("m") - size, F.lit(0)).alias("start"), (F.col("m") + size).alias("end"), "support"
    )


def replicate_ratio_filter(df: DataFrame, columns: Sequence[str], low: float = 0.4, high: float = 2.5) -> DataFrame:
    """Keep rows whose first replicate is within ``low``..``high`` of each other one; adds the mean."""
    ok = F.lit(True)
    for c in columns[1:]:
        ratio = F.try_divide(F.col(columns[0]), F.col(c))
        ok = ok & (ratio > low) & (ratio < high)
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return df.where(ok).withColumn("mean", total / len(columns))


def top_n_peaks(df: DataFrame, n: int, by: str) -> DataFrame:
    """The ``n`` best peaks, in coordinate order."""
    return df.orderBy(F.desc(by), *COORDS).limit(n).orderBy(*COORDS)


def recalibrate_pvalues(orig: DataFrame, remixed: DataFrame, p: str = "p_value") -> DataFrame:
    """Empirical p: share of re-mixed p-values (and one zero) at or below the original, and its BH value."""
    marks = orig.select(F.col(p), F.lit(0).cast("long").alias("w")).distinct()
    pool = remixed.select(F.col(p), F.lit(1).cast("long").alias("w")).unionByName(marks)


    sums = pool.groupBy(p).agg(F.sum("w").alias("w"))
    ran = tiled_scan(sums, [], [F.col(p)], value_bucket(F.col(p)), running={"_le": ("sum", F.col("w"))})
    total = remixed.agg((F.count(F.lit(1)) + 1).alias("_n"))
    joined = orig.join(ran.select(p, "_le"), p).crossJoin(F.broadcast(total))
    out = joined.withColumn("recal_p", (F.col("_le") + 1) / F.col("_n")).select(*orig.columns, "recal_p")
    return p_adjust(cut_lineage(out), "recal_p", "BH", name="recal_fdr")


# --- merging peak sets -----------------------------------------------------


def merge_two_sets(peaks: DataFrame, widths: Sequence[int] = WIDTHS) -> DataFrame:
    """Merge labelled peaks (``set``) that contain each other or overlap by > 0.8 of the shorter.

    In (start, end) order a peak that is still free takes the first later peak it can merge
    with.  The merged region is the shared part, labelled ``both``; a free end longer than
    half of its peak becomes a new peak of its set.  Peaks that merged with none, and
    leftovers, are reported when no merged region covers 90 % of them.

    Which peaks are still free when their turn comes is told tile by tile for every state that can
    enter (:mod:`chains`), in a fixed number of stages however long the chains of wishes are.
    """
    order = ["start", "end", "set"]
    p = cut_lineage(ranked(peaks.select(*COORDS, "set").distinct(), ["chrom"], [F.col(c) for c in order], "rank"))
    p = p.withColumn("pid", F.struct(*order))
    pairs = overlap_join(p, p).where(F.col("rank") < F.col("b_rank"))
    size_i, size_j = F.col("end") - F.col("start"), F.col("b_end") - F.col("b_start")
    contains = F.col("b_end") <= F.col("end")
    partial = ~contains & (F.col("b_start") < F.col("end")) & (
        (F.col("end") - F.col("b_start")) / F.least(size_i, size_j) > 0.8
    )
    wish = cut_lineage(
        pairs.where(contains | partial).groupBy("chrom", "pid", "rank")
        .agg(F.min(F.struct("b_rank", "b_pid")).alias("w")).select("chrom", "pid", "rank", F.col("w.b_rank").alias("wish"), F.col("w.b_pid").alias("partner"))
    )
    # A partner without a wish of its own takes nobody; it needs no place in a chain.
    wishing = wish.select("chrom", F.col("rank").alias("wish"), F.lit(True).alias("_goes_on"))
    links = wish.select("chrom", "rank", "wish").join(wishing, ["chrom", "wish"], "left")
    free = choosers(links.select("chrom", "rank", F.when(F.col("_goes_on"), F.col("wish")).alias("wish")), ["chrom"], "rank", "wish", widths)
    taken = cut_lineage(wish.join(free, ["chrom", "rank"]))
    i = lambda c: F.col(f"pid.{c}")
    j = lambda c: F.col(f"partner.{c}")
    len_i, len_j = i("end") - i("start"), j("end") - j("start")
    inside = j("end") <= i("end")
    merged = taken.select(
        "chrom", F.greatest(i("start"), j("start")).alias("start"), F.least(i("end"), j("end")).alias("end"),
        F.lit("both").alias("set"),
    )
    keep = lambda cond, s, e, name: F.when(cond & (e > s), F.struct(s.alias("start"), e.alias("end"), name.alias("set")))
    spare = taken.select(
        "chrom",
        F.explode(
            F.array(
                keep(
                    ((j("start") - i("start")) / len_i > 0.5) & (inside | (len_i >= len_j)),
                    i("start"), j("start") - 1, i("set"),
                ),
                keep(inside & ((i("end") - j("end")) / len_i > 0.5), j("end") + 1, i("end"), i("set")),
                keep(
                    ~inside & (len_i < len_j) & ((j("end") - i("end")) / len_j > 0.5), i("end") + 1, j("end"), j("set"),
                ),
            )
        ).alias("s"),
    ).where("s is not null").select("chrom", "s.start", "s.end", "s.set")
    used = taken.select("chrom", "pid").unionByName(taken.select("chrom", F.col("partner").alias("pid"))).distinct()
    alone = p.join(used, ["chrom", "pid"], "left_anti").select(*COORDS, "set")
    rest = overlap_anti(alone.unionByName(spare), merged, 0.90)
    return merged.unionByName(rest.select(*COORDS, "set")).distinct()


def merge_two_sets_extended(peaks: DataFrame) -> DataFrame:
    """Merge extended peaks across two sets, nearest partner first.

    Peaks have an extended span (``start, end``), a core (``core_start, core_end``) and a
    ``set``.  Two peaks of different sets with overlapping spans qualify by close maxima
    (``maxClose``), containment (``contain``) or 75 % overlap (``partial``); each keeps
    the qualifying partner with the nearest maximum and mutual choices merge.  Output
    is the joint span, the mean maximum and the reason; the others are unique.
    """
    middle = F.col("core_start") + F.floor((F.col("core_end") - F.col("core_start")) / 2)
    order = ["start", "end", "core_start", "core_end", "set"]
    distinct = peaks.withColumn("max", middle).select(*COORDS, "core_start", "core_end", "max", "set").distinct()
    p = cut_lineage(ranked(distinct, ["chrom"], [F.col(c) for c in order], "rank"))
    gap = F.abs(F.col("max") - F.col("b_max"))
    apart = F.least(F.abs(F.col("b_core_end") - F.col("core_end")), F.abs(F.col("b_core_start") - F.col("core_start")))
    shorter = F.least(F.col("core_end") - F.col("core_start"), F.col("b_core_end") - F.col("b_core_start"))
    span = F.least(F.col("end") - F.col("start"), F.col("b_end") - F.col("b_start"))
    first = F.col("rank") < F.col("b_rank")
    reason = (
        F.when((gap <= apart) & (apart < shorter * 0.25), "maxClose")
        .when(F.when(first, F.col("b_end") <= F.col("end")).otherwise(F.col("end") <= F.col("b_end")), "contain")
        .when(F.when(first, F.col("end") - F.col("b_start")).otherwise(F.col("b_end") - F.col("start")) / span >= 0.75, "partial")
    )
    fit = overlap_join(p, p).where(F.col("set") != F.col("b_set")).where(reason.isNotNull())
    # Gap and partner in one number, so that pairs are aggregated in place and not sorted; no gap comes first.
    unit = F.lit(10**18).cast("decimal(19,0)")
    nearest = ((F.coalesce(gap, F.lit(-1)) + 1).cast("decimal(18,0)") * unit + F.col("b_rank")).cast("decimal(38,0)")
    choice = cut_lineage(
        fit.groupBy("chrom", "rank").agg(F.min(nearest).alias("m")).select("chrom", "rank", (F.col("m") % unit).cast("long").alias("b_rank"))
    )
    back = choice.select("chrom", F.col("b_rank").alias("rank"), F.col("rank").alias("b_rank"))
    mutual = cut_lineage(choice.where(first).join(back, ["chrom", "rank", "b_rank"]))
    partner = p.select("chrom", *[F.col(c).alias(f"b_{c}") for c in p.columns if c != "chrom"])
    merged = mutual.join(p, ["chrom", "rank"]).join(partner, ["chrom", "b_rank"]).select(
        "chrom", F.least("start", "b_start").alias("start"), F.greatest("end", "b_end").alias("end"),
        F.lit("both").alias("set"), F.floor((F.col("max") + F.col("b_max")) / 2).alias("max"), reason.alias("reason"),
    )
    used = mutual.select("chrom", "rank").unionByName(mutual.select("chrom", F.col("b_rank").alias("rank")))
    alone = p.join(used, ["chrom", "rank"], "left_anti").select(*COORDS, "set", "max", F.lit("None").alias("reason"))
    return merged.unionByName(alone)


def merge_n_sets(peaks: DataFrame, overlap: float = 0.8) -> DataFrame:
    """Merge any number of peak sets (``set``, ``summit_offset``) by chains of overlapping peaks.

    Along (start, end, set) a peak continues the contig of the previous one when it ends
    inside it or shares ``overlap`` of the shorter.  A contig of one peak is ``unique``; if
    its first and last summit are close it gives one ``simple`` peak around the mean summit,
    otherwise ``complex`` peaks around its last and its first summit; members near neither are
    merged by steps of their distance from the first summit, so every member is in a peak.  Names
    are the sets joined by ``&``; no peak starts before 0.
    """
    slack = (1 - overlap) * 2
    keys, order = ["chrom"], [F.col("start"), F.col("end"), F.col("set"), F.col("summit_offset")]
    tile = F.floor(F.col("start") / TILE)
    p = peaks.select(*COORDS, "set", "summit_offset")
    prev = tiled_scan(p, keys, order, tile, preceding={"prev_start": F.col("start"), "prev_end": F.col("end")})
    size, before = F.col("end") - F.col("start"), F.col("prev_end") - F.col("prev_start")
    goes_on = (F.col("end") <= F.col("prev_end")) | (
        (F.col("start") <= F.col("prev_end"))
        & ((F.col("prev_end") - F.col("start")) / F.least(size, before) >= overlap)
    )
    marked = prev.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).drop("prev_start", "prev_end")
    contigs = cut_lineage(tiled_scan(marked, keys, order, tile, running={"contig": ("sum", F.col("_new"))}).drop("_new"))
    rank = F.struct("start", "end", "set", "summit_offset")
    summit = F.col("start") + F.col("summit_offset")
    stats = contigs.groupBy("chrom", "contig").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(F.struct("start", "end", "set", summit.alias("summit")), rank).alias("first"),
        F.max_by(F.struct("start", "end", "set", summit.alias("summit")), rank).alias("last"),
        F.avg(summit).alias("mean"), F.min(size).alias("shortest"), F.array_join(F.array_sort(F.collect_set("set")), "&").alias("name"),
    )
    reach = slack * F.least(F.col("last.end") - F.col("last.start"), F.col("first.end") - F.col("first.start"))
    kind = F.when(F.col("n") == 1, "unique").when(F.col("last.summit") - F.col("first.summit") <= reach, "simple").otherwise("complex")
    stats = stats.withColumn("kind", kind)
    wide = (1 - (overlap - 0.1)) * 2
    window = lambda m, low: [
        F.greatest((m - slack * low).cast("long"), F.lit(0)).alias("start"), (m + wide * low).cast("long").alias("end")
    ]
    unique = stats.where("kind = 'unique'").select("chrom", "first.start", "first.end", "name", "kind")
    simple = stats.where("kind = 'simple'").select("chrom", *window(F.col("mean"), F.col("shortest")), "name", "kind")
    # A complex contig is read against its last and its first summit, what is left in steps of a window's half.
    odd = stats.where("kind = 'complex'").select("chrom", "contig", "shortest", "first", "last")
    close = lambda end: F.abs(summit - F.col(f"{end}.summit")) <= slack * F.least(F.col(f"{end}.end") - F.col(f"{end}.start"), size)
    group = lambda kind, step, anchor: F.struct(F.lit(kind).alias("kind"), step.cast("long").alias("step"), anchor.cast("long").alias("anchor"))
    step = F.floor((summit - F.col("first.summit")) / F.greatest(slack * F.col("shortest"), F.lit(1)))
    ends = [F.when(close(e), group(e, F.lit(0), F.col(f"{e}.summit"))) for e in ("last", "first")]
    none = F.when(~close("last") & ~close("first"), group("between", step, F.lit(None)))
    near = contigs.join(odd, ["chrom", "contig"]).withColumn("group", F.explode(F.array_compact(F.array(*ends, none))))
    anchor = F.first("group.anchor")
    groups = near.groupBy("chrom", "contig", "group").agg(
        ((F.sum(summit) + F.coalesce(anchor, F.lit(0))) / (F.count(F.lit(1)) + F.when(anchor.isNull(), 0).otherwise(1))).alias("mean"),
        F.first("shortest").alias("shortest"), F.array_join(F.array_sort(F.collect_set("set")), "&").alias("name"),
    )
    complex_ = groups.select("chrom", *window(F.col("mean"), F.col("shortest")), "name", F.lit("complex").alias("kind"))
    return unique.unionByName(simple).unionByName(complex_)


def merge_summary(merged: DataFrame) -> DataFrame:
    """Merged peaks by kind."""
    return merged.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
