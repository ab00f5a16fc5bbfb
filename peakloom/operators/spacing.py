"""Distances and orientations between binding sites."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.tails import normal_p
from ..runtime import cut_lineage
from .normalise import p_adjust, prop_test
from .overlap import overlap_join

MAD_SCALE = 1.4826


def _near_pairs(a: DataFrame, b: DataFrame, reach: int, keys: Sequence[str]) -> DataFrame:
    """Site pairs of one sequence whose positions differ by at most ``reach``.

    Joined on sequence and position bin, so a long sequence is spread over many tasks and
    a site only meets sites near it.  The rows of ``b`` are set out in three bins, so the fewer are best ``b``.  Sites are many although their tables are small on disk, so neither
    side is sent whole through the driver.
    """
    width = max(reach, 1)
    left = a.select(
        *keys, *[F.col(c).alias(f"{c}1") for c in ("pos", "strand", "score")],
        F.floor(F.col("pos") / width).alias("_bin"),
    )
    right = b.select(
        *keys, *[F.col(c).alias(f"{c}2") for c in ("pos", "strand", "score")],
        F.explode(F.array(*[F.floor(F.col("pos") / width) + d for d in (-1, 0, 1)])).alias("_bin"),
    )
    return left.join(right.hint("merge"), [*keys, "_bin"]).drop("_bin").where(F.abs(F.col("pos2") - F.col("pos1")) <= reach)


def site_pairs(sites: DataFrame, reach: int, keys: Sequence[str] = ("seq_id",)) -> DataFrame:
    """Ordered pairs of sites of one sequence, first by position (``+`` before ``-`` at the same one)."""
    after = (F.col("pos1") < F.col("pos2")) | (
        (F.col("pos1") == F.col("pos2")) & (F.col("strand1") == "+") & (F.col("strand2") == "-")
    )
    return _near_pairs(sites, sites, reach, list(keys)).where(after)


def site_pairs_2(a: DataFrame, b: DataFrame, reach: int, keys: Sequence[str] = ("seq_id",)) -> DataFrame:
    """Pairs of a site of one model and a site of another in the same sequence."""
    return _near_pairs(a, b, reach, list(keys))


def _facing(first_right: int, first_left: int, second_left: int, second_right: int, length: int, first: int = 1, second: int = 2):
    """Edges that face the gap, by the strands of the two sites; the one that leads is ``first``."""
    plus1, plus2 = F.col(f"strand{first}") == "+", F.col(f"strand{second}") == "+"
    end1 = F.col(f"pos{first}") + length - F.when(plus1, first_right).otherwise(first_left)
    start2 = F.col(f"pos{second}") + F.when(plus2, second_left).otherwise(second_right)
    return end1, start2


def spacing_homotypic(
    sites: DataFrame, length: int, smin: int = 0, smax: int = 30, offset_left: int = 0, offset_right: int = 0,
    keys: Sequence[str] = ("seq_id",),
) -> DataFrame:
    """Direct (DR), everted (ER) and inverted (IR) repeats with the distance of the facing edges."""
    reach = smax + length + abs(offset_left) + abs(offset_right)
    pairs = site_pairs(sites, reach, keys)
    end1, start2 = _facing(offset_right, offset_left, offset_left, offset_right, length)
    conf = (
        F.when(F.col("strand1") == F.col("strand2"), "DR").when(F.col("strand1") == "-", "ER").otherwise("IR")
    )
    out = pairs.select(
        *keys, conf.alias("conf"), (start2 - end1).cast("int").alias("space"), "score1", "score2", "pos1", "pos2",
        end1.cast("int").alias("corr_pos1"), start2.cast("int").alias("corr_pos2"),
    )
    return out.where(F.col("space").between(smin, smax))


def spacing_heterotypic(
    a: DataFrame, b: DataFrame, length_a: int, length_b: int, smin: int = 0, smax: int = 30,
    offsets_a: tuple[int, int] = (0, 0), offsets_b: tuple[int, int] = (0, 0), keys: Sequence[str] = ("seq_id",),
    opposed_both_orders: bool = False,
) -> DataFrame:
    """Pairs of two models in both orders: ER and IR, and DR12 / DR21 by which motif leads.

    ``order`` tells which model's site comes first; sites are reported as (a, b) either way.
    ER and IR are taken from the a-first order only unless ``opposed_both_orders``.
    """
    (la, ra), (lb, rb) = offsets_a, offsets_b
    around = smax + sum(map(abs, (la, ra, lb, rb)))

    def one_way(first, second, length, offs, other, tag):
        """The pair with site ``first`` in front."""
        end1, start2 = _facing(offs[1], offs[0], other[0], other[1], length, first, second)
        strand = F.col(f"strand{first}")
        same = F.col("strand1") == F.col("strand2")
        lead = "DR12" if tag == "12" else "DR21"
        trail = "DR21" if tag == "12" else "DR12"
        conf = F.when(same & (strand == "+"), lead).when(same, trail).when(strand == "-", "ER").otherwise("IR")
        edges = {first: end1.cast("int"), second: start2.cast("int")}
        met = F.abs(F.col("pos2") - F.col("pos1")) <= around + length
        return F.struct(
            conf.alias("conf"), (start2 - end1).cast("int").alias("space"), F.lit(tag).alias("order"),
            edges[1].alias("corr_pos1"), edges[2].alias("corr_pos2"), met.alias("met"),
        )

    # Sites meet once, and each pair is looked at in both orders.
    pairs = site_pairs_2(a, b, around + max(length_a, length_b), keys)
    ways = F.array(one_way(1, 2, length_a, offsets_a, offsets_b, "12"), one_way(2, 1, length_b, offsets_b, offsets_a, "21"))
    out = pairs.select(*keys, *[f"{c}{i}" for c in ("score", "pos") for i in (1, 2)], F.inline(ways))
    out = out.where(F.col("met") & F.col("space").between(smin, smax))
    if not opposed_both_orders:
        out = out.where((F.col("order") == "12") | F.col("conf").isin("DR12", "DR21"))
    return out.select(
        *keys, "conf", "space", "order", "score1", "score2", "pos1", "pos2", "corr_pos1", "corr_pos2"
    )


def peaks_with_tss(peaks: DataFrame, tss: DataFrame, window: int) -> DataFrame:
    """Peaks that lie inside the +-``window`` around a start, as start pseudo-sites per peak.

    ``peaks`` has ``seq_id``; the site has length 1, score -1 and its 1-based position in the peak.
    """
    near = tss.select("chrom", (F.col("pos") - window).alias("start"), (F.col("pos") + window + 1).alias("end"), "pos", "strand")
    held = overlap_join(peaks, near, min_frac_a=1.0)
    return held.select(
        "seq_id", (F.col("b_pos") - F.col("start") + 1).cast("int").alias("pos"),
        F.col("b_strand").alias("strand"), F.lit(-1.0).alias("score"),
    )


def spacing_to_tss(
    sites: DataFrame, tss_sites: DataFrame, length: int, smin: int = 0, smax: int = 1000,
    offset_left: int = 0, offset_right: int = 0, keys: Sequence[str] = ("seq_id",),
) -> DataFrame:
    """Spacing between binding sites and transcription starts (a site of length 1)."""
    return spacing_heterotypic(
        sites, tss_sites, length, 1, smin, smax, (offset_left, offset_right), (0, 0), keys, True
    )


def _over_thresholds(pairs: DataFrame, thresholds: Sequence[float], strict: bool, single: str | None = None) -> DataFrame:
    worst = F.col(single) if single else F.least("score1", "score2")
    cuts = F.array(*[F.lit(float(t)) for t in thresholds])
    passed = F.filter(cuts, lambda t: worst > t if strict else worst >= t)
    return pairs.withColumn("threshold", F.explode(passed))


def spacing_counts(
    pairs: DataFrame, thresholds: Sequence[float], strict: bool = True, keys: Sequence[str] = (), score: str | None = None
) -> DataFrame:
    """Pairs per threshold, conformation and distance, all thresholds in one pass."""
    return _over_thresholds(pairs, thresholds, strict, score).groupBy(*keys, "threshold", "conf", "space").agg(
        F.count(F.lit(1)).alias("n")
    )


def conformation_totals(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs per threshold and conformation."""
    return counts.groupBy(*keys, "threshold", "conf").agg(F.sum("n").alias("total"))


def collapse_ar(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ignore the conformation of a symmetric motif (all repeats)."""
    return (
        counts.groupBy(*keys, "threshold", "space").agg(F.sum("n").alias("n")).withColumn("conf", F.lit("AR"))
    )


def _shares(counts: DataFrame, name: str) -> DataFrame:
    total = counts.groupBy("threshold").agg(F.sum("n").alias("_all"))
    every = counts.unionByName(collapse_ar(counts).withColumn("conf", F.lit("ALL")))
    return every.join(total, "threshold").select(
        "threshold", "conf", "space", (F.col("n") / F.col("_all")).alias(name)
    )


def relative_enrichment(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """Share of each conformation and distance among positives over the share among negatives.

    One seen in one class only stays, without an enrichment.
    """
    both = _shares(pos, "pos_share").join(_shares(neg, "neg_share"), ["threshold", "conf", "space"], "full")
    return both.withColumn("enrichment", F.try_divide(F.col("pos_share"), F.col("neg_share")))


def scannable_length(regions: DataFrame, length: int) -> Column:
    """Aggregate: places a motif of ``length`` can start in the sequences; none in a shorter one."""
    return F.sum(F.greatest(F.col("seq_len") + 1 - length, F.lit(0)))


def absolute_rate(pos: DataFrame, neg: DataFrame, pos_len: DataFrame, neg_len: DataFrame) -> DataFrame:
    """Total pairs per conformation, positives over negatives, corrected for scannable length.

    The length tables hold one row with ``length``.
    """
    p = conformation_totals(pos).withColumnRenamed("total", "_p")
    n = conformation_totals(neg).withColumnRenamed("total", "_n")
    norm = pos_len.select(F.col("length").alias("_lp")).crossJoin(F.broadcast(neg_len.select(F.col("length").alias("_ln"))))
    return (
        p.join(n, ["threshold", "conf"], "left").crossJoin(F.broadcast(norm))
        .select(
            "threshold", "conf",
            F.coalesce((F.col("_p") / F.col("_n")) / (F.col("_lp") / F.col("_ln")), F.lit(0.0)).alias("rate"),
        )
    )


def spacing_fc_z(counts: DataFrame, method: str = "median", keys: Sequence[str] = (), zeros: bool = False) -> DataFrame:
    """Fold change and Z score of every distance between the smallest and largest observed.

    The expectation is the median (Z by 1.4826 MAD), mean (sd) or uniform (binomial) of the
    counts over the observed distances of a conformation; distances without pairs get
    count 0 and are part of the expectation with ``zeros``.  A zero spread gives a null Z, a zero
    expectation a null fold change.  ``counts`` has one row per distance, so all
    tables here are as small as the distance range.
    """
    group = [*keys, "threshold"]
    counts = cut_lineage(counts)
    span = counts.groupBy(*group).agg(F.min("space").alias("lo"), F.max("space").alias("hi"))
    if zeros:
        every = counts.select(*group, "conf").distinct().join(span, group).withColumn("space", F.explode(F.sequence("lo", "hi")))
        counts = every.drop("lo", "hi").join(counts, [*group, "conf", "space"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if method == "median":
        mid = counts.groupBy(*group, "conf").agg(F.median("n").alias("u"))
        away = counts.join(mid, [*group, "conf"]).groupBy(*group, "conf").agg(
            F.first("u").alias("u"), (F.median(F.abs(F.col("n") - F.col("u"))) * MAD_SCALE).alias("sigma")
        )
    elif method == "mean":
        away = counts.groupBy(*group, "conf").agg(F.avg("n").cast("double").alias("u"), F.stddev_samp("n").alias("sigma"))
    elif method == "uniform":
        total = counts.groupBy(*group, "conf").agg(F.sum("n").alias("_pop")).join(span, group)
        share = 1 / (F.col("hi") - F.col("lo") + 1)
        away = total.select(
            *group, "conf", (F.col("_pop") * share).alias("u"), F.sqrt(F.col("_pop") * share * (1 - share)).alias("sigma")
        )
    else:
        raise ValueError("method must be 'median', 'mean' or 'uniform'")
    grid = away.join(span, group).withColumn("space", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi")
    seen = grid.join(counts, [*group, "conf", "space"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return seen.select(
        *group, "conf", "space", "n", F.try_divide("n", "u").alias("fc"),
        F.when(F.col("sigma") > 0, (F.col("n") - F.col("u")) / F.col("sigma")).alias("z"),
    )


def spacing_pvalues(stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Two-sided normal p-value, Bonferroni-adjusted over conformation and distance per threshold."""
    p = F.when(F.col("z").isNotNull(), normal_p(F.coalesce("z", F.lit(0.0))))
    return p_adjust(stats.withColumn("p_value", p), "p_value", "bonferroni", [*keys, "threshold"])


def significant_spacings(stats: DataFrame, min_log2fc: float = 0.6, alpha: float = 0.05) -> DataFrame:
    """Distances seen clearly more often than expected."""
    return stats.where((F.col("n") > 0) & (F.log2("fc") > min_log2fc) & (F.col("p_adj") < alpha))


def spacing_candidates(significant: DataFrame, min_thresholds: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """Conformation and distance pairs significant at several thresholds."""
    return (
        significant.groupBy(*keys, "conf", "space").agg(F.count_distinct("threshold").alias("n_thresholds"))
        .where(F.col("n_thresholds") >= min_thresholds)
    )


def sliding_orientation_counts(pairs: DataFrame, width: int = 10, reach: int = 1000) -> DataFrame:
    """Pairs with a distance in ``[d, d+width-1]`` for each d in 0..reach, by orientation.

    ``after`` counts DR21 and IR, ``before`` DR12 and ER.
    """
    spread = pairs.where((F.col("space") >= 0) & (F.col("space") <= reach + width - 1)).groupBy("conf", "space").agg(
        F.count(F.lit(1)).alias("n")
    )
    covered = spread.withColumn(
        "d", F.explode(F.sequence(F.greatest(F.col("space") - width + 1, F.lit(0)), F.least(F.col("space"), F.lit(reach))))
    )
    of = lambda c: F.coalesce(F.sum(F.when(F.col("conf") == c, F.col("n"))), F.lit(0)).alias(c.lower())
    sums = covered.groupBy("d").agg(*[of(c) for c in ("DR12", "ER", "DR21", "IR")])
    grid = pairs.sparkSession.range(reach + 1).select(F.col("id").cast("int").alias("d"))
    # One row per distance: written, since both sides and the tests read it again.
    wide = cut_lineage(grid.join(sums, "d", "left").na.fill(0))
    side = lambda name, a, b: wide.select(
        F.lit(name).alias("side"), F.col("d").alias("start"), (F.col("d") + width - 1).alias("end"),
        F.col(a).alias("same"), F.col(b).alias("opposite"),
    )
    return side("before", "dr12", "er").unionByName(side("after", "dr21", "ir"))


def orientation_tests(windows: DataFrame) -> DataFrame:
    """Same against opposite orientation in every window, BH-adjusted per side."""
    some = windows.where(F.col("same") + F.col("opposite") > 0).withColumn("n", F.col("same") + F.col("opposite"))
    return p_adjust(prop_test(some, "same", "opposite", "n"), "p_value", "BH", ["side"])


def orientation_global(candidates: DataFrame, column: str, first, second) -> DataFrame:
    """Share of candidates in two groups tested against each other."""
    counts = candidates.agg(
        F.count_if(F.col(column) == first).alias("x1"), F.count_if(F.col(column) == second).alias("x2"),
        F.count(F.lit(1)).alias("n"),
    )
    return prop_test(counts, "x1", "x2", "n")


def tss_candidate_table(stats: DataFrame, candidates: DataFrame, symmetric: bool = False) -> DataFrame:
    """Mean Z of each candidate over the thresholds (kept if positive), with a signed distance."""
    picked = stats.join(candidates.select("conf", "space"), ["conf", "space"])
    mean = picked.groupBy("conf", "space").agg(F.avg("z").alias("mean_z")).where("mean_z > 0")
    before = F.col("conf").isin("DR12", "ER")
    out = mean.select(
        F.when(before, -F.col("space")).otherwise(F.col("space")).alias("distance"), "conf",
        F.col("conf").isin("DR12", "DR21").alias("same_orientation"),
        F.when(before, "before").otherwise("after").alias("position"), "mean_z",
    )
    if symmetric:
        out = out.groupBy("distance", "position").agg(F.max("mean_z").alias("mean_z")).withColumn("conf", F.lit("AR"))
    return out


def pairs_to_regions(pairs: DataFrame, regions: DataFrame, length_1: int, length_2: int | None = None) -> DataFrame:
    """Genome span of each pair as a BED6 row whose score is the sum of both."""
    size2 = length_1 if length_2 is None else length_2
    span = pairs.join(regions.select("seq_id", "chrom", F.col("start").alias("_s")), "seq_id")
    low = F.least("pos1", "pos2")
    high = F.greatest(F.col("pos1") + length_1, F.col("pos2") + size2)
    return span.select(
        "chrom", (F.col("_s") + low - 1).alias("start"), (F.col("_s") + high - 1).alias("end"),
        F.concat_ws("_", "conf", F.col("space").cast("string")).alias("name"),
        (F.col("score1") + F.col("score2")).alias("score"),
        F.when(F.col("conf").isin("DR21"), "-").otherwise("+").alias("strand"),
    )


def sites_per_model(sites: DataFrame, threshold: float, model: str = "motif_id") -> DataFrame:
    """Sites above the threshold for each model."""
    return sites.where(F.col("score") > threshold).groupBy(model).agg(F.count(F.lit(1)).alias("n_sites"))


def cooccurrence_rules(sites: DataFrame, model: str = "motif_id", window: str = "seq_id") -> DataFrame:
    """Market basket over model pairs present in the same window.

    Counts once per window; support, confidence, lift and cosine, and a z-score against
    independent placement of the two models.
    """
    seen = sites.select(window, model).distinct()
    single = seen.groupBy(model).agg(F.count(F.lit(1)).alias("n"))
    windows = seen.select(window).distinct().agg(F.count(F.lit(1)).alias("windows"))
    # A window holds each model once, so its item list is as short as the model list.
    baskets = seen.groupBy(window).agg(F.array_sort(F.collect_list(model)).alias("items"))
    pairs = (
        baskets.select(F.posexplode("items").alias("i", "tf1"), "items")
        .select("tf1", F.explode(F.slice("items", F.col("i") + 2, F.size("items"))).alias("tf2"))
        .groupBy("tf1", "tf2").agg(F.count(F.lit(1)).alias("pair_count"))
    )
    both = (
        pairs.join(single.withColumnsRenamed({model: "tf1", "n": "tf1_count"}), "tf1")
        .join(single.withColumnsRenamed({model: "tf2", "n": "tf2_count"}), "tf2")
        .crossJoin(F.broadcast(windows))
    )
    n, a, b, w = (F.col(c).cast("double") for c in ("pair_count", "tf1_count", "tf2_count", "windows"))
    expected = a * b / w
    spread = F.sqrt(expected * (1 - a / w) * (1 - b / w) * w / F.greatest(w - 1, F.lit(1.0)))
    return both.select(
        "tf1", "tf2", "pair_count", "tf1_count", "tf2_count", (n / w).alias("support"),
        (n / a).alias("confidence"), (n * w / (a * b)).alias("lift"), (n / F.sqrt(a * b)).alias("cosine"),
        F.when(spread > 0, (n - expected) / spread).alias("zscore"),
    )


def significant_rules(rules: DataFrame, by: Sequence[str] = ("zscore", "cosine"), share: float = 0.05) -> DataFrame:
    """Rules in the top ``share`` by every one of the measures; a rule without a measure is not among them.

    There are at most as many rules as pairs of models, so the quantiles are exact.
    """
    cuts = rules.agg(*[F.percentile(F.round(c, 9), 1 - share).alias(f"_{c}") for c in by])
    kept = rules.crossJoin(F.broadcast(cuts))
    for c in by:
        kept = kept.where(F.round(c, 9) >= F.col(f"_{c}"))
    return kept.select(*rules.columns)


#: Positions of a tile in which gaps are counted.
GAP_TILE = 1 << 16
#: Pairs of places that are set out at a time; more than ``GAP_DENSE`` for two models cost more than products of their counts.
GAP_PAIRS = 1 << 21
GAP_DENSE = 1 << 15


def _products(first: np.ndarray, second: np.ndarray, reach: int) -> np.ndarray:
    """For each gap up to ``reach`` the sum of ``first[p] * second[p + gap]``, exact; ``second`` is longer by more than ``reach``."""
    tops = int(first.max(initial=0)), int(second.max(initial=0))
    if min(tops) == 0:
        return np.zeros(reach + 1, np.int64)
    # Errors of the transforms stay far below one half for sums below 2**36; larger counts go in parts.
    if tops[0] * tops[1] * len(first) >= 1 << 36:
        if tops[0] >= tops[1]:
            return (_products(first >> 4, second, reach) << 4) + _products(first & 15, second, reach)
        return (_products(first, second >> 4, reach) << 4) + _products(first, second & 15, reach)
    # What comes round again lies before the gaps.
    size = 1 << (len(second) - 1).bit_length()
    both = np.fft.rfft(first[::-1], size) * np.fft.rfft(second, size)
    return np.rint(np.fft.irfft(both, size)[len(first) - 1:len(first) + reach]).astype(np.int64)


def _gaps(ends: tuple[np.ndarray, ...], begins: tuple[np.ndarray, ...], reach: int) -> list[tuple[np.ndarray, ...]]:
    """Rows ``(model, other, gap, n)`` of ends of a model and beginnings of another up to ``reach`` behind them.

    Both sides are ``(model, place, copies)`` of one tile in order of place; places of ends are below ``GAP_TILE``, of beginnings
    below that and ``reach``.  Few pairs are set out, many are counted by products of the models' counts by place.
    """
    (x, place, copies), (y, other, times) = ends, begins
    low, high = np.searchsorted(other, place, "left"), np.searchsorted(other, place + reach, "right")
    upto = np.append(0, np.cumsum(high - low))
    left, right = np.unique(x), np.unique(y)
    out = []
    if upto[-1] <= GAP_DENSE * len(left) * len(right):
        share = upto[1:] // GAP_PAIRS
        cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(x)]
        for a, b in zip(cuts, cuts[1:]):
            n = (high - low)[a:b]
            at = np.repeat(low[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            mine = np.repeat(np.arange(a, b), n)
            differ = x[mine] != y[at]
            at, mine = at[differ], mine[differ]
            models = max(int(left.max(initial=0)), int(right.max(initial=0))) + 1
            key, where = np.unique((x[mine] * models + y[at]) * (reach + 1) + other[at] - place[mine], return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, where, copies[mine] * times[at])
            out.append((key // (reach + 1) // models, key // (reach + 1) % models, key % (reach + 1), total))
        return out
    laid = lambda side, width: {int(m): np.bincount(side[1][side[0] == m], side[2][side[0] == m], width).astype(np.int64) for m in np.unique(side[0])}
    firsts, seconds = laid(ends, GAP_TILE), laid(begins, GAP_TILE + reach + 1)
    for i, first in firsts.items():
        for j, second in seconds.items():
            if i != j:
                total = _products(first, second, reach)
                gap = np.flatnonzero(total)
                out.append((np.full(len(gap), i), np.full(len(gap), j), gap, total[gap]))
    return out


def cooccurrence_distances(
    sites: DataFrame, lowest: int = 0, highest: int = 100, keys: Sequence[str] = ("seq_id",), model: str = "motif_id"
) -> DataFrame:
    """Sites of two models by the bases between them (negative where they overlap): ``tf1, tf2, distance, n``.

    Sites have ``pos`` and ``stop``, half open.  Equal sites are counted before they meet.  Sites that do not overlap
    have the distance from the end of one to the beginning of the other, so ends and beginnings are counted by
    position, and gaps by products of these counts in tiles; sites are only paired where they overlap.
    """
    keys = list(keys)
    stacked = sites.dropna(subset=[*keys, model, "pos"]).groupBy(*keys, model, "pos", "stop").agg(F.count(F.lit(1)).alias("copies"))
    # Written, as the sites are read again and curves too; what goes into Python are rows of numbers.
    stacked = cut_lineage(stacked)
    proper = F.coalesce(F.col("pos") < F.col("stop"), F.lit(False))
    parts = []
    if highest >= 0:
        parts.append(_apart(stacked.where(proper), highest, keys, model).where(F.col("distance") >= lowest))
    # Overlapping sites, and those without bases, which may end on both sides of another.
    if lowest < 0 or highest < 0 or not stacked.where(~proper).isEmpty():
        near = _paired(stacked, lowest, highest, keys, model)
        parts.append(near.where("_odd OR distance < 0").drop("_odd"))
    curve = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    kind = stacked.select((F.col("pos") - F.col("stop")).alias("d")).schema["d"].dataType
    return cut_lineage(curve.groupBy("tf1", "tf2", F.col("distance").cast(kind).alias("distance")).agg(F.sum("n").alias("n")), slim=True)


def _paired(stacked: DataFrame, lowest: int, highest: int, keys: Sequence[str], model: str) -> DataFrame:
    """Rows of pairs by distance, met one by one in position bins; ``_odd`` tells where one has no bases."""
    width = F.max(F.col("stop") - F.col("pos"))
    longest = F.broadcast(stacked.agg((F.greatest(F.coalesce(width, F.lit(1)), F.lit(1)) + F.lit(max(highest, 0))).alias("_w")))
    side = lambda i: [F.col(a).alias(f"{b}{i}") for a, b in ((model, "tf"), ("pos", "pos"), ("stop", "stop"), ("copies", "copies"))]
    tagged = stacked.crossJoin(longest).withColumn("_bin", F.floor(F.col("pos") / F.col("_w")))
    left = tagged.select(*keys, "_bin", *side(1))
    right = tagged.select(*keys, F.explode(F.array(*[F.col("_bin") + d for d in (-1, 0, 1)])).alias("_bin"), *side(2))
    gap = F.greatest("pos1", "pos2") - F.least("stop1", "stop2")
    pairs = left.join(right.hint("merge"), [*keys, "_bin"]).where("tf1 < tf2").withColumn("distance", gap)
    odd = ~F.coalesce((F.col("pos1") < F.col("stop1")) & (F.col("pos2") < F.col("stop2")), F.lit(False))
    return pairs.where(F.col("distance").between(lowest, highest)).groupBy("tf1", "tf2", "distance", odd.alias("_odd")).agg(
        F.sum(F.col("copies1") * F.col("copies2")).alias("n")
    )


def _apart(stacked: DataFrame, highest: int, keys: Sequence[str], model: str) -> DataFrame:
    """Rows of ``tf1, tf2, distance, n`` of sites with bases that do not overlap, up to ``highest`` bases apart."""
    kind = stacked.schema[model].dataType.simpleString()
    tile = lambda place: F.floor(place / GAP_TILE)
    # An end meets what begins in its tile and up to ``highest`` behind it.
    homes = F.sequence(tile(F.col("pos") - highest), tile(F.col("pos")))
    points = stacked.select(*keys, F.col(model).alias("_m"), "copies", F.explode(F.array(
        F.struct(F.lit(False).alias("begins"), F.col("stop").cast("long").alias("at"), F.array(tile(F.col("stop"))).alias("tiles")),
        F.struct(F.lit(True).alias("begins"), F.col("pos").cast("long").alias("at"), homes.alias("tiles")),
    )).alias("e")).select(*keys, "_m", "copies", "e.begins", "e.at", F.explode("e.tiles").alias("_tile"))
    counted = points.groupBy(*keys, "_tile", "_m", "begins", "at").agg(F.sum("copies").alias("copies"))
    slim = counted.select(*keys, "_tile", "_m", "begins", (F.col("at") - F.col("_tile") * GAP_TILE).cast("long").alias("off"), "copies")
    group = [*keys, "_tile"]
    dealt = slim.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group)
    form = to_arrow_type(stacked.schema[model].dataType)

    def counts(tables: list[pa.Table]) -> list[pa.RecordBatch]:
        table = pa.concat_tables(tables)
        models = table.column("_m").combine_chunks().dictionary_encode()
        code, off, copies = models.indices.to_numpy().astype(np.int64), table.column("off").to_numpy(), table.column("copies").to_numpy()
        begins, order = table.column("begins").to_numpy(), np.argsort(off, kind="stable")
        sides = [tuple(c[order[begins[order] == b]] for c in (code, off, copies)) for b in (False, True)]
        names = models.dictionary.cast(form)
        return [
            pa.RecordBatch.from_arrays([names.take(pa.array(x)), names.take(pa.array(y)), pa.array(gap), pa.array(n)], ["tf1", "tf2", "distance", "n"])
            for x, y, gap, n in _gaps(*sides, highest) if len(gap)
        ]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.table(batch)
            change = np.zeros(len(table) - 1, bool)
            for c in group:
                number = batch.column(c).dictionary_encode().indices.to_numpy()
                change |= number[1:] != number[:-1]
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(table)]
            for a, b in zip(edges, edges[1:]):
                here = tuple(batch.column(c)[a].as_py() for c in group)
                if here != key and kept:
                    yield from counts(kept)
                    kept = []
                key = here
                kept.append(table.slice(a, b - a))
        if kept:
            yield from counts(kept)

    # The pair is in the order of the names, whichever comes first.
    found = dealt.mapInArrow(meet, f"tf1 {kind}, tf2 {kind}, distance long, n long")
    return found.select(F.least("tf1", "tf2").alias("tf1"), F.greatest("tf1", "tf2").alias("tf2"), "distance", "n")


def preferred_spacing_flag(
    peaks: DataFrame, pairs: DataFrame, spacings: Sequence[tuple[str, int]], thresholds: Sequence[float], id_col: str = "seq_id"
) -> DataFrame:
    """Per threshold, 1 for peaks holding a listed conformation and distance with both scores at or above it."""
    wanted = F.concat_ws("_", "conf", F.col("space").cast("string")).isin(*[f"{c}_{s}" for c, s in spacings])
    hits = _over_thresholds(pairs.where(wanted), thresholds, False).select(id_col, "threshold").distinct()
    grid = peaks.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    return grid.join(hits.withColumn("_h", F.lit(1)), [id_col, "threshold"], "left").select(
        *peaks.columns, "threshold", F.coalesce("_h", F.lit(0)).alias("flag")
    )


def decile_spacing_matrix(
    pairs: DataFrame, deciles: DataFrame, thresholds: Sequence[float], symmetric: bool = False, id_col: str = "seq_id"
) -> DataFrame:
    """Z score by decile, conformation and distance, all deciles in one job."""
    tagged = pairs.join(deciles.select(id_col, "decile"), id_col)
    counts = spacing_counts(tagged, thresholds, keys=["decile"])
    if symmetric:
        counts = collapse_ar(counts, ["decile"])
    return spacing_fc_z(counts, keys=["decile"])
