"""Sweep-line operators on interval sets: merge, complement, depth, tracks, tiling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..runtime import cut_lineage
from .overlap import COORDS, TILE, overlap_join
from .scans import draw, quantiles_of_counts, ranked, tiled_scan, value_bucket

#: Rows handled in one task where rows are dealt by count.
PART = 1 << 17


def _depth(df: DataFrame, keys: Sequence[str], weight: Column, slop: int = 0) -> DataFrame:
    """Change points of the depth: one row per position where it changes."""
    edges = df.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("start").alias("pos"), weight.alias("step")),
                F.struct((F.col("end") + slop).alias("pos"), (-weight).alias("step")),
            )
        ).alias("e"),
    ).select(*keys, "e.pos", "e.step")
    steps = edges.groupBy(*keys, "pos").agg(F.sum("step").alias("step")).where("step != 0")
    return tiled_scan(
        steps, keys, [F.col("pos")], F.floor(F.col("pos") / TILE),
        running={"depth": ("sum", F.col("step"))}, following={"next_pos": F.col("pos")},
    )


def _islands(df: DataFrame, keys: Sequence[str], slop: int = 0) -> DataFrame:
    """Maximal stretches covered by at least one interval, bookended ones joined."""
    borders = _depth(df, keys, F.lit(1).cast("long"), slop).where(
        (F.col("depth") == 0) | (F.col("depth") == F.col("step"))
    )
    # Two rows per island, few beside the intervals, are written before they are paired up.
    paired = tiled_scan(
        cut_lineage(borders.select(*keys, "pos", "depth")), keys, [F.col("pos")], F.floor(F.col("pos") / TILE),
        following={"stop": F.col("pos")},
    )
    return paired.where("depth > 0").select(
        *keys, F.col("pos").alias("start"), (F.col("stop") - slop).alias("end")
    )


def merge_intervals(
    df: DataFrame, aggs: Mapping[str, Column] | None = None, distance: int = 0,
    keys: Sequence[str] = ("chrom",),
) -> DataFrame:
    """Union of overlapping or touching intervals (gaps up to ``distance`` are bridged).

    ``aggs`` are aggregate columns over the members; ``size`` counts them.
    """
    keys = list(keys)
    if not aggs:
        return _islands(df, keys, distance)
    return (
        cluster_intervals(df, distance, keys)
        .groupBy(*keys, "cluster_start", "cluster_end")
        .agg(*[c.alias(n) for n, c in aggs.items()])
        .withColumnsRenamed({"cluster_start": "start", "cluster_end": "end"})
    )


def cluster_intervals(df: DataFrame, distance: int = 0, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Add the island each interval belongs to as ``cluster_start`` and ``cluster_end``."""
    keys = list(keys)
    islands = _islands(df, keys, distance)
    spots = df.select(*keys, F.col("start").alias("pos")).distinct()
    marks = spots.unionByName(
        islands.select(*keys, F.col("start").alias("pos"), F.struct("start", "end").alias("isle")),
        allowMissingColumns=True,
    )
    marks = marks.groupBy(*keys, "pos").agg(F.max("isle").alias("isle"))
    located = tiled_scan(
        marks, keys, [F.col("pos")], F.floor(F.col("pos") / TILE), filled={"home": F.col("isle")}
    ).select(
        *keys, F.col("pos").alias("start"),
        F.col("home.start").alias("cluster_start"), F.col("home.end").alias("cluster_end"),
    )
    return df.join(located, [*keys, "start"]).select(*df.columns, "cluster_start", "cluster_end")


def pileup(
    reads: DataFrame, sizes: DataFrame | None = None, scale: float | Column = 1.0,
    keep_zero: bool = False, keys: Sequence[str] = ("chrom",),
) -> DataFrame:
    """Piecewise-constant depth as ``(keys, start, end, value)``.

    With ``keep_zero`` the uncovered parts of every chromosome in ``sizes`` are
    reported too, as depth 0.
    """
    keys = list(keys)
    depth = _depth(reads, keys, F.lit(1).cast("long"))
    rate = scale if isinstance(scale, Column) else F.lit(float(scale))
    covered = depth.where("depth > 0").select(
        *keys, F.col("pos").alias("start"), F.col("next_pos").alias("end"),
        (F.col("depth") * rate).alias("value"),
    )
    if not keep_zero:
        return covered
    if sizes is None:
        raise ValueError("keep_zero needs the chromosome sizes")
    gaps = complement(reads, sizes, keys)
    return covered.unionByName(gaps.withColumn("value", F.lit(0.0)))


def complement(df: DataFrame, sizes: DataFrame, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Parts of each chromosome that no interval covers, both ends included.

    ``sizes`` has one row per key with ``length``.
    """
    keys = list(keys)
    fences = sizes.select(*keys, F.explode(F.array(F.lit(-1).cast("long"), F.col("length"))).alias("start"))
    fences = fences.withColumn("end", F.col("start") + 1)
    isles = _islands(df.select(*keys, "start", "end").unionByName(fences.select(*keys, "start", "end")), keys)
    gaps = tiled_scan(
        isles, keys, [F.col("start")], F.floor(F.col("start") / TILE), following={"next": F.col("start")}
    )
    return (
        gaps.join(sizes.select(*keys, "length"), keys)
        .select(*keys, F.col("end").alias("start"), F.least("next", "length").alias("end"))
        .where("start < end")
    )


def combine_tracks(tracks: DataFrame, names: Sequence[str], op: str = "mean", by: str = "track") -> DataFrame:
    """Mean or max of several tracks over their common breakpoints (missing is 0).

    ``tracks`` is long, with the track name in ``by``.
    """
    edges = tracks.select(
        "chrom", by,
        F.explode(
            F.array(
                F.struct(F.col("start").alias("pos"), F.col("value").alias("v")),
                F.struct(F.col("end").alias("pos"), F.lit(None).cast("double").alias("v")),
            )
        ).alias("e"),
    ).select("chrom", by, "e.pos", "e.v")
    points = edges.groupBy("chrom", "pos").agg(
        *[
            F.max(F.when(F.col(by) == n, F.coalesce("v", F.lit(float("-inf"))))).alias(f"_e{i}")
            for i, n in enumerate(names)
        ]
    )
    # A track that ends here and does not start again drops to 0.
    points = points.select(
        "chrom", "pos",
        *[
            F.when(F.col(f"_e{i}") == float("-inf"), F.lit(0.0)).otherwise(F.col(f"_e{i}")).alias(f"_v{i}")
            for i in range(len(names))
        ],
    )
    level = tiled_scan(
        points, ["chrom"], [F.col("pos")], F.floor(F.col("pos") / TILE),
        following={"end": F.col("pos")},
        filled={f"_h{i}": F.col(f"_v{i}") for i in range(len(names))},
    ).where("end is not null")
    held = [F.coalesce(F.col(f"_h{i}"), F.lit(0.0)) for i in range(len(names))]
    if op == "mean":
        value = sum(held[1:], held[0]) / len(held)
    elif op == "max":
        value = F.greatest(*held) if len(held) > 1 else held[0]
    else:
        raise ValueError("op must be 'mean' or 'max'")
    return level.select("chrom", F.col("pos").alias("start"), "end", value.alias("value"))


def scale_track(track: DataFrame, factor: float | Column) -> DataFrame:
    """Multiply every value of a track."""
    rate = factor if isinstance(factor, Column) else F.lit(float(factor))
    return track.withColumn("value", F.col("value") * rate)


def track_noise(track: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Length-weighted mean of a track."""
    size = F.col("end") - F.col("start")
    return track.groupBy(*keys).agg((F.sum(F.col("value") * size) / F.sum(size)).alias("noise"))


def make_bins(sizes: DataFrame, length: int) -> DataFrame:
    """Tile each chromosome into windows of ``length`` bp; the last one may be shorter."""
    return (
        sizes.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(length).cast("long"))))
        .select("chrom", "start", F.least(F.col("start") + length, F.col("length")).alias("end"))
    )


def random_windows(draws: DataFrame, sizes: DataFrame, length: int, seed: int, merge: bool = True) -> DataFrame:
    """One window per row of ``draws`` (column ``id``), uniform over the genome, then merged.

    ``sizes`` is one row per chromosome; the windows depend only on ``id`` and seed.
    """
    room = sizes.select("chrom", F.greatest(F.col("length") - length + 1, F.lit(0)).alias("room")).where("room > 0")
    numbered = ranked(room, [], [F.col("chrom")], "_k")
    laid = tiled_scan(numbered, [], [F.col("_k")], F.floor(F.col("_k") / PART), running={"upto": ("sum", F.col("room"))})
    total = room.agg(F.sum("room").alias("_total"))
    spots = (
        draws.select("id").crossJoin(F.broadcast(total))
        .select("id", F.pmod(draw(seed, F.col("id")), F.col("_total")).alias("spot"))
    )
    # Each draw is a point on the chromosomes laid end to end; the contig list may be long,
    # so it is met by bins and not broadcast.
    axis = F.lit("genome").alias("chrom")
    lanes = laid.select(
        axis, (F.col("upto") - F.col("room")).alias("start"), F.col("upto").alias("end"), F.col("chrom").alias("lane")
    )
    points = spots.select(axis, F.col("spot").alias("start"), (F.col("spot") + 1).alias("end"))
    placed = overlap_join(points, lanes, bin_width=1 << 20).select(
        F.col("b_lane").alias("chrom"), (F.col("start") - F.col("b_start")).alias("start")
    )
    windows = placed.withColumn("end", F.col("start") + length)
    return merge_intervals(windows) if merge else windows


def shuffle_intervals(
    df: DataFrame, sizes: DataFrame, seed: int, within: DataFrame | None = None, id_col: str = "id"
) -> DataFrame:
    """Move every interval to a random place on its chromosome, keeping its length.

    With ``within`` the place is inside one of those (disjoint) regions, each place of each region that is
    long enough being as likely.  Places are numbered along the regions from the longest on (then by start),
    so running totals by length tell their number for every interval length and a search among the lengths
    finds the region of a place: no interval length meets the regions one by one.  Intervals that fit nowhere
    or whose chromosome has no size or region stay, without a place (null ``start`` and ``end``).
    """
    size = (F.col("end") - F.col("start")).alias("_len")
    if within is None:
        moved = df.join(sizes.select("chrom", F.col("length").alias("_size")), "chrom", "left").withColumn("_len", size)
        places = F.when(F.col("_size") >= F.col("_len"), F.col("_size") - F.col("_len") + 1)
        moved = moved.withColumn("_at", F.pmod(draw(seed, F.col(id_col)), places))
        return moved.withColumn("start", F.col("_at")).withColumn("end", F.col("_at") + F.col("_len")).select(*df.columns)
    regions = within.select("chrom", F.col("start").alias("_rs"), (F.col("end") - F.col("start")).alias("_r"))
    sized = df.withColumn("_len", size)
    classes, reach = _room_by_length(regions, sized.select("chrom", "_len").distinct())
    aimed = cut_lineage(
        sized.join(reach, ["chrom", "_len"], "left").withColumn("_spot", F.pmod(draw(seed, F.col(id_col)), F.when(F.col("_total") > 0, F.col("_total"))))
    )
    spots = aimed.where("_spot is not null").select("chrom", "_len", "_spot").distinct()
    found = _find_places(spots, classes)
    numbered = ranked(regions, ["chrom", "_r"], [F.col("_rs")], "_k")
    put = found.join(numbered, ["chrom", "_r", "_k"]).select("chrom", "_len", "_spot", (F.col("_rs") + F.col("_at")).alias("_new"))
    placed = aimed.join(put, ["chrom", "_len", "_spot"], "left")
    return placed.withColumn("start", F.col("_new")).withColumn("end", F.col("_new") + F.col("_len")).select(*df.columns)


def _room_by_length(regions: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal regions with running totals from the longest on, and the places for each length.

    Regions of length r hold an interval of length l in r - l + 1 places, so all that are long enough hold
    it in (sum of their lengths) - (their number) * (l - 1): two running totals over the regions by length
    answer every l.  Disjoint regions on G bases have at most sqrt(2 G) lengths.
    """
    classes = regions.groupBy("chrom", F.col("_r").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    marks = classes.select("chrom", "_v", "_n", F.lit(1).alias("_class")).unionByName(
        lengths.select("chrom", F.col("_len").alias("_v"), F.lit(0).cast("long").alias("_n"), F.lit(0).alias("_class"))
    )
    ran = cut_lineage(tiled_scan(
        marks, ["chrom"], [-F.col("_v"), -F.col("_class")], value_bucket(-F.col("_v")),
        running={"_count": ("sum", F.col("_n")), "_sum": ("sum", F.col("_n") * F.col("_v"))},
    ))
    reach = ran.where("_class = 0").select("chrom", F.col("_v").alias("_len"), (F.col("_sum") - F.col("_count") * (F.col("_v") - 1)).alias("_total"))
    return ran.where("_class = 1").select("chrom", F.col("_v").alias("_r"), "_count", "_sum"), reach


def _search(length: np.ndarray, spot: np.ndarray, r: np.ndarray, count: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, place in it and number of the region (from 1) of each spot; classes go from long to short.

    The room up to a class grows along the classes that are long enough, so it is found by halving.
    """
    low, high = np.zeros(len(spot), np.int64), np.searchsorted(-r, -length, "right") - 1
    while (low < high).any():
        middle = (low + high) // 2
        below = total[middle] - count[middle] * (length - 1) <= spot
        low, high = np.where(below, middle + 1, low), np.where(below, high, middle)
    before = np.where(low > 0, total[low - 1] - count[low - 1] * (length - 1), 0)
    room = r[low] - length + 1
    return low, (spot - before) % room, (spot - before) // room + 1


def _find_places(spots: DataFrame, classes: DataFrame) -> DataFrame:
    """``_r, _k, _at`` (region length, number among the regions of that length, place) of spots.

    A chromosome's spots are dealt to parts of ``PART`` rows, each of which gets its classes.
    """
    parts = spots.groupBy("chrom").agg(F.ceil(F.count(F.lit(1)) / PART).alias("_parts"))
    left = spots.join(parts, "chrom").withColumn("_part", F.pmod(F.xxhash64("_len", "_spot"), F.col("_parts"))).drop("_parts")
    right = classes.join(parts, "chrom").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")

    def find(some: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(table):
            return pd.DataFrame({c: [] for c in ("chrom", "_len", "_spot", "_r", "_k", "_at")})
        table = table.sort_values("_r", ascending=False)
        r, count, total = (table[c].to_numpy(np.int64) for c in ("_r", "_count", "_sum"))
        at, place, number = _search(some["_len"].to_numpy(np.int64), some["_spot"].to_numpy(np.int64), r, count, total)
        return pd.DataFrame({"chrom": some["chrom"].to_numpy(), "_len": some["_len"].to_numpy(), "_spot": some["_spot"].to_numpy(), "_r": r[at], "_k": number, "_at": place})

    keys = ["chrom", "_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(find, "chrom string, _len long, _spot long, _r long, _k long, _at long")


def _offset_spans(anchors: DataFrame, signal: DataFrame, up: int, down: int, keep: Sequence[str], more: Sequence[str] = ()) -> DataFrame:
    """First and last offset of every segment near an anchor, strand-aware when ``strand`` is present.

    ``keep`` are columns of the anchors, ``more`` of the signal.
    """
    strand = F.col("strand") if "strand" in anchors.columns else F.lit("+")
    before = F.when(strand == "-", down - 1).otherwise(up)
    after = F.when(strand == "-", up + 1).otherwise(down)
    windows = anchors.select(
        "chrom", (F.col("pos") - before).alias("start"), (F.col("pos") + after).alias("end"),
        "pos", strand.alias("strand"), *keep,
    )
    pairs = overlap_join(windows, signal.select(*COORDS, "value", *more))
    low, high = F.greatest("start", "b_start") - F.col("pos"), F.least("end", "b_end") - 1 - F.col("pos")
    back = F.col("strand") == "-"
    return pairs.select(
        *keep, *[F.col(f"b_{c}").alias(c) for c in more],
        F.when(back, -high).otherwise(low).alias("first"), F.when(back, -low).otherwise(high).alias("last"), F.col("b_value").alias("value"),
    )


def meta_profile(
    anchors: DataFrame, signal: DataFrame, up: int, down: int, keys: Sequence[str] = (), expanded: bool = False
) -> DataFrame:
    """Signal around anchors (``chrom, pos[, strand]``) by offset in ``[-up, down)``.

    Mean over the covering segments, and with ``expanded`` also median, sd and n.  Segments are not laid out
    base by base: the mean is made of running totals over two events a segment, at most ``up + down + 1``
    offsets a key.  The median needs the values at an offset; equal values over equal offsets collapse before
    they are.  Null values count in n alone; a value that is not finite makes the mean of its offsets NaN.
    """
    keys = list(keys)
    spans = _offset_spans(anchors, signal, up, down, keys)
    if expanded:
        return _spread_profile(spans, keys)
    finite = F.col("value").isNotNull() & (F.abs(F.col("value")) < float("inf"))
    odd = F.col("value").isNotNull() & ~finite
    step = lambda at, sign: F.struct(at.alias("offset"), F.lit(sign).alias("sign"))
    events = spans.select(*keys, "value", F.explode(F.array(step(F.col("first"), 1), step(F.col("last") + 1, -1))).alias("e"))
    steps = events.groupBy(*keys, F.col("e.offset").alias("offset")).agg(
        F.sum("e.sign").alias("rows"), F.sum(F.when(finite, F.col("e.sign")).otherwise(0)).alias("n"),
        F.sum(F.when(odd, F.col("e.sign")).otherwise(0)).alias("odd"), F.sum(F.when(finite, F.col("e.sign") * F.col("value")).otherwise(0.0)).alias("total"),
    )
    along = W.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)]).orderBy("offset")
    ran = steps.select(*keys, "offset", F.lead("offset").over(along).alias("until"), *[F.sum(c).over(along).alias(c) for c in ("rows", "n", "odd", "total")])
    mean = F.when(F.col("odd") > 0, float("nan")).when(F.col("n") > 0, F.col("total") / F.col("n"))
    return ran.where("rows > 0").select(*keys, F.explode(F.sequence("offset", F.col("until") - 1)).alias("offset"), mean.alias("mean"))


def _spread_profile(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, median, sd and n by offset, from the distinct values there and their counts."""
    alike = spans.groupBy(*keys, "first", "last", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = alike.select(*keys, F.explode(F.sequence("first", "last")).alias("offset"), "value", "n")
    counts = cut_lineage(counts.groupBy(*keys, "offset", "value").agg(F.sum("n").alias("n")))
    at = [*keys, "offset"]
    there = F.when(F.col("value").isNotNull(), F.col("n"))
    base = counts.groupBy(*at).agg((F.sum(F.col("value") * F.col("n")) / F.sum(there)).alias("mean"), F.sum("n").alias("n"), F.sum(there).alias("_total"))
    valued = counts.where("value is not null")
    means = base.where("_total is not null").select(*at, "mean", "_total")
    away = valued.join(means, at).groupBy(*at).agg(
        F.sqrt(F.sum(F.col("n") * (F.col("value") - F.col("mean")) ** 2) / F.nullif(F.max("_total") - 1, F.lit(0))).alias("sd"))
    ran = tiled_scan(valued, at, [F.col("value")], value_bucket(F.col("value")), running={"upto": ("sum", F.col("n"))})
    ran = ran.withColumn("below", F.col("upto") - F.col("n"))
    mid = quantiles_of_counts(ran, means.select(*at, "_total"), at, "value", F.array(F.lit(0.5))).select(*at, F.col("quantile").alias("median"))
    return base.drop("_total").join(away, at, "left").join(mid, at, "left").select(*at, "mean", "sd", "n", "median")


def signal_matrix(
    anchors: DataFrame, tracks: DataFrame, up: int, down: int, bin_size: int, order_by: str,
    id_col: str = "id", by: str = "track",
) -> DataFrame:
    """Binned signal per region and track, with the region's rank key.

    Long output ``(id, track, bin, signal, sort_value)``; ``sort_value`` is the region's
    mean over all bins of the track named ``order_by`` (missing bins are 0).  A segment gives one
    row for each bin it touches, with the bases it has there.
    """
    spans = _offset_spans(anchors.select("chrom", "pos", id_col), tracks, up, down, [id_col], [by])
    bins = (up + down) // bin_size
    cell = lambda at: F.floor((at + up) / bin_size)
    touched = spans.select("*", F.explode(F.sequence(cell(F.col("first")), cell(F.col("last")))).alias("bin"))
    low = F.col("bin") * bin_size - up
    bases = F.least(F.col("last"), low + bin_size - 1) - F.greatest(F.col("first"), low) + 1
    cells = touched.groupBy(id_col, by, "bin").agg((F.sum(F.col("value") * bases) / bin_size).alias("signal"))
    # The rank key is read off the cells themselves, so segments meet anchors once.
    own = F.sum(F.when(F.col(by) == order_by, F.col("signal"))).over(W.partitionBy(id_col)) / bins
    return cells.select(
        id_col, by, "bin", "signal", F.coalesce(F.when(F.col(id_col).isNotNull(), own), F.lit(0.0)).alias("sort_value")
    )


def interval_union_all(sets: Mapping[str, DataFrame], label: str = "set") -> DataFrame:
    """Concatenate labelled interval sets."""
    parts = [df.select(*COORDS, F.lit(name).alias(label)) for name, df in sets.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

