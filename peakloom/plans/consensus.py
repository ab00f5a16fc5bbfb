"""From replicate peaks to consensus peaks with coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.overlap import overlap_anti
from ..operators.peaks import confirmed_regions, consensus_summits, peak_evidence, peak_max_per_replicate, replicate_concordance, sd_outlier_filter, top_n_peaks


def consensus_peaks(
    peaks: DataFrame, tracks: DataFrame, replicates: Sequence[str], track_names: Sequence[str],
    blacklist: DataFrame | None = None, phs: int = 200, min_reps: int = 2, weak: float = 1e-4, strong: float = 1e-8,
    sd_filter: bool = True, per_peak: bool = False, top: int | None = None,
) -> DataFrame:
    """Concordant regions, one peak per shared summit, and the highest coverage per replicate.

    ``peaks`` has ``summit``, ``replicate`` and ``neg_log10_p``; ``tracks`` is long by ``track``.  With
    ``per_peak`` each replicate's peaks are confirmed or discarded one by one and only kept ones make a
    region; ``top`` keeps the regions with the best evidence.
    """
    usable = peaks if blacklist is None else overlap_anti(peaks, blacklist)
    if per_peak:
        regions = confirmed_regions(peak_evidence(usable, weak, strong, min_reps), top)
    else:
        regions = replicate_concordance(usable, weak, strong, min_reps)
        regions = regions if top is None else top_n_peaks(regions, top, "fisher")
    narrow = consensus_summits(regions.select("chrom", "start", "end"), usable, replicates, phs, min_reps)
    measured = peak_max_per_replicate(narrow, tracks, track_names)
    if sd_filter:
        measured = sd_outlier_filter(measured, [f"max_{n}" for n in track_names])
    return measured
