"""From sequences to preferred spacings of a motif."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.motifs import Model, scan_pwm
from ..operators.spacing import collapse_ar, spacing_counts, spacing_fc_z, spacing_homotypic, spacing_pvalues
from ..runtime import cut_lineage


def spacing_enrichment(
    sequences: DataFrame, model: Model, thresholds: Sequence[float], smin: int = 0, smax: int = 30,
    offset_left: int = 0, offset_right: int = 0, method: str = "median",
) -> DataFrame:
    """Count, fold change, Z score and adjusted p-value of each conformation and distance.

    Sites are filtered at the lowest threshold inside the scan, so only hits are paired;
    pairs meet by sequence and position bin, and everything after the counts is small.
    """
    # The hits meet themselves, so they are written once and not scanned for twice.
    sites = cut_lineage(scan_pwm(sequences, [model], min(thresholds), with_kmer=False))
    pairs = spacing_homotypic(sites, model.length, smin, smax, offset_left, offset_right)
    counts = spacing_counts(pairs, thresholds)
    if model.symmetric:
        counts = collapse_ar(counts)
    return spacing_pvalues(spacing_fc_z(counts, method))
