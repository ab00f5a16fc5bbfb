"""Which motifs stand together, and at which distances: overlaps resolved, rules, distance curves, peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.resolve import preferred_distances, resolve_overlaps
from ..operators.spacing import cooccurrence_distances, cooccurrence_rules, significant_rules
from ..runtime import cut_lineage


def cooccurrence_peaks(
    sites: DataFrame, lowest: int = 0, highest: int = 100, smooth: int = 3, least: float = 2.0,
    share: float = 0.05, ties: Sequence[str] = (), key: str = "seq_id", model: str = "motif_id",
) -> DataFrame:
    """Preferred distances of the pairs of models whose rule is among the top ``share``; 1 takes all pairs.

    ``sites`` (``pos, stop, score``) lose what overlaps a better one first, so a pair of models that find the
    same sites is no rule.
    """
    kept = cut_lineage(resolve_overlaps(sites, [key], ties=ties))
    curve = cooccurrence_distances(kept, lowest, highest, [key], model)
    if share < 1:
        rules = significant_rules(cooccurrence_rules(kept, model, key), share=share)
        curve = curve.join(rules.select("tf1", "tf2"), ["tf1", "tf2"])
    return preferred_distances(curve, lowest, highest, smooth, least)
