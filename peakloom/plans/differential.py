"""Which regions differ between two conditions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.normalise import cpm, fold_change, ratio_deciles, replicate_mean, rpkm
from ..operators.overlap import count_many_in_regions
from ..runtime import cut_lineage


def counts_per_sample(peaks: DataFrame, reads: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Long ``(peak columns, sample, count)`` with zeros, all samples in one pass over the reads."""
    ones = {f"_s{i}": (F.col("sample") == s).cast("long") for i, s in enumerate(samples)}
    # One row per region: written, since the totals and the rows both read it.
    wide = cut_lineage(count_many_in_regions(peaks, reads, ones))
    cells = F.array(*[F.struct(F.lit(s).alias("sample"), F.col(f"_s{i}").alias("count")) for i, s in enumerate(samples)])
    return wide.select(*peaks.columns, F.explode(cells).alias("c")).select(*peaks.columns, "c.sample", "c.count")


def with_condition(df: DataFrame, conditions: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add ``condition`` by sample name."""
    kind = F.lit(None).cast("string")
    for name, samples in conditions.items():
        kind = F.when(F.col("sample").isin(*samples), name).otherwise(kind)
    return df.withColumn("condition", kind)


def differential_regions(
    peaks: DataFrame, reads: DataFrame, conditions: Mapping[str, Sequence[str]], libraries: DataFrame | None = None, groups: int = 10
) -> DataFrame:
    """RPKM per condition, their ratio and its decile for every region.

    ``peaks`` has an ``id``; ``conditions`` names two sets of replicate samples.  Without
    ``libraries`` the reads in peaks are the denominator.
    """
    a, b = list(conditions)
    counts = counts_per_sample(peaks, reads, [s for group in conditions.values() for s in group])
    level = with_condition(rpkm(cpm(counts, libraries)), conditions)
    mean = replicate_mean(level, ["id", "chrom", "start", "end"], "condition", "rpkm")
    # The two conditions are fixed names, so this pivot is one aggregation.
    wide = mean.groupBy("id", "chrom", "start", "end").agg(
        *[F.max(F.when(F.col("condition") == c, F.round("mean", 9))).alias(c) for c in (a, b)]
    )
    # One row per region, written once: ranking reads it several times.
    changed = cut_lineage(fold_change(wide, a, b).withColumn("ratio", F.round("ratio", 9)))
    return ratio_deciles(changed, "ratio", "id", groups)
