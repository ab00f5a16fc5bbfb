"""Read-level statistics: duplicates, library size, insert size, reads in peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from .overlap import overlap_semi
from .segments import merge_intervals

LOCATION = ["chrom", "start", "end", "strand"]
PROPER_FIRST = 0x42


def dedup_reads(reads: DataFrame, keep: int | str = 1, order: Sequence[str] = ("name",), keys: Sequence[str] = ()) -> DataFrame:
    """At most ``keep`` reads per location and strand (``'all'`` keeps everything).

    Rows are first thinned inside each of 64 parts of a location, so a location that
    holds a third of the library is never sorted by one task.
    """
    if keep == "all":
        return reads
    place = [*keys, *LOCATION]
    part = F.pmod(F.xxhash64(*order), F.lit(64))
    sort = [F.col(c) for c in order]
    thin = W.partitionBy(*place, "_part").orderBy(*sort)
    final = W.partitionBy(*place).orderBy(*sort)
    return (
        reads.withColumn("_part", part)
        .withColumn("_rn", F.row_number().over(thin)).where(F.col("_rn") <= keep)
        .withColumn("_rn", F.row_number().over(final)).where(F.col("_rn") <= keep)
        .drop("_part", "_rn")
    )


def duplicate_histogram(reads: DataFrame, keep: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """How many locations hold 1, 2, 3 ... reads; ``keep`` caps the multiplicity as dedup does."""
    per_place = reads.groupBy(*keys, *LOCATION).agg(F.count(F.lit(1)).alias("multiplicity"))
    if keep is not None:
        per_place = per_place.withColumn("multiplicity", F.least("multiplicity", F.lit(keep).cast("long")))
    return per_place.groupBy(*keys, "multiplicity").agg(F.count(F.lit(1)).alias("locations"))


def duplication_rate(reads: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total reads, occupied locations and (total - unique) / total."""
    hist = duplicate_histogram(reads, keys=keys)
    total, unique = F.sum(F.col("multiplicity") * F.col("locations")), F.sum("locations")
    return hist.groupBy(*keys).agg(
        total.alias("total"), unique.alias("unique"), ((total - unique) / total).alias("dup_rate")
    )


def insert_size_stats(alignments: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population sd of the fragment length over first reads of proper pairs."""
    first = alignments.where(F.col("flag").bitwiseAND(PROPER_FIRST) == PROPER_FIRST)
    size = F.abs(F.col("tlen"))
    return first.groupBy(*keys).agg(
        F.avg(size).alias("mean_insert"), F.stddev_pop(size).alias("sd_insert"), F.count(F.lit(1)).alias("pairs")
    )


def library_size(reads: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Mapped reads and the factor to counts per million."""
    return reads.groupBy(*keys).agg(F.count(F.lit(1)).alias("library_size")).withColumn(
        "scale", F.lit(1e6) / F.col("library_size")
    )


def frip(reads: DataFrame, peaks: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Share (%) of reads that overlap the merged peaks, per key.

    Equal read locations are weighed once, so the position counts see distinct places.
    """
    keys = list(keys)
    places = reads.groupBy(*keys, "chrom", "start", "end").agg(F.count(F.lit(1)).alias("copies"))
    inside = (
        overlap_semi(places, merge_intervals(peaks))
        .groupBy(*keys).agg(F.sum("copies").alias("in_peaks"))
    )
    total = reads.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    both = total.join(inside, keys, "left") if keys else total.crossJoin(F.broadcast(inside))
    hit = F.coalesce("in_peaks", F.lit(0))
    return both.select(*keys, "total", hit.alias("in_peaks"), (100 * hit / F.col("total")).alias("frip"))


def mapping_stats(alignments: DataFrame, reads: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """One row per sample: mates, mapped, insert size, fragments and duplication."""
    keys = list(keys)
    flag = F.col("flag")
    mates = alignments.groupBy(*keys).agg(
        F.count_if(flag.bitwiseAND(64) != 0).alias("read1"),
        F.count_if(flag.bitwiseAND(128) != 0).alias("read2"),
        F.count_if(flag.bitwiseAND(4) == 0).alias("mapped"),
    )
    return (
        mates.join(insert_size_stats(alignments, keys), keys, "left")
        .join(duplication_rate(reads, keys), keys, "left")
        .withColumnsRenamed({"total": "tot_frag", "unique": "uniq_frag"})
    )


def sample_stats(reads: DataFrame, filtered: DataFrame, peaks: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Total and filtered tags, peaks and reads in peaks for each sample."""
    keys = list(keys)
    total = reads.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_tags"))
    kept = frip(filtered, peaks, keys).withColumnRenamed("total", "filtered_tags")
    n_peaks = peaks.agg(F.count(F.lit(1)).alias("n_peaks"))
    return total.join(kept, keys).crossJoin(F.broadcast(n_peaks))
