"""Methylation, annotation and conservation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.dna import cg_count
from ..runtime import cut_lineage
from .filters import derive_promoters, primary_transcripts
from .motifs import best_site, leading_sites, site_to_genome
from .normalise import correlation_test
from .overlap import COORDS, POINT_TILE, best_of_spans, best_overlap, count_points_in_regions
from .points import value_lists
from .scans import tiled_scan
from .segments import complement, merge_intervals, meta_profile, shuffle_intervals

#: Fixed value: annotation classes kept per region.
CLASSES = ["exon", "intron", "intergenic", "5UTR", "3UTR", "promoter"]


def methylated_sites_in_regions(regions: DataFrame, methylation: DataFrame, cutoff: float = 0.5, name: str = "meth_sites") -> DataFrame:
    """Number of positions with probability above ``cutoff`` in each region; zeros are kept.

    Methylation positions are 1-based, as in the maps.
    """
    points = methylation.where(F.col("prob") > cutoff).select("chrom", (F.col("pos") - 1).alias("pos"))
    return count_points_in_regions(regions, points, name)


def with_cg_count(df: DataFrame, seq_col: str = "seq", name: str = "cg_count") -> DataFrame:
    """Add the number of C and G bases."""
    return df.withColumn(name, cg_count(F.col(seq_col)))


def lookup_value(sites: DataFrame, table: DataFrame, value: str = "prob", name: str = "values") -> DataFrame:
    """Value of every base of each site (``chrom, start, end``) as an array in base order, null where unknown.

    ``table`` has 1-based ``pos``.  Sites are short, so the arrays are too; the longest one is found first.  Values come
    in packed lists by tile and bases are laid out beside them in the rows of the sites, so neither is a row of a
    shuffle and an array is not shuffled.
    """
    return value_lists(sites, table.select("chrom", (F.col("pos") - 1).alias("pos"), value), value, name, POINT_TILE)


def peak_site_methylation_table(
    peaks: DataFrame, sites: DataFrame, methylation: DataFrame, cutoff: float, id_col: str = "seq_id"
) -> DataFrame:
    """Peak coverage, its best site above ``cutoff``, methylated positions and per-base probabilities.

    ``peaks`` has coordinates, ``seq`` and coverages; peaks without a site keep nulls.
    """
    slim = sites.where(F.col("score") > cutoff).select(id_col, "pos", "strand", "kmer", "motif_len", "score")
    best = best_site(leading_sites(slim, [id_col]), [id_col])
    # Written, as a table is read several times and these are small beside the sequences.
    placed = cut_lineage(site_to_genome(best, peaks.select(id_col, "chrom", "start"), id_col), slim=True)
    spans = peaks.select(*COORDS).unionByName(placed.select(*COORDS)).distinct()
    counts = cut_lineage(methylated_sites_in_regions(spans, methylation), slim=True)
    counted = with_cg_count(peaks).join(counts, COORDS).select(*peaks.columns, "meth_sites", "cg_count")
    site = cut_lineage(lookup_value(placed, methylation, name="base_probs").join(counts, COORDS).select(
        id_col, F.col("score").alias("site_score"), F.col("start").alias("site_start"), F.col("end").alias("site_end"),
        F.col("strand").alias("site_strand"), F.col("kmer").alias("motif_seq"), F.col("meth_sites").alias("meth_sites_in_motif"), "base_probs",
    ), slim=True)
    return counted.join(site, id_col, "left")


def log_signal_ratio(df: DataFrame, a: str, b: str, name: str = "log_ratio") -> DataFrame:
    """log10((a + min+ a) / (b + min+ b)), min+ being the smallest non-zero value."""
    low = df.agg(
        F.min(F.when(F.col(a) != 0, F.col(a))).alias("_la"), F.min(F.when(F.col(b) != 0, F.col(b))).alias("_lb")
    )
    ratio = F.log10((F.col(a) + F.col("_la")) / (F.col(b) + F.col("_lb")))
    return df.crossJoin(F.broadcast(low)).withColumn(name, ratio).drop("_la", "_lb")


def methylation_correlations(
    table: DataFrame, ratio: str = "log_ratio", length: int | None = None, symmetric: bool = False, min_points: int = 10
) -> DataFrame:
    """Correlation of methylation with the signal ratio: over the peak, over the site, and at each base.

    Asymmetric motifs are read along the motif's strand (a C on ``+`` is a G read on ``-``);
    symmetric ones pair a base with its mirror and take the larger probability.
    """
    # Read for the whole and for the bases.
    table = cut_lineage(table.where("site_score is not null").select(
        F.col(ratio), "site_score", "meth_sites", "start", "end", "meth_sites_in_motif", "motif_seq", "base_probs", "site_strand"
    ))
    whole = table.where("site_score is not null").select(
        F.col(ratio).alias("y"),
        F.explode(F.array(
            F.struct(F.lit("peak_density").alias("what"), (F.col("meth_sites") / (F.col("end") - F.col("start"))).alias("x")),
            F.struct(F.lit("site_count").alias("what"), F.col("meth_sites_in_motif").cast("double").alias("x")),
        )).alias("e"),
    ).select(F.col("e.what").alias("what"), F.col("e.x").alias("x"), "y")
    zipped = F.arrays_zip(F.split("motif_seq", "").alias("base"), F.col("base_probs").alias("prob"))
    bases = table.where("site_score is not null").select(
        F.col(ratio).alias("y"), "site_strand", F.length("motif_seq").alias("len"), F.posexplode(zipped).alias("i", "c")
    ).select("y", "site_strand", "len", "i", F.col("c.base").alias("base"), F.col("c.prob").alias("prob"))
    if symmetric:
        tagged = table.where("site_score is not null").withColumn("len", F.length("motif_seq")).select(
            F.col(ratio).alias("y"), F.col("len"),
            F.explode(F.sequence(F.lit(0), F.floor(F.col("len") / 2).cast("int"))).alias("i"),
            F.split("motif_seq", "").alias("b"), F.col("base_probs").alias("v"),
        )
        here, there = lambda c: F.col(c)[F.col("i")], lambda c: F.col(c)[F.col("len") - 1 - F.col("i")]
        each = F.explode(F.array(F.struct(F.lit("C").alias("n1"), F.lit("G").alias("n2")), F.struct(F.lit("G").alias("n1"), F.lit("C").alias("n2"))))
        tagged = tagged.withColumn("n", each).where((here("b") == F.col("n.n1")) | (there("b") == F.col("n.n2")))
        rows = tagged.select(
            F.concat(F.col("n.n1"), (F.col("i") + 1).cast("string"), F.col("n.n2"), (F.col("len") - F.col("i")).cast("string")).alias("what"),
            F.greatest(here("v"), there("v")).alias("x"), "y",
        )
    else:
        along = F.when(F.col("site_strand") == "+", F.col("i")).otherwise(F.col("len") - 1 - F.col("i"))
        read = F.when(F.col("site_strand") == "+", F.col("base")).otherwise(F.translate("base", "ACGT", "TGCA"))
        rows = bases.select(
            F.concat(read, (along + 1).cast("string")).alias("what"), F.col("prob").alias("x"), "y", read.alias("r")
        ).where(F.col("r").isin("C", "G")).drop("r")
    return correlation_test(whole.unionByName(rows), "x", "y", ["what"], min_points)


def build_annotation(gff: DataFrame, sizes: DataFrame, promoter_length: int = 1000) -> DataFrame:
    """Regions with a type: features, promoters, introns and intergenic parts (CDS counts as exon)."""
    primary = primary_transcripts(gff)
    genes = primary.where("type = 'gene'")
    promoters = derive_promoters(genes, promoter_length).join(sizes.select("chrom", "length"), "chrom").select(
        "chrom", "start", F.least("end", "length").alias("end"), F.lit("promoter").alias("type")
    ).where("start < end")
    kind = F.when(F.col("type") == "CDS", "exon").otherwise(F.col("type"))
    features = primary.where(~F.col("type").isin("gene", "mRNA", "rRNA")).select(*COORDS, kind.alias("type"))
    body = primary.select(*COORDS)
    intergenic = complement(body.unionByName(promoters.select(*COORDS)), sizes)
    off_gene = complement(body, sizes)
    introns = complement(features.select(*COORDS).unionByName(off_gene.select(*COORDS)), sizes)
    tag = lambda df, name: df.select(*COORDS, F.lit(name).alias("type"))
    return (
        tag(introns, "intron").unionByName(tag(intergenic, "intergenic"))
        .unionByName(features).unionByName(promoters)
    )


def exon_gap_introns(gff: DataFrame) -> DataFrame:
    """Introns as gaps between consecutive exons of one transcript."""
    exons = gff.where(F.col("type") == "exon").select(
        *COORDS, "strand", F.coalesce(F.element_at("attributes", "Parent"), F.element_at("attributes", "ID")).alias("transcript")
    )
    merged = merge_intervals(exons.select("transcript", *COORDS), keys=["transcript", "chrom"])
    gaps = tiled_scan(
        merged, ["transcript", "chrom"], [F.col("start")], F.floor(F.col("start") / (1 << 20)), following={"next": F.col("start")}
    )
    return gaps.where("next > end").select("chrom", F.col("end").alias("start"), F.col("next").alias("end"), "transcript")


def annotate_peaks(peaks: DataFrame, annotation: DataFrame) -> DataFrame:
    """The annotation type that shares most with each peak."""
    return best_overlap(peaks, annotation, ["type"]).select(
        *peaks.columns, F.coalesce("b_type", F.lit("intergenic")).alias("type"), "overlap"
    )


def feature_percentages(annotated: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share (%) of peaks in each annotation type."""
    counts = annotated.groupBy(*keys, "type").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(*keys).agg(F.sum("n").alias("_t"))
    both = counts.join(total, list(keys)) if keys else counts.crossJoin(F.broadcast(total))
    return both.select(*keys, "type", "n", (100 * F.col("n") / F.col("_t")).alias("percent"))


def merge_annotations_per_region(regions: DataFrame, annotation: DataFrame, min_frac: float = 0.10) -> DataFrame:
    """All known types that cover ``min_frac`` of a region, sorted and joined by ``;``."""
    known = annotation.where(F.col("type").isin(*CLASSES)).select(*COORDS, "type")
    # A type covers enough of a region if the one of it that shares most does, so no pairs are needed.
    placed = regions.select(*COORDS).where("chrom IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL").distinct()
    asked = placed.select(F.explode(F.array(*[F.concat(F.lit(f"{c}:"), "chrom") for c in CLASSES])).alias("chrom"), "start", "end")
    met = best_of_spans(asked, known.withColumn("chrom", F.concat("type", F.lit(":"), "chrom")), [], min_frac)
    kind, at = F.substring_index("chrom", ":", 1), F.locate(":", F.col("chrom"))
    names = sorted(CLASSES)
    number = F.array_position(F.array(*[F.lit(c) for c in names]), kind).cast("int") - 1
    # A bit for each type, as numbers are put together before they are shuffled.
    bits = met.select(F.substring("chrom", at + 1, F.length("chrom")).alias("chrom"), "start", "end", F.call_function("shiftleft", F.lit(1), number).alias("_b"))
    types = bits.groupBy(*COORDS).agg(F.bit_or("_b").alias("_b"))
    held = F.array_compact(F.array(*[F.when(F.col("_b").bitwiseAND(1 << i) != 0, F.lit(c)) for i, c in enumerate(names)]))
    return regions.join(types.hint("merge"), COORDS, "left").select(
        *regions.columns, F.when(F.col("_b").isNotNull(), F.array_join(held, ";")).otherwise("intergenic").alias("types")
    )


def conservation_profile(
    sites: DataFrame, tracks: Mapping[str, DataFrame], sizes: DataFrame, up: int, down: int, seed: int, id_col: str = "id"
) -> DataFrame:
    """Mean of each track by offset around sites, beside the same for randomly moved sites.

    ``sites`` has coordinates and an id; anchors are the site middles.
    """
    moved = shuffle_intervals(sites.select(*COORDS, id_col), sizes, seed, id_col=id_col).where("start is not null")
    anchor = lambda df: df.select("chrom", F.floor((F.col("start") + F.col("end")) / 2).alias("pos"))
    out = None
    for name, track in tracks.items():
        real = meta_profile(anchor(sites), track, up, down).withColumnRenamed("mean", "sites")
        null = meta_profile(anchor(moved), track, up, down).withColumnRenamed("mean", "shuffled")
        part = real.join(null, "offset", "full").withColumn("track", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("track", "offset", "sites", "shuffled")


def add_chromosome_rows(gff: DataFrame, sequences: DataFrame) -> DataFrame:
    """Add one ``chromosome`` feature per sequence if the annotation has none.

    ``sequences`` is a chunked genome (``chrom, offset, seq``).
    """
    present = gff.agg((F.count_if(F.col("type") == "chromosome") > 0).alias("_has"))
    size = sequences.groupBy("chrom").agg(F.max(F.col("offset") + F.length("seq")).alias("end"))
    rows = size.crossJoin(F.broadcast(present)).where(~F.col("_has")).select(
        "chrom", F.lit("genome").alias("source"), F.lit("chromosome").alias("type"), F.lit(0).cast("long").alias("start"), "end",
        F.lit(".").alias("score"), F.lit(".").alias("strand"), F.lit(".").alias("phase"),
        F.create_map(F.lit("ID"), F.col("chrom"), F.lit("Name"), F.col("chrom")).alias("attributes"),
    )
    return gff.unionByName(rows)
