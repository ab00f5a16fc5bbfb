"""Tab-separated inputs.

Each format has a ``parse_*`` function from a DataFrame of text lines (column ``value``)
to typed columns, and a ``read_*`` function that applies it to files.  Parsing is plain
column expressions, so unused columns are never produced.  Coordinates come out 0-based
half-open; an interval without length is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _fields(lines: DataFrame, skip: str) -> DataFrame:
    """Split data lines; ``skip`` is a pattern of lines to leave out."""
    text = F.rtrim(F.regexp_replace("value", "\r$", ""))
    return lines.where((F.length(text) > 0) & ~text.rlike(skip)).select(F.split(text, "\t").alias("f"))


def _at(i: int) -> Column:
    """Field ``i`` (1-based), null when missing or written as NA or '.'."""
    value = F.try_element_at("f", F.lit(i))
    return F.when(~value.isin("NA", ".", ""), value)


HEADER = r"^(#|track\b|browser\b|(?i)chr(om)?\t(begin|start)\b)"


def parse_bed(lines: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """BED3/4/5; column 5 is the summit offset, by default half the width.

    ``extra`` names further columns, read as text.
    """
    f = _fields(lines, HEADER)
    start, end = _at(2).cast("long"), _at(3).cast("long")
    half = F.floor((F.col("end") - F.col("start")) / 2)
    out = f.select(
        _at(1).alias("chrom"), start.alias("start"), end.alias("end"), _at(4).alias("name"),
        _at(5).cast("long").alias("_summit"), *[_at(6 + i).alias(c) for i, c in enumerate(extra)],
    ).where("start < end")
    return out.withColumn("summit_offset", F.coalesce("_summit", half)).select(
        "chrom", "start", "end", "name", "summit_offset", *extra
    )


def parse_reads(lines: DataFrame) -> DataFrame:
    """BED6 reads with strand."""
    return _fields(lines, HEADER).select(
        _at(1).alias("chrom"), _at(2).cast("long").alias("start"), _at(3).cast("long").alias("end"),
        _at(4).alias("name"), _at(5).cast("double").alias("score"), _at(6).alias("strand"),
    ).where("start < end")


def parse_narrowpeak(lines: DataFrame) -> DataFrame:
    """The ten narrowPeak columns."""
    return _fields(lines, HEADER).select(
        _at(1).alias("chrom"), _at(2).cast("long").alias("start"), _at(3).cast("long").alias("end"),
        _at(4).alias("name"), _at(5).cast("double").alias("score"), _at(6).alias("strand"),
        _at(7).cast("double").alias("signal_value"), _at(8).cast("double").alias("neg_log10_p"),
        _at(9).cast("double").alias("neg_log10_q"), _at(10).cast("long").alias("summit_offset"),
    ).where("start < end")


def parse_bedgraph(lines: DataFrame) -> DataFrame:
    """Signal track; track and header lines are skipped."""
    return _fields(lines, HEADER).select(
        _at(1).alias("chrom"), _at(2).cast("long").alias("start"), _at(3).cast("long").alias("end"), _at(4).cast("double").alias("value")
    ).where("start < end")


def parse_chrom_sizes(lines: DataFrame) -> DataFrame:
    """Chromosome and length."""
    return _fields(lines, "^#").select(_at(1).alias("chrom"), _at(2).cast("long").alias("length"))


def genome_size(sizes: DataFrame) -> DataFrame:
    """Total length."""
    return sizes.agg(F.sum("length").alias("genome_size"))


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignment records with their tags as a map; ``mismatches`` is the XM:i tag.

    ``start`` is 0-based and ``end`` follows from the reference bases the CIGAR takes up (M, D, N, =, X);
    without one from the length of the sequence, and without that it is one base.
    """
    f = _fields(lines, "^@")
    tags = F.map_from_entries(
        F.transform(
            F.filter(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), lambda t: t.rlike("^..:.:")),
            lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.substring(t, 6, 1 << 20).alias("value")),
        )
    )
    seq = F.when(F.col("f")[9] != "*", F.col("f")[9])
    taken = F.regexp_extract_all(F.col("f")[5], F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    covered = F.when(F.size(taken) > 0, F.aggregate(taken, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")))
    out = f.select(
        covered.alias("_covered"), F.col("f")[0].alias("name"), F.col("f")[1].cast("int").alias("flag"), F.col("f")[2].alias("chrom"),
        (F.col("f")[3].cast("long") - 1).alias("start"), F.col("f")[4].cast("int").alias("mapq"),
        F.col("f")[8].cast("long").alias("tlen"), seq.alias("seq"), tags.alias("tags"),
    )
    return out.withColumn("end", F.col("start") + F.coalesce("_covered", F.length("seq"), F.lit(1))).drop("_covered").withColumn(
        "mismatches", F.try_element_at("tags", F.lit("XM")).cast("int")
    ).withColumn("strand", F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+"))


def parse_methylation(lines: DataFrame) -> DataFrame:
    """Position (1-based) and methylation probability, its sign dropped."""
    return _fields(lines, HEADER).select(
        _at(1).alias("chrom"), _at(2).cast("long").alias("pos"), F.abs(_at(4).cast("double")).alias("prob")
    )


def parse_site_scores(lines: DataFrame) -> DataFrame:
    """The eight-column site table; the region is taken from the sequence name once, here."""
    name = r"^(.*):(\d+)-(\d+)$"
    return _fields(lines, "^#").select(
        _at(1).alias("seq_name"), F.regexp_extract(_at(1), name, 1).alias("chrom"),
        F.regexp_extract(_at(1), name, 2).cast("long").alias("region_start"),
        F.regexp_extract(_at(1), name, 3).cast("long").alias("region_end"),
        _at(2).cast("int").alias("pos"), _at(3).cast("int").alias("stop"), F.col("f")[3].alias("strand"),
        _at(5).alias("kmer"), _at(6).alias("type"), _at(7).cast("int").alias("motif_len"), _at(8).cast("double").alias("score"),
    )


def parse_kmer_hits(lines: DataFrame) -> DataFrame:
    """k-mer hits: motif, sequence name and score."""
    return _fields(lines, "^(#|Motif\t)").select(
        _at(1).alias("motif"), _at(2).alias("seq_no"), _at(3).alias("motif_name"), _at(4).alias("seq_name"),
        _at(5).alias("match"), _at(6).alias("seq_pos"), _at(7).alias("coord"), F.col("f")[7].alias("strand"),
        _at(9).cast("double").alias("score"),
    )


def _reader(parse):
    def read(spark: SparkSession, path, **options) -> DataFrame:
        return parse(spark.read.text(path), **options)

    read.__doc__ = f"Files of: {parse.__doc__}"
    return read


read_bed = _reader(parse_bed)
read_reads = _reader(parse_reads)
read_narrowpeak = _reader(parse_narrowpeak)
read_bedgraph = _reader(parse_bedgraph)
read_chrom_sizes = _reader(parse_chrom_sizes)
read_sam_text = _reader(parse_sam)
read_methylation = _reader(parse_methylation)
read_site_scores = _reader(parse_site_scores)
read_kmer_hits = _reader(parse_kmer_hits)
