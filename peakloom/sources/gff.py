"""GFF3 input and the peak hierarchy output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import _fields


def parse_gff3(lines: DataFrame) -> DataFrame:
    """Features with 0-based half-open coordinates and their attributes as a map."""
    f = _fields(lines, "^#").where(F.size("f") >= 9)
    return f.select(
        F.col("f")[0].alias("chrom"), F.col("f")[1].alias("source"), F.col("f")[2].alias("type"),
        (F.col("f")[3].cast("long") - 1).alias("start"), F.col("f")[4].cast("long").alias("end"),
        F.col("f")[5].alias("score"), F.col("f")[6].alias("strand"), F.col("f")[7].alias("phase"),
        F.str_to_map(F.rtrim(F.regexp_replace(F.col("f")[8], ";+$", "")), F.lit(";"), F.lit("=")).alias("attributes"),
    )


def read_gff3(spark: SparkSession, path) -> DataFrame:
    """Features of GFF3 files."""
    return parse_gff3(spark.read.text(path))


def gff_hierarchy(peaks: DataFrame, source: str = "peaks") -> DataFrame:
    """Three GFF rows per peak (region, peak and maximum), linked by ID and Parent.

    ``peaks`` has coordinates, a unique ``name``, ``signal_value`` and ``summit_offset``.
    """
    top = F.col("start") + F.col("summit_offset")
    row = lambda kind, s, e, attributes: F.struct(
        F.lit(kind).alias("type"), s.alias("start"), e.alias("end"), attributes.alias("attributes")
    )
    name = F.col("name")
    rows = F.array(
        row("boundRegion", F.col("start"), F.col("end"), F.concat(F.lit("ID="), name)),
        row("Peak", F.col("start"), F.col("end"), F.concat(F.lit("ID="), name, F.lit(".1;Parent="), name)),
        row("Max", top, top + 1, F.concat(F.lit("ID="), name, F.lit(".1.1;Parent="), name, F.lit(".1"))),
    )
    return peaks.select("chrom", "signal_value", F.explode(rows).alias("r")).select(
        "chrom", F.lit(source).alias("source"), F.col("r.type").alias("type"), F.col("r.start").alias("start"),
        F.col("r.end").alias("end"), F.col("signal_value").alias("score"), F.lit(".").alias("strand"), F.lit(".").alias("phase"),
        F.col("r.attributes").alias("attributes"),
    )


def write_gff_hierarchy(peaks: DataFrame, path: str, source: str = "peaks") -> None:
    """Write :func:`gff_hierarchy` as GFF3 (1-based closed)."""
    rows = gff_hierarchy(peaks, source).withColumn("start", F.col("start") + 1)
    order = ["chrom", "start", "end"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.csv(path, sep="\t", quote="", escape="")
