"""Row filters and coordinate projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

SECONDARY = 0x100
COORDS = ["chrom", "start", "end"]


def filter_alignments(df: DataFrame, max_mm: int = 2, min_mapq: int = 30, multi: bool = False) -> DataFrame:
    """Keep alignments with few mismatches and a mapping quality above ``min_mapq``."""
    keep = (F.col("mapq") > min_mapq) & (F.coalesce(F.col("mismatches"), F.lit(0)) <= max_mm)
    if not multi:
        keep = keep & (F.col("flag").bitwiseAND(SECONDARY) == 0)
    return df.where(keep)


def extend_reads(df: DataFrame, fraglen: int) -> DataFrame:
    """Lengthen reads by ``fraglen`` in their own direction, staying on the chromosome."""
    return df.withColumns(
        {
            "start": F.when(F.col("strand") == "-", F.greatest(F.col("start") - fraglen, F.lit(0))).otherwise(F.col("start")),
            "end": F.when(F.col("strand") == "+", F.col("end") + fraglen).otherwise(F.col("end")),
        }
    )


def clamp_start(df: DataFrame, minimum: int = 0) -> DataFrame:
    """Raise starts below ``minimum`` to it."""
    return df.withColumn("start", F.greatest("start", F.lit(minimum).cast("long")))


def resize_on_summit(df: DataFrame, half: int = 200) -> DataFrame:
    """Recentre every peak on its summit."""
    summit = F.col("start") + F.col("summit_offset")
    return df.withColumns({"start": summit - half, "end": summit + half})


def resize_on_position(df: DataFrame, half: int = 200, position: str | None = None) -> DataFrame:
    """Recentre on the column ``position``, or on the midpoint without one."""
    centre = F.col(position) if position else F.floor((F.col("start") + F.col("end")) / 2)
    return df.withColumns({"start": centre - half, "end": centre + half})


def filter_signal(df: DataFrame, k: float = 3.0, column: str = "signal_value") -> DataFrame:
    """Keep peaks whose enrichment exceeds ``k``."""
    return df.where(F.col(column) > k)


def filter_height(df: DataFrame, columns: Sequence[str], height: float) -> DataFrame:
    """Keep peaks whose maximum exceeds ``height`` in every replicate."""
    return df.where(F.forall(F.array(*columns), lambda x: x > height))


def filter_min_coverage(df: DataFrame, a: str, b: str, threshold: float = 3.0) -> DataFrame:
    """Keep peaks covered above ``threshold`` in at least one of two conditions."""
    return df.where((F.col(a) > threshold) | (F.col(b) > threshold))


def filter_sites(df: DataFrame, threshold: float, strict: bool = True, column: str = "score") -> DataFrame:
    """Keep sites scoring above (or, not strict, at least) ``threshold``."""
    return df.where(F.col(column) > threshold if strict else F.col(column) >= threshold)


def filter_chrom(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Keep or drop chromosomes by name."""
    if include:
        df = df.where(F.col("chrom").isin(*include))
    if exclude:
        df = df.where(~F.col("chrom").isin(*exclude))
    return df


def primary_transcripts(gff: DataFrame) -> DataFrame:
    """Genes, and the features that belong to the first isoform (``.1``)."""
    first = lambda key: F.coalesce(F.element_at("attributes", key).rlike(r"\.1(\D|$)"), F.lit(False))
    return gff.where((F.col("type") == "gene") | first("ID") | first("Parent"))


def derive_tss(genes: DataFrame, window: int | None = None) -> DataFrame:
    """Transcription start of stranded genes (0-based ``pos``), optionally with a window around it."""
    pos = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1)
    out = genes.where(F.col("strand").isin("+", "-")).withColumn("pos", pos)
    if window is None:
        return out
    return out.withColumns(
        {"start": F.greatest(F.col("pos") - window, F.lit(0)), "end": F.col("pos") + window + 1}
    )


def derive_promoters(genes: DataFrame, length: int) -> DataFrame:
    """Region of ``length`` bp upstream of each gene; empty ones are dropped."""
    plus = F.col("strand") == "+"
    start = F.when(plus, F.greatest(F.col("start") - length, F.lit(0))).otherwise(F.col("end"))
    end = F.when(plus, F.col("start")).otherwise(F.col("end") + length)
    out = genes.withColumn("_s", start).withColumn("_e", end)
    return (
        out.withColumn("start", F.col("_s")).withColumn("end", F.col("_e")).drop("_s", "_e")
        .where("end > start")
    )


def distinct_regions(df: DataFrame) -> DataFrame:
    """Unique coordinates."""
    return df.select(*COORDS).distinct()


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project by name."""
    return df.select(*names)


def label_peak_origin(df: DataFrame, name: str, column: str = "set") -> DataFrame:
    """Tag every peak with the set it comes from."""
    return df.withColumn(column, F.lit(name))


def normalise_chrom(df: DataFrame, style: str = "chr", column: str = "chrom") -> DataFrame:
    """Bring ``N``, ``ChrN`` and ``chrN`` to one spelling (``chr``, ``Chr`` or ``bare``)."""
    bare = F.regexp_replace(F.col(column), "^(?i)chr", "")
    prefix = {"chr": "chr", "Chr": "Chr", "bare": ""}[style]
    return df.withColumn(column, F.concat(F.lit(prefix), bare))


def join_on_key(tables: Mapping[str, DataFrame], keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join value tables on a key; value columns get the table's name as prefix."""
    out = None
    for name, df in tables.items():
        part = df.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in keys])
        out = part if out is None else out.join(part, list(keys), how)
    return out
