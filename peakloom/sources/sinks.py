"""Sorted text output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_tsv(df: DataFrame, path: str, header: bool = False, order: Sequence[str] = ("chrom", "start")) -> None:
    """Tab-separated files in global coordinate order; missing values are written as NA."""
    (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.csv(path, sep="\t", header=header, nullValue="NA", quote="", escape="")
    )


def write_bed(df: DataFrame, path: str, columns: Sequence[str] = ("chrom", "start", "end")) -> None:
    """BED files sorted by chromosome and start."""
    write_tsv(df.select(*columns), path)


def write_parquet(df: DataFrame, path: str, order: Sequence[str] = ("chrom", "start")) -> None:
    """Parquet by chromosome, sorted inside, so that later reads prune by chromosome."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("chrom").parquet(path)
