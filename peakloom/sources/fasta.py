"""FASTA input and output."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dna import clean_sequence
from ..operators.scans import tiled_scan
from ..operators.sequences import CHUNK
from ..runtime import cut_lineage

#: Bases of a piece that a task cuts off its lines.
PIECE = 1 << 16


def parse_fasta(records: DataFrame) -> DataFrame:
    """``(name, seq)`` from records (the text between ``>`` signs, column ``value``)."""
    text = F.regexp_replace("value", "\r", "")
    head = F.substring_index(text, "\n", 1)
    body = F.regexp_replace(F.substring(text, F.length(head) + 1, F.length(text)), r"\s", "")
    return records.where(F.length(F.trim("value")) > 0).select(
        F.substring_index(F.trim(head), " ", 1).alias("name"), clean_sequence(body).alias("seq")
    )


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """One row per record; upper case, unknown bases as ``-``.  For records that fit a row, see :func:`read_genome`."""
    return parse_fasta(spark.read.option("lineSep", ">").text(path))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of byte ranges to headers and stretches of at most ``PIECE`` bases, in order."""
    count = 0
    for batch in batches:
        place, text = [], []
        for block, line in zip(batch.column("at").to_pylist(), batch.column("value").to_pylist()):
            if place and block == place[-1] and not line.startswith(">") and not text[-1][0].startswith(">"):
                text[-1].append(line)
            else:
                place.append(block)
                text.append([line])
        rows = []
        for block, lines in zip(place, text):
            head = lines[0][1:].split(None, 1) if lines[0].startswith(">") else None
            if head is not None:
                rows.append((block, (head or [""])[0], ""))
                continue
            bases = "".join("".join(lines).split())
            rows += [(block, None, bases[k : k + PIECE]) for k in range(0, len(bases), PIECE)]
        if rows:
            blocks, heads, bases = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, batch.schema.field("at").type), pa.array(range(count, count + len(rows)), pa.int64()), pa.array(heads, pa.string()), pa.array(bases, pa.string())],
                ["at", "n", "head", "bases"],
            )
            count += len(rows)


def read_genome(spark: SparkSession, path, size: int = CHUNK) -> DataFrame:
    """Genome rows of ``size`` bases for :func:`peakloom.operators.sequences.extract_sequences`.

    Files are read by byte ranges, so a record may lie in many tasks and none holds it.  A task cuts its lines
    into pieces; running totals of their lengths over the byte ranges of a file carry the record and the place
    in it across ranges; pieces meet in the rows that they touch.  Headers are lines with ``>``; sequences are
    wrapped over lines, as is usual: one line is read as one value.  Lines before the first header belong to
    no record.  Equal names, in one file or several, are rows of their own.
    """
    lines = spark.read.text(path)
    at = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    cut = cut_lineage(lines.select(at.alias("at"), "value").mapInArrow(_segments, "at struct<path:string,block:bigint>, n long, head string, bases string"))
    pieces = cut.select("at.path", "at.block", "n", "head", F.length("bases").cast("long").alias("size"))
    # Pieces of a byte range are counted by the task that reads it; ranges follow each other in a file.
    rank = [F.col("block"), F.col("n")]
    ran = cut_lineage(tiled_scan(
        pieces, ["path"], rank, F.col("block"), running={"upto": ("sum", F.col("size")), "record": ("sum", F.col("head").isNotNull().cast("long"))}
    ))
    begins = F.when(F.col("head").isNotNull(), F.struct("head", F.col("upto").alias("from")))
    named = tiled_scan(ran, ["path"], rank, F.col("block"), filled={"of": begins}).where("head is null and of is not null")
    placed = named.select("path", "block", "n", "record", F.col("of.head").alias("chrom"), (F.col("upto") - F.col("size") - F.col("of.from")).alias("start"), "size")
    whole = placed.join(cut.select("at.path", "at.block", "n", "bases").where("head is null"), ["path", "block", "n"])
    first, last = F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("size") - 1) / size)
    touched = whole.withColumn("chunk_no", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    low = F.greatest(F.col("start"), F.col("chunk_no") * F.lit(size).cast("long"))
    high = F.least(F.col("start") + F.col("size"), (F.col("chunk_no") + 1) * F.lit(size).cast("long"))
    part = F.substring("bases", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
    rows = touched.groupBy("path", "record", "chrom", "chunk_no").agg(F.array_sort(F.collect_list(F.struct(low.alias("low"), part.alias("part")))).alias("parts"))
    return rows.select(
        "chrom", "chunk_no", (F.col("chunk_no") * F.lit(size).cast("long")).alias("offset"),
        clean_sequence(F.array_join(F.transform("parts", lambda p: p["part"]), "")).alias("seq"),
    )


def fasta_records(df: DataFrame, id_col: str = "name", seq_col: str = "seq", weight_col: str | None = None) -> DataFrame:
    """Text records, optionally with a weight in the header."""
    head = F.concat(F.lit(">"), F.col(id_col).cast("string"))
    if weight_col:
        head = F.concat(head, F.lit(" "), F.col(weight_col).cast("string"))
    return df.select(F.concat(head, F.lit("\n"), F.col(seq_col)).alias("value"))


def write_fasta(df: DataFrame, path: str, id_col: str = "name", seq_col: str = "seq", weight_col: str | None = None) -> None:
    """Write records as text files."""
    fasta_records(df, id_col, seq_col, weight_col).write.text(path)
