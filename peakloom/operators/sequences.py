"""Sequence tables: extraction from a chunked genome, GC, k-mers, encodings, labels."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.codes import kmer_codes, slices
from ..functions.dna import gc_content, reverse_complement

#: Bases per genome row.
CHUNK = 1 << 14


def _cut(seq: Column, size: int, piece: Callable[[Column, Column], Column]) -> Column:
    """Array of ``piece(number, letters)`` for every ``size`` letters.

    Pieces are taken from the bytes, whose offsets are known; offsets in a string are found from its start.
    """
    numbers = F.sequence(F.lit(0), F.floor((F.length(seq) - 1) / size).cast("int"))
    of = lambda b: F.transform(numbers, lambda i: piece(i, F.substring(b, i * size + 1, F.lit(size)).cast("string")))
    return F.flatten(F.transform(F.array(seq.cast("binary")), of))


def chunk_sequences(df: DataFrame, id_col: str, seq_col: str, size: int = CHUNK) -> DataFrame:
    """Cut long sequences (ASCII letters) into rows ``(chrom, chunk_no, offset, seq)``."""
    pieces = _cut(F.col(seq_col), size, lambda i, piece: F.struct(i.alias("chunk_no"), piece.alias("seq")))
    return (
        df.where(F.length(seq_col) > 0)
        .select(F.col(id_col).cast("string").alias("chrom"), F.explode(pieces).alias("p"))
        .select("chrom", "p.chunk_no", (F.col("p.chunk_no") * F.lit(size).cast("long")).alias("offset"), "p.seq")
    )


def extract_sequences(
    intervals: DataFrame, genome: DataFrame, size: int = CHUNK, stranded: bool = False
) -> DataFrame:
    """Add ``seq`` for each interval from a genome cut by :func:`chunk_sequences`.

    An interval that leaves its chromosome gets the part that exists; one wholly outside
    is dropped.  With ``stranded`` minus-strand intervals are reverse-complemented.

    What lies in one chunk is cut from it beside its row; only pieces of several chunks are shuffled and put together.
    """
    first, last = F.floor(F.col("start") / size).cast("int"), F.floor((F.col("end") - 1) / size).cast("int")
    # A chunk that is there several times is no single piece.
    chunks = genome.withColumn("_copies", F.count(F.lit(1)).over(W.partitionBy("chrom", "chunk_no")))
    low = F.greatest(F.col("start") - F.col("offset"), F.lit(0))
    high = F.least(F.col("end") - F.col("offset"), F.lit(size))
    # Taken from the bytes (letters are ASCII): a place in a string is found from its start.
    piece = F.substring(F.col("_letters").cast("binary"), (low + 1).cast("int"), (high - low).cast("int")).cast("string")
    letters = chunks.select("chrom", "chunk_no", "offset", F.col("seq").alias("_letters"), "_copies")
    near = intervals.where(first == last).withColumn("chunk_no", first).join(letters.where("_copies = 1"), ["chrom", "chunk_no"])
    cut = near.select(*[F.col(c) for c in intervals.columns], piece.alias("seq"))

    touched = intervals.select("chrom", "start", "end").distinct().withColumn("_parted", first != last).withColumn("chunk_no", F.explode(F.sequence(first, last)))
    pieces = touched.join(letters, ["chrom", "chunk_no"]).where("_parted OR _copies > 1").select("chrom", "start", "end", "chunk_no", piece.alias("piece"))
    # An interval spans few chunks, so the list per interval is short.
    whole = pieces.groupBy("chrom", "start", "end").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "piece"))), lambda x: x["piece"]), ""
        ).alias("seq")
    )
    joined = intervals.join(whole, ["chrom", "start", "end"]).select(*intervals.columns, "seq")
    out = cut.unionByName(joined).where(F.length("seq") > 0)
    if stranded:
        out = out.withColumn(
            "seq", F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
        )
    return out.select(*intervals.columns, "seq")


def with_gc(df: DataFrame, digits: int = 2) -> DataFrame:
    """Add ``gc`` and drop sequences that are cut off or hold other letters than ACGT."""
    out = df.withColumn("gc", gc_content(F.col("seq"), digits)).where("gc is not null")
    if "start" in df.columns:
        out = out.where(F.length("seq") == F.col("end") - F.col("start"))
    return out


def augment_rc(df: DataFrame, min_length: int = 0) -> DataFrame:
    """Each sequence and its reverse complement, in rows marked ``+`` and ``-``."""
    both = F.array(
        F.struct(F.lit("+").alias("strand"), F.col("seq").alias("s")),
        F.struct(F.lit("-").alias("strand"), reverse_complement(F.col("seq")).alias("s")),
    )
    rest = [c for c in df.columns if c not in ("seq", "strand")]
    return (
        df.where(F.length("seq") >= min_length).withColumn("_b", F.explode(both))
        .select(*rest, F.col("_b.strand").alias("strand"), F.col("_b.s").alias("seq"))
    )


def one_hot(df: DataFrame, size: int, seq_col: str = "seq") -> DataFrame:
    """4 x ``size`` encodings of the sequence and of its reverse complement, padded with N.

    A longer sequence is cut into consecutive windows of ``size`` so that all of it is encoded.
    """
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.length(seq_col) - 1) / size).cast("int")),
        lambda i: F.struct(
            i.alias("window"),
            F.rpad(F.substring(F.col(seq_col), i * size + 1, F.lit(size)), size, "N").alias("s"),
        ),
    )
    wide = df.where(F.length(seq_col) > 0).withColumn("_w", F.explode(cut))
    letters = F.split(F.col("_w.s"), "")
    is_base = lambda b: lambda x: F.when(x == b, F.lit(1.0)).otherwise(F.lit(0.0)).cast("float")
    hot = lambda s: F.array(*[F.transform(s, is_base(b)) for b in "ACGT"])
    rc = F.split(reverse_complement(F.col("_w.s")), "")
    return wide.select(*df.columns, F.col("_w.window").alias("window"), hot(letters).alias("forward"), hot(rc).alias("reverse"))


def kmer_enrichment(
    df: DataFrame, label: str, kmin: int, kmax: int, top: int = 5
) -> DataFrame:
    """The ``top`` k-mers whose share of positive sequences most exceeds that of negatives.

    One row of ``df`` is one sequence.  Counted by sequences that hold the k-mer; score is
    log2 of the ratio of shares with a pseudo-count of one sequence.  k is at most 31.  Rows labelled
    neither 1 nor 0 are not looked at.
    """
    df = df.where(F.col(label).isin(0, 1))
    totals = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    pos_n = totals.agg(
        F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("pos_n"), F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("neg_n")
    )
    source = df.select(F.col(label).cast("long").alias("label"), "seq")

    def count(batches):
        for batch in batches:
            for labels, offsets, data in slices(batch):
                for k in range(kmin, kmax + 1):
                    owner, code = kmer_codes(data, offsets, k)
                    # each k-mer once per sequence, then sequences per k-mer and label
                    order = np.lexsort((code, owner))
                    owner, code = owner[order], code[order]
                    fresh = np.ones(len(code), bool)
                    fresh[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
                    hit = labels[owner[fresh]] == 1
                    words, at = np.unique(code[fresh], return_inverse=True)
                    pos = np.bincount(at, hit, len(words)).astype(np.int64)
                    neg = np.bincount(at, ~hit, len(words)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(words), k, np.int32)), pa.array(words), pa.array(pos), pa.array(neg)],
                        names=["k", "code", "pos", "neg"],
                    )

    seen = source.mapInArrow(count, "k int, code long, pos long, neg long")
    counts = seen.groupBy("k", "code").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).crossJoin(F.broadcast(pos_n))
    # a base-4 number reads as letters after conversion to that base
    digits = F.lpad(F.conv(F.col("code").cast("string"), 10, 4), F.col("k"), F.lit("0"))
    letters = F.translate(digits, "0123", "ACGT")
    share = ((F.col("pos") + 1) / (F.col("pos_n") + 1)) / ((F.col("neg") + 1) / (F.col("neg_n") + 1))
    scored = counts.select("k", "code", "pos", "neg", F.round(F.log2(share), 9).alias("enrichment"))
    best = scored.orderBy(F.desc("enrichment"), F.desc("pos"), "k", "code").limit(top)
    return best.select(letters.alias("kmer"), "pos", "neg", "enrichment")


def kmer_score_sequences(sequences: DataFrame, hits: DataFrame, id_col: str, method: str = "SUM") -> DataFrame:
    """SUM, BEST or MEAN of the hit scores of each sequence; without hits 0."""
    fn = {"SUM": F.sum, "BEST": F.max, "MEAN": F.avg}[method.upper()]
    scored = hits.groupBy(id_col).agg(fn("score").alias("_s"))
    return sequences.join(scored, id_col, "left").select(
        *sequences.columns, F.coalesce("_s", F.lit(0.0)).alias("kmer_score")
    )


def labelled_sequences(positives: DataFrame, negatives: DataFrame, genome: DataFrame, size: int = CHUNK) -> DataFrame:
    """``label, seq, chrom, start, end`` rows for training."""
    tagged = positives.select("chrom", "start", "end", F.lit(1).alias("label")).unionByName(
        negatives.select("chrom", "start", "end", F.lit(0).alias("label"))
    )
    return extract_sequences(tagged, genome, size).select("label", "seq", "chrom", "start", "end")
