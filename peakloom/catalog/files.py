"""Queries on inputs and outputs: tables are written as the text formats and read back."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..runtime import fresh_path
from ..sources import fasta, gff, motifs as motif_files, sinks, tables
from .base import query, r, rounded
from .views import PFM


def _lines(df, *columns):
    return df.select(F.concat_ws("\t", *[c if not isinstance(c, str) else F.col(c).cast("string") for c in columns]).alias("value"))


@query("read_bed", """SELECT chrom, "start", "end", id::VARCHAR AS name, CASE WHEN id % 2 = 0 THEN summit_offset ELSE ("end" - "start") // 2 END AS summit_offset FROM peaks""")
def _(v):
    summit = F.when(F.col("id") % 2 == 0, F.col("summit_offset").cast("string")).otherwise(F.lit("."))
    return tables.parse_bed(_lines(v.peaks, "chrom", "start", "end", "id", summit))


@query("read_reads", """SELECT chrom, "start", "end", name, strand FROM reads""")
def _(v):
    lines = _lines(v.reads, "chrom", "start", "end", "name", F.lit("0"), "strand")
    return tables.parse_reads(lines).select("chrom", "start", "end", "name", "strand")


@query("read_narrowpeak", f"""SELECT chrom, "start", "end", id::VARCHAR AS name, {r('signal_value', 9)} AS signal_value, summit_offset FROM peaks""")
def _(v):
    dot = F.lit(".")
    lines = _lines(v.peaks, "chrom", "start", "end", "id", F.lit("0"), dot, F.col("signal_value").cast("string"), F.lit("5.5"), F.lit("2.5"), "summit_offset")
    out = tables.parse_narrowpeak(lines).select("chrom", "start", "end", "name", "signal_value", "summit_offset")
    return rounded(out, "signal_value", digits=9)


@query("read_bedgraph", """SELECT chrom, "start", "end", value FROM signal""")
def _(v):
    head = v.sizes.select(F.lit("track type=bedGraph").alias("value"))
    return tables.parse_bedgraph(_lines(v.signal, "chrom", "start", "end", "value").unionByName(head))


@query("read_chrom_sizes", """SELECT sum(length)::BIGINT AS genome_size FROM sizes""")
def _(v):
    return tables.genome_size(tables.parse_chrom_sizes(_lines(v.sizes, "chrom", "length")))


@query("read_fasta", """SELECT seq_id::VARCHAR AS name, md5(seq) AS seq FROM seqs""")
def _(v):
    wrapped = F.regexp_replace("seq", "(.{1,60})", "$1\n")
    records = v.seqs.select(F.concat(F.col("seq_id").cast("string"), F.lit(" a sequence\n"), wrapped).alias("value"))
    return fasta.parse_fasta(records).withColumn("seq", F.md5("seq"))


@query("read_sam_text", """SELECT concat_ws('-', l_orderkey, l_linenumber) AS name, (l_linenumber % 2 * 16)::INT AS flag, 'chr' || (l_suppkey % 5 + 1) AS chrom, l_partkey * 10 AS "start", l_partkey * 10 + 40 + l_suppkey % 20 + l_partkey % 300 AS "end", (l_partkey % 61)::INT AS mapq,
    (l_suppkey % 5)::INT AS mismatches, CASE WHEN l_linenumber % 2 = 1 THEN '-' ELSE '+' END AS strand FROM lineitem""")
def _(v):
    t = v.table("lineitem")
    lines = _lines(
        t, F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")), (F.col("l_linenumber") % 2 * 16).cast("string"),
        F.concat(F.lit("chr"), F.col("l_suppkey") % 5 + 1), (F.col("l_partkey") * 10 + 1).cast("string"), (F.col("l_partkey") % 61).cast("string"),
        F.concat(F.lit("5S30M2I"), F.col("l_suppkey") % 20 + 1, F.lit("M"), F.col("l_partkey") % 300, F.lit("N4D5=3H\t=\t0\t0\t*\t*\tAS:i:0")), F.concat(F.lit("XM:i:"), (F.col("l_suppkey") % 5).cast("string")),
    )
    return tables.parse_sam(lines).select("name", "flag", "chrom", "start", "end", "mapq", "mismatches", "strand")


@query("read_methylation", f"""SELECT chrom, pos, {r('prob')} AS prob FROM methyl""")
def _(v):
    lines = _lines(v.methyl, "chrom", "pos", F.lit("x"), (-F.col("prob")).cast("string"))
    return rounded(tables.parse_methylation(lines), "prob")


@query("read_site_scores", f"""SELECT chrom, "start" AS region_start, "end" AS region_end, (seq_id % 40 + 1)::INT AS pos, '+' AS strand, {r('-seq_id / 7.0::DOUBLE')} AS score FROM spots""")
def _(v):
    name = F.concat(F.col("chrom"), F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    pos = F.col("seq_id") % 40 + 1
    lines = _lines(v.spots, name, pos.cast("string"), (pos + 11).cast("string"), F.lit("+\tACGTACGTACG\tPWM\t11"), (-F.col("seq_id") / 7.0).cast("string"))
    out = tables.parse_site_scores(lines).select("chrom", "region_start", "region_end", "pos", "strand", "score")
    return rounded(out, "score")


@query("read_kmer_hits", """SELECT event_type AS motif, user_id::VARCHAR AS seq_name, value AS score FROM events""")
def _(v):
    lines = _lines(v.table("events"), "event_type", F.lit("0\tk"), "user_id", F.lit("ACGT\t1\tx\t+"), "value")
    head = v.sizes.select(F.lit("## numSequence:5").alias("value")).unionByName(v.sizes.select(F.lit("Motif\tSeqID").alias("value")))
    return tables.parse_kmer_hits(lines.unionByName(head)).select("motif", "seq_name", "score")


@query("read_motif_collection", f"""SELECT 'm' || c_custkey AS motif_id, (i + 1)::INT AS "row", b AS base, c::DOUBLE AS value FROM customer CROSS JOIN (VALUES
    {", ".join(f"({i}, '{b}', {c})" for i, row in enumerate(PFM) for b, c in zip("ACGT", row))}) t(i, b, c)""")
def _(v):
    """One matrix file per customer, all parsed in one job."""
    body = "\n".join("\t".join(str(x) for x in row) for row in PFM)
    text = F.concat(F.lit("MATRIX\tCOUNT\tASYMMETRIC\tm"), F.col("c_custkey").cast("string"), F.lit("\tSIMPLE\nA\tC\tG\tT\n" + body + "\n"))
    files = v.table("customer").select(F.col("c_custkey").cast("string").alias("path"), text.alias("value"))
    return motif_files.parse_motifs(files).select("motif_id", "row", "base", "value")


@query("write_bed", """SELECT chrom, "start", "end", id::VARCHAR AS name FROM peaks""")
def _(v):
    path = fresh_path(v.spark, "peaks-bed")
    sinks.write_bed(v.peaks, path, ["chrom", "start", "end", "id"])
    return tables.read_bed(v.spark, path).select("chrom", "start", "end", "name")


@query("write_tsv", """SELECT chrom, "start", "end", value FROM signal""")
def _(v):
    path = fresh_path(v.spark, "signal-tsv")
    sinks.write_tsv(v.signal.select("chrom", "start", "end", "value"), path, header=True)
    return tables.read_bedgraph(v.spark, path)


@query("write_parquet", """SELECT id, chrom, "start", "end" FROM peaks""")
def _(v):
    path = fresh_path(v.spark, "peaks-parquet")
    sinks.write_parquet(v.peaks.select("id", "chrom", "start", "end"), path)
    return v.spark.read.parquet(path).select("id", "chrom", "start", "end")


@query("write_fasta", """SELECT seq_id::VARCHAR AS name, md5(seq) AS seq FROM seqs""")
def _(v):
    path = fresh_path(v.spark, "seqs-fasta")
    fasta.write_fasta(v.seqs.withColumn("weight", F.length("seq")), path, "seq_id", "seq", "weight")
    return fasta.read_fasta(v.spark, path).withColumn("seq", F.md5("seq"))


@query("read_genome", """SELECT seq_id::VARCHAR AS chrom, k::INT AS chunk_no, k * 1000 AS "offset", md5(substr(seq, k * 1000 + 1, 1000)) AS seq
    FROM (SELECT *, unnest(range(0, (length(seq) + 999) // 1000)) AS k FROM seqs)""")
def _(v):
    path = fresh_path(v.spark, "genome-fasta")
    wrapped = v.seqs.select("seq_id", F.rtrim(F.regexp_replace("seq", "(.{60})", "$1\n")).alias("seq"))
    fasta.write_fasta(wrapped, path, "seq_id", "seq")
    return fasta.read_genome(v.spark, path, 1000).withColumn("seq", F.md5("seq"))


@query("write_gff_hierarchy", """SELECT chrom, unnest(['boundRegion', 'Peak', 'Max']) AS type, unnest(["start", "start", "start" + summit_offset]) AS "start",
    unnest(["end", "end", "start" + summit_offset + 1]) AS "end", unnest(['p' || id, 'p' || id || '.1', 'p' || id || '.1.1']) AS id FROM peaks""")
def _(v):
    path = fresh_path(v.spark, "peaks-gff")
    gff.write_gff_hierarchy(v.peaks.withColumn("name", F.concat(F.lit("p"), "id")), path)
    return gff.read_gff3(v.spark, path).select("chrom", "type", "start", "end", F.col("attributes")["ID"].alias("id"))
