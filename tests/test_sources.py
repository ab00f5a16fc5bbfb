"""Text formats by hand and through files."""

import pytest

from peakloom.operators import motifs as mt
from peakloom.runtime import fresh_path
from peakloom.sources import fasta, gff, motifs, sinks, tables


def lines(spark, *text):
    return spark.createDataFrame([(t,) for t in text], "value string")


def test_bed_defaults(spark):
    df = lines(spark, "track x", "chr\tbegin\tend", "chr1\t10\t21", "chr1\t5\t9\tp\t2", "chr1\t7\t7\tempty", "#c")
    assert [tuple(r) for r in tables.parse_bed(df).orderBy("start").collect()] == [("chr1", 5, 9, "p", 2), ("chr1", 10, 21, None, 5)]


def test_sam_tags_and_missing(spark):
    df = lines(spark, "@HD\tx", "r1\t99\tchr1\t101\t42\t5M\t=\t0\t-180\tACGTA\t*\tXM:i:1\tNM:i:2", "r2\t16\tchr2\t7\t3\t*\t*\t0\t0\t*\t*")
    a, b = tables.parse_sam(df).orderBy("name").collect()
    assert (a.start, a.end, a.mismatches, a.tlen, a.strand, a.tags["NM"]) == (100, 105, 1, -180, "+", "2")
    assert (b.start, b.mismatches, b.strand) == (6, None, "-")


def test_gff_coordinates(spark):
    row = gff.parse_gff3(lines(spark, "##gff", "Chr1\ts\tgene\t11\t20\t.\t+\t.\tID=g1;Name=n;")).first()
    assert (row.start, row.end, row.attributes) == (10, 20, {"ID": "g1", "Name": "n"})


def test_fasta_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 first\nACGn\nTT\n>s2\nGG\n")
    got = {r.name: r.seq for r in fasta.read_fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert got == {"s1": "ACG-TT", "s2": "GG"}


MATRIX = "MATRIX\tCOUNT\tSYMMETRIC\tdemo\tDEPENDENCY\nA\tC\tG\tT\n1\t2\t3\t4\n5\t6\t7\t8\n2\t2\t2\t2\nDEPENDENCY (2 3)\n" + "".join(
    f"A{b}\t{i + 1}\t1\t1\t1\n" for i, b in enumerate("ACGT")
)


def test_motif_files(spark, tmp_path):
    (tmp_path / "good.pfm").write_text(MATRIX)
    got = motifs.read_motif_collection(spark, str(tmp_path / "*.pfm"))
    models = mt.collect_models(got)
    assert [(m.motif_id, m.symmetric, m.length) for m in models] == [("demo", True, 3)]
    (positions, table), = models[0].blocks
    assert positions == [2, 3] and list(table[:8]) == [1, 1, 1, 1, 2, 1, 1, 1]
    (tmp_path / "bad.pfm").write_text("MATRIX\tODD\tSYMMETRIC\tx\tSIMPLE\nA\tC\tG\tT\n1\t1\t1\t1\n")
    with pytest.raises(ValueError, match="unknown matrix kind"):
        motifs.read_motif_collection(spark, str(tmp_path / "*.pfm"))


def test_bed_output_is_sorted(spark):
    df = spark.createDataFrame([("chr2", 5, 9), ("chr1", 30, 40), ("chr1", 4, 8)], "chrom string, start long, end long")
    path = fresh_path(spark, "bed")
    sinks.write_bed(df, path)
    assert [r.value for r in spark.read.text(path).coalesce(1).collect()] == ["chr1\t4\t8", "chr1\t30\t40", "chr2\t5\t9"]
