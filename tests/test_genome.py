"""Genomes read by byte ranges beside the reader of whole records."""

import random

from peakloom.operators.sequences import chunk_sequences
from peakloom.sources import fasta


def write(path, records, width, draw, end="\n"):
    with open(path, "w", newline="") as out:
        for name, seq in records:
            out.write(f">{name} of {len(seq)}{end}")
            for k in range(0, len(seq), width):
                out.write(seq[k : k + width] + end)
            if draw.random() < 0.3:
                out.write(end)


def test_genome_by_byte_ranges(spark, tmp_path):
    draw = random.Random(6)
    make = lambda n: "".join(draw.choice("ACGTacgtNn") for _ in range(n))
    first = [("chr1", make(260_000)), ("empty", ""), *[(f"s{k}", make(draw.randint(1, 400))) for k in range(200)], ("chr2", make(90_000))]
    write(tmp_path / "a.fa", first, 60, draw)
    second = [("chrX", make(50_000)), ("tiny", "a")]
    write(tmp_path / "b.fa", second, 71, draw, "\r\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        for size, paths in ((1000, "a.fa"), (16_384, "*.fa"), (7, "b.fa")):
            got = fasta.read_genome(spark, str(tmp_path / paths), size)
            assert spark.read.text(str(tmp_path / paths)).rdd.getNumPartitions() > (1 if size == 7 else 15)
            want = chunk_sequences(fasta.read_fasta(spark, str(tmp_path / paths)), "name", "seq", size)
            assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
            plain = [(n, k // size, k, s[k : k + size].upper().replace("N", "-")) for n, s in (first if paths == "a.fa" else second if paths == "b.fa" else first + second) for k in range(0, len(s), size)]
            assert sorted(map(tuple, got.collect())) == sorted(plain)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_genome_odd_files(spark, tmp_path):
    (tmp_path / "odd.fa").write_text("AAAA\n>a x > y\nAC GT\n\n>a\nTT\n>\nG\n>b")
    got = sorted(map(tuple, fasta.read_genome(spark, str(tmp_path / "odd.fa"), 3).collect()))
    assert got == [("", 0, 0, "G"), ("a", 0, 0, "ACG"), ("a", 0, 0, "TT"), ("a", 1, 3, "T")]
    (tmp_path / "none.fa").write_text("")
    assert fasta.read_genome(spark, str(tmp_path / "none.fa")).count() == 0
