"""Letters of texts as bases, pieces of sequences and types of bins."""

import random

from pyspark.sql import functions as F

from peakloom.catalog import views
from peakloom.operators import sampling, sequences


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_letters_are_read_by_the_byte(spark):
    texts = [None, "", " ", "Zz-aB9", "Äpfel über naïve 日本語 İı tail", "a\x00b퟿c\n\t", "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    before = F.translate(F.regexp_replace("text", "[^A-Za-z]", ""), views.LETTERS, views.BASES)
    got = df.select("doc_id", views.to_bases("text").alias("a"), before.alias("b")).collect()
    assert len(got) == len(texts) and all(r.a == r.b for r in got)


def test_pieces_are_cut_from_bytes(spark):
    seq = "".join(random.Random(1).choices("ACGTN", k=100))
    genome = sequences.chunk_sequences(spark.createDataFrame([("c", seq)], "id string, seq string"), "id", "seq", 16)
    spans = [(0, 100), (3, 5), (15, 33), (90, 130), (100, 120), (7, 7), (32, 48)]
    got = sequences.extract_sequences(spark.createDataFrame([("c", a, z) for a, z in spans], "chrom string, start long, end long"), genome, 16)
    assert "as binary), cast(" in plan_of(got)
    assert {(r.start, r.end): r.seq for r in got.collect()} == {(a, z): seq[a:z] for a, z in spans if seq[a:z]}


def test_types_are_counted_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    bins = spark.createDataFrame([("exon",)] * 5 + [("5UTR;exon",)] * 2 + [("intron",)], "type string").mapInArrow(seen, "type string")
    got = {r.type: r.simple for r in sampling.simplify_types(bins, min_bins=3).collect()}
    assert got == {"exon": "exon", "5UTR;exon": "exon", "intron": "intergenic"} and read.value == 8
