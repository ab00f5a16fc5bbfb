"""What is read several times is made once."""

from pyspark.sql import functions as F

from peakloom.operators import sampling


def test_sizes_of_a_bin_library_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def length(n):
        made.add(1)
        return n

    sizes = spark.createDataFrame([("a", 40), ("b", 30)], "chrom string, n long").select("chrom", length("n").alias("length"))
    annotation = spark.createDataFrame([("a", 0, 20, "exon"), ("b", 0, 30, "intron")], "chrom string, start long, end long, type string")
    genome = spark.createDataFrame([("a", 0, 0, "ACGT" * 10), ("b", 0, 0, "ACGTA" * 6)], "chrom string, chunk_no int, offset long, seq string")
    near = spark.createDataFrame([("b", 1, 4)], "chrom string, start long, end long")
    bins = sampling.genome_bin_library(sizes, annotation, genome, 10, near)
    rows = sorted((r.chrom, r.start, r.type) for r in bins.collect())
    assert rows == [("a", 0, "exon"), ("a", 10, "exon"), ("a", 20, "intergenic"), ("a", 30, "intergenic"), ("b", 10, "intron"), ("b", 20, "intron")]
    assert made.value == 2
