"""Packed lists of points, the sites they are read for, and sequences cut beside their rows."""

import math
import random

import numpy as np
import pyarrow as pa

from peakloom.operators import points
from peakloom.operators.motifs import best_site, leading_sites
from peakloom.operators.reports import lookup_value, peak_site_methylation_table
from peakloom.operators.sequences import extract_sequences


def test_lists_give_back_their_points():
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(-50, 400), rng.choice([None, float("nan"), 0.5, -1.0])) for _ in range(3000)]
    table = pa.table({"chrom": [r[0] for r in rows], "pos": [r[1] for r in rows], "_v": pa.array([r[2] for r in rows], pa.float64())})
    batch = points._lists(table, 128, 10)
    order = lambda v: (v is not None, v is not None and math.isnan(v), v if v is not None and not math.isnan(v) else 0)
    for chrom, tile, entry in zip(*(batch.column(i).to_pylist() for i in range(3))):
        place, value = points.unpacked([entry], pa.float64())
        want = sorted(((p - tile * 128, order(v)) for c, p, v in rows if c == chrom and tile * 128 <= p < (tile + 1) * 128 + 10))
        assert list(zip(place.tolist(), map(order, value.to_pylist()))) == want
    assert np.array_equal(points._numbers(points._numbers_packed(np.array([0, 7, 70000, 2**32 - 1]))), [0, 7, 70000, 2**32 - 1])


def test_a_value_is_shuffled_once_and_an_array_never(spark):
    regions = spark.range(40).selectExpr("concat('a', id div 1000) AS chrom", "id * 300 AS start", "id * 300 + 300 AS end", "id")
    table = spark.range(12000).selectExpr("concat('a', id div 100000) AS chrom", "id + 1 AS pos", "id % 7 / 7D AS prob")
    found = lookup_value(regions, table)
    assert {r["id"]: r["values"] for r in found.collect()} == {i: [(i * 300 + k) % 7 / 7 for k in range(300)] for i in range(40)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    # One exchange of the lists and one of the sites; before, lists came by task and tile, then by tile, and arrays by site.
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("Exchange hashpartitioning") == 2


def test_leading_sites_leave_the_best(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), rng.randrange(1, 40), rng.choice("+-"), rng.choice([None, float("nan"), -0.0, 0.0, -2.5, float("-inf")]) if i % 3 else -2.5, "ACGT") for i in range(2000)]
    rows += [(9, 5, "-", None, "A"), (9, 4, "+", None, "C"), (8, 5, "-", -1.0, "A"), (8, 5, "+", -1.0, "C")]
    df = spark.createDataFrame(rows, "seq_id long, pos int, strand string, score double, kmer string").repartition(3)
    led = leading_sites(df, ["seq_id"])
    slim = ("seq_id", "pos", "strand")
    assert sorted(map(str, best_site(led, ["seq_id"]).select(*slim).collect())) == sorted(map(str, best_site(df, ["seq_id"]).select(*slim).collect()))
    assert led.count() < df.count()


def test_sequences_of_chunks_that_come_twice(spark):
    genome = spark.createDataFrame([("a", 0, 0, "ACGT"), ("a", 1, 4, "GGTA"), ("a", 1, 4, "CCTA"), ("b", 0, 0, "TTTT")], "chrom string, chunk_no int, offset long, seq string")
    spans = [("a", 1, 3), ("a", 1, 3), ("a", 2, 6), ("a", 5, 7), ("b", 3, 9), ("b", 8, 9), ("b", 2, 2), (None, 0, 2), ("b", -2, 2)]
    got = extract_sequences(spark.createDataFrame(spans, "chrom string, start long, end long"), genome, 4)
    assert sorted(map(tuple, got.collect())) == [("a", 1, 3, "CG"), ("a", 1, 3, "CG"), ("a", 2, 6, "GTCCGG"), ("a", 5, 7, "CTGT"), ("b", -2, 2, "TT"), ("b", 3, 9, "T")]
    plan = extract_sequences(spark.createDataFrame(spans[:2], "chrom string, start long, end long"), genome, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "_parted" in plan


def test_methylation_table_counts_and_looks_up(spark):
    peaks = spark.createDataFrame([(1, "a", 10, 16, "ACGTCG"), (2, "a", 30, 33, "AAA"), (2, "a", 30, 33, "AAA")], "seq_id long, chrom string, start long, end long, seq string")
    sites = spark.createDataFrame([(1, 2, "+", "CG", 2, 5.0), (1, 5, "-", "CG", 2, 5.0), (1, 1, "+", "AC", 2, 4.0)], "seq_id long, pos int, strand string, kmer string, motif_len int, score double")
    methyl = spark.createDataFrame([("a", 12, 0.9), ("a", 13, 0.1), ("a", 16, 0.8)], "chrom string, pos long, prob double")
    got = peak_site_methylation_table(peaks, sites, methyl, 0.0)
    assert got.columns == ["seq_id", "chrom", "start", "end", "seq", "meth_sites", "cg_count", "site_score", "site_start", "site_end", "site_strand", "motif_seq", "meth_sites_in_motif", "base_probs"]
    rows = sorted(map(tuple, got.select("seq_id", "meth_sites", "cg_count", "site_start", "site_end", "meth_sites_in_motif", "base_probs").collect()), key=str)
    assert rows == [(1, 2, 4, 11, 13, 1, [0.9, 0.1]), (2, 0, 0, None, None, None, None), (2, 0, 0, None, None, None, None)]


def test_the_table_of_correlations_is_made_once(spark):
    from pyspark.sql import functions as F

    from peakloom.operators.reports import methylation_correlations

    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def ratio(n):
        made.add(1)
        return n / 7

    rows = [(i, 0, 10, 5.0, i % 4, i % 3, "ACGT"[i % 4] + "CG", [0.1 * i, 0.2, 0.3 * (i % 5)], "+-"[i % 2]) for i in range(24)]
    table = spark.createDataFrame(rows, "n long, start long, end long, site_score double, meth_sites long, meth_sites_in_motif long, motif_seq string, base_probs array<double>, site_strand string")
    for symmetric in (False, True):
        made.value = 0
        found = methylation_correlations(table.withColumn("log_ratio", ratio("n")), symmetric=symmetric)
        assert {"peak_density", "site_count"} < {r["what"] for r in found.collect()}
        assert made.value == len(rows)
