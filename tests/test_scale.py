"""Ranks without one task, exact tails, and ordinary input that once stopped a job."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom import runtime
from peakloom.functions.tails import beta_tail, gamma_tail
from peakloom.operators import evaluation as ev, normalise as nm, sequences as sq, spacing as sp
from peakloom.operators.scans import ranked


def test_rank_with_a_value_shared_by_a_third(spark):
    rows = [(i, 1.0 if i % 3 == 0 else float(i % 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v double")
    got = {r["id"]: r["rank"] for r in ranked(df, [], [F.col("v"), F.col("id")]).collect()}
    want = {i: n for n, (v, i) in enumerate(sorted((v, i) for i, v in rows), 1)}
    assert got == want
    keyed = {(r["k"], r["id"]): r["rank"] for r in ranked(df.withColumn("k", F.col("id") % 2), ["k"], [F.col("v"), F.col("id")]).collect()}
    for k in (0, 1):
        order = sorted((v, i) for i, v in rows if i % 2 == k)
        assert all(keyed[k, i] == n for n, (_, i) in enumerate(order, 1))


def test_rank_never_gathers_rows_in_one_task(spark):
    df = spark.range(2000).select("id", (F.col("id") % 7).cast("double").alias("v"))
    out = nm.ratio_deciles(df, "v", "id")
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString()
    # One row a partition, or one total, may meet in one task; rows do not: no sort of ids stands above such an exchange.
    for sort in re.findall(r"Window \[.*", text):
        assert "_o1" not in sort or "_part" in sort


def test_deciles_keep_rows_without_a_value(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else float(i)) for i in range(40)], "id long, v double")
    out = nm.ratio_deciles(df, "v", "id").collect()
    assert len(out) == 40 and sum(r["decile"] is None for r in out) == 10


def test_group_trend_keeps_the_last_group(spark):
    df = spark.createDataFrame([(i, 1.0 + i, i % 2) for i in range(104)], "id long, s double, f int")
    out = nm.group_trend(df, "s", "f", "id", groups=10).collect()
    assert len(out) == 11 and [r["full"] for r in sorted(out, key=lambda r: r["group"])] == [True] * 10 + [False]


def test_rank_pair_keeps_the_longer_set(spark):
    df = spark.createDataFrame([(i, int(i < 7), float(i)) for i in range(10)], "seq_id long, label int, score double")
    out = ev.rank_pair(df).orderBy("rank").collect()
    assert len(out) == 7 and [r["negative"] for r in out][3:] == [None] * 4


@pytest.mark.parametrize("mean", [0.5, 3.0, 40.0, 1500.0])
def test_poisson_tail_by_sums(mean):
    ks = np.arange(1, int(mean + 20 * math.sqrt(mean)) + 5)
    terms = np.exp(np.arange(0, 4 * len(ks) + 200) * math.log(mean) - mean - np.array([math.lgamma(i + 1) for i in range(0, 4 * len(ks) + 200)]))
    want = np.array([terms[k:].sum() for k in ks])
    assert np.allclose(gamma_tail(ks.astype(float), np.full(len(ks), mean)), want, rtol=1e-9, atol=1e-13)


@pytest.mark.parametrize("mean", [1e5, 1e6, 1e7, 1e8])
def test_poisson_tail_at_depth(mean):
    for z in (-2.0, 0.0, 1.0, 3.0):
        k = round(mean + z * math.sqrt(mean))
        h = (k - 0.5 - mean) / math.sqrt(mean)
        want = 0.5 * math.erfc(h / math.sqrt(2)) + (h * h - 1) / (6 * math.sqrt(2 * math.pi * mean)) * math.exp(-h * h / 2)
        assert gamma_tail(np.array([float(k)]), np.array([mean]))[0] == pytest.approx(want, rel=2e-3 / math.log10(mean))


def test_student_tail_at_many_degrees():
    for t in (0.5, 2.0, 4.0):
        got = beta_tail(np.array([1e9 / (1e9 + t * t)]), np.array([5e8]), np.array([0.5]))[0]
        assert got == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-4)


def test_division_by_nothing(spark):
    counts = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (1, "b", 3), (2, "b", 5)], "id int, sample string, count long")
    assert [r["cpm"] is None for r in nm.cpm(counts).orderBy("sample", "id").collect()] == [True, True, False, False]
    two = spark.createDataFrame([(1.0, 0.0), (0.0, 2.0), (4.0, 2.0)], "a double, b double")
    assert [r["log2fc"] for r in nm.ma_table(two, "a", "b").collect()] == [None, None, 1.0]
    line = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, y double")
    r = nm.correlation_test(line, "x", "y").first()
    assert r["r"] == pytest.approx(1) and r["p_value"] == pytest.approx(0, abs=1e-12)
    single = spark.createDataFrame([(1, "x", 3.0), (1, "y", 4.0), (1, "y", 5.0)], "peak_id int, g string, cpm double")
    assert nm.differential_counts(single, "g", "x", "y").first()["p_value"] is None
    only = spark.createDataFrame([("m", 1, 0.5), ("m", 1, 0.7)], "model string, label int, score double")
    assert ev.multi_model_roc(only).first()["auc"] is None


def test_unlabelled_sequences_are_not_negatives(spark):
    df = spark.createDataFrame([(1, "ACGTACGT"), (0, "TTTTTTTT"), (None, "ACGTACGT"), (None, "ACGTACGT")], "label int, seq string")
    assert max(r["neg"] for r in sq.kmer_enrichment(df, "label", 4, 4, top=50).collect()) <= 1


def test_spacings_of_one_class_stay(spark):
    schema = "threshold double, conf string, space int, n long"
    pos = spark.createDataFrame([(0.0, "DR", 1, 3), (0.0, "DR", 2, 1)], schema)
    neg = spark.createDataFrame([(0.0, "DR", 1, 2), (0.0, "DR", 5, 2)], schema)
    out = {r["space"]: r["enrichment"] for r in sp.relative_enrichment(pos, neg).where("conf = 'DR'").collect()}
    assert out == {1: 1.5, 2: None, 5: None}


def test_shared_folder_is_asked_for_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "a"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        runtime.shared_dir(Session())


def test_pieces_of_long_sequences_scan_alike():
    import numpy as np
    import pyarrow as pa

    from peakloom.operators.motifs import Model, _scan_batches

    draw = np.random.default_rng(3)
    seqs = ["".join(draw.choice(list("ACGTN"), n)) for n in (0, 3, 5, 64, 65, 130, 700)]
    models = [Model("a", False, draw.normal(size=(6, 4))), Model("b", True, draw.normal(size=(3, 4)))]
    batch = pa.record_batch({"id": pa.array(range(len(seqs))), "seq": pa.array(seqs)})

    def found(bases):
        out = []
        for model, strand, ids, offsets, data, home, at, score, short in _scan_batches([batch], models, None, bases):
            out += [(model.motif_id, strand, int(ids[h]), int(p - offsets[h]), float(x)) for h, p, x in zip(home[at], at, score[at])]
            out += [(model.motif_id, strand, int(ids[i]), -1, 0.0) for i in short]
        return sorted(out)

    whole = found(1 << 21)
    assert len(whole) > 2000 and found(64) == whole and found(7) == whole


def test_look_ahead_drops_no_site():
    import numpy as np
    import pyarrow as pa

    from peakloom.operators.motifs import Model, _scan_batches

    draw = np.random.default_rng(8)
    seqs = ["".join(draw.choice(list("ACGTacgtN"), n)) for n in (0, 4, 9, 300, 2000)]
    whole_numbers = np.round(draw.normal(size=(9, 4)) * 3)
    barred = draw.normal(size=(8, 4))
    barred[2, 1] = -np.inf
    models = [
        Model("long", False, draw.normal(size=(17, 4))), Model("short", True, draw.normal(size=(3, 4))),
        Model("ties", False, whole_numbers), Model("barred", False, barred), Model("large", False, draw.normal(size=(7, 4)) * 1e9),
        Model("pairs", False, draw.normal(size=(10, 4)), [([3, 4], draw.normal(size=16)), ([6, 8, 9], draw.normal(size=64))]),
        Model("only", False, draw.normal(size=(2, 4)), [([1, 2], draw.normal(size=16))]), Model("ties", False, -whole_numbers),
    ]
    batch = pa.record_batch({"id": pa.array(range(len(seqs))), "seq": pa.array(seqs)})

    def found(threshold):
        return [
            [(strand, int(ids[h]), int(p - offsets[h]), float(x)) for h, p, x in zip(home[at], at, score[at])]
            for _, strand, ids, offsets, _, home, at, score, _ in _scan_batches([batch], models, threshold)
        ]

    every = found(None)
    for threshold in (-1e9, -999.0, -30.0, -3.0, 0.0, 3.0, 5.0, 1e9, 1e10):
        assert found(threshold) == [[site for site in sites if site[3] > threshold] for sites in every]
    assert sum(map(len, found(3.0))) > 100


def test_chunks_join_to_the_sequence(spark):
    from peakloom.operators.sequences import chunk_sequences

    seqs = [("a", "ACGT" * 25), ("b", "A"), ("c", ""), ("d", None), ("e", "ACGTACG")]
    got = chunk_sequences(spark.createDataFrame(seqs, "id string, seq string"), "id", "seq", 7).collect()
    for name, seq in seqs:
        mine = sorted((r.offset, r.seq) for r in got if r.chrom == name)
        assert "".join(x for _, x in mine) == (seq or "") and all(len(x) <= 7 and o % 7 == 0 for o, x in mine)


@pytest.mark.parametrize("tile", [64, 1 << 16])
def test_complex_clusters_against_one_walk(spark, monkeypatch, tile):
    import random

    from peakloom.operators import peaks

    monkeypatch.setattr(peaks, "TILE", tile)
    draw, rows = random.Random(5), []
    for chrom, n, span in (("chr1", 300, 9000), ("chr2", 60, 900), ("chr3", 2, 50)):
        rows += [(chrom, max(0, s - 400), s + 400, s) for s in (draw.randrange(span) + 500 for _ in range(n))]
    rows += [("chr4", 0, 800, 300)] * 5
    for size in (90, 200):
        want = []
        for chrom in ("chr1", "chr2", "chr4"):
            groups = []
            for s in sorted(r[3] for r in rows if r[0] == chrom):
                if not groups or s - groups[-1][0] > size:
                    groups.append([s])
                else:
                    groups[-1].append(s)
            want += [(chrom, max(sum(g) // len(g) - size, 0), sum(g) // len(g) + size, len(g)) for g in groups]
        df = spark.createDataFrame(rows, "chrom string, start long, end long, summit long")
        assert sorted(map(tuple, peaks.split_complex_clusters(df, size, 3).collect())) == sorted(want)


def test_no_member_of_a_chain_is_lost(spark):
    from peakloom.operators.peaks import merge_n_sets

    rows = [("chr1", i * 100, i * 100 + 200, "M" if i == 3 else "AB"[i % 2], 100) for i in range(7)]
    got = merge_n_sets(spark.createDataFrame(rows, "chrom string, start long, end long, set string, summit_offset long"), 0.5).collect()
    assert any("M" in r.name.split("&") for r in got) and all(r.start >= 0 for r in got)


def test_what_finds_no_place_stays(spark):
    from peakloom.operators.sampling import matched_negatives, split_top
    from peakloom.operators.segments import shuffle_intervals

    sizes = spark.createDataFrame([("chr1", 500)], "chrom string, length long")
    df = spark.createDataFrame([(1, "chr1", 0, 100), (2, "chr1", 0, 900), (3, "chr9", 0, 10)], "id long, chrom string, start long, end long")
    got = {r.id: r for r in shuffle_intervals(df, sizes, 1).collect()}
    assert got[1].end - got[1].start == 100 and got[2].start is None and got[3].end is None
    within = spark.createDataFrame([("chr1", 100, 300)], "chrom string, start long, end long")
    got = {r.id: r for r in shuffle_intervals(df, sizes, 1, within).collect()}
    assert 100 <= got[1].start <= 200 and got[2].start is None and got[3].start is None

    lib = spark.createDataFrame([("chr1", i * 200, i * 200 + 200, "exon", 0.5) for i in range(2)], "chrom string, start long, end long, type string, gc double")
    pos = spark.createDataFrame([(i, "exon", 0.5) for i in range(3)], "id long, type string, gc double")
    got = matched_negatives(pos, lib, 1).collect()
    assert sorted(r.id for r in got) == [0, 1, 2] and sorted(r.round == "none" for r in got) == [False, False, True]
    assert split_top(pos, 2, "gc", "id").count() == 3 and split_top(pos, 2, "gc", "id", reuse_train=True).count() == 5


def test_alignment_ends_follow_the_cigar(spark):
    from peakloom.sources.tables import parse_sam

    line = "r{}\t0\tchr1\t11\t9\t{}\t*\t0\t0\t{}\t*"
    cases = [("10M", "*", 20), ("3S10M2I5D4N2H", "*", 29), ("4=1X", "*", 15), ("*", "ACGT", 14), ("*", "*", 11)]
    got = parse_sam(spark.createDataFrame([(line.format(i, c, s),) for i, (c, s, _) in enumerate(cases)], "value string")).orderBy("name").collect()
    assert [r.end for r in got] == [e for *_, e in cases]


def test_distances_of_sites(spark):
    from peakloom.operators.spacing import cooccurrence_distances

    rows = [(1, "a", 10, 16), (1, "b", 20, 26), (1, "b", 20, 26), (1, "b", 13, 19), (1, "b", 500, 506), (2, "a", 100, 106), (2, "b", 90, 96), (1, "a", 5000, 5006)]
    df = spark.createDataFrame(rows, "seq_id long, motif_id string, pos long, stop long")
    assert sorted(map(tuple, cooccurrence_distances(df, 0, 50).collect())) == [("a", "b", 4, 3)]
    assert sorted(map(tuple, cooccurrence_distances(df, -6, 600).collect())) == [("a", "b", -3, 1), ("a", "b", 4, 3), ("a", "b", 484, 1)]


def test_sites_are_not_sent_whole_to_meet(spark, tmp_path):
    from peakloom.operators.spacing import site_pairs

    # Small on disk, so that Spark would broadcast it.
    spark.range(0, 3000, 1, 2).selectExpr("id % 7 AS seq_id", "cast(id AS int) AS pos", "'+' AS strand", "1D AS score").write.parquet(str(tmp_path / "s"))
    pairs = site_pairs(spark.read.parquet(str(tmp_path / "s")), 7)
    assert pairs.count() == 2993
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
