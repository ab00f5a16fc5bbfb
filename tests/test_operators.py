"""Operators against hand-computed tables and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom.functions import tails
from peakloom.operators import evaluation, motifs, normalise, overlap, peaks, sampling, scans, segments, spacing


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


@pytest.fixture(scope="module")
def intervals(spark):
    rnd = random.Random(1)
    make = lambda n, longest: [
        (i, "chr1" if rnd.random() < 0.7 else "chr2", s := rnd.randrange(3000), s + 1 + rnd.randrange(longest)) for i in range(n)
    ]
    a, b = make(120, 200), make(120, 400)
    # a pile-up: a third of one side at one place
    b += [(1000 + i, "chr1", 1500, 1600) for i in range(60)]
    schema = "id long, chrom string, start long, end long"
    return a, b, spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


def test_overlap_join_splits_hot_bins(intervals):
    a, b, da, db = intervals
    want = sorted((x[0], y[0], min(x[3], y[3]) - max(x[2], y[2])) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    got = overlap.overlap_join(da, db, bin_width=64, hot_rows=20)
    assert rows(got, "id", "b_id", "overlap") == want
    assert rows(overlap.overlap_join(da, db), "id", "b_id", "overlap") == want


def test_counts_need_no_pairs(intervals, monkeypatch):
    a, b, da, db = intervals
    monkeypatch.setattr(overlap, "TILE", 128)
    want = sorted((x[0], sum(x[1] == y[1] and x[2] < y[3] and y[2] < x[3] for y in b)) for x in a)
    assert rows(overlap.count_in_regions(da, db), "id", "n") == want
    assert rows(overlap.overlap_anti(da, db), "id") == [(i,) for i, n in want if n == 0]


def test_merge_and_complement_across_tiles(intervals, spark, monkeypatch):
    a, _, da, _ = intervals
    monkeypatch.setattr(segments, "TILE", 64)
    covered = {c: set() for c in ("chr1", "chr2")}
    for _, c, s, e in a:
        covered[c].update(range(s, e))
    merged = rows(segments.merge_intervals(da), "chrom", "start", "end")
    seen = {c: set() for c in covered}
    for c, s, e in merged:
        seen[c].update(range(s, e))
    assert seen == covered
    assert rows(segments.merge_intervals(segments.merge_intervals(da)), "chrom", "start", "end") == merged
    sizes = spark.createDataFrame([("chr1", 4000), ("chr2", 4000)], "chrom string, length long")
    gaps = segments.complement(da, sizes)
    again = segments.complement(gaps, sizes)
    assert rows(again, "chrom", "start", "end") == merged
    depth = segments.pileup(da)
    assert depth.agg(F.sum((F.col("end") - F.col("start")) * F.col("value"))).first()[0] == sum(x[3] - x[2] for x in a)


def test_value_bucket_keeps_order(spark):
    values = [-1e9, -3.5, -3.4999, -1e-12, 0.0, 1e-300, 1e-12, 0.5, 0.5000001, 2.0, 1e12]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(scans.value_bucket(F.col("v"))).collect()]
    assert got == sorted(got)


def test_exact_quantiles(spark):
    rnd = np.random.default_rng(3)
    data = [(k, float(v)) for k in "ab" for v in list(rnd.normal(size=101)) + [0.25] * 60]
    df = spark.createDataFrame(data, "k string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 0.999, 1.0]
    for k, p, q in rows(scans.exact_quantiles(df, ["k"], "v", probs)):
        assert q == pytest.approx(np.quantile([v for kk, v in data if kk == k], p))


def test_bh_is_monotone_and_matches(spark):
    rnd = random.Random(5)
    p = [rnd.random() ** 2 for _ in range(80)] + [0.03] * 20
    order = sorted(range(len(p)), key=lambda i: -p[i])
    want, low = {}, 1.0
    for k, i in enumerate(order):
        low = min(low, p[i] * len(p) / (len(p) - k))
        want[i] = low
    df = spark.createDataFrame(list(enumerate(p)), "id long, p double")
    for i, _, adj in rows(normalise.p_adjust(df, "p")):
        # equal p-values share the smallest adjusted value
        assert adj == pytest.approx(min(want[j] for j in want if p[j] == p[i]))


def test_auc_is_mann_whitney(spark):
    rnd = random.Random(7)
    data = [(i, int(rnd.random() < 0.4), round(rnd.gauss(0, 1), 1)) for i in range(200)]
    df = spark.createDataFrame(data, "id long, label int, score double")
    pos, neg = [s for _, l, s in data if l], [s for _, l, s in data if not l]
    u = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    points = evaluation.roc_points(df)
    assert evaluation.auc(points, digits=None).first()[0] == pytest.approx(u)
    assert evaluation.partial_auc(points, 1.0, digits=None).first()[0] == pytest.approx(u)


def test_tails(spark):
    df = spark.createDataFrame([(1.959963984540054, 10.0, 2.228138851964939, 12.591587243743977)], "z double, df double, t double, x double")
    got = df.select(
        tails.normal_p(F.col("z")), tails.t_p("t", "df"), tails.chi2_even_p(F.col("x"), F.lit(3)), tails.chi2_1_p(F.lit(3.841458820694124)),
        tails.poisson_sf(F.lit(5.0), F.lit(2.0)), tails.poisson_sf(F.lit(2.0), F.lit(5.0)), tails.f_p(F.lit(4.102821015130401), F.lit(2.0), F.lit(10.0)),
    ).first()
    head = sum(math.exp(-2) * 2**k / math.factorial(k) for k in range(5))
    want = [0.05, 0.05, 0.05, 0.05, 1 - head, 1 - math.exp(-5) * 6, 0.05]
    assert list(got) == pytest.approx(want, abs=1e-9)


# --- motifs ----------------------------------------------------------------


def test_scan_by_hand(spark):
    matrix = [[0.0, -1.0, -2.0, -3.0], [-4.0, 0.0, -5.0, -6.0]]
    model = motifs.Model("m", False, np.array(matrix))
    seqs = spark.createDataFrame([(1, "ACNA"), (2, "G"), (3, "TGTT")], "seq_id long, seq string")
    got = {(r.seq_id, r.pos, r.strand): (r.kmer, r.score) for r in motifs.scan_pwm(seqs, [model]).collect()}
    value = dict(zip("ACGT", range(4)))
    for seq_id, seq in ((1, "ACNA"), (3, "TGTT")):
        for i in range(len(seq) - 1):
            word = seq[i:i + 2]
            for strand, text in (("+", word), ("-", word[::-1].translate(str.maketrans("ACGT", "TGCA")))):
                want = -999.0 if "N" in word else matrix[0][value[text[0]]] + matrix[1][value[text[1]]]
                assert got.pop((seq_id, i + 1, strand)) == (word, want)
    assert got == {(2, 1, "+"): ("G", -66.0), (2, 1, "-"): ("G", -66.0)}
    best = rows(motifs.scan_best(seqs, [model]), "seq_id", "pos", "strand", "score")
    full = rows(motifs.best_site(motifs.scan_pwm(seqs, [model])), "seq_id", "pos", "strand", "score")
    assert best == full
    whole = rows(motifs.occupancy(motifs.scan_pwm(seqs, [model])), "seq_id", "occupancy")
    assert [x for r in rows(motifs.scan_occupancy(seqs, [model]), "seq_id", "occupancy") for x in r] == pytest.approx([x for r in whole for x in r])


def test_dependency_block_both_strands(spark):
    rnd = np.random.default_rng(2)
    matrix, block = rnd.normal(size=(4, 4)), rnd.normal(size=16)
    model = motifs.Model("m", False, matrix, [([2, 3], block)])
    seq = "".join(rnd.choice(list("ACGT"), 60))
    code = {b: i for i, b in enumerate("ACGT")}
    score = lambda w: matrix[0][code[w[0]]] + block[4 * code[w[1]] + code[w[2]]] + matrix[3][code[w[3]]]
    df = spark.createDataFrame([(1, seq)], "seq_id long, seq string")
    for r in motifs.scan_pwm(df, [model]).collect():
        word = r.kmer if r.strand == "+" else r.kmer[::-1].translate(str.maketrans("ACGT", "TGCA"))
        assert r.score == pytest.approx(score(word))


def test_pfm_to_pwm_pseudo_counts(spark):
    count = motifs.motif_rows("c", "COUNT", "SYMMETRIC", [[8, 0, 1, 1], [2, 2, 2, 4]])
    freq = motifs.motif_rows("f", "FREQUENCY", "SYMMETRIC", [[0.7, 0.1, 0.1, 0.1]])
    score = motifs.motif_rows("s", "SCORE", "SYMMETRIC", [[0.0, -1.0, -2.0, -3.0]])
    df = motifs.pfm_to_pwm(spark.createDataFrame(count + freq + score, motifs.MOTIF_SCHEMA))
    got = {(r.motif_id, r.row, r.base): r.value for r in df.collect()}
    assert got["c", 1, "C"] == pytest.approx(math.log(0.1 / 0.9))
    assert got["f", 1, "A"] == 0 and got["f", 1, "C"] == pytest.approx(math.log((0.1 + 1 / 600) / (0.7 + 1 / 600)))
    assert got["s", 1, "T"] == -3.0


def test_spacing_of_a_known_pair(spark):
    sites = spark.createDataFrame(
        [(1, 93, "+", -0.97), (1, 110, "+", -9.09), (1, 150, "-", -2.0), (1, 165, "+", -1.0)], "seq_id long, pos int, strand string, score double"
    )
    got = rows(spacing.spacing_homotypic(sites, 10, 0, 60, 2, 2), "conf", "space", "pos1", "pos2", "corr_pos1", "corr_pos2")
    assert ("DR", 11, 93, 110, 101, 112) in got
    assert ("IR", 34, 110, 150, 118, 152) in got and ("ER", 9, 150, 165, 158, 167) in got
    assert all(space == c2 - c1 for _, space, _, _, c1, c2 in got)


# --- peak sets -------------------------------------------------------------


def brute_merge_two(data):
    out = []
    for chrom in sorted({d[0] for d in data}):
        ps = sorted(set((s, e, n) for c, s, e, n in data if c == chrom))
        used, merged, spare = set(), [], []
        for i, (s, e, n) in enumerate(ps):
            if i in used:
                continue
            for j in range(i + 1, len(ps)):
                js, je, jn = ps[j]
                if js >= e:
                    break
                li, lj = e - s, je - js
                inside = je <= e
                if not inside and not (e - js) / min(li, lj) > 0.8:
                    continue
                used |= {i, j}
                merged.append((chrom, max(s, js), min(e, je), "both"))
                if (js - s) / li > 0.5 and (inside or li >= lj):
                    spare.append((chrom, s, js - 1, n))
                if inside and (e - je) / li > 0.5:
                    spare.append((chrom, je + 1, e, n))
                if not inside and li < lj and (je - e) / lj > 0.5:
                    spare.append((chrom, e + 1, je, jn))
                break
        rest = [(chrom, *p) for i, p in enumerate(ps) if i not in used] + spare
        keep = [r for r in rest if not any(min(r[2], m[2]) - max(r[1], m[1]) >= 0.9 * (r[2] - r[1]) for m in merged)]
        out += merged + keep
    return sorted(set(out))


def test_merge_two_sets_follows_the_order(spark):
    rnd = random.Random(11)
    data = [("chr1", s := rnd.randrange(2500), s + rnd.choice([100, 110, 200, 420]), rnd.choice("AB")) for _ in range(90)]
    df = spark.createDataFrame(data, "chrom string, start long, end long, set string")
    assert rows(peaks.merge_two_sets(df), "chrom", "start", "end", "set") == brute_merge_two(data)


def brute_consensus(regions, summits, reps, phs, need):
    out = []
    for c, rs, re in regions:
        near = min((re - rs) * 0.4, 300)
        clusters = {}
        for k, rep in enumerate(reps):
            mine = sorted({(m, s, e) for cc, s, e, m, r in summits if cc == c and r == rep and s < re and rs < e})
            choice, centres = {}, sorted(clusters)
            for m, s, e in mine if k else []:
                close = [(abs(m - x), x) for x in centres if abs(m - x) <= near]
                if close:
                    choice[m] = min(close)
            kept = {}
            for m, (gap, x) in choice.items():
                kept[x] = min(kept.get(x, (gap, m)), (gap, m))
            for m, s, e in mine:
                x = choice[m][1] if m in choice and kept[choice[m][1]][1] == m else m
                clusters.setdefault(x, []).append((m, s, e, rep))
        for x, members in clusters.items():
            if len(members) >= need:
                mean = sum(m for m, *_ in members) // len(members)
                out.append((c, mean - phs, mean + phs, ",".join(sorted({r for *_, r in members}))))
    return sorted(out)


def test_consensus_summits_against_fold(spark):
    rnd = random.Random(4)
    data = []
    for rep in "123":
        for start in range(0, 9000, 300):
            if rnd.random() < 0.8:
                s = start + rnd.randrange(120)
                e = s + 150
                data.append(("chr1", s, e, s + rnd.randrange(150), rep))
    data = list({(d[0], d[3], d[4]): d for d in data}.values())
    regions = [("chr1", i, i + 900) for i in range(0, 9000, 1000)]
    dr = spark.createDataFrame(regions, "chrom string, start long, end long")
    ds = spark.createDataFrame(data, "chrom string, start long, end long, summit long, replicate string")
    got = rows(peaks.consensus_summits(dr, ds, ["1", "2", "3"], 100, 2, rescue=False), "chrom", "start", "end", "replicates")
    assert got == brute_consensus(regions, data, "123", 100, 2)


def test_split_complex_clusters_walk(spark):
    rnd = random.Random(9)
    summits = sorted(rnd.randrange(6000) for _ in range(60))
    df = spark.createDataFrame([("chr1", max(s - 200, 0), s + 200, s) for s in summits], "chrom string, start long, end long, summit long")
    want, centre, group = [], None, []
    islands = rows(segments.merge_intervals(df), "start", "end")
    for lo, hi in islands:
        inside = [s for s in summits if lo <= max(s - 200, 0) and s + 200 <= hi]
        if len(inside) <= 3:
            continue
        centre, group = None, []
        for s in inside + [None]:
            if centre is None or s is None or s - centre > 150:
                if group:
                    m = sum(group) // len(group)
                    want.append((max(m - 150, 0), m + 150, len(group)))
                centre, group = s, []
            if s is not None:
                group.append(s)
    assert rows(peaks.split_complex_clusters(df, 150, 3), "start", "end", "support") == sorted(want)


def test_call_peaks_finds_the_pile(spark):
    rnd = random.Random(6)
    ground = lambda n: [("chr1", s := rnd.randrange(100_000), s + 200) for _ in range(n)]
    treat = ground(200) + [("chr1", 50_000 + rnd.randrange(50), 50_250) for _ in range(60)]
    schema = "chrom string, start long, end long"
    sizes = spark.createDataFrame([("chr1", 100_300)], "chrom string, length long")
    got = peaks.call_peaks(spark.createDataFrame(treat, schema), spark.createDataFrame(ground(260), schema), sizes, min_len=50).collect()
    assert any(r.start <= 50_100 < r.end and 50_000 <= r.summit <= 50_250 for r in got) and len(got) < 5


def test_matched_negatives_constraints(spark):
    rnd = random.Random(8)
    kinds = ["exon", "intron"]
    lib = [("chr1", i * 200, i * 200 + 200, rnd.choice(kinds), round(rnd.uniform(0.3, 0.7), 2)) for i in range(400)]
    pos = [(i, rnd.choice(kinds), round(rnd.uniform(0.35, 0.65), 2)) for i in range(60)]
    dl = spark.createDataFrame(lib, "chrom string, start long, end long, type string, gc double")
    dp = spark.createDataFrame(pos, "id long, type string, gc double")
    got = sampling.n_negative_sets(dp, dl, 2, seed=3).collect()
    assert sorted((r.set_no, r.id) for r in got) == sorted((s, i) for s in (1, 2) for i, *_ in pos)
    assert len({(r.set_no, r.start) for r in got}) == len(got)
    kind = {i: t for i, t, _ in pos}
    near = [r for r in got if r.round.startswith("gc")]
    assert len(near) > 0.8 * len(got)
    assert all(r.type == kind[r.id] and abs(r.gc - r.pos_gc) <= 0.0301 for r in near)
