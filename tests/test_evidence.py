"""Replicate evidence peak by peak and the count model, beside plain versions."""

import math
import random

import numpy as np
import pytest

from peakloom.operators import dispersion, peaks


def fisher_tail(stat, n):
    return math.exp(-stat / 2) * sum((stat / 2) ** k / math.factorial(k) for k in range(n))


def plain_evidence(data, weak, strong, need, alpha, rule):
    best = {}
    for c, s, e, r, q in data:
        if q >= -math.log10(weak):
            best[c, s, e, r] = max(q, best.get((c, s, e, r), q))
    tests, asked = {}, {}
    for me, q in best.items():
        partners = {}
        for other, oq in best.items():
            if other[0] == me[0] and other[3] != me[3] and other[1] < me[2] and me[1] < other[2]:
                partners[other[3]] = max(partners.get(other[3], (0,)), (oq, -other[1], -other[2], other))
        stat = 2 * math.log(10) * (q + sum(p[0] for p in partners.values()))
        n = len(partners) + 1
        ok = n >= need and fisher_tail(stat, n) <= strong
        tests[me] = (n, stat, ok)
        if n >= need:
            for p in partners.values():
                asked.setdefault(p[3], []).append(ok)
    out = {}
    for me, (n, stat, ok) in tests.items():
        others = asked.get(me, [])
        yes = ok and all(others) if rule == "technical" else ok or any(others)
        out[me] = (n, stat, yes)
    kept = {}
    for rep in {m[3] for m in out}:
        ps = sorted((10 ** -best[m], m) for m in out if m[3] == rep and out[m][2])
        low = 1.0
        for k in range(len(ps), 0, -1):
            low = min(low, ps[k - 1][0] * len(ps) / k)
            kept[ps[k - 1][1]] = low <= alpha
    return {m: (*v, kept.get(m, False)) for m, v in out.items()}


@pytest.mark.parametrize("rule, need", [("technical", 2), ("biological", 2), ("technical", 3)])
def test_peak_evidence(spark, rule, need):
    draw = random.Random(need)
    data = [(f"chr{draw.randint(1, 2)}", s := draw.randrange(6000), s + draw.randint(30, 300), draw.choice("abcd"), float(draw.randint(2, 14))) for _ in range(220)]
    data += data[:3] + [("chr1", 10, 20, "a", 9.0), ("chr1", 10, 20, "a", 5.0), ("chr9", 1, 5, "a", 30.0)]
    df = spark.createDataFrame(data, "chrom string, start long, end long, replicate string, neg_log10_p double")
    got = peaks.peak_evidence(df, 1e-4, 1e-8, need, 1e-6, rule)
    want = plain_evidence(data, 1e-4, 1e-8, need, 1e-6, rule)
    found = {(r.chrom, r.start, r.end, r.replicate): r for r in got.collect()}
    assert set(found) == set(want)
    for me, (n, stat, yes, kept) in want.items():
        r = found[me]
        assert (r.replicates, r.verdict, r.kept) == (n, "confirmed" if yes else "discarded", kept) and math.isclose(r.fisher, stat)
        assert r.kind == ("strong" if r.neg_log10_p >= 8 else "weak") and (r.fdr is None) == (not yes)
    regions = peaks.confirmed_regions(got, 5).collect()
    everything = peaks.confirmed_regions(got).collect()
    assert len(regions) == min(5, len(everything)) and {r.fisher for r in regions} == set(sorted((r.fisher for r in everything), reverse=True)[:5])
    assert sum(r.peaks for r in everything) == sum(k for *_, k in want.values())
    assert peaks.peak_evidence(df.limit(0)).count() == 0


def test_chains_of_touching_peaks_are_judged_one_by_one(spark):
    data = [("chr1", 0, 100, "a", 12.0), ("chr1", 90, 200, "b", 12.0), ("chr1", 190, 300, "a", 4.0), ("chr1", 290, 400, "c", 4.0)]
    df = spark.createDataFrame(data, "chrom string, start long, end long, replicate string, neg_log10_p double")
    got = {(r.start, r.verdict) for r in peaks.peak_evidence(df).collect()}
    assert got == {(0, "confirmed"), (90, "confirmed"), (190, "discarded"), (290, "discarded")}


def test_log_gamma():
    x = np.concatenate([10.0 ** np.arange(-6, 9, 0.37), np.arange(1, 30, 0.5)])
    want = np.array([math.lgamma(v) for v in x])
    assert np.allclose(dispersion.log_gamma(x), want, rtol=1e-13, atol=1e-12)


def plain_model(table, one, two):
    samples = one + two
    sizes = [sum(row[s] for row in table.values()) for s in samples]
    target = math.exp(sum(math.log(v) for v in sizes) / len(sizes))
    y = {p: [row[s] * target / v for s, v in zip(samples, sizes)] for p, row in table.items()}
    grid = [2 ** (-9 + k / 4) for k in range(49)]

    def curve(v):
        out = []
        for phi in grid:
            r, total = 1 / phi, 0.0
            for part in (v[: len(one)], v[len(one) :]):
                n = len(part)
                if n > 1:
                    total += sum(math.lgamma(x + r) for x in part) - math.lgamma(sum(part) + n * r) + math.lgamma(n * r) - n * math.lgamma(r)
            out.append(total)
        return out

    curves = {p: curve(v) for p, v in y.items() if sum(v) > 0}
    mean = [sum(c[k] for c in curves.values()) / len(curves) for k in range(49)]
    free = len(one) + len(two) - 2
    out = {}
    for p, c in curves.items():
        own = [a + 10 / free * b for a, b in zip(c, mean)]
        best = max(range(49), key=lambda k: own[k])
        i = min(max(best, 1), 47)
        bend = own[i - 1] - 2 * own[i] + own[i + 1]
        shift = best - i if best != i else max(-1, min(1, 0.5 * (own[i - 1] - own[i + 1]) / bend)) if bend < 0 else 0
        phi = 2 ** (-9 + (i + shift) / 4)
        a, b = (math.floor(sum(part) + 0.5) for part in (y[p][: len(one)], y[p][len(one) :]))
        ra, rb = len(one) / phi, len(two) / phi
        chance = [math.exp(math.lgamma(x + ra) - math.lgamma(ra) - math.lgamma(x + 1) + math.lgamma(a + b - x + rb) - math.lgamma(rb) - math.lgamma(a + b - x + 1)
                           + math.lgamma(a + b + 1) + math.lgamma(ra + rb) - math.lgamma(a + b + ra + rb)) for x in range(a + b + 1)]
        assert math.isclose(sum(chance), 1, rel_tol=1e-8)
        out[p] = (phi, min(1.0, 2 * min(sum(chance[: a + 1]), sum(chance[a:]))))
    return out


@pytest.mark.parametrize("one, two", [(["a", "b", "c"], ["d", "e"]), (["a"], ["b", "c"])])
def test_negative_binomial_model(spark, one, two):
    draw = np.random.default_rng(len(one))
    table = {}
    for p in range(200):
        mean = float(draw.choice([0.3, 4, 30, 400]))
        lift = draw.choice([1, 1, 1, 6])
        table[p] = {s: int(draw.negative_binomial(4, 4 / (4 + mean * (lift if s in two else 1)))) for s in one + two}
    table[200] = {s: 0 for s in one + two}
    long = [(p, s, n) for p, row in table.items() for s, n in row.items() if n or s == one[0]] + [(1, "zz", 9)]
    got = dispersion.differential_counts_nb(spark.createDataFrame(long, "peak_id long, sample string, count long").repartition(5), {"x": one, "y": two})
    found = {r.peak_id: r for r in got.collect()}
    want = plain_model(table, one, two)
    assert set(found) == set(table) and found[200].p_value is None and found[200].dispersion is None and found[200].fdr is None
    for p, (phi, value) in want.items():
        assert math.isclose(found[p].dispersion, phi, rel_tol=1e-6) and math.isclose(found[p].p_value, value, rel_tol=1e-6, abs_tol=1e-300)
    ranked = sorted(r.p_value for r in found.values() if r.p_value is not None)
    low = 1.0
    adjusted = {}
    for k in range(len(ranked), 0, -1):
        low = min(low, ranked[k - 1] * len(ranked) / k)
        adjusted[ranked[k - 1]] = min(low, adjusted.get(ranked[k - 1], low))
    assert all(math.isclose(r.fdr, adjusted[r.p_value]) for r in found.values() if r.p_value is not None)


def test_no_replicates_no_test(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 50), (2, "a", 7)], "peak_id long, sample string, count long")
    got = {r.peak_id: r for r in dispersion.differential_counts_nb(df, {"x": ["a"], "y": ["b"]}).collect()}
    assert got[1].log_fc > 0 and [got[k][c] for k in (1, 2) for c in ("p_value", "fdr", "dispersion")] == [None] * 6
    assert dispersion.differential_counts_nb(df.limit(0), {"x": ["a", "c"], "y": ["b"]}).count() == 0


def test_tails_of_great_totals(monkeypatch):
    first, second = np.array([0, 40, 3000, 90_000, 7]), np.array([0, 11, 2000, 91_000, 0])
    size = np.array([3.0, 0.4, 50.0, 8.0, 2.0])
    whole = dispersion.exact_p(first, second, size, size)
    assert (whole <= 1).all() and whole[0] == 1
    monkeypatch.setattr(dispersion, "STEP", 100)
    assert np.allclose(dispersion.exact_p(first, second, size, size), whole, rtol=1e-9)


def test_consensus_from_kept_peaks(spark):
    from peakloom.plans.consensus import consensus_peaks

    data = [("chr1", 1000 * i, 1000 * i + 300, 1000 * i + 140 + 10 * k, r, 12.0 + i) for i in range(3) for k, r in enumerate("ab")]
    data += [("chr1", 9000, 9300, 9100, "a", 4.0), ("chr1", 9100, 9400, 9200, "b", 4.0)]
    df = spark.createDataFrame(data, "chrom string, start long, end long, summit long, replicate string, neg_log10_p double")
    tracks = spark.createDataFrame([("chr1", 0, 10_000, 5.0, "t")], "chrom string, start long, end long, value double, track string")
    for per_peak in (True, False):
        got = consensus_peaks(df, tracks, ["a", "b"], ["t"], sd_filter=False, per_peak=per_peak, strong=1e-9)
        assert sorted((r.start + r.end) // 2 for r in got.collect()) == [145, 1145, 2145]
        best = consensus_peaks(df, tracks, ["a", "b"], ["t"], sd_filter=False, per_peak=per_peak, strong=1e-9, top=1)
        assert [(r.start + r.end) // 2 for r in best.collect()] == [2145]
