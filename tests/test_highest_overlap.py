"""The highest overlapping segment against all pairs."""

import random

import pytest

from peakloom.operators import overlap, peaks, segments


def brute(regions, segments):
    out = set()
    nan = lambda v: v != v
    for c, s, e in set(regions):
        met = [g for g in segments if g[0] == c and g[1] < e and s < g[2]]
        if met:
            top = max(met, key=lambda g: ((0, 0) if g[3] is None else (2, 0) if nan(g[3]) else (1, g[3]), -g[1], -g[2]))
            out.add((c, s, e, top[1], top[2], "nan" if top[3] is not None and nan(top[3]) else top[3]))
    return out


@pytest.mark.parametrize("hot", [1_000_000, 40])
def test_highest_overlap(spark, monkeypatch, hot):
    monkeypatch.setattr(overlap, "HOT_ROWS", hot)
    draw = random.Random(3)
    segments = []
    for _ in range(600):
        s = draw.choice([draw.randrange(0, 3000), draw.randrange(60_000, 140_000), -draw.randrange(1, 500)])
        segments.append((draw.choice(["a", "b"]), s, s + draw.choice([0, 1, 1, 1, 30, 400, 90_000]), draw.choice([None, float("nan"), 1.0, -0.5, draw.random(), draw.random()])))
    regions = [(c, s, s + w) for c in "abc" for s in range(-600, 140_000, 771) for w in (0, 1, 5, 700, 70_000)]
    regions += regions[:9]
    got = overlap.highest_overlap(spark.createDataFrame(regions, "chrom string, start long, end long"), spark.createDataFrame(segments, "chrom string, start long, end long, value double"))
    rows = {(r.chrom, r.start, r.end, r.b_start, r.b_end, "nan" if r.b_value is not None and r.b_value != r.b_value else r.b_value) for r in got.collect()}
    assert rows == brute(regions, segments)


def test_nothing_is_paired(spark, monkeypatch):
    def refused(*args, **named):
        raise AssertionError("paired")

    monkeypatch.setattr(overlap, "overlap_join", refused)
    monkeypatch.setattr(peaks, "overlap_join", refused)
    signal = spark.createDataFrame([("a", 5 * i, 5 * i + 1, float(i % 13)) for i in range(200)], "chrom string, start long, end long, value double")
    regions = spark.createDataFrame([("a", 10, 60), ("a", 0, 4), ("a", 1, 5), ("b", 0, 9)], "chrom string, start long, end long")
    assert {(r.start, r.position, r.max_value) for r in overlap.argmax_position(regions, signal).collect()} == {(10, 55, 11.0), (0, 0, 0.0)}
    reps = spark.createDataFrame([("a", 0, 50, "1", 9.0), ("a", 40, 90, "2", 6.0), ("a", 45, 95, "2", 7.0), ("a", 60, 99, "3", None)], "chrom string, start long, end long, replicate string, neg_log10_p double")
    assert {(r.start, r.replicates) for r in peaks.peak_evidence(reps).collect()} == {(0, 2), (40, 2), (45, 2)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "chrom string, start long, end long, value double")
    assert overlap.highest_overlap(none, none).count() == 0


def test_signal_matrix_pairs_once(spark):
    anchors = spark.createDataFrame([("a", 100, 1), ("a", 104, 1), ("a", 100, 2), ("a", 100, None), ("b", 5, 3)], "chrom string, pos long, id long")
    tracks = spark.createDataFrame([("a", 95, 97, "u", 2.0), ("a", 101, 102, "u", 3.0), ("a", 101, 102, "v", 7.0), ("b", 5, 6, "v", 1.0)], "chrom string, start long, end long, track string, value double")
    out = segments.signal_matrix(anchors, tracks, 10, 10, 10, "u")
    assert {(*r[:3], round(r[3], 9), round(r[4], 9)) for r in out.collect()} == {
        (1, "u", 0, 1.1, 0.7), (1, "u", 1, 0.3, 0.7), (1, "v", 0, 0.7, 0.7), (1, "v", 1, 0.7, 0.7), (2, "u", 0, 0.4, 0.35), (2, "u", 1, 0.3, 0.35), (2, "v", 1, 0.7, 0.35),
        (None, "u", 0, 0.4, 0.0), (None, "u", 1, 0.3, 0.0), (None, "v", 1, 0.7, 0.0), (3, "v", 1, 0.1, 0.0),
    }
    # Two joins with the hot bins and the one of pairs.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 3
