"""The highest coverage of each replicate in a peak beside all pairs, and without pairing."""

import random

from peakloom.operators import overlap, peaks


def test_peak_max_is_the_highest_of_all_pairs_without_pairing(spark, monkeypatch):
    rng = random.Random(6)
    spans = [("a", s := rng.randrange(65_000, 66_500), s + rng.randint(1, 400)) for _ in range(200)]
    spans += [spans[0], ("b", 1, 5), ("c", 1, 5), (None, 1, 5), ("a", None, 5)]
    rows = [("a", s := rng.randrange(64_800, 66_900), s + rng.choice([1, 1, 30, 3000]), float(rng.randrange(50)), rng.choice(["x", "y", "z"])) for _ in range(400)]
    rows += [("b", 0, 9, None, "x"), ("b", 2, 9, -3.0, "y"), ("b", 2, 9, 7.0, None), ("a", 65_000, 65_500, float("nan"), "y"), (None, 1, 9, 4.0, "x")]
    df = spark.createDataFrame(spans, "chrom string, start long, end long")
    tracks = spark.createDataFrame(rows, "chrom string, start long, end long, value double, track string")

    def top(peak, name):
        met = [v for c, s, e, v, t in rows if t == name and v is not None and None not in (*peak, c) and c == peak[0] and s < peak[2] and peak[1] < e]
        return max(met, key=lambda v: (v != v, v), default=0.0)

    paired = []
    plain = overlap.overlap_join
    for module in (overlap, peaks):
        monkeypatch.setattr(module, "overlap_join", lambda *rest, **named: paired.append(1) or plain(*rest, **named), raising=False)
    out = peaks.peak_max_per_replicate(df, tracks, ["x", "y"])
    assert not paired
    plain_row = lambda r: str(tuple("nan" if v != v else v for v in r))
    # A NaN is the highest there is, and na.fill makes it 0.
    clean = lambda v: 0.0 if v != v else v
    want = [(*p, x := clean(top(p, "x")), y := clean(top(p, "y")), (x + y) / 2) for p in spans]
    assert sorted(map(plain_row, out.collect())) == sorted(map(plain_row, want))
