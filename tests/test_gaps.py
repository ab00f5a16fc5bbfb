"""Distances of co-occurring sites beside all pairs, and without pairing sites that lie apart."""

import random

import numpy as np

from peakloom.operators import spacing


def plain(rows, lowest, highest):
    out = {}
    for s1, m1, p1, e1 in rows:
        for s2, m2, p2, e2 in rows:
            if None in (s1, m1, p1, s2, m2, p2) or s1 != s2 or not m1 < m2:
                continue
            d = max(p1, p2) - min(e for e in (e1, e2) if e is not None)
            if lowest <= d <= highest:
                out[m1, m2, d] = out.get((m1, m2, d), 0) + 1
    return sorted((*k, n) for k, n in out.items())


def test_distances_are_those_of_all_pairs(spark, monkeypatch):
    rng = random.Random(5)
    rows = [("a", rng.choice("xyz"), p := rng.randrange(65_000, 66_000), p + rng.choice([1, 1, 5, 12])) for _ in range(250)]
    rows += [("b", rng.choice("xy"), p := rng.randrange(-100, 100), p + 3) for _ in range(60)]
    rows += rows[:40] + [(None, "x", 1, 2), ("a", None, 65_100, 65_101), ("a", "x", None, 3)]
    odd = [("b", "x", 5, 5), ("b", "y", 5, 5), ("b", "y", 9, 7)]
    for dense in (1 << 15, 0):
        monkeypatch.setattr(spacing, "GAP_DENSE", dense)
        for some, lowest, highest in ((rows, 0, 300), (rows, 20, 70), (rows, -8, 40), (rows, -8, -2), (rows + odd, 0, 60)):
            df = spark.createDataFrame(some, "seq_id string, motif_id string, pos long, stop long")
            assert sorted(map(tuple, spacing.cooccurrence_distances(df, lowest, highest).collect())) == plain(some, lowest, highest)


def test_sites_that_lie_apart_are_not_paired(spark, monkeypatch):
    monkeypatch.setattr(spacing, "_paired", None, raising=False)
    df = spark.range(3000).selectExpr("'a' AS seq_id", "concat('m', id % 2) AS motif_id", "id * 40 AS pos", "id * 40 + 1 AS stop")
    got = spacing.cooccurrence_distances(df, 0, 100)
    assert sorted(map(tuple, got.collect())) == [("m0", "m1", 39, 2999)]
    plan = df._jdf and spacing.cooccurrence_distances(df, 0, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for top in (2, 5000, 1 << 22):
        first, second = rng.integers(0, top, 4000), rng.integers(0, top, 4101)
        want = [int((first * second[g:g + 4000]).sum()) for g in range(101)]
        assert spacing._products(first, second, 100).tolist() == want
