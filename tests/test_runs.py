"""Pairs that are the result come in runs of neighbours, whole and small when written."""

import random

import pytest

from peakloom.catalog import QUERIES
from peakloom.operators import overlap

SPAN = 10_000_000


def key_at(start, factor, turn):
    """A key whose place in the view is ``start``; ``turn`` tells keys of one place apart."""
    return start * pow(factor, -1, SPAN) % SPAN + turn * SPAN


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """Tables whose peaks and features crowd 12,000 positions, in no order, with the rows of their views."""
    rnd, folder = random.Random(5), tmp_path_factory.mktemp("crowded")
    orders = [(key_at(rnd.randrange(2000, 12000), 6151, i), 5 * rnd.randrange(100)) for i in range(3000)]
    orders += [(key_at(500_000 + 900 * i, 6151, i), 0) for i in range(20)] + [(orders[0][0], None), (None, 5)]
    part = [(key_at(rnd.randrange(10000) // 5 * 5, 4999, i), rnd.randrange(10, 51)) for i in range(150)]
    part += [(None, 7)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").selectExpr(
        "*", "'1-URGENT' AS o_orderpriority", "1e5D AS o_totalprice").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(part, "p_partkey long, p_size int").write.parquet(f"{folder}/part.parquet")
    peaks = [(k, s := k * 6151 % SPAN, s + 200 + k % 201) for k, c in orders if k is not None and c is not None]
    types = ["intergenic", "promoter", "5UTR", "3UTR", "intron", "exon"]
    features = [(k, s := k * 4999 % SPAN, min(s + 300 * n, SPAN + 500), types[k % 6]) for k, n in part if k is not None]
    return str(folder), peaks, features


def pairs(peaks, features):
    return [(a, b, min(e, y) - max(s, x), t, e - s) for a, s, e in peaks for b, x, y, t in features if s < y and x < e]


WANT = {
    "overlap_join": lambda p, f: [(a, b, t, o) for a, b, o, t, _ in pairs(p, f)],
    "overlap_min_fraction": lambda p, f: [(a, b, o) for a, b, o, _, n in pairs(p, f) if o >= n * 0.1],
    "overlap_containment": lambda p, f: [(a, b) for a, b, o, _, n in pairs(p, f) if o == n],
    "overlap_join_left": lambda p, f: [(a, b, o) for a, b, o, _, _ in pairs(p, f)],
}


@pytest.mark.parametrize("name", WANT)
def test_written_pairs_follow_each_other(spark, crowded, name):
    folder, peaks, features = crowded
    got = [tuple(r) for r in QUERIES[name](spark, folder).collect()]
    met = [r for r in got if r[1] is not None]
    assert sorted(met) == sorted(WANT[name](peaks, features))
    if name == "overlap_join_left":
        hit = {r[0] for r in met}
        lone = [(k, None, 0) for k, _, _ in peaks if k not in hit]
        assert lone and set(lone) <= {r for r in got if r[1] is None}
    # A feature is told once for many peaks, not anew in each row.
    assert sum(r[1] != s[1] for r, s in zip(met, met[1:])) < len(met) / 12


@pytest.mark.parametrize("hot_rows, run", [(10**6, 64), (20, 3)])
def test_runs_give_the_same_pairs(spark, monkeypatch, hot_rows, run):
    monkeypatch.setattr(overlap, "RUN", run)
    rnd = random.Random(2)
    make = lambda n, longest: [(i, rnd.choice(["chr1", "chr2"]), s := rnd.randrange(600), s + rnd.randrange(longest)) for i in range(n)]
    a, b = make(150, 60), make(150, 300)
    a += [(900, "chr1", 256, 256), (901, "chr2", 300, 290), *[(902, "chr1", 320, 330)] * 12, (903, None, 1, 9), (904, "chr1", None, 9), (905, "chr1", 5, None)]
    b += [(900, "chr1", 256, 256), *[(902, "chr1", 300, 400)] * 5, (903, None, 1, 9), (904, "chr2", None, 9)]
    da, db = (spark.createDataFrame(x, "id long, chrom string, start long, end long") for x in (a, b))
    out = lambda df: sorted(map(str, df.collect()))
    for more in ({"how": "left"}, {"min_frac_a": 0.5}, {"min_frac_b": 0.5}):
        plain = overlap.overlap_join(da, db, bin_width=64, hot_rows=hot_rows, **more)
        met = overlap.overlap_join(da, db, bin_width=64, hot_rows=hot_rows, in_runs=True, **more)
        assert met.columns == plain.columns and out(met) == out(plain)


def test_runs_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(overlap, "TASK_ROWS", 50)
    make = lambda n, step, long: spark.range(n).selectExpr("id", "concat('chr', id % 2) AS chrom", f"id * {step} % 20000 AS start", f"id * {step} % 20000 + {long} AS end")
    a, b = make(2000, 37, 100), make(300, 71, 900)
    met, plain = overlap.overlap_join(a, b, in_runs=True), overlap.overlap_join(a, b)
    assert met.rdd.getNumPartitions() == 40
    assert sorted(met.collect()) == sorted(plain.collect())
