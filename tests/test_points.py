"""Points listed by tile beside plain versions."""

import random

from peakloom.operators.overlap import count_points_in_regions
from peakloom.operators.reports import lookup_value

SCHEMA = "chrom string, start long, end long"


def made(rng):
    spans = [("a", s := rng.randrange(5000), s + rng.choice([1, 11, 300, 2500])) for _ in range(300)]
    spans += [("b", 5, 9), ("none", 3, 8), ("a", 7, 7), ("a", 20, 10), spans[0], (None, 1, 4), ("a", None, 4)]
    points = [("a", rng.randrange(1, 9000), rng.choice([None, 0.1, 0.6, 0.9])) for _ in range(3000)]
    points += [("a", 1024, 0.7)] * 50 + [("c", 4, 0.9), (None, 5, 0.9), ("a", None, 0.9), ("b", 7, 0.8)]
    return spans, points


def test_points_are_counted_and_looked_up(spark):
    spans, points = made(random.Random(3))
    regions = spark.createDataFrame(spans, SCHEMA)
    table = spark.createDataFrame(points, "chrom string, pos long, prob double").repartition(5)
    got = count_points_in_regions(regions, table.selectExpr("chrom", "pos - 1 AS pos"))
    below = lambda c, x: sum(p[0] == c and p[1] is not None and p[1] - 1 < x for p in points)
    known = [s for s in spans if None not in s]
    assert sorted(map(tuple, got.collect())) == sorted((*s, below(s[0], s[2]) - below(s[0], s[1])) for s in known)

    at_place = {}
    for p in points:
        at_place.setdefault(p[:2], []).append(p[2])

    def values(chrom, start, end):
        out = []
        for at in sorted({start, end - 1, *range(start, end), *range(end - 1, start + 1)}):
            here = sorted(at_place.get((chrom, at + 1), []), key=lambda v: (v is not None, v))
            out += here or [None]
        return out

    found = {tuple(r)[:3]: r["values"] for r in lookup_value(regions, table).collect()}
    assert found == {s: values(*s) if None not in s[1:] and s[0] else found[s] for s in spans}
    assert lookup_value(regions, table).count() == len(spans)


def test_values_are_listed_before_they_are_shuffled(spark):
    regions = spark.range(20).selectExpr("'a' AS chrom", "id * 300 AS start", "id * 300 + 300 AS end")
    points = spark.range(6000).selectExpr("'a' AS chrom", "id + 1 AS pos", "0.9D AS prob")
    plan = lookup_value(regions, points)._jdf.queryExecution().executedPlan().toString()
    # A base is no row: only spans are laid out, by tile.
    assert "explode(sequence(start" not in plan and "partial_collect_list(_e#" in plan
    counted = count_points_in_regions(regions, points.selectExpr("chrom", "pos - 1 AS pos"), "n")
    assert {r["n"] for r in counted.collect()} == {300}
