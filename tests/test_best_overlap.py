"""The best overlapping interval beside comparing all pairs, and without pairing what lies in one."""

import random

from peakloom.operators import overlap
from peakloom.operators.overlap import best_overlap
from peakloom.operators.reports import CLASSES, merge_annotations_per_region

SPAN = "chrom string, start long, end long"


def made(rng, longest):
    rows = [(rng.choice("ab"), s := rng.randrange(200_000, 206_000), s + rng.randint(0, longest), rng.choice([None, *CLASSES])) for _ in range(500)]
    return rows + rows[:20] + [(None, 1, 5, "exon"), ("a", None, 5, "exon"), ("a", 3, None, "exon")]


def best(peak, others, least):
    met = [(o, min(peak[2], o[2]) - max(peak[1], o[1])) for o in others if None not in (*peak, *o[:3]) and o[0] == peak[0] and o[1] < peak[2] and peak[1] < o[2]]
    met = [(o, n) for o, n in met if n >= least * (peak[2] - peak[1])]
    if not met:
        return (None, None, None, 0)
    o, n = min(met, key=lambda m: (-m[1], m[0][1], m[0][2], m[0][3] is not None, m[0][3] or ""))
    return (o[1], o[2], o[3], n)


def test_best_overlap_is_the_best_of_all_pairs(spark):
    for seed, longest in enumerate((40, 400, 5000)):
        rng = random.Random(seed)
        others, peaks = made(rng, longest), [r[:3] for r in made(rng, 300)]
        a, b = spark.createDataFrame(peaks, SPAN), spark.createDataFrame(others, SPAN + ", type string")
        for least in (None, 0.5):
            got = sorted(map(tuple, best_overlap(a, b, ["type"], least).collect()), key=str)
            assert got == sorted(((*p, *best(p, others, least or -1e9)) for p in peaks), key=str)


def test_what_lies_in_one_interval_is_not_paired(spark, monkeypatch):
    paired = []
    plain = overlap.overlap_join
    monkeypatch.setattr(overlap, "overlap_join", lambda a, b, *rest, **named: paired.append((a.count(), b.count())) or plain(a, b, *rest, **named))
    peaks = spark.range(200).selectExpr("'a' AS chrom", "5000 + id * 10 AS start", "5300 + id * 10 AS end")
    deep = spark.range(3000).selectExpr("'a' AS chrom", "id * 5 AS start", "id * 5 + 300 * (1 + id % 50) AS end", "'exon' AS type")
    out = best_overlap(peaks, deep, ["type"])
    assert out.where("overlap = 300").count() == 200
    ((left, right),) = paired
    assert left == 0 and right < 300
    assert {r["types"] for r in merge_annotations_per_region(peaks, deep).collect()} == {"exon"}


def test_rows_that_grow_with_the_regions_are_not_broadcast(spark):
    rng = random.Random(8)
    others, peaks = made(rng, 3000), [r[:3] for r in made(rng, 300)] + [("c", 1, 5)]
    a, b = spark.createDataFrame(peaks, SPAN), spark.createDataFrame(others, SPAN + ", type string")
    merged = merge_annotations_per_region(a, b)
    # Written columns and laid out types look small to the planner, which sent them to the driver.
    for df in (best_overlap(a, b, ["type"]), merged):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # What is left is the list of hot bins.
        assert [s for s in plan.splitlines() if "BroadcastHashJoin" in s and ("start#" in s or "_part#" in s or "_tile#" in s)] == []

    def types(peak):
        met = {k for k in CLASSES if best(peak, [o for o in others if o[3] == k], 0.1)[0] is not None}
        return ";".join(sorted(met)) or "intergenic"

    assert sorted(map(tuple, merged.collect()), key=str) == sorted(((*p, types(p)) for p in peaks), key=str)
