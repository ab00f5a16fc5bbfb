"""Matched negatives against matchings found row by row."""

import random

import numpy as np
import pytest

from peakloom.operators.sampling import matched_negatives
from peakloom.operators.transport import cheapest_transport

LIB = "chrom string, start long, end long, type string, gc double"
POS = "id long, type string, gc double"


def most_pairs(left, right, fits) -> int:
    """Size of the largest matching, by augmenting paths between single rows."""
    holder = {}

    def place(i, seen):
        for j in range(len(right)):
            if j not in seen and fits(left[i], right[j]):
                seen.add(j)
                if j not in holder or place(holder[j], seen):
                    holder[j] = i
                    return True
        return False

    return sum(place(i, set()) for i in range(len(left)))


def least_cost(supply, demand, cost):
    """(units, cost) by trying every way to send unit after unit."""
    best = {(tuple(supply), tuple(demand)): 0}
    units = 0
    while True:
        after = {}
        for (s, d), paid in best.items():
            for i in range(len(s)):
                for j in range(len(d)):
                    if s[i] and d[j] and np.isfinite(cost[i][j]):
                        key = (s[:i] + (s[i] - 1,) + s[i + 1:], d[:j] + (d[j] - 1,) + d[j + 1:])
                        after[key] = min(after.get(key, np.inf), paid + cost[i][j])
        if not after:
            return units, min(best.values())
        best, units = after, units + 1


def test_transport_moves_the_most_at_the_least_cost():
    draw = np.random.default_rng(2)
    for _ in range(60):
        p, b = draw.integers(1, 4, 2)
        supply, demand = draw.integers(0, 4, p), draw.integers(0, 4, b)
        cost = np.where(draw.random((p, b)) < 0.3, np.inf, draw.integers(0, 6, (p, b)))
        flow = cheapest_transport(supply, demand, cost)
        assert (flow >= 0).all() and (flow.sum(1) <= supply).all() and (flow.sum(0) <= demand).all()
        assert not flow[np.isinf(cost)].any()
        assert (flow.sum(), (flow * np.where(flow > 0, cost, 0)).sum()) == least_cost(supply.tolist(), demand.tolist(), cost)
    assert cheapest_transport(np.zeros(0, int), np.array([2]), np.zeros((0, 1))).shape == (0, 1)
    assert cheapest_transport(np.array([2]), np.zeros(0, int), np.zeros((1, 0))).shape == (1, 0)
    # A hundred cells of many rows take no longer than their number asks for.
    cells = np.arange(110)
    gap = np.abs(cells[:, None] - cells).astype(float)
    big = cheapest_transport(draw.integers(0, 10**7, 110), draw.integers(0, 10**7, 110), np.where(gap <= 3, gap, np.inf))
    assert big.sum() > 10**8


@pytest.mark.parametrize("seed", range(3))
def test_as_many_are_matched_as_can_be(spark, seed):
    rnd = random.Random(seed)
    kinds = ["exon", "intron", "promoter"]
    lib = [("chr1", i * 200, i * 200 + 200, rnd.choice(kinds), round(rnd.uniform(0.3, 0.7), 2)) for i in range(90)]
    pos = [(i, rnd.choice(kinds), round(rnd.uniform(0.35, 0.5), 2)) for i in range(70)]
    got = matched_negatives(spark.createDataFrame(pos, POS), spark.createDataFrame(lib, LIB), seed).collect()
    assert sorted(r.id for r in got) == list(range(70)) and len({r.start for r in got}) == 70
    hundredths = lambda x: int(x * 100 + 0.5)
    near = lambda p, q: p[1] == q[3] and abs(hundredths(p[2]) - hundredths(q[4])) <= 3
    by_start, by_id = {q[1]: q for q in lib}, {p[0]: p for p in pos}
    first = [r for r in got if r.round.startswith("gc")]
    assert len(first) == most_pairs(pos, lib, near)
    assert all(near(by_id[r.id], by_start[r.start]) and r.round == f"gc{abs(hundredths(r.gc) - hundredths(r.pos_gc))}" for r in first)
    kept = {r.id for r in first}, {r.start for r in first}
    left, free = [p for p in pos if p[0] not in kept[0]], [q for q in lib if q[1] not in kept[1]]
    tenths = lambda x: int(x * 10 + 0.5)
    wide = lambda p, q: p[1] == q[3] and abs(tenths(p[2]) - tenths(q[4])) <= 4
    assert sum(r.round.startswith("tenth") for r in got) == most_pairs(left, free, wide)
    same = sum(by_id[r.id][1] == by_start[r.start][3] for r in got)
    assert same == sum(min(sum(p[1] == k for p in pos), sum(q[3] == k for q in lib)) for k in kinds)


def test_one_stratum_missing_values_and_empty_tables(spark):
    lib = [("chr1", i, i + 1, "exon", 0.5) for i in range(500)] + [("chr2", 0, 9, "exon", None), ("chr2", 9, 19, None, 0.5)]
    pos = [(i, "exon", 0.5) for i in range(480)] + [(900, "exon", None), (901, None, 0.5), (902, "intron", 0.5), (903, "exon", float("nan"))]
    dp, dl = spark.createDataFrame(pos, POS), spark.createDataFrame(lib, LIB)
    got = matched_negatives(dp, dl, 4, sets=2).collect()
    assert len(got) == 2 * len(pos) and len({(r.set_no, r.chrom, r.start) for r in got}) == len(got)
    named = {(r.set_no, r.id): r.round for r in got}
    assert all(named[s, i] == "gc0" for s in (1, 2) for i in range(480))
    assert all((named[s, 900], named[s, 903]) == ("type", "type") and (named[s, 901], named[s, 902]) == ("any", "any") for s in (1, 2))
    assert {r.id: r.start for r in got if r.set_no == 1} != {r.id: r.start for r in got if r.set_no == 2}
    again = matched_negatives(dp.repartition(5), dl.repartition(7), 4, sets=2).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert matched_negatives(dp.limit(0), dl, 4).count() == 0
    assert {r.round for r in matched_negatives(dp, dl.limit(0), 4).collect()} == {"none"}
