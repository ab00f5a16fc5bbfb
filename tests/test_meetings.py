"""Sites of two models beside plain pairs."""

import itertools
import random

import pytest

from peakloom.operators import spacing


def plain_pairs(a, b, la, lb, smin, smax, oa, ob, both):
    out = []
    for (lead, trail, length, o, p, tag) in ((a, b, la, oa, ob, "12"), (b, a, lb, ob, oa, "21")):
        for (k, p1, s1, v1), (j, p2, s2, v2) in itertools.product(lead, trail):
            if k != j or k is None:
                continue
            end1 = p1 + length - (o[1] if s1 == "+" else o[0])
            start2 = p2 + (p[0] if s2 == "+" else p[1])
            names = ("DR12", "DR21") if tag == "12" else ("DR21", "DR12")
            conf = names[s1 != "+"] if s1 == s2 else "ER" if s1 == "-" else "IR"
            if smin <= start2 - end1 <= smax and (tag == "12" or both or conf[:2] == "DR"):
                mine, other = ((p1, v1, end1), (p2, v2, start2)) if tag == "12" else ((p2, v2, start2), (p1, v1, end1))
                out.append((k, conf, start2 - end1, tag, mine[1], other[1], mine[0], other[0], mine[2], other[2]))
    return sorted(out)


@pytest.mark.parametrize("both", [False, True])
def test_sites_of_two_models_meet_once(spark, both):
    rng = random.Random(5)
    made = lambda n: [(rng.choice([1, 2, None]), rng.randrange(1, 150), rng.choice("+-"), float(rng.randrange(9))) for _ in range(n)]
    a, b = made(60), made(40)
    a += a[:2]
    schema = "seq_id long, pos int, strand string, score double"
    got = spacing.spacing_heterotypic(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 6, 4, 0, 25, (1, 2), (0, 1), opposed_both_orders=both)
    assert sorted(map(tuple, got.collect())) == plain_pairs(a, b, 6, 4, 0, 25, (1, 2), (0, 1), both)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
