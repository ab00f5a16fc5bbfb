"""Random places inside regions: every place is as likely, and rows stay bounded."""

import random
from collections import Counter

import numpy as np

from peakloom.operators import segments


def test_search_counts_places():
    draw = random.Random(4)
    for _ in range(300):
        lengths = sorted((draw.randint(0, 30) for _ in range(draw.randint(1, 12))), reverse=True)
        r = np.array(sorted(set(lengths), reverse=True))
        count = np.array([sum(x >= v for x in lengths) for v in r])
        total = np.array([sum(x for x in lengths if x >= v) for v in r])
        size = draw.randint(0, r[0])
        want = [(int(np.flatnonzero(r == x)[0]), at, sum(y == x for y in lengths[: k + 1])) for k, x in enumerate(lengths) if x >= size for at in range(x - size + 1)]
        got = segments._search(np.full(len(want), size), np.arange(len(want)), r, count, total)
        assert list(zip(*(g.tolist() for g in got))) == want


def test_every_place_is_as_likely(spark):
    regions = [("chr1", 0, 12), ("chr1", 100, 105), ("chr1", 200, 212), ("chr1", 300, 303), ("chr2", 50, 54)]
    within = spark.createDataFrame(regions, "chrom string, start long, end long")
    data = [(i, "chr1", 7, 11) for i in range(16_000)] + [(20_000 + i, "chr2", 0, 4) for i in range(50)] + [(30_000, "chr1", 0, 13), (30_001, "chr3", 0, 1), (30_002, "chr2", 0, 5), (30_003, "chr1", 1, 13)]
    df = spark.createDataFrame(data, "id long, chrom string, start long, end long")
    for part in (1 << 17, 700):
        segments.PART, before = part, segments.PART
        try:
            got = {r.id: (r.chrom, r.start, r.end) for r in segments.shuffle_intervals(df, None, 3, within).collect()}
        finally:
            segments.PART = before
        assert len(got) == len(data)
        places = Counter(got[i][1] for i in range(16_000))
        fit = [s + k for c, s, e in regions if c == "chr1" for k in range(e - s - 4 + 1)]
        assert sorted(places) == fit and all(got[i][2] - got[i][1] == 4 for i in range(16_000))
        expected = 16_000 / len(fit)
        assert sum((places[p] - expected) ** 2 / expected for p in fit) < 45  # 19 degrees of freedom, chance about 0.0007
        assert all(got[20_000 + i] == ("chr2", 50, 54) for i in range(50))
        assert [got[i][1] for i in (30_000, 30_001, 30_002)] == [None] * 3 and got[30_003][1] in (0, 200)


def test_lengths_do_not_meet_regions(spark):
    """Every interval length and every region of one chromosome: rows follow their sum, not their product."""
    n = 3000
    within = spark.range(n).selectExpr("'chr1' as chrom", "id * 10000 as start", "id * 10000 + 1000 + id as end")
    df = spark.range(n).selectExpr("id", "'chr1' as chrom", "0L as start", "500 + id as end")
    regions = within.selectExpr("chrom", "start as _rs", "end - start as _r")
    classes, reach = segments._room_by_length(regions, df.selectExpr("chrom", "end as _len"))
    assert classes.count() == n and reach.count() == n
    got = segments.shuffle_intervals(df, None, 8, within).collect()
    assert len(got) == n and all(r.start // 10000 * 10000 <= r.start and r.end <= r.start // 10000 * 10000 + 1000 + r.start // 10000 for r in got)
