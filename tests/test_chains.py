"""Choices along chains of wishes beside following them one by one."""

import random

from peakloom.operators import peaks
from peakloom.operators.chains import choosers, shrink

from test_operators import brute_merge_two, rows


def plain(wishes):
    """Who chooses, taking nodes in order."""
    claimed, out = set(), set()
    for node, wish in sorted(wishes):
        if node not in claimed:
            out.add(node)
            if wish is not None:
                claimed.add(wish)
    return out


def chain(draw, n, far):
    out = []
    for node in range(n):
        wish = node + draw.randint(1, far)
        if draw.random() < 0.9:
            out.append((node, wish if draw.random() < 0.95 else None))
    there = {node for node, _ in out}
    return [(node, wish if wish in there else None) for node, wish in out]


def in_two_levels(wishes, width):
    """The shrunk links of all tiles, settled at once, and the tiles again with what enters."""
    links = [(0, n, -1 if w is None else w, 0) for n, w in wishes]
    tiles = {}
    for row in links:
        tiles.setdefault(row[1] // width, []).append(row)
    opened = {(2, -1, w, 0) for _, n, w, _ in links if w >= 0 and w // width != n // width}
    up = []
    for at, mine in tiles.items():
        up += shrink(mine + [o for o in opened if o[2] // width == at], lambda p: p // width == at)
    assert len([u for u in up if u[0] == 0]) <= 2 * len(opened)
    top = shrink(up, lambda p: True, settle=True)
    enter = {r for r in up if r[0] == 1} | {(1, -1, p, 0) for k, c, p, t in up if k == 0 and top[c] ^ t and c // width != p // width}
    out = set()
    for at, mine in tiles.items():
        out |= {c for c, known in shrink(mine + [e for e in enter if e[2] // width == at], lambda p: p // width == at, settle=True).items() if known}
    return out


def test_ten_thousand_chains():
    draw = random.Random(2)
    for _ in range(10_000):
        wishes = chain(draw, draw.randint(1, 40), draw.choice([1, 2, 5, 30]))
        assert in_two_levels(wishes, draw.choice([1, 2, 5, 16, 100])) == plain(wishes), wishes


def test_choosers_in_levels(spark):
    draw = random.Random(5)
    made = {f"c{k}": chain(draw, draw.choice([1, 50, 300]), draw.choice([1, 3, 60])) for k in range(40)}
    links = spark.createDataFrame([(k, n, w) for k, ws in made.items() for n, w in ws], "chrom string, node long, wish long")
    want = {(k, n) for k, ws in made.items() for n in plain(ws)}
    for widths in ((8, 64), (5, 20, 100), (1 << 14, 1 << 20), (16,)):
        assert {tuple(r) for r in choosers(links, ["chrom"], widths=widths).collect()} == want
    assert choosers(links.limit(0), ["chrom"]).count() == 0


def test_a_chain_through_a_whole_chromosome(spark):
    data = [("chr1", 30 * i, 30 * i + 300, "AB"[i % 2]) for i in range(2000)]
    frame = spark.createDataFrame(data, "chrom string, start long, end long, set string")
    stages = []
    for n in (200, 2000):
        before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
        got = rows(peaks.merge_two_sets(frame.where(f"start < {30 * n}"), widths=(16, 128)), "chrom", "start", "end", "set")
        stages.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before))
        assert got == brute_merge_two([d for d in data if d[1] < 30 * n])
    assert abs(stages[0] - stages[1]) <= 2


def test_merge_two_sets_on_many_chromosomes(spark):
    draw = random.Random(8)
    data = []
    for c in range(120):
        span = draw.choice([300, 3000, 20_000])
        data += [(f"chr{c}", s := draw.randrange(span), s + draw.choice([90, 100, 110, 200, 420, 1500]), draw.choice("AB")) for _ in range(draw.randint(1, 120))]
    frame = spark.createDataFrame(data, "chrom string, start long, end long, set string")
    assert rows(peaks.merge_two_sets(frame, widths=(16, 64)), "chrom", "start", "end", "set") == brute_merge_two(data)


def test_extended_pairs_are_made_once(spark, monkeypatch):
    made = []
    plain = peaks.cut_lineage
    monkeypatch.setattr(peaks, "cut_lineage", lambda df: made.append(df) or plain(df))
    data = [("a", 0, 700, 150, 550, "A"), ("a", 20, 720, 170, 570, "B"), ("a", 300, 1000, 450, 850, "A"), ("a", 330, 900, 480, 750, "B"), ("b", 0, 700, 150, 550, "A"), (None, 0, 700, 150, 550, "B")]
    out = peaks.merge_two_sets_extended(spark.createDataFrame(data + data[:2], "chrom string, start long, end long, core_start long, core_end long, set string"))
    assert {tuple(r) for r in out.collect()} == {
        ("a", 0, 720, "both", 360, "maxClose"), ("a", 300, 1000, "both", 632, "contain"), ("b", 0, 700, "A", 350, "None"), (None, 0, 700, "B", 350, "None")
    }
    # Pairs reach one aggregation and are not joined again.
    assert "_bin" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sum("_bin" in df._jdf.queryExecution().optimizedPlan().toString() for df in made) == 1
