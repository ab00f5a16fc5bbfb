"""Overlapping sites, preferred distances and profiles beside plain versions."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from peakloom.operators.chains import choosers
from peakloom.operators.resolve import preferred_distances, resolve_overlaps
from peakloom.operators.segments import meta_profile, signal_matrix
from peakloom.plans.cooccurrence import cooccurrence_peaks


def walk(sites):
    """Sites (pos, stop, score, tie) of one key that stay, in order of place."""
    low = float("-inf")
    kept, stands = [], None
    for s in sorted(sites, key=lambda s: (s[0], -(low if s[2] is None else s[2]), s[1], [-ord(c) for c in s[3]])):
        worth = low if s[2] is None else s[2]
        if stands is None or s[0] >= stands[1]:
            if stands is not None:
                kept.append(stands)
            stands = s
        elif worth > (low if stands[2] is None else stands[2]):
            stands = s
    return kept + ([stands] if stands else [])


@pytest.mark.parametrize("tile,span,longest", [(1, 300, 9), (64, 20_000, 30), (1 << 16, 400, 350)])
def test_resolve_overlaps_is_the_walk(spark, tile, span, longest):
    rng = random.Random(span)
    rows = []
    for key in ("a", "b", "c"):
        for _ in range(1500):
            pos = rng.randrange(span)
            rows.append((key, pos, pos + rng.randint(1, longest), rng.choice([None, *[x / 2 for x in range(12)]]), rng.choice("xyz")))
    # A long climb: each site is beaten by the next one, over many tiles.
    rows += [("climb", i, i + 3, float(i), "x") for i in range(0, 9000, 2)]
    rows += [rows[0], ("gone", None, 4, 1.0, "x"), (None, 1, 4, 1.0, "x")]
    df = spark.createDataFrame(rows, "seq_id string, pos long, stop long, score double, model string")
    got = sorted(map(tuple, resolve_overlaps(df, ties=["model"], tile=tile).collect()), key=str)
    want = [(k, *s) for k in ("a", "b", "c", "climb") for s in walk([row[1:] for row in rows if row[0] == k and row[1] is not None])]
    assert got == sorted(want, key=str)


def test_resolve_overlaps_of_nothing(spark):
    df = spark.createDataFrame([], "seq_id long, pos int, stop int, score double")
    out = resolve_overlaps(df)
    assert out.columns == df.columns and out.count() == 0


def test_preferred_distances_finds_planted_peaks(spark):
    rng = random.Random(4)
    rows = [("a", "b", d, 40 + d // 4 + rng.randint(0, 2) + (60 if d in (20, 21, 70) else 0)) for d in range(101)]
    rows += [("a", "c", d, 7) for d in range(101)] + [("b", "c", 50, 3), ("b", "c", 4000, 9)]
    curve = spark.createDataFrame(rows, "tf1 string, tf2 string, distance long, n long")
    peaks = {(p["tf1"], p["tf2"], p["distance"]) for p in preferred_distances(curve, 0, 100, 0, 2.0).collect()}
    assert {p for p in peaks if p[:2] == ("a", "b")} <= {("a", "b", 20), ("a", "b", 21), ("a", "b", 70)}
    assert any(p[2] in (20, 21) for p in peaks) and ("a", "b", 70) in peaks
    assert not any(p[:2] == ("a", "c") for p in peaks) and ("b", "c", 50) in peaks


def test_cooccurrence_peaks_after_overlaps(spark):
    rows = []
    for i in range(60):
        at = 1000 * i
        # "w" stands on every site of "a" with a lower score and is no partner of it or of "b".
        rows += [("s", "a", at, at + 8, 5.0), ("s", "w", at + 2, at + 9, 1.0), ("s", "b", at + 20, at + 26, 4.0)]
    df = spark.createDataFrame(rows, "seq_id string, motif_id string, pos long, stop long, score double")
    got = cooccurrence_peaks(df, 0, 50, smooth=0, least=2.0, share=1.0).collect()
    assert [(p["tf1"], p["tf2"], p["distance"], p["n"]) for p in got] == [("a", "b", 12, 60)]


def test_profiles_of_long_segments(spark):
    rng = random.Random(7)
    up, down = 12, 9
    anchors = [(rng.choice(["p", "q"]), rng.randrange(40, 300), rng.choice("+-"), i, i % 3) for i in range(25)]
    signal = [(rng.choice(["p", "q"]), s, s + rng.randint(1, 30), rng.choice([None, 0.1, 0.5, 2.0, 7.25]), rng.choice("uv")) for s in (rng.randrange(0, 320) for _ in range(120))]
    a = spark.createDataFrame(anchors, "chrom string, pos long, strand string, id long, k long")
    b = spark.createDataFrame(signal, "chrom string, start long, end long, value double, track string")
    seen, cells = {}, {}
    for chrom, pos, strand, i, k in anchors:
        for chrom2, s, e, value, track in signal:
            if chrom2 != chrom:
                continue
            for at in range(s, e):
                off = pos - at if strand == "-" else at - pos
                if -up <= off < down:
                    seen.setdefault((k, off), []).append(value)
                if -up <= at - pos < down:
                    cells.setdefault((i, track, (at - pos + up) // 7), []).append(value)
    got = {(r["k"], r["offset"]): r for r in meta_profile(a, b, up, down, ["k"], expanded=True).collect()}
    plain = {(r["k"], r["offset"]): r["mean"] for r in meta_profile(a, b, up, down, ["k"]).collect()}
    assert set(got) == set(plain) == set(seen)
    for key, values in seen.items():
        known = [v for v in values if v is not None]
        row = got[key]
        assert row["n"] == len(values)
        if not known:
            assert row["mean"] is None and plain[key] is None and row["median"] is None
            continue
        assert row["mean"] == pytest.approx(statistics.fmean(known)) and plain[key] == pytest.approx(statistics.fmean(known))
        assert row["median"] == pytest.approx(statistics.median(known))
        assert (row["sd"] is None) if len(known) == 1 else row["sd"] == pytest.approx(statistics.stdev(known), abs=1e-9)
    one = meta_profile(a, b, up, down).groupBy().agg(F.count("*")).first()[0]
    assert one == len({off for _, off in seen})
    matrix = {(r["id"], r["track"], r["bin"]): r["signal"] for r in signal_matrix(a, b, up, down, 7, "u").collect()}
    assert set(matrix) == set(cells)
    for key, values in cells.items():
        known = [v for v in values if v is not None]
        assert matrix[key] == pytest.approx(sum(known) / 7) if known else matrix[key] is None


def test_many_short_keys_share_calls(spark):
    rows = [(key, *s) for key in range(3000) for s in ((3, 9, 1.0), (5, 11, 2.0 if key % 2 else 0.5), (10, 12, 1.5))]
    df = spark.createDataFrame(rows, "seq_id long, pos long, stop long, score double")
    out = resolve_overlaps(df)
    assert sorted(map(tuple, out.collect())) == sorted((key, *s[:3]) for key in range(3000) for s in walk([r[1:] + ("",) for r in rows[3 * key:3 * key + 3]]))
    # The calls into Python go by batch and not by key.
    links = spark.createDataFrame([(key, n, n + 1 if n < 3 else None) for key in range(2000) for n in (1, 2, 3)], "seq_id long, node long, wish long")
    told = choosers(links, ["seq_id"])
    assert {tuple(r) for r in told.collect()} == {(key, n) for key in range(2000) for n in (1, 3)}
    assert "FlatMapGroupsInPandas [_batch" in told._jdf.queryExecution().toString()
