"""Best sites and occupancy from one scan."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom.operators import motifs


def test_scores_and_occupancy_come_from_one_scan(spark, monkeypatch):
    rng = random.Random(2)
    one = motifs.Model("one", False, np.log(np.random.default_rng(1).dirichlet([1] * 4, 8)))
    two = motifs.Model("two", True, np.log(np.random.default_rng(2).dirichlet([1] * 4, 4)))
    rows = [(i, "".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=rng.choice([0, 3, 5, 20, 90])))) for i in range(40)] + [(None, "ACGTACGTACGT"), (3, "ACGTACGTAACC"), (50, None)]
    df = spark.createDataFrame(rows, "seq_id long, seq string").repartition(4).where("seq IS NOT NULL")
    best = motifs.scan_best(df, [one, two])
    want = best.join(motifs.scan_occupancy(df, [one, two]), ["motif_id", "seq_id"])
    full = motifs.best_site(motifs.scan_pwm(df, [one, two]))
    assert sorted(map(str, best.collect())) == sorted(map(str, full.collect()))
    want = {r.seq_id: r for r in want.groupBy("seq_id").pivot("motif_id", ["one", "two"]).agg(F.max("score").alias("score"), F.max("occupancy").alias("occupancy")).collect()}
    monkeypatch.setattr(motifs, "scan_occupancy", None)
    got = motifs.add_scores_to_table(df.select("seq_id").distinct(), df, [one, two], with_occupancy=True).collect()
    assert len(got) == len(want) + 1
    for r in got:
        for name in ("one_score", "two_score", "one_occupancy", "two_occupancy"):
            assert r[name] is None if r.seq_id is None else r[name] == pytest.approx(want[r.seq_id][name])


@pytest.mark.parametrize("blocks", [[], [([2, 3], np.arange(16.0))], [([8, 9], np.arange(16.0))]])
def test_first_columns_at_once(blocks):
    model = motifs.Model("m", False, np.random.default_rng(3).normal(size=(9, 4)), blocks)
    codes = np.random.default_rng(4).choice(5, 400, p=[0.24] * 4 + [0.04]).astype(np.uint8)
    first = motifs._first_columns(model)
    assert (first is None) == (len(blocks) > 0 and blocks[0][0][0] <= motifs.LOOK_UP)
    for c in (codes, codes % 4):
        assert (motifs._window_scores(c, model) == motifs._window_scores(c, model, None, motifs._words_at(c), first)).all()
