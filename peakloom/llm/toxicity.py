"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

Grades are ordered: 0 not toxic, 1 toxic, 2 toxic in a text of low quality (labels ``toxic`` and
``quality``).  One weight a feature is shared by all thresholds,

    P(grade <= k) = logistic(threshold_k - sum of weights of the text's features)

and the expected severity is the sum of P(grade > k).  Features are the distinct words of a text,
lower-cased (A-Z) runs of digits, letters and non-ASCII characters, hashed to ``FEATURES`` numbers.

The fit looks at a bounded sample of labelled documents: ``SAMPLE`` rows a grade, chosen by a hash of the
id and weighted back to the grades' shares (a documented parameter).  Every document is scored, whole.

Null and empty texts have no features.  Rows that repeat a doc_id are scored each on its own; null ids
stay null.  Of repeated labels of a document the greatest toxic and the least quality count; a null
toxic label is none, a null quality counts as good.  Without labels, or with one grade only, severity is
that grade for every text.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from .words import MARKS, chunks, words_of

FEATURES = 1 << 18
SAMPLE = 3000
GRADES = 3
#: A feature is fitted if it occurs in so many sampled texts, and if its share of texts above grade 0
#: differs from theirs by this chi-square.  Common words differ by chance; one in 300,000 would by 22.
LEAST_TEXTS = 3
LEAST_CHI2 = 22.0
SHRINK = 1e-4
STEPS = 400


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Text and number of each distinct word, in order of text."""
    words = words_of(batch, lower=True, between=MARKS)
    both = words.doc() * FEATURES + (words.hashes() % np.uint64(FEATURES)).astype(np.int64)
    both = np.unique(both)
    return both // FEATURES, both % FEATURES


@dataclass
class Model:
    weights: np.ndarray
    #: Rising; one fewer than grades.  Infinite where a grade was never seen.
    thresholds: np.ndarray

    def above(self, sums: np.ndarray) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - sums[:, None], -700, 700)))


def fit_rows(rows: list[np.ndarray], grades: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> Model:
    """Weighted maximum likelihood with a penalty, by Adam on all rows at once."""
    seen = np.unique(grades)
    thresholds = np.full(GRADES - 1, np.inf)
    if not len(seen):
        return Model(np.zeros(FEATURES), thresholds)
    thresholds[: seen[0]] = -np.inf
    if len(seen) == 1:
        return Model(np.zeros(FEATURES), thresholds)
    rank = np.searchsorted(seen, grades)
    weight = weight / weight.sum()
    share = np.array([weight[rank == k].sum() for k in range(len(seen))])
    cuts = np.log(np.cumsum(share)[:-1] / (1 - np.cumsum(share)[:-1]))
    which = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    texts = np.bincount(column, minlength=FEATURES)
    severe = np.bincount(column[(rank > 0)[which]], minlength=FEATURES)
    all_texts, all_severe = len(rows), int((rank > 0).sum())
    expected = texts * (all_severe / all_texts)
    spread = texts * (all_severe / all_texts) * (1 - all_severe / all_texts) * (1 - texts / all_texts)
    chi2 = (np.abs(severe - expected) - 0.5).clip(0) ** 2 / np.maximum(spread, 1e-9)
    used = np.flatnonzero((texts >= LEAST_TEXTS) & (chi2 >= LEAST_CHI2))
    place = np.full(FEATURES, -1)
    place[used] = np.arange(len(used))
    ok = place[column] >= 0
    which, column = which[ok], place[column[ok]]

    # The first threshold and the logs of the gaps to the next keep the order.
    x = np.concatenate([np.zeros(len(used)), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        theta = np.cumsum(np.r_[x[len(used)], np.exp(x[len(used) + 1 :])])
        s = np.bincount(which, x[: len(used)][column], len(rows))
        below = 1 / (1 + np.exp(np.clip(np.c_[np.full(len(s), -np.inf), theta[None, :] - s[:, None], np.full(len(s), np.inf)], -60, 60) * -1))
        below[:, 0], below[:, -1] = 0, 1
        hi, lo = below[np.arange(len(s)), rank + 1], below[np.arange(len(s)), rank]
        p = np.maximum(hi - lo, 1e-12)
        up, down = hi * (1 - hi) / p, lo * (1 - lo) / p
        d_s = weight * (up - down)
        g = np.zeros_like(x)
        g[: len(used)] = np.bincount(column, d_s[which], len(used)) + SHRINK * x[: len(used)] / len(rows) ** 0.5
        d_theta = np.array([-(weight * up)[rank == k].sum() + (weight * down)[rank == k + 1].sum() for k in range(len(theta))])
        g[len(used)] = d_theta.sum()
        for k in range(1, len(theta)):
            g[len(used) + k] = d_theta[k:].sum() * np.exp(x[len(used) + k])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-10)
    weights = np.zeros(FEATURES)
    weights[used] = x[: len(used)]
    theta = np.cumsum(np.r_[x[len(used)], np.exp(x[len(used) + 1 :])])
    for k in range(GRADES - 1):
        # Above grade k means above the last seen grade that is not greater.
        at = int(np.searchsorted(seen, k, "right")) - 1
        thresholds[k] = -np.inf if at < 0 else np.inf if at >= len(theta) else theta[at]
    return Model(weights, thresholds)


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``grade`` of labelled documents."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    poor = F.coalesce(F.col("quality"), F.lit(1)) == 0
    return rows.select("doc_id", F.when(F.col("toxic") == 0, 0).when(poor, 2).otherwise(1).alias("grade"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents a grade."""
    rows = graded(labels).withColumn("h", F.xxhash64("doc_id"))
    counts = {r["grade"]: r["n"] for r in rows.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    # A grade may hold nearly all rows: ranked in parts first.
    rows = rows.withColumn("part", F.pmod(F.col("h"), F.lit(64)))
    for keys in (["grade", "part"], ["grade"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))).filter(F.col("rank") <= sample)
    chosen = rows.select(F.col("doc_id").alias("chosen"), "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            doc, number = _features(batch)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array([number[a:z] for a, z in zip(cuts, cuts[1:])], pa.list_(pa.int64()))], ["grade", "numbers"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).select("grade", F.col("text").cast("string").alias("text"))
    got = texts.mapInArrow(run, "grade int, numbers array<bigint>").collect()
    got.sort(key=lambda r: (r["grade"], r["numbers"]))
    grades = np.array([r["grade"] for r in got], np.int64)
    used = {g: int((grades == g).sum()) for g in counts}
    weight = np.array([counts[g] / used[g] for g in grades.tolist()])
    return fit_rows([np.array(r["numbers"], np.int64) for r in got], grades, weight)


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, p_toxic, p_severe, expected_severity, grade (the likeliest) and toxic of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in chunks(batches):
            doc, number = _features(batch)
            above = m.above(np.bincount(doc, m.weights[number], batch.num_rows))
            p = -np.diff(np.c_[np.ones(len(above)), above, np.zeros(len(above))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above[:, 0]), pa.array(above[:, 1]), pa.array(above.sum(1)), pa.array(p.argmax(1).astype(np.int32)), pa.array(above[:, 0] >= 0.5)],
                ["doc_id", "p_toxic", "p_severe", "expected_severity", "grade", "toxic"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, p_toxic double, p_severe double, expected_severity double, grade int, toxic boolean")
