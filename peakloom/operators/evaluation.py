"""Model evaluation on label/score tables and score distributions.

Every function takes key columns (e.g. ``model``), so many models are evaluated in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scans import quantiles_of_counts, ranked, tiled_scan, value_bucket


def roc_points(df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at each distinct score, best score first.

    Also keeps the counts at the score (``pos``, ``neg``), running counts (``tp``, ``fp``)
    and totals (``P``, ``N``); equal scores collapse before the shuffle.  A rate over no rows is null.
    """
    keys = list(keys)
    counts = df.groupBy(*keys, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    total = counts.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    ran = tiled_scan(
        counts, keys, [-F.col(score)], -value_bucket(F.col(score)),
        running={"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))},
    )
    both = ran.join(total, keys) if keys else ran.crossJoin(F.broadcast(total))
    return both.withColumn("fpr", F.try_divide(F.col("fp"), F.col("N"))).withColumn("tpr", F.try_divide(F.col("tp"), F.col("P")))


def _area() -> Column:
    return F.sum(F.try_divide(F.try_divide(F.col("neg"), F.col("N")) * (2 * F.col("tp") - F.col("pos")), 2 * F.col("P")))


def _early_area(limit: float) -> Column:
    f0, t0 = F.try_divide(F.col("fp") - F.col("neg"), F.col("N")), F.try_divide(F.col("tp") - F.col("pos"), F.col("P"))
    f1, t1 = F.col("fpr"), F.col("tpr")
    stop = F.least(f1, F.lit(float(limit)))
    top = F.when(f1 > f0, t0 + F.try_divide((t1 - t0) * (stop - f0), f1 - f0)).otherwise(t1)
    return F.sum(F.when(f0 < limit, (stop - f0) * (t0 + top) / 2).otherwise(0.0))


def _precision_area() -> Column:
    return F.sum(F.try_divide(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")) * F.col("pos"), F.col("P")))


def _digits(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def auc(points: DataFrame, keys: Sequence[str] = (), digits: int | None = 3) -> DataFrame:
    """Area under the ROC points by trapezoids."""
    return points.groupBy(*keys).agg(_digits(_area(), digits).alias("auc"))


def partial_auc(points: DataFrame, limit: float, keys: Sequence[str] = (), digits: int | None = 3) -> DataFrame:
    """Area up to ``limit`` false positives, with the true positive rate interpolated there."""
    return points.groupBy(*keys).agg(_digits(_early_area(limit), digits).alias("partial_auc"))


def average_precision(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision averaged over the steps in recall."""
    return points.groupBy(*keys).agg(_precision_area().alias("average_precision"))


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1-F3 and specificity at every 0.01 between the rounded minimum and the maximum."""
    keys = list(keys)
    cell = F.floor(F.col(score) * 100).cast("long")
    hist = df.groupBy(*keys, cell.alias("step")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    span = df.groupBy(*keys).agg(
        (F.round(F.min(score)) * 100).cast("long").alias("lo"), F.floor(F.max(score) * 100).cast("long").alias("hi"),
        F.count_if(F.col(label) == 1).alias("P"), F.count_if(F.col(label) == 0).alias("N"),
    )
    grid = span.select(*keys, F.explode(F.sequence("lo", "hi")).alias("step"), F.lit(0).alias("pos"), F.lit(0).alias("neg"), F.lit(True).alias("on"))
    cells = (
        hist.withColumn("on", F.lit(False)).unionByName(grid).groupBy(*keys, "step")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("on").alias("on"))
    )
    ran = tiled_scan(
        cells, keys, [-F.col("step")], -F.floor(F.col("step") / 4096),
        running={"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))},
    ).where("on")
    both = ran.join(span, keys) if keys else ran.crossJoin(F.broadcast(span))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    beta = lambda w: F.try_divide(tp, tp + (1 - w) * fp + w * fn)
    return both.select(
        *keys, (F.col("step") / 100).alias("threshold"), (tp + fp).alias("retrieved"),
        F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, F.col("P")).alias("recall"),
        beta(F.lit(0.5)).alias("f1"), beta(F.lit(0.8)).alias("f2"), beta(F.lit(0.9)).alias("f3"),
        F.try_divide(tn, F.col("N")).alias("specificity"),
    )


def best_thresholds(sweep: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The (first) threshold with the highest F1, F2 and F3."""
    best = lambda c: F.max_by("threshold", F.struct(F.col(c), -F.col("threshold"))).alias(f"best_{c}")
    return sweep.groupBy(*keys).agg(best("f1"), best("f2"), best("f3"))


def sensitivity_specificity(best: DataFrame, thresholds: Sequence[float], label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """Sequence-level sensitivity and 1 - specificity at each threshold, from best scores."""
    rows = best.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    hit = F.col("score") >= F.col("threshold")
    share = lambda k: F.try_divide(F.count_if(hit & (F.col(label) == k)), F.count_if(F.col(label) == k))
    return rows.groupBy(*keys, "threshold").agg(share(1).alias("se"), share(0).alias("one_minus_sp"))


def weighted_counts(counts: DataFrame, keys: Sequence[str], value: str = "score", weight: str = "n") -> DataFrame:
    """Running weights over distinct values: ``below`` and ``upto`` per ``(keys, value)``."""
    distinct = counts.groupBy(*keys, value).agg(F.sum(weight).alias("n"))
    ran = tiled_scan(
        distinct, keys, [F.col(value)], value_bucket(F.col(value)), running={"upto": ("sum", F.col("n"))}
    )
    return ran.withColumn("below", F.col("upto") - F.col("n"))


def score_quantiles(counts: DataFrame, probs: Column | Sequence[float], keys: Sequence[str] = ("motif_id",)) -> DataFrame:
    """Type-7 quantiles of counted scores ``(keys, score, n)``: rows ``(keys, prob, quantile)``.

    ``probs`` is a list or a Column holding an array of probabilities over ``_total``.
    """
    keys = list(keys)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    wanted = probs if isinstance(probs, Column) else F.array(*[F.lit(float(p)) for p in probs])
    return quantiles_of_counts(weighted_counts(counts, keys), totals, keys, "score", wanted)


def quantile_density_grid(counts: DataFrame, genome_length: Column | float, keys: Sequence[str] = ("motif_id",)) -> DataFrame:
    """Score at 97.50 ... 99.99 % by 0.01 % with the density of + strand sites per kb at or above it."""
    keys = list(keys)
    # Rounded so that 0.9 + i/10000 is the same double everywhere.
    grid = [round(0.9 + i / 10000, 4) for i in range(750, 1000)]
    cuts = score_quantiles(counts, grid, keys)
    plus = counts.where("strand = '+'")
    return sites_at_or_above(cuts, plus, keys).select(
        *keys, F.col("quantile").alias("threshold"), "prob",
        (F.col("_above") / (F.lit(genome_length) / 1000)).alias("sites_per_kb"),
    )


def sites_at_or_above(cuts: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_above``, the weight of scores >= ``quantile``, to a table of cuts."""
    marks = cuts.select(*keys, F.col("quantile").alias("score"), F.lit(0).cast("long").alias("n")).distinct()
    ran = weighted_counts(counts.select(*keys, "score", "n").unionByName(marks), keys)
    total = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    above = ran.join(total, list(keys)).select(
        *keys, F.col("score").alias("quantile"), (F.col("_total") - F.col("below")).alias("_above")
    )
    return cuts.join(above, [*keys, "quantile"])


def density_to_threshold(counts: DataFrame, genome_length: float | Column, keys: Sequence[str] = ("motif_id",)) -> DataFrame:
    """Score cutoff that leaves 5.00 ... 0.01 + strand sites per kb."""
    keys = list(keys)
    plus = counts.where("strand = '+'")
    per_kb = F.transform(F.sequence(F.lit(1), F.lit(500)), lambda i: i / F.lit(100))
    share = lambda d: F.greatest(1 - d * (F.lit(genome_length) / 1000) / F.col("_total"), F.lit(0.0))
    cuts = score_quantiles(plus, F.transform(per_kb, share), keys)
    total = plus.groupBy(*keys).agg(F.sum("n").alias("_total"))
    wanted = total.select(*keys, "_total", F.explode(per_kb).alias("sites_per_kb"))
    wanted = wanted.withColumn("prob", share(F.col("sites_per_kb")))
    return wanted.join(cuts, [*keys, "prob"]).select(
        *keys, F.col("quantile").alias("threshold"), "prob", "sites_per_kb"
    )


def score_histogram(df: DataFrame, low: float, high: float, bins: int, keys: Sequence[str] = (), score: str = "score", weight: Column | None = None) -> DataFrame:
    """Counts per equal-width bin; 0 and bins+1 hold what falls outside."""
    cell = F.expr(f"width_bucket({score}, {low}D, {high}D, {bins})")
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys, cell.alias("bin")).agg(n.alias("n"))


def ecdf(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of the weight at or below each distinct score."""
    ran = weighted_counts(counts, list(keys))
    total = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    both = ran.join(total, list(keys)) if keys else ran.crossJoin(F.broadcast(total))
    return both.select(*keys, "score", (F.col("upto") / F.col("_total")).alias("ecdf"))


def lookup_thresholds(models: DataFrame, quantiles: DataFrame, probs: Sequence[float] = (0.995, 0.997, 0.999)) -> DataFrame:
    """The stored cutoffs of each model, one column per probability."""
    wide = quantiles.where(F.col("prob").isin(*probs)).groupBy("motif_id").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias("th_" + str(p).replace(".", "_")) for p in probs]
    )
    return models.join(wide, "motif_id", "left")


def rank_pair(df: DataFrame, label: str = "label", score: str = "score", id_col: str = "seq_id") -> DataFrame:
    """The i-th best positive beside the i-th best negative; the larger set goes on beside nulls."""
    placed = ranked(df, [label], [-F.col(score), F.col(id_col)], "rank")
    side = lambda k, name: placed.where(F.col(label) == k).select("rank", F.col(score).alias(name))
    return side(1, "positive").join(side(0, "negative"), "rank", "full")


def multi_model_roc(df: DataFrame, limit: float = 0.1, label: str = "label", score: str = "score", model: str = "model") -> DataFrame:
    """AUC, early AUC and average precision of every model in one table."""
    return roc_points(df, label, score, [model]).groupBy(model).agg(
        _area().alias("auc"), _early_area(limit).alias("partial_auc"), _precision_area().alias("average_precision")
    )
