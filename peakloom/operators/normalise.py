"""Normalisation, condition comparison and the statistics around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.tails import chi2_1_p, f_p, t_p
from ..runtime import cut_lineage
from .scans import exact_quantiles, ranked, tiled_scan, value_bucket, value_counts

FLOOR = 0.01
ZERO_STEP = 0.001


def correlation(x: str | Column, y: str | Column) -> Column:
    """Pearson's r as an aggregate; null where a side does not vary."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def cpm(counts: DataFrame, libraries: DataFrame | None = None, column: str = "count") -> DataFrame:
    """Counts per million of long ``(peak, sample, count)`` rows.

    Reads in peaks are the denominator, or the ``library_size`` of ``libraries``.  A sample without
    reads has null.
    """
    if libraries is None:
        totals = counts.groupBy("sample").agg(F.sum(column).alias("_total"))
    else:
        totals = libraries.select("sample", F.col("library_size").alias("_total"))
    return counts.join(totals, "sample").withColumn("cpm", F.try_divide(F.col(column), F.col("_total") / 1e6)).drop("_total")


def rpkm(df: DataFrame) -> DataFrame:
    """CPM per kilobase."""
    return df.withColumn("rpkm", F.col("cpm") / ((F.col("end") - F.col("start")) / 1000))


def replicate_mean(df: DataFrame, keys: Sequence[str], condition: str, value: str, name: str = "mean") -> DataFrame:
    """Mean over the replicates of each condition."""
    return df.groupBy(*keys, condition).agg(F.avg(value).alias(name))


def control_subtract(
    df: DataFrame, keys: Sequence[str], value: str, is_control: Column, floor: float = FLOOR
) -> DataFrame:
    """Mean of (replicate - mean control) with non-positive results set to ``floor``, and the plain mean."""
    sums = df.groupBy(*keys).agg(
        F.avg(F.when(~is_control, F.col(value))).alias("uncorrected"),
        F.coalesce(F.avg(F.when(is_control, F.col(value))), F.lit(0.0)).alias("_ctrl"),
    )
    diff = F.col("uncorrected") - F.col("_ctrl")
    return sums.select(*keys, F.when(diff <= 0, F.lit(floor)).otherwise(diff).alias("corrected"), "uncorrected")


def fold_change(df: DataFrame, a: str, b: str, eps: float = ZERO_STEP) -> DataFrame:
    """Ratio a/b; a zero on either side is replaced by ``eps``, both zero gives null."""
    ratio = (
        F.when((F.col(a) != 0) & (F.col(b) != 0), F.col(a) / F.col(b))
        .when(F.col(a) != 0, F.col(a) / eps)
        .when(F.col(b) != 0, F.lit(eps) / F.col(b))
    )
    return df.withColumn("ratio", ratio).withColumn("log2fc", F.log2("ratio"))


def ma_table(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mean coverage and log2 ratio; null where a side is zero."""
    ratio = F.when((F.col(a) > 0) & (F.col(b) > 0), F.log2(F.try_divide(F.col(a), F.col(b))))
    return df.withColumn("mean_cov", (F.col(a) + F.col(b)) / 2).withColumn("log2fc", ratio)


def p_adjust(df: DataFrame, p: str, method: str = "BH", keys: Sequence[str] = (), name: str = "p_adj") -> DataFrame:
    """Benjamini-Hochberg or Bonferroni over the non-null p-values of each key."""
    keys = list(keys)
    known = df.where(F.col(p).isNotNull())
    size = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    if method == "bonferroni":
        wide = df.join(size, keys, "left") if keys else df.crossJoin(F.broadcast(size))
        return wide.withColumn(name, F.least(F.lit(1.0), F.col(p) * F.col("_m"))).drop("_m")
    if method != "BH":
        raise ValueError("method must be 'BH' or 'bonferroni'")
    counted = value_counts(known, keys, p)
    counted = counted.join(size, keys) if keys else counted.crossJoin(F.broadcast(size))
    raw = counted.withColumn("_raw", F.col(p) * F.col("_m") / F.col("upto"))
    adjusted = tiled_scan(
        raw, keys, [-F.col(p)], -value_bucket(F.col(p)), running={"_adj": ("min", F.col("_raw"))}
    ).select(*keys, F.col(p), F.least(F.lit(1.0), F.col("_adj")).alias(name))
    return df.join(adjusted, [*keys, p], "left").select(*df.columns, name)


def differential_counts(counts: DataFrame, group: str, first: str, second: str) -> DataFrame:
    """Per peak log2 fold change (second over first), mean log2 CPM, Welch test and FDR.

    ``counts`` is long with ``peak_id``, ``cpm`` and the group column.  The test is
    Welch's t on log2(CPM + 0.5); it is not a quasi-likelihood fit.  A condition of one replicate
    has no variance to test with: t, df and p are null.
    """
    logged = counts.withColumn("_l", F.log2(F.col("cpm") + 0.5))
    cols = []
    for tag, name in (("1", first), ("2", second)):
        mine = F.when(F.col(group) == name, F.col("_l"))
        cols += [
            F.avg(mine).alias(f"_m{tag}"), F.coalesce(F.var_samp(mine), F.lit(0.0)).alias(f"_v{tag}"),
            F.count(mine).alias(f"_n{tag}"),
        ]
    m = logged.groupBy("peak_id").agg(F.avg("_l").alias("log_cpm"), *cols)
    s1, s2 = F.try_divide(F.col("_v1"), F.col("_n1")), F.try_divide(F.col("_v2"), F.col("_n2"))
    diff = F.col("_m2") - F.col("_m1")
    nu = F.try_divide((s1 + s2) ** 2, F.try_divide(s1**2, F.col("_n1") - 1) + F.try_divide(s2**2, F.col("_n2") - 1))
    enough = ((s1 + s2) > 0) & (F.col("_n1") > 1) & (F.col("_n2") > 1)
    tested = m.select(
        "peak_id", "log_cpm", diff.alias("log_fc"),
        F.when(enough, F.try_divide(diff, F.sqrt(s1 + s2))).alias("t"), F.when(enough, nu).alias("df"),
    )
    p = F.when(F.col("t").isNotNull(), t_p(F.coalesce("t", F.lit(0.0)), F.coalesce("df", F.lit(1.0))))
    tested = cut_lineage(tested.withColumn("p_value", p))
    return p_adjust(tested, "p_value", "BH", name="fdr")


def classify_change(df: DataFrame, log_fc: str = "log_fc", fdr: str | None = None, cut: float = 1.0) -> DataFrame:
    """-1, 0 or 1 by fold change; with ``fdr`` also the label, ``both`` unless FDR <= 0.05."""
    out = df.withColumn("change", F.when(F.col(log_fc) < -cut, -1).when(F.col(log_fc) > cut, 1).otherwise(0))
    if fdr:
        out = out.withColumn(
            "label",
            F.when((F.col(log_fc) < -cut) & (F.col(fdr) <= 0.05), "first")
            .when((F.col(log_fc) > cut) & (F.col(fdr) <= 0.05), "second")
            .otherwise("both"),
        )
    return out


def ratio_deciles(df: DataFrame, value: str, id_col: str, n: int = 10, name: str = "decile") -> DataFrame:
    """Equal groups along ``value`` (ties by id); what is left over joins the last group.

    Rows without a value belong to no group and keep a null one.
    """
    data = df.where(F.col(value).isNotNull())
    total = data.agg(F.greatest(F.round(F.count(F.lit(1)) / n), F.lit(1)).cast("long").alias("_size"))
    placed = ranked(data, [], [F.col(value), F.col(id_col)], "_rank")
    group = F.least(F.floor((F.col("_rank") - 1) / F.col("_size")) + 1, F.lit(n))
    grouped = placed.crossJoin(F.broadcast(total)).withColumn(name, group.cast("int")).select(*df.columns, name)
    return grouped.unionByName(df.where(F.col(value).isNull()).withColumn(name, F.lit(None).cast("int")))


def decile_composition(df: DataFrame, set_col: str, names: Sequence[str], decile: str = "decile") -> DataFrame:
    """Share (%) of each peak set in each decile."""
    total = F.count(F.lit(1))
    return df.where(F.col(decile).isNotNull()).groupBy(decile).agg(
        *[(100 * F.count_if(F.col(set_col) == n) / total).alias(f"pct_{n}") for n in names]
    )


def decile_ranges(df: DataFrame, value: str, decile: str = "decile") -> DataFrame:
    """Smallest and largest ratio (3 digits) per decile and its class."""
    low, high = F.round(F.min(value), 3), F.round(F.max(value), 3)
    return df.where(F.col(decile).isNotNull()).groupBy(decile).agg(low.alias("low"), high.alias("high")).withColumn(
        "attribution", F.when(F.col("high") < 1, "<1").when(F.col("low") > 1, ">1").otherwise("~1")
    )


def pairwise_correlation(df: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of sample columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(samples) for b in samples[i + 1:]]
    row = df.agg(*[correlation(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r"))
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        ).alias("x")
    ).select("x.a", "x.b", "x.r")


def group_trend(df: DataFrame, score: str, flag: str, id_col: str, groups: int = 10) -> DataFrame:
    """Mean ratio and % flagged in equal groups along ``score``; R2 of log10 mean against %.

    A last group below 74 % of the group size is kept and marked not ``full``; the fit is over full groups.
    """
    total = df.agg(F.count(F.lit(1)).alias("_n")).withColumn("_size", F.greatest(F.round(F.col("_n") / groups), F.lit(1)).cast("long"))
    placed = ranked(df, [], [F.col(score), F.col(id_col)], "_rank").crossJoin(F.broadcast(total))
    grouped = placed.groupBy((F.floor((F.col("_rank") - 1) / F.col("_size")) + 1).alias("group"), "_size").agg(
        F.avg(score).alias("mean_ratio"), (F.avg(F.col(flag)) * 100).alias("pct_flagged"),
        F.sum(flag).alias("n_flagged"), F.count(F.lit(1)).alias("_rows"),
    )
    # A handful of groups from here on.
    marked = grouped.withColumn("full", F.col("_rows") >= 0.74 * F.col("_size")).drop("_rows", "_size")
    fit = marked.where("full").agg((correlation(F.log10("mean_ratio"), "pct_flagged") ** 2).alias("r2"))
    return marked.crossJoin(F.broadcast(fit))


def n_set_ratio_table(areas: DataFrame, keys: Sequence[str], sample: str, value: str, names: Sequence[str]) -> DataFrame:
    """Each sample's value per region and its ratio to the first sample."""
    # One column a sample: they are parameters, so this is one aggregation.
    wide = areas.groupBy(*keys).agg(*[F.max(F.when(F.col(sample) == n, F.col(value))).alias(n) for n in names])
    return wide.select(
        *keys, *names, *[F.when(F.col(names[0]) != 0, F.col(n) / F.col(names[0])).alias(f"ratio_{n}") for n in names]
    )


def count_pca(df: DataFrame, columns: Sequence[str], k: int = 2) -> DataFrame:
    """Loadings of the first ``k`` principal components of the sample columns."""
    from pyspark.ml.feature import PCA, VectorAssembler

    data = VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(data)
    loads = model.pc.toArray()
    rows = [
        (name, j + 1, float(loads[i, j]), float(model.explainedVariance[j]))
        for i, name in enumerate(columns) for j in range(k)
    ]
    return df.sparkSession.createDataFrame(rows, "sample string, component int, loading double, explained double")


def correlation_test(df: DataFrame, x: str, y: str, keys: Sequence[str] = (), min_points: int = 10) -> DataFrame:
    """Pearson r, p-value and n per key; keys with ``min_points`` rows or fewer give nulls, p is 0 at |r| = 1."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf"))
    stats = df.where(finite(x) & finite(y)).groupBy(*keys).agg(correlation(x, y).alias("_r"), F.count(F.lit(1)).alias("n"))
    r = F.when(F.col("n") > min_points, F.col("_r"))
    t = F.col("r") * F.sqrt(F.try_divide((F.col("n") - 2).cast("double"), F.greatest(1 - F.col("r") ** 2, F.lit(0.0))))
    out = stats.withColumn("r", r)
    exact = 1 - F.col("r") ** 2 <= 0
    p = F.when(exact, 0.0).when(F.col("r").isNotNull(), t_p(F.coalesce(t, F.lit(0.0)), F.greatest(F.col("n") - 2, F.lit(1)).cast("double")))
    return out.withColumn("p_value", p).select(*keys, "r", "p_value", "n")


def average_rank(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Rank of each row within its key, ties sharing the mean rank."""
    ranks = value_counts(df, keys, value).select(
        *keys, value, ((F.col("below") + 1 + F.col("upto")) / 2).alias(name)
    )
    return df.join(ranks, [*keys, value]).select(*df.columns, name)


def spearman_matrix(long: DataFrame, row: str, position: str, value: str) -> DataFrame:
    """Spearman correlation between positions of long ``(row, position, value)`` data, BH-adjusted.

    ``position`` has few distinct values (motif columns); pairs are formed within a row.
    """
    data = long.where(F.col(value).isNotNull())
    left = data.select(row, F.col(position).alias("pos_a"), F.col(value).alias("va"))
    right = data.select(row, F.col(position).alias("pos_b"), F.col(value).alias("vb"))
    pairs = cut_lineage(left.join(right, row).where("pos_a < pos_b"))
    keys = ["pos_a", "pos_b"]
    ranked = average_rank(average_rank(pairs, keys, "va", "ra"), keys, "vb", "rb")
    # One row per pair of positions.
    tested = cut_lineage(correlation_test(ranked, "ra", "rb", keys, min_points=3))
    return p_adjust(tested, "p_value", "BH")


def anova_by_group(df: DataFrame, group: str, value: str, min_size: int = 3) -> DataFrame:
    """One-way ANOVA over groups of at least ``min_size``, with each group's mean and 0.9 quantile."""
    per = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("_var")
    ).where(F.col("n") >= min_size)
    quant = exact_quantiles(df, [group], value, [0.9]).select(group, F.col("quantile").alias("q90"))
    grand = per.agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_grand"), F.sum("n").alias("_total"),
        F.count(F.lit(1)).alias("_k"), F.sum((F.col("n") - 1) * F.col("_var")).alias("_within"),
        F.sum(F.col("n") * F.col("mean") ** 2).alias("_sq"),
    )
    df1, df2 = F.col("_k") - 1, F.col("_total") - F.col("_k")
    between = F.col("_sq") - F.col("_total") * F.col("_grand") ** 2
    test = grand.select(
        ((between / df1) / (F.col("_within") / df2)).alias("f"), df1.alias("df1"), df2.alias("df2")
    )
    test = test.withColumn("p_value", f_p(F.col("f"), F.col("df1").cast("double"), F.col("df2").cast("double")))
    return per.drop("_var").join(quant, group).crossJoin(F.broadcast(test))


def linear_fit(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slope and intercept of y on x."""
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


def prop_test(df: DataFrame, x1: str, x2: str, n: str) -> DataFrame:
    """Two-proportion chi-square test of x1/n against x2/n with continuity correction."""
    a, b, size = F.col(x1).cast("double"), F.col(x2).cast("double"), F.col(n).cast("double")
    pooled = (a + b) / (2 * size)
    yates = F.least(F.lit(0.5), F.abs(a / size - b / size) / (2 / size))
    hit, miss = size * pooled, size * (1 - pooled)
    cell = lambda seen, want: (F.abs(seen - want) - yates) ** 2 / want
    stat = cell(a, hit) + cell(b, hit) + cell(size - a, miss) + cell(size - b, miss)
    sound = (size > 0) & (pooled > 0) & (pooled < 1)
    out = df.withColumn("prop_1", F.when(size > 0, a / size)).withColumn("prop_2", F.when(size > 0, b / size))
    out = out.withColumn("chi2", F.when(sound, stat))
    return out.withColumn("p_value", F.when(F.col("chi2").isNotNull(), chi2_1_p(F.coalesce("chi2", F.lit(0.0)))))
