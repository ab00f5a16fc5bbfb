"""Queries on normalisation, comparison and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tails import normal_p
from ..operators import normalise as nm
from ..operators.comoments import many_sample_correlations
from ..operators.dispersion import differential_counts_nb
from ..operators.overlap import COORDS
from ..plans.differential import counts_per_sample, differential_regions, with_condition
from .base import f_p_sql, normal_p_sql, query, r, rounded, t_p_sql

CONDITIONS = {"a": ["s0", "s1", "s2"], "b": ["s3", "s4", "s5"]}
SAMPLES = ["s0", "s1", "s2", "s3", "s4", "s5"]

COUNTS = """SELECT p.id, p."start", p."end", s.sample, count(b.name) AS n FROM peaks p CROSS JOIN (SELECT 's' || unnest(range(0, 6)) AS sample) s
    LEFT JOIN reads b ON p.chrom = b.chrom AND p."start" < b."end" AND b."start" < p."end" AND b.sample = s.sample GROUP BY 1, 2, 3, 4"""
CPM = f"""SELECT *, n / (sum(n) OVER (PARTITION BY sample) / 1e6) AS cpm FROM ({COUNTS})"""
RPKM = f"""SELECT *, CASE WHEN sample IN ('s0', 's1', 's2') THEN 'a' ELSE 'b' END AS condition, cpm / (("end" - "start") / 1000) AS rpkm FROM ({CPM})"""
MEANS = f"""SELECT id, round(avg(rpkm) FILTER (WHERE condition = 'a'), 9) AS a, round(avg(rpkm) FILTER (WHERE condition = 'b'), 9) AS b FROM ({RPKM}) GROUP BY 1"""
RATIO = f"""SELECT id, a, b, round(CASE WHEN a <> 0 AND b <> 0 THEN a / b WHEN a <> 0 THEN a / 0.001 WHEN b <> 0 THEN 0.001 / b END, 9) AS ratio FROM ({MEANS})"""
DECILES = f"""SELECT *, least((row_number() OVER (ORDER BY ratio, id) - 1) // greatest(round(count(*) OVER () / 10), 1)::BIGINT + 1, 10)::INT AS decile
    FROM ({RATIO}) WHERE ratio IS NOT NULL"""
#: With regions that have no reads under either condition, which belong to no group.
REGIONS = f"""SELECT * FROM ({DECILES}) UNION ALL SELECT *, NULL::INT AS decile FROM ({RATIO}) WHERE ratio IS NULL"""


def _peaks(v):
    return v.peaks.select("id", *COORDS)


def _counts(v):
    return counts_per_sample(_peaks(v), v.reads, SAMPLES)


def _level(v):
    return with_condition(nm.rpkm(nm.cpm(_counts(v))), CONDITIONS)


def _regions(v):
    return differential_regions(_peaks(v), v.reads, CONDITIONS)


@query("differential_regions", f"""SELECT id, {r('a')} AS a, {r('b')} AS b, {r('ratio')} AS ratio, {r('log2(ratio)')} AS log2fc, decile FROM ({REGIONS})""")
def _(v):
    out = _regions(v).withColumn("log2fc", F.log2("ratio"))
    return rounded(out.select("id", "a", "b", "ratio", "log2fc", "decile"), "a", "b", "ratio", "log2fc")


@query("cpm_in_peaks", f"""SELECT id, sample, n AS count, {r('cpm')} AS cpm FROM ({CPM})""")
def _(v):
    return rounded(nm.cpm(_counts(v)).select("id", "sample", "count", "cpm"), "cpm")


@query("cpm_in_libraries", f"""SELECT c.id, c.sample, {r('c.n / (l.n / 1e6)')} AS cpm FROM ({COUNTS}) c JOIN (SELECT sample, count(*) AS n FROM reads GROUP BY 1) l USING (sample)""")
def _(v):
    from ..operators.reads import library_size

    return rounded(nm.cpm(_counts(v), library_size(v.reads)).select("id", "sample", "cpm"), "cpm")


@query("rpkm", f"""SELECT id, sample, {r('rpkm')} AS rpkm FROM ({RPKM})""")
def _(v):
    return rounded(_level(v).select("id", "sample", "rpkm"), "rpkm")


@query("replicate_mean", f"""SELECT id, condition, {r('avg(rpkm)')} AS mean FROM ({RPKM}) GROUP BY 1, 2""")
def _(v):
    return rounded(nm.replicate_mean(_level(v), ["id"], "condition", "rpkm"), "mean")


@query("control_subtract", f"""SELECT id, CASE WHEN {r('a - b')} <= 0 THEN 0.01::DOUBLE ELSE {r('a - b')} END AS corrected, {r('a')} AS uncorrected FROM (
    SELECT id, avg(rpkm) FILTER (WHERE condition = 'a') AS a, avg(rpkm) FILTER (WHERE condition = 'b') AS b FROM ({RPKM}) GROUP BY 1)""")
def _(v):
    return rounded(nm.control_subtract(_level(v), ["id"], "rpkm", F.col("condition") == "b"), "corrected", "uncorrected")


@query("fold_change", f"""SELECT id, {r('ratio')} AS ratio FROM ({RATIO})""")
def _(v):
    m = nm.replicate_mean(_level(v), ["id"], "condition", "rpkm").groupBy("id").agg(
        *[F.max(F.when(F.col("condition") == c, F.round("mean", 9))).alias(c) for c in "ab"]
    )
    return rounded(nm.fold_change(m, "a", "b").select("id", F.round("ratio", 9).alias("ratio")), "ratio")


@query("ma_table", f"""SELECT id, {r('(a + b) / 2')} AS mean_cov, CASE WHEN a > 0 AND b > 0 THEN {r('log2(a / b)')} END AS log2fc FROM ({MEANS})""")
def _(v):
    out = nm.ma_table(_regions(v), "a", "b")
    return rounded(out.select("id", "mean_cov", "log2fc"), "mean_cov", "log2fc")


PV = """SELECT o_orderkey AS id, (o_orderkey * 7919 % 10007) / 10007.0::DOUBLE AS p, o_orderpriority AS family FROM orders"""


def _pvalues(v):
    return v.table("orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") * 7919 % 10007 / 10007.0).alias("p"), F.col("o_orderpriority").alias("family")
    )


@query("p_adjust_bh", f"""SELECT id, {r('least(1, adj)')} AS p_adj FROM (SELECT id, min(raw) OVER (PARTITION BY family ORDER BY p DESC RANGE UNBOUNDED PRECEDING) AS adj FROM (
    SELECT *, p * count(*) OVER (PARTITION BY family) / count(*) OVER (PARTITION BY family ORDER BY p RANGE UNBOUNDED PRECEDING) AS raw FROM ({PV})))""")
def _(v):
    return rounded(nm.p_adjust(_pvalues(v), "p", "BH", ["family"]).select("id", "p_adj"), "p_adj")


@query("p_adjust_bonferroni", f"""SELECT id, {r('least(1, p * (SELECT count(*) FROM orders))')} AS p_adj FROM ({PV})""")
def _(v):
    return rounded(nm.p_adjust(_pvalues(v), "p", "bonferroni").select("id", "p_adj"), "p_adj")


LOGGED = f"""SELECT id, sample, CASE WHEN sample IN ('s0', 's1', 's2') THEN 'a' ELSE 'b' END AS condition, log2(cpm + 0.5) AS l FROM ({CPM})"""
WELCH = f"""SELECT id, log_cpm, m2 - m1 AS log_fc, CASE WHEN v1 / 3 + v2 / 3 > 1e-18 THEN (m2 - m1) / sqrt(v1 / 3 + v2 / 3) END AS t,
    CASE WHEN v1 / 3 + v2 / 3 > 1e-18 THEN pow(v1 / 3 + v2 / 3, 2) / (pow(v1 / 3, 2) / 2 + pow(v2 / 3, 2) / 2) END AS df FROM (
    SELECT id, avg(l) AS log_cpm, avg(l) FILTER (WHERE condition = 'a') AS m1, avg(l) FILTER (WHERE condition = 'b') AS m2,
    var_samp(l) FILTER (WHERE condition = 'a') AS v1, var_samp(l) FILTER (WHERE condition = 'b') AS v2 FROM ({LOGGED}) GROUP BY 1)"""
TESTED = f"""SELECT *, CASE WHEN t IS NOT NULL THEN {t_p_sql('t', 'df', 200)} END AS p FROM ({WELCH})"""


@query("differential_counts", f"""SELECT id AS peak_id, {r('log_cpm', 4)} AS log_cpm, {r('log_fc', 4)} AS log_fc, {r('t', 4)} AS t, {r('df', 4)} AS df,
    {r('p', 4)} AS p_value FROM ({TESTED})""")
def _(v):
    counts = with_condition(nm.cpm(_counts(v)), CONDITIONS).withColumnRenamed("id", "peak_id")
    out = nm.differential_counts(counts, "condition", "a", "b")
    cols = ["log_cpm", "log_fc", "t", "df", "p_value"]
    return rounded(out.select("peak_id", *cols), *cols, digits=4)


@query("differential_counts_fdr", f"""WITH p AS ({TESTED}), raw AS (SELECT *, p * count(p) OVER () / count(p) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING) AS raw FROM p WHERE p IS NOT NULL),
    f AS (SELECT id, least(1, min(raw) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS fdr FROM raw)
    SELECT id AS peak_id, {r('fdr', 4)} AS fdr, CASE WHEN log_fc < -1 THEN -1 WHEN log_fc > 1 THEN 1 ELSE 0 END AS change,
    CASE WHEN log_fc < -1 AND fdr <= 0.05 THEN 'first' WHEN log_fc > 1 AND fdr <= 0.05 THEN 'second' ELSE 'both' END AS label FROM p LEFT JOIN f USING (id)""")
def _(v):
    counts = with_condition(nm.cpm(_counts(v)), CONDITIONS).withColumnRenamed("id", "peak_id")
    out = nm.classify_change(nm.differential_counts(counts, "condition", "a", "b"), "log_fc", "fdr")
    return rounded(out.select("peak_id", "fdr", "change", "label"), "fdr", digits=4)


# The count model: lib the library sizes, y the scaled counts, curve the conditional likelihoods on the grid.
NB = f"""lib AS (SELECT sample, sum(n)::DOUBLE AS size FROM ({{counts}}) GROUP BY 1), target AS (SELECT exp(avg(ln(size))) AS t FROM lib WHERE size > 0),
    y AS (SELECT id, sample, CASE WHEN sample IN ('s0', 's1', 's2') THEN 1 ELSE 2 END AS g, n * (SELECT t FROM target) / size AS v FROM ({{counts}}) JOIN lib USING (sample)),
    z AS (SELECT id, sum(v) FILTER (WHERE g = 1) AS z1, sum(v) FILTER (WHERE g = 2) AS z2 FROM y GROUP BY 1),
    grid AS (SELECT k, pow(2.0::DOUBLE, 9 - 0.25 * k) AS r FROM (SELECT unnest(range(0, 49)) AS k)),
    own AS (SELECT id, k, r, sum(lgamma(v + r)) AS own FROM y, grid GROUP BY 1, 2, 3),
    curve AS (SELECT id, k, own - lgamma(z1 + 3 * r) - lgamma(z2 + 3 * r) + 2 * lgamma(3 * r) - 6 * lgamma(r) AS l FROM own JOIN z USING (id) WHERE z1 + z2 > 0),
    share AS (SELECT k, avg(l) AS m FROM curve GROUP BY 1),
    both_l AS (SELECT id, k, l + 10.0::DOUBLE / 4 * m AS l FROM curve JOIN share USING (k)),
    top AS (SELECT id, arg_max(k, (l, -k)) AS k FROM both_l GROUP BY 1),
    near AS (SELECT t.id, t.k, greatest(1, least(47, t.k)) AS i FROM top t),
    bend AS (SELECT n.id, n.k, n.i, max(l) FILTER (WHERE b.k = i - 1) AS a, max(l) FILTER (WHERE b.k = i) AS b, max(l) FILTER (WHERE b.k = i + 1) AS c
        FROM near n JOIN both_l b ON b.id = n.id AND b.k BETWEEN i - 1 AND i + 1 GROUP BY 1, 2, 3),
    phi AS (SELECT id, pow(2.0::DOUBLE, -9 + 0.25 * (i + CASE WHEN i <> k THEN k - i WHEN a - 2 * b + c < 0 THEN greatest(-1, least(1, 0.5 * (a - c) / (a - 2 * b + c))) ELSE 0 END)) AS d FROM bend),
    whole AS (SELECT id, floor(z1 + 0.5)::BIGINT AS a, floor(z2 + 0.5)::BIGINT AS b, 3 / d AS r FROM z JOIN phi USING (id)),
    term AS (SELECT id, a, x, exp(lgamma(a + b + 1) + lgamma(2 * r) - lgamma(a + b + 2 * r) - 2 * lgamma(r) + lgamma(x + r) - lgamma(x + 1) + lgamma(a + b - x + r) - lgamma(a + b - x + 1)) AS p
        FROM (SELECT *, unnest(range(0, a + b + 1)) AS x FROM whole)),
    test AS (SELECT id, least(1, 2 * least(sum(p) FILTER (WHERE x <= a), sum(p) FILTER (WHERE x >= a))) AS p FROM term GROUP BY 1),
    raw AS (SELECT *, p * count(*) OVER () / count(*) OVER (ORDER BY round(p, 12) RANGE UNBOUNDED PRECEDING) AS raw FROM test),
    fdr AS (SELECT id, least(1, min(raw) OVER (ORDER BY round(p, 12) DESC RANGE UNBOUNDED PRECEDING)) AS fdr FROM raw),
    whole_fc AS (SELECT id, log2(((z1 + z2) / 6 + 0.5) * 1e6::DOUBLE / (SELECT t FROM target)) AS log_cpm, log2((z2 / 3 + 0.5) / (z1 / 3 + 0.5)) AS log_fc FROM z)"""


@query("differential_counts_nb", f"""WITH {NB.replace('{counts}', COUNTS)} SELECT id AS peak_id, {r('log_cpm', 4)} AS log_cpm, {r('log_fc', 4)} AS log_fc,
    {r('d', 4)} AS dispersion, {r('p', 4)} AS p_value, {r('fdr', 4)} AS fdr FROM whole_fc LEFT JOIN phi USING (id) LEFT JOIN test USING (id) LEFT JOIN fdr USING (id)""")
def _(v):
    counts = _counts(v).withColumnRenamed("id", "peak_id").select("peak_id", "sample", "count")
    out = differential_counts_nb(counts, CONDITIONS)
    return rounded(out, "log_cpm", "log_fc", "dispersion", "p_value", "fdr", digits=4)


@query("classify_change", f"""SELECT id, CASE WHEN log2(ratio) < -1 THEN -1 WHEN log2(ratio) > 1 THEN 1 ELSE 0 END AS change FROM ({RATIO})""")
def _(v):
    out = _regions(v).withColumn("log2fc", F.log2("ratio"))
    return nm.classify_change(out, "log2fc").select("id", "change")


@query("ratio_deciles", f"""SELECT id, decile FROM ({REGIONS})""")
def _(v):
    return _regions(v).select("id", "decile")


@query("decile_composition", f"""SELECT decile, {r('''100.0 * count(*) FILTER (WHERE "set" = 'A') / count(*)''')} AS "pct_A",
    {r('''100.0 * count(*) FILTER (WHERE "set" = 'B') / count(*)''')} AS "pct_B" FROM ({DECILES}) JOIN (SELECT id, "set" FROM peaks) USING (id) GROUP BY 1""")
def _(v):
    out = nm.decile_composition(_regions(v).join(v.peaks.select("id", "set"), "id"), "set", ["A", "B"])
    return rounded(out, "pct_A", "pct_B")


@query("decile_ranges", f"""SELECT *, CASE WHEN high < 1 THEN '<1' WHEN low > 1 THEN '>1' ELSE '~1' END AS attribution FROM (
    SELECT decile, {r('min(ratio)', 3)} AS low, {r('max(ratio)', 3)} AS high FROM ({DECILES}) GROUP BY 1)""")
def _(v):
    return rounded(nm.decile_ranges(_regions(v), "ratio"), "low", "high", digits=3)


WIDE = "SELECT id, " + ", ".join(f"max(rpkm) FILTER (WHERE sample = '{s}') AS {s}" for s in SAMPLES) + f" FROM ({RPKM}) GROUP BY 1"


def _wide(v, value="rpkm"):
    return _level(v).groupBy("id").agg(*[F.max(F.when(F.col("sample") == s, F.col(value))).alias(s) for s in SAMPLES])


@query("pairwise_correlation", "SELECT a, b, round(r, 6) + 0.0 AS r FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM ({WIDE})" for i, a in enumerate(SAMPLES) for b in SAMPLES[i + 1:]) + ")")
def _(v):
    return rounded(nm.pairwise_correlation(_wide(v), SAMPLES), "r")


# Every supplier is a sample here and every part a feature.
DEPTH = """SELECT l_partkey AS feature, 's' || l_suppkey AS sample, sum(l_quantity)::DOUBLE AS value FROM lineitem GROUP BY 1, 2"""


@query("sample_correlations", f"""WITH d AS MATERIALIZED ({DEPTH})
    SELECT x.sample AS a, y.sample AS b, count(*) AS n, CASE WHEN min(x.value) < max(x.value) AND min(y.value) < max(y.value) THEN {r('corr(x.value, y.value)')} END AS r
    FROM d x JOIN d y ON x.feature = y.feature AND x.sample < y.sample GROUP BY 1, 2""")
def _(v):
    rows = v.table("lineitem").select("l_partkey", F.concat(F.lit("s"), F.col("l_suppkey")).alias("sample"), F.col("l_quantity").cast("double").alias("value"))
    return rounded(many_sample_correlations(rows, "l_partkey", "sample", "value"), "r")


TREND = """SELECT o_orderkey AS id, o_totalprice / 100000 AS ratio, CASE WHEN o_totalprice / 500000 + (o_custkey % 10) / 10.0 > 1 THEN 1 ELSE 0 END AS flag FROM orders"""


@query("group_trend", f"""WITH n AS (SELECT round(count(*) / 10)::BIGINT AS size FROM orders), g AS (SELECT (row_number() OVER (ORDER BY ratio, id) - 1) // (SELECT size FROM n) + 1 AS "group", * FROM ({TREND})),
    s AS (SELECT "group", avg(ratio) AS mean_ratio, avg(flag) * 100 AS pct_flagged, sum(flag)::BIGINT AS n_flagged, count(*) >= 0.74 * (SELECT size FROM n) AS "full" FROM g GROUP BY 1)
    SELECT "group", {r('mean_ratio')} AS mean_ratio, {r('pct_flagged')} AS pct_flagged, n_flagged, "full", (SELECT {r('pow(corr(log10(mean_ratio), pct_flagged), 2)')} FROM s WHERE "full") AS r2 FROM s""")
def _(v):
    data = v.table("orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 100000).alias("ratio"),
        F.when(F.col("o_totalprice") / 500000 + F.col("o_custkey") % 10 / 10 > 1, 1).otherwise(0).alias("flag"),
    )
    return rounded(nm.group_trend(data, "ratio", "flag", "id"), "mean_ratio", "pct_flagged", "r2")


@query("n_set_ratio_table", f"""SELECT id, {r('s0')} AS s0, {r('s1')} AS s1, {r('s2')} AS s2, CASE WHEN s0 <> 0 THEN {r('s0 / s0')} END AS ratio_s0,
    CASE WHEN s0 <> 0 THEN {r('s1 / s0')} END AS ratio_s1, CASE WHEN s0 <> 0 THEN {r('s2 / s0')} END AS ratio_s2 FROM ({WIDE})""")
def _(v):
    out = nm.n_set_ratio_table(_level(v), ["id"], "sample", "rpkm", ["s0", "s1", "s2"])
    return rounded(out, "s0", "s1", "s2", "ratio_s0", "ratio_s1", "ratio_s2")


@query("count_pca")
def _(v):
    return nm.count_pca(_wide(v), SAMPLES, 2)


EV = """SELECT event_type, value AS x, value * 0.5 + (event_id % 17) AS y, user_id % 7 AS grp FROM events"""


def _xy(v):
    return v.table("events").select(
        "event_type", F.col("value").alias("x"), (F.col("value") * 0.5 + F.col("event_id") % 17).alias("y"), (F.col("user_id") % 7).alias("grp"), "event_id"
    )


NOISE = """SELECT event_type, (event_id * 7919 % 1009)::DOUBLE AS x, (event_id * 104729 % 1013)::DOUBLE AS y FROM events"""


@query("correlation_test", f"""SELECT event_type, {r('r')} AS r, {r(t_p_sql('(r * sqrt((n - 2) / (1 - r * r)))', '(n - 2)', 2000))} AS p_value, n FROM (
    SELECT event_type, corr(x, y) AS r, count(*) AS n FROM ({NOISE}) GROUP BY 1)""")
def _(v):
    data = v.table("events").select(
        "event_type", (F.col("event_id") * 7919 % 1009).cast("double").alias("x"), (F.col("event_id") * 104729 % 1013).cast("double").alias("y")
    )
    return rounded(nm.correlation_test(data, "x", "y", ["event_type"]), "r", "p_value")


@query("linear_fit", f"""SELECT event_type, {r('regr_slope(y, x)')} AS slope, {r('regr_intercept(y, x)')} AS intercept FROM ({EV}) GROUP BY 1""")
def _(v):
    return rounded(nm.linear_fit(_xy(v), "x", "y", ["event_type"]), "slope", "intercept")


@query("anova_by_group", f"""WITH g AS (SELECT grp, count(*) AS n, avg(x) AS mean, var_samp(x) AS v, quantile_cont(x, 0.9) AS q90 FROM ({EV}) GROUP BY 1 HAVING count(*) >= 3),
    t AS (SELECT sum(n * mean) / sum(n) AS grand, sum(n) AS total, count(*) AS k, sum((n - 1) * v) AS inside, sum(n * mean * mean) AS sq FROM g),
    f AS (SELECT ((sq - total * grand * grand) / (k - 1)) / (inside / (total - k)) AS f, (k - 1)::BIGINT AS df1, (total - k)::BIGINT AS df2 FROM t)
    SELECT g.grp, g.n, {r('g.mean')} AS mean, {r('g.q90')} AS q90, {r('f.f', 4)} AS f, f.df1, f.df2, {r(f_p_sql('f.f', 'f.df1', 'f.df2'), 4)} AS p_value FROM g CROSS JOIN f""")
def _(v):
    out = rounded(nm.anova_by_group(_xy(v), "grp", "x"), "mean", "q90")
    return rounded(out, "f", "p_value", digits=4)


@query("spearman_matrix", f"""WITH w AS (SELECT user_id, event_type, avg(value) AS v FROM events GROUP BY 1, 2),
    p AS (SELECT a.event_type AS pos_a, b.event_type AS pos_b, a.v AS va, b.v AS vb FROM w a JOIN w b USING (user_id) WHERE a.event_type < b.event_type),
    k AS (SELECT pos_a, pos_b, rank() OVER (PARTITION BY pos_a, pos_b ORDER BY va) + (count(*) OVER (PARTITION BY pos_a, pos_b, va) - 1) / 2.0 AS ra,
        rank() OVER (PARTITION BY pos_a, pos_b ORDER BY vb) + (count(*) OVER (PARTITION BY pos_a, pos_b, vb) - 1) / 2.0 AS rb FROM p),
    c AS (SELECT pos_a, pos_b, corr(ra, rb) AS r, count(*) AS n FROM k GROUP BY 1, 2),
    t AS (SELECT *, {t_p_sql('(r * sqrt((n - 2) / (1 - r * r)))', '(n - 2)', 2000)} AS p FROM c),
    q AS (SELECT *, p * count(*) OVER () / count(*) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING) AS raw FROM t)
    SELECT pos_a, pos_b, {r('r')} AS r, n, {r('p', 5)} AS p_value, {r('least(1, min(raw) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING))', 5)} AS p_adj FROM q""")
def _(v):
    long = v.table("events").groupBy("user_id", "event_type").agg(F.avg("value").alias("v"))
    out = nm.spearman_matrix(long, "user_id", "event_type", "v")
    return rounded(rounded(out, "r"), "p_value", "p_adj", digits=5)


CELLS = """SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS x1, count(*) FILTER (WHERE l_returnflag = 'A') AS x2, count(*) AS n FROM lineitem GROUP BY 1"""
PROP = f"""SELECT *, x1 / n AS prop_1, x2 / n AS prop_2, least(0.5, abs(x1 / n - x2 / n) / (2.0 / n)) AS y, (x1 + x2) / (2.0 * n) AS q FROM ({CELLS})"""
CHI = f"""SELECT *, pow(abs(x1 - n * q) - y, 2) / (n * q) + pow(abs(x2 - n * q) - y, 2) / (n * q) + pow(abs(n - x1 - n * (1 - q)) - y, 2) / (n * (1 - q))
    + pow(abs(n - x2 - n * (1 - q)) - y, 2) / (n * (1 - q)) AS chi2 FROM ({PROP})"""


@query("prop_test", f"""SELECT l_suppkey, x1, x2, n, {r('prop_1')} AS prop_1, {r('prop_2')} AS prop_2, {r('chi2')} AS chi2, {r(normal_p_sql('sqrt(chi2)'))} AS p_value FROM ({CHI})""")
def _(v):
    flag = F.col("l_returnflag")
    cells = v.table("lineitem").groupBy("l_suppkey").agg(
        F.count_if(flag == "R").alias("x1"), F.count_if(flag == "A").alias("x2"), F.count(F.lit(1)).alias("n")
    )
    return rounded(nm.prop_test(cells, "x1", "x2", "n"), "prop_1", "prop_2", "chi2", "p_value")


@query("normal_p", f"""SELECT o_orderkey, {r(normal_p_sql('z', 200))} AS p_value FROM (SELECT o_orderkey, (o_totalprice - 250000) / 100000 AS z FROM orders)""")
def _(v):
    z = (F.col("o_totalprice") - 250000) / 100000
    return rounded(v.table("orders").select("o_orderkey", normal_p(z).alias("p_value")), "p_value")
