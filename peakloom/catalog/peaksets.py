"""Queries on peak calling, consensus and merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import peaks as pk
from ..operators import segments as sg
from ..operators.overlap import COORDS
from ..plans.consensus import consensus_peaks
from .base import query, r, rounded
from .intervals import ISLES

OV = 'a.chrom = b.chrom AND a."start" < b."end" AND b."start" < a."end"'
TREAT, CONTROL = ["s0", "s1", "s2"], ["s3", "s4", "s5"]
DEPTH = """SELECT sample AS track, chrom, pos AS "start", lead(pos) OVER w AS "end", sum(step) OVER w AS value FROM (
    SELECT sample, chrom, pos, sum(step) AS step FROM (SELECT sample, chrom, "start" AS pos, 1 AS step FROM reads UNION ALL SELECT sample, chrom, "end", -1 FROM reads)
    GROUP BY 1, 2, 3 HAVING sum(step) <> 0) WINDOW w AS (PARTITION BY sample, chrom ORDER BY pos)"""


def _part(v, samples):
    return v.reads.where(F.col("sample").isin(*samples))


def _tracks(v):
    return sg.pileup(v.reads, keys=["sample", "chrom"]).withColumnRenamed("sample", "track")


def _summits(v):
    """Peaks of five replicates with summit and evidence."""
    return v.peaks.select(
        *COORDS, "summit_offset", (F.col("start") + F.col("summit_offset")).alias("summit"), F.col("batch").alias("replicate"),
        F.col("signal_value").alias("neg_log10_p"), "id", "set",
    )


WIDTHS = "SELECT unnest([200, 500, 5000]) AS w"
SPREAD = f"""SELECT w, chrom, greatest(("start" + "end") // 2 - w // 2, 0) AS s, ("start" + "end") // 2 + w // 2 AS e FROM reads CROSS JOIN ({WIDTHS}) WHERE sample IN ('s3', 's4', 's5')"""


@query("local_background", f"""WITH sp AS ({SPREAD}), st AS (SELECT w, chrom, pos, sum(d)::BIGINT AS step FROM (SELECT w, chrom, s AS pos, 1 AS d FROM sp UNION ALL SELECT w, chrom, e, -1 FROM sp)
    GROUP BY 1, 2, 3 HAVING sum(d) <> 0), pts AS (SELECT DISTINCT chrom, pos FROM st),
    lv AS (SELECT p.chrom, p.pos, k.w, coalesce(t.step, 0) AS step FROM pts p CROSS JOIN ({WIDTHS}) k LEFT JOIN st t ON t.chrom = p.chrom AND t.pos = p.pos AND t.w = k.w),
    cum AS (SELECT chrom, pos, w, sum(step) OVER (PARTITION BY chrom, w ORDER BY pos) * 200.0::DOUBLE / w AS depth FROM lv),
    mx AS (SELECT chrom, pos, max(depth) AS m FROM cum GROUP BY 1, 2)
    SELECT * FROM (SELECT chrom, pos AS "start", lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS "end", {r('m')} AS value FROM mx) WHERE "end" IS NOT NULL""")
def _(v):
    return rounded(pk.local_background(_part(v, CONTROL), v.sizes), "value")


@query("call_peaks")
def _(v):
    return pk.call_peaks(_part(v, TREAT), _part(v, CONTROL), v.sizes, q=0.05, min_len=50)


GROUPED = DEPTH.replace("FROM reads", "FROM (SELECT * REPLACE (CASE WHEN sample < 's3' THEN 't' ELSE 'c' END AS sample) FROM reads)")


@query("filter_vs_control", f"""WITH d AS ({GROUPED}), t AS (SELECT * FROM d WHERE track = 't' AND value > 0), c AS (SELECT * FROM d WHERE track = 'c' AND value > 0),
    a AS (SELECT a.id, max(b.value) AS mx, avg(b.value) AS mn FROM peaks a JOIN t b ON {OV} GROUP BY 1), k AS (SELECT a.id, max(b.value) AS mx, avg(b.value) AS mn FROM peaks a JOIN c b ON {OV} GROUP BY 1)
    SELECT p.id FROM peaks p LEFT JOIN a USING (id) LEFT JOIN k USING (id) WHERE coalesce(k.mx, 0) * 1.5 < coalesce(a.mx, 0) AND coalesce(k.mn, 0) * 1.5 < coalesce(a.mn, 0)""")
def _(v):
    out = pk.filter_vs_control(v.peaks.select("id", *COORDS), sg.pileup(_part(v, TREAT)), sg.pileup(_part(v, CONTROL)), 1.5)
    return out.select("id")


# An island of qualifying peaks, as in ISLES but over the peaks with enough evidence.
FIT = ISLES.replace("FROM peaks)", "FROM peaks WHERE signal_value >= 4)")


@query("replicate_concordance", f"""WITH i AS ({FIT}), b AS (SELECT chrom, isle, batch, max(signal_value) AS best FROM i GROUP BY 1, 2, 3),
    s AS (SELECT chrom, isle, min("start") AS "start", max("end") AS "end" FROM i GROUP BY 1, 2),
    f AS (SELECT chrom, isle, count(*) AS replicates, sum(2 * ln(10.0::DOUBLE) * best) AS fisher FROM b GROUP BY 1, 2),
    p AS (SELECT *, exp(-fisher / 2) * (1 + CASE WHEN replicates > 1 THEN fisher / 2 ELSE 0 END + CASE WHEN replicates > 2 THEN pow(fisher / 2, 2) / 2 ELSE 0 END
        + CASE WHEN replicates > 3 THEN pow(fisher / 2, 3) / 6 ELSE 0 END + CASE WHEN replicates > 4 THEN pow(fisher / 2, 4) / 24 ELSE 0 END) AS p FROM f)
    SELECT s.chrom, s."start", s."end", replicates, {r('fisher')} AS fisher, {r('log10(p)')} AS log_p FROM p JOIN s USING (chrom, isle) WHERE replicates >= 2 AND p <= 1e-8""")
def _(v):
    out = pk.replicate_concordance(_summits(v), 1e-4, 1e-8, 2)
    out = out.withColumn("log_p", F.log10("combined_p")).drop("combined_p")
    return rounded(out, "fisher", "log_p")


def _evidence_sql(passes: str) -> str:
    """One row a peak: f the peaks, best the partners, tests the tests, j the verdicts, fdr over the confirmed."""
    tail = " + ".join(f"CASE WHEN replicates > {k} THEN pow(fisher / 2, {k}) / {f} ELSE 0 END" for k, f in ((1, 1), (2, 2), (3, 6), (4, 24)))
    return f"""f AS (SELECT chrom, "start" AS s, "end" AS e, batch, max(signal_value) AS q FROM peaks WHERE signal_value >= 4 GROUP BY ALL),
    best AS (SELECT a.chrom, a.s, a.e, a.batch, b.batch AS ob, arg_max(b.s, (b.q, -b.s, -b.e)) AS os, arg_max(b.e, (b.q, -b.s, -b.e)) AS oe, max(b.q) AS oq
        FROM f a JOIN f b ON a.chrom = b.chrom AND a.s < b.e AND b.s < a.e AND a.batch <> b.batch GROUP BY 1, 2, 3, 4, 5),
    t0 AS (SELECT f.*, coalesce(n, 0) + 1 AS replicates, 2 * ln(10.0::DOUBLE) * (q + coalesce(o, 0)) AS fisher
        FROM f LEFT JOIN (SELECT chrom, s, e, batch, count(*) AS n, sum(oq) AS o FROM best GROUP BY 1, 2, 3, 4) USING (chrom, s, e, batch)),
    t1 AS (SELECT *, exp(-fisher / 2) * (1 + {tail}) AS p FROM t0),
    tests AS (SELECT *, replicates >= 2 AND p <= 1e-8 AS ok FROM t1),
    asked AS (SELECT b.chrom, os AS s, oe AS e, ob AS batch, bool_and(ok) AS allok, bool_or(ok) AS anyok FROM best b JOIN tests t USING (chrom, s, e, batch) WHERE replicates >= 2 GROUP BY 1, 2, 3, 4),
    j AS (SELECT t.*, {passes} AS yes FROM tests t LEFT JOIN asked USING (chrom, s, e, batch)),
    raw AS (SELECT *, pow(10.0::DOUBLE, -q) * count(*) OVER (PARTITION BY batch) / count(*) OVER (PARTITION BY batch ORDER BY pow(10.0::DOUBLE, -q) RANGE UNBOUNDED PRECEDING) AS raw FROM j WHERE yes),
    fdr AS (SELECT chrom, s, e, batch, least(1, min(raw) OVER (PARTITION BY batch ORDER BY pow(10.0::DOUBLE, -q) DESC RANGE UNBOUNDED PRECEDING)) AS fdr FROM raw)"""


def _evidence(v, rule):
    # An evidence of 1 at most: some of the confirmed stay above the FDR bound.
    return pk.peak_evidence(_summits(v), 1e-4, 1e-8, 2, 1e-5, rule)


EVIDENCE = f"""chrom, s AS "start", e AS "end", batch AS replicate, CASE WHEN q >= 8 THEN 'strong' ELSE 'weak' END AS kind, replicates, {r('fisher')} AS fisher,
    {r('log10(p)')} AS log_p, CASE WHEN yes THEN 'confirmed' ELSE 'discarded' END AS verdict, {r('log10(fdr)')} AS log_fdr, coalesce(fdr <= 1e-5, FALSE) AS kept"""


def _logs(out):
    logged = out.withColumns({"log_p": F.log10("combined_p"), "log_fdr": F.log10("fdr")})
    return rounded(logged.drop("combined_p", "fdr", "neg_log10_p"), "fisher", "log_p", "log_fdr")


@query("peak_evidence", f"""WITH {_evidence_sql('ok AND coalesce(allok, TRUE)')} SELECT {EVIDENCE} FROM j LEFT JOIN fdr USING (chrom, s, e, batch)""")
def _(v):
    return _logs(_evidence(v, "technical"))


@query("peak_evidence_biological", f"""WITH {_evidence_sql('ok OR coalesce(anyok, FALSE)')} SELECT {EVIDENCE} FROM j LEFT JOIN fdr USING (chrom, s, e, batch)""")
def _(v):
    return _logs(_evidence(v, "biological"))


@query("confirmed_regions", f"""WITH {_evidence_sql('ok OR coalesce(anyok, FALSE)')},
    k AS (SELECT j.* FROM j JOIN fdr USING (chrom, s, e, batch) WHERE fdr <= 1e-5),
    n AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM k),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isle FROM n),
    g AS (SELECT chrom, min(s) AS "start", max(e) AS "end", count(DISTINCT batch) AS replicates, max(fisher) AS fisher, count(*) AS peaks FROM i GROUP BY chrom, isle)
    SELECT chrom, "start", "end", replicates, {r('fisher')} AS fisher, peaks FROM g ORDER BY g.fisher DESC, chrom, "start", "end" LIMIT 300""")
def _(v):
    return rounded(pk.confirmed_regions(_evidence(v, "biological"), 300), "fisher")


@query("consensus_summits")
def _(v):
    summits = _summits(v)
    return pk.consensus_summits(sg.merge_intervals(summits), summits, ["1", "2", "3", "4", "5"], 200, 2)


@query("peak_max_per_replicate", f"""WITH d AS ({DEPTH}) SELECT a.id, coalesce(max(b.value) FILTER (WHERE track = 's0'), 0)::DOUBLE AS max_s0, coalesce(max(b.value) FILTER (WHERE track = 's1'), 0)::DOUBLE AS max_s1,
    coalesce(max(b.value) FILTER (WHERE track = 's2'), 0)::DOUBLE AS max_s2, {r('''(coalesce(max(b.value) FILTER (WHERE track = 's0'), 0) + coalesce(max(b.value) FILTER (WHERE track = 's1'), 0)
    + coalesce(max(b.value) FILTER (WHERE track = 's2'), 0)) / 3''')} AS mean_max FROM peaks a LEFT JOIN d b ON {OV} AND b.value > 0 GROUP BY 1""")
def _(v):
    out = pk.peak_max_per_replicate(v.peaks.select("id", *COORDS), _tracks(v), TREAT)
    return rounded(out.select("id", "max_s0", "max_s1", "max_s2", "mean_max"), "mean_max")


NUM = "SELECT o_orderkey AS id, (o_totalprice % 97)::DOUBLE AS a, (o_totalprice % 89)::DOUBLE AS b, (o_totalprice % 83)::DOUBLE AS c, (o_custkey % 100)::DOUBLE * 3 AS d, 5.0::DOUBLE AS e FROM orders"


def _numbers(v):
    price = F.col("o_totalprice")
    return v.table("orders").select(
        F.col("o_orderkey").alias("id"), (price % 97).alias("a"), (price % 89).alias("b"), (price % 83).alias("c"),
        ((F.col("o_custkey") % 100) * 3).cast("double").alias("d"), F.lit(5.0).alias("e"),
    )


SD = "sqrt((pow(a - m, 2) + pow(b - m, 2) + pow(c - m, 2)) / 3)"
OUT = " + ".join(f"CASE WHEN abs({x} - m) > 1.2 * {SD} THEN 1 ELSE 0 END" for x in "abc")


@query("sd_outlier_filter", f"""SELECT id FROM (SELECT *, (a + b + c) / 3 AS m FROM ({NUM})) WHERE {OUT} < 1.5""")
def _(v):
    return pk.sd_outlier_filter(_numbers(v), ["a", "b", "c"], 1.2).select("id")


@query("replicate_ratio_filter", f"""SELECT id, {r('(a + b + c) / 3')} AS mean FROM ({NUM}) WHERE b <> 0 AND c <> 0 AND a / b > 0.4 AND a / b < 2.5 AND a / c > 0.4 AND a / c < 2.5""")
def _(v):
    return rounded(pk.replicate_ratio_filter(_numbers(v), ["a", "b", "c"]).select("id", "mean"), "mean")


@query("simple_clusters", f"""SELECT chrom, min("start") AS "start", max("end") AS "end", {r('avg("start" + summit_offset)')} AS mean_summit FROM ({ISLES}) GROUP BY chrom, isle HAVING count(*) = 3""")
def _(v):
    return rounded(pk.simple_clusters(_summits(v)), "mean_summit")


@query("split_complex_clusters")
def _(v):
    wide = _summits(v).withColumns({"start": F.greatest(F.col("start") - 1000, F.lit(0)), "end": F.col("end") + 1000})
    return pk.split_complex_clusters(wide, 200, 3)


@query("top_n_peaks", """SELECT id, chrom, "start", "end" FROM (SELECT *, row_number() OVER (ORDER BY signal_value DESC, chrom, "start", "end") AS k FROM peaks) WHERE k <= 500""")
def _(v):
    return pk.top_n_peaks(v.peaks, 500, "signal_value").select("id", *COORDS)


PV = "(o_orderkey * 7919 % 10007) / 10007.0::DOUBLE"
REMIX = f"""o AS (SELECT o_orderkey AS id, {PV} AS p FROM orders WHERE o_orderpriority < '3'), x AS (SELECT {PV} AS p FROM orders WHERE o_orderpriority >= '3'),
    n AS (SELECT count(*) + 1 AS n FROM x), xc AS (SELECT p, sum(count(*)) OVER (ORDER BY p) AS le FROM x GROUP BY p),
    rc AS (SELECT id, o.p, (coalesce(le, 0) + 1) / (SELECT n FROM n) AS rp FROM o ASOF LEFT JOIN xc ON o.p >= xc.p),
    raw AS (SELECT *, rp * count(*) OVER () / count(*) OVER (ORDER BY rp RANGE UNBOUNDED PRECEDING) AS raw FROM rc)"""


@query("recalibrate_pvalues", f"""WITH {REMIX} SELECT id, {r('rp')} AS recal_p, {r('least(1, min(raw) OVER (ORDER BY rp DESC RANGE UNBOUNDED PRECEDING))')} AS recal_fdr FROM raw""")
def _(v):
    p = (F.col("id") * 7919 % 10007 / 10007.0).alias("p_value")
    sets = v.peaks.select("id", p, "set")
    out = pk.recalibrate_pvalues(sets.where("set = 'A'").select("id", "p_value"), sets.where("set = 'B'").select("p_value"))
    return rounded(out.select("id", "recal_p", "recal_fdr"), "recal_p", "recal_fdr")


# --- merging sets ----------------------------------------------------------


# In order, one peak of each chromosome a step; ``used`` are the later peaks that are taken.
TWO_SETS = """RECURSIVE p AS (SELECT chrom, s, e, st, row_number() OVER (PARTITION BY chrom ORDER BY s, e, st) AS k FROM (SELECT DISTINCT chrom, "start" AS s, "end" AS e, "set" AS st FROM peaks)),
    w AS (SELECT a.chrom, a.k, min(b.k) AS j FROM p a JOIN p b ON a.chrom = b.chrom AND a.s < b.e AND b.s < a.e AND b.k > a.k
        WHERE b.e <= a.e OR (b.s < a.e AND (a.e - b.s) / least(a.e - a.s, b.e - b.s)::DOUBLE > 0.8) GROUP BY 1, 2),
    o AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY k) AS n FROM w),
    walk(chrom, n, k, j, takes, used) AS (
        SELECT DISTINCT chrom, 0::BIGINT, 0::BIGINT, 0::BIGINT, FALSE, []::BIGINT[] FROM o
        UNION ALL SELECT o.chrom, o.n, o.k, o.j, NOT list_contains(used, o.k),
            list_concat(list_filter(used, lambda x: x > o.k), CASE WHEN list_contains(used, o.k) THEN []::BIGINT[] ELSE [o.j] END)
        FROM walk JOIN o ON o.chrom = walk.chrom AND o.n = walk.n + 1),
    t AS (SELECT walk.chrom, i.k, i.s AS si, i.e AS ei, i.st AS ni, j.k AS jk, j.s AS sj, j.e AS ej, j.st AS nj, j.e <= i.e AS inside, i.e - i.s AS li, j.e - j.s AS lj
        FROM walk JOIN p i ON i.chrom = walk.chrom AND i.k = walk.k JOIN p j ON j.chrom = walk.chrom AND j.k = walk.j WHERE takes),
    merged AS (SELECT chrom, greatest(si, sj) AS s, least(ei, ej) AS e, 'both' AS st FROM t),
    spare AS (SELECT chrom, si AS s, sj - 1 AS e, ni AS st FROM t WHERE (sj - si) / li::DOUBLE > 0.5 AND (inside OR li >= lj)
        UNION ALL SELECT chrom, ej + 1, ei, ni FROM t WHERE inside AND (ei - ej) / li::DOUBLE > 0.5
        UNION ALL SELECT chrom, ei + 1, ej, nj FROM t WHERE NOT inside AND li < lj AND (ej - ei) / lj::DOUBLE > 0.5),
    rest AS (SELECT chrom, s, e, st FROM p WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.chrom = p.chrom AND (t.k = p.k OR t.jk = p.k)) UNION ALL SELECT * FROM spare WHERE e > s)"""


@query("merge_two_sets", f"""WITH {TWO_SETS} SELECT chrom, s AS "start", e AS "end", st AS "set" FROM merged
    UNION SELECT chrom, s, e, st FROM rest r WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.chrom = r.chrom AND m.s < r.e AND r.s < m.e AND least(m.e, r.e) - greatest(m.s, r.s) >= 0.9 * (r.e - r.s))""")
def _(v):
    return pk.merge_two_sets(v.peaks)


EXT = """SELECT DISTINCT chrom, greatest("start" - 150, 0) AS s, "end" + 150 AS e, "start" AS cs, "end" AS ce, "start" + ("end" - "start") // 2 AS m, "set" FROM peaks"""
KEY = "struct_pack(s := {0}.s, e := {0}.e, cs := {0}.cs, ce := {0}.ce, st := {0}.\"set\")"
EXTENDED = f"""p AS ({EXT}), j AS (SELECT a.chrom, {KEY.format('a')} AS ka, {KEY.format('b')} AS kb, a.m AS ma, b.m AS mb, abs(a.m - b.m) AS gap,
        CASE WHEN abs(a.m - b.m) <= least(abs(b.ce - a.ce), abs(b.cs - a.cs)) AND least(abs(b.ce - a.ce), abs(b.cs - a.cs)) < 0.25 * least(a.ce - a.cs, b.ce - b.cs) THEN 'maxClose'
            WHEN b.e <= a.e THEN 'contain' WHEN (a.e - b.s) / least(a.e - a.s, b.e - b.s)::DOUBLE >= 0.75 THEN 'partial' END AS reason
        FROM p a JOIN p b ON a.chrom = b.chrom AND a.s < b.e AND b.s < a.e AND a."set" <> b."set"
            AND (a.s, a.e, a.cs, a.ce, a."set") < (b.s, b.e, b.cs, b.ce, b."set")),
    fit AS (SELECT * FROM j WHERE reason IS NOT NULL),
    either AS (SELECT chrom, ka AS k, kb AS o, gap FROM fit UNION ALL SELECT chrom, kb, ka, gap FROM fit),
    best AS (SELECT chrom, k, o FROM (SELECT *, row_number() OVER (PARTITION BY chrom, k ORDER BY gap, o) AS rn FROM either) WHERE rn = 1),
    mut AS (SELECT f.* FROM fit f JOIN best x ON x.chrom = f.chrom AND x.k = f.ka AND x.o = f.kb JOIN best y ON y.chrom = f.chrom AND y.k = f.kb AND y.o = f.ka)"""


@query("merge_two_sets_extended", f"""WITH {EXTENDED} SELECT chrom, least(ka.s, kb.s) AS "start", greatest(ka.e, kb.e) AS "end", 'both' AS "set", (ma + mb) // 2 AS "max", reason FROM mut
    UNION ALL SELECT chrom, s, e, "set", m, 'None' FROM p WHERE NOT EXISTS (SELECT 1 FROM mut WHERE mut.chrom = p.chrom AND (mut.ka = {KEY.format('p')} OR mut.kb = {KEY.format('p')}))""")
def _(v):
    wide = v.peaks.select(
        "chrom", F.greatest(F.col("start") - 150, F.lit(0)).alias("start"), (F.col("end") + 150).alias("end"),
        F.col("start").alias("core_start"), F.col("end").alias("core_end"), "set",
    )
    return pk.merge_two_sets_extended(wide)


NSETS = """p AS (SELECT chrom, "start" AS s, "end" AS e, batch, summit_offset AS so, "start" + summit_offset AS top FROM peaks),
    l AS (SELECT *, lag(s) OVER w AS ps, lag(e) OVER w AS pe FROM p WINDOW w AS (PARTITION BY chrom ORDER BY s, e, batch, so)),
    c AS (SELECT *, sum(CASE WHEN pe IS NOT NULL AND (e <= pe OR (s <= pe AND (pe - s) / least(e - s, pe - ps)::DOUBLE >= 0.5)) THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY s, e, batch, so ROWS UNBOUNDED PRECEDING) AS contig FROM l),
    g AS (SELECT chrom, contig, count(*) AS n, arg_min(top, (s, e, batch, so)) AS ftop, arg_max(top, (s, e, batch, so)) AS ltop, arg_min(e - s, (s, e, batch, so)) AS flen, arg_max(e - s, (s, e, batch, so)) AS llen,
        min(s) AS s, max(e) AS e, avg(top) AS mean, min(e - s) AS shortest, string_agg(DISTINCT batch, '&' ORDER BY batch) AS name FROM c GROUP BY 1, 2),
    k AS (SELECT *, CASE WHEN n = 1 THEN 'unique' WHEN ltop - ftop <= 1.0 * least(flen, llen) THEN 'simple' ELSE 'complex' END AS kind FROM g),
    o AS (SELECT chrom, contig, shortest, unnest([ltop, ftop]) AS atop, unnest([llen, flen]) AS alen, unnest([1, 2]) AS which FROM k WHERE kind = 'complex'),
    b AS (SELECT chrom, contig, avg(top) AS mean, any_value(shortest) AS shortest, string_agg(DISTINCT batch, '&' ORDER BY batch) AS name FROM (
        SELECT c.chrom, c.contig, c.top, c.batch, k.shortest, floor((c.top - ftop) / greatest(1.0 * k.shortest, 1))::BIGINT AS step FROM c JOIN k USING (chrom, contig)
        WHERE kind = 'complex' AND abs(top - ftop) > 1.0 * least(flen, c.e - c.s) AND abs(top - ltop) > 1.0 * least(llen, c.e - c.s)) GROUP BY chrom, contig, step),
    x AS (SELECT o.chrom, o.contig, o.which, (sum(top) + any_value(atop)) / (count(*) + 1) AS mean, any_value(shortest) AS shortest, string_agg(DISTINCT batch, '&' ORDER BY batch) AS name
        FROM o JOIN c ON c.chrom = o.chrom AND c.contig = o.contig AND abs(top - atop) <= 1.0 * least(alen, e - s) GROUP BY 1, 2, 3),
    out AS (SELECT chrom, s AS "start", e AS "end", name, kind FROM k WHERE kind = 'unique'
        UNION ALL SELECT chrom, greatest(trunc(mean - 1.0 * shortest)::BIGINT, 0), trunc(mean + 1.2::DOUBLE * shortest)::BIGINT, name, kind FROM k WHERE kind = 'simple'
        UNION ALL SELECT chrom, greatest(trunc(mean - 1.0 * shortest)::BIGINT, 0), trunc(mean + 1.2::DOUBLE * shortest)::BIGINT, name, 'complex' FROM (FROM x SELECT chrom, mean, shortest, name UNION ALL FROM b SELECT chrom, mean, shortest, name))"""


def _nsets(v):
    return pk.merge_n_sets(v.peaks.select(*COORDS, F.col("batch").alias("set"), "summit_offset"), 0.5)


@query("merge_n_sets", f"""WITH {NSETS} SELECT * FROM out""")
def _(v):
    return _nsets(v)


@query("merge_summary", f"""WITH {NSETS} SELECT kind, count(*) AS n FROM out GROUP BY 1""")
def _(v):
    return pk.merge_summary(_nsets(v))


@query("consensus_peaks")
def _(v):
    return consensus_peaks(_summits(v), _tracks(v), ["1", "2", "3", "4", "5"], TREAT)
