"""Queries on the distances and orientations of binding sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import motifs as mt
from ..operators import resolve as rs
from ..operators import sequences as sq
from ..operators import spacing as sx
from .base import normal_p_sql, query, r, rounded
from .views import MOTIF, MOTIF_SHORT, PFM, PFM_SHORT

L = len(PFM_SHORT)
LOW, MIDDLE, HIGH = -8.0, -7.0, -6.0
CUTS = [LOW, MIDDLE, HIGH]

SITES = f"SELECT seq_id, pos, strand, score FROM win_short WHERE score > {LOW}"
# A site under the number of its stretch and of the one before, to be met by sites at most a stretch ahead of it.
NEXT = "SELECT *, unnest([pos // {1}, pos // {1} - 1]) AS kb FROM {0}"
CONF = "CASE WHEN a.strand = b.strand THEN 'DR' WHEN a.strand = '-' THEN 'ER' ELSE 'IR' END"
END1 = f"a.pos + {L} - CASE WHEN a.strand = '+' THEN 2 ELSE 1 END"
START2 = "b.pos + CASE WHEN b.strand = '+' THEN 1 ELSE 2 END"
PAIRS = f"""SELECT a.seq_id, {CONF} AS conf, ({START2} - ({END1}))::INT AS space, a.score AS score1, b.score AS score2, a.pos::INT AS pos1, b.pos::INT AS pos2,
    ({END1})::INT AS corr_pos1, ({START2})::INT AS corr_pos2 FROM s a JOIN ({NEXT.format('s', 64)}) b ON a.seq_id = b.seq_id AND a.pos // 64 = b.kb
    AND (a.pos < b.pos OR (a.pos = b.pos AND a.strand = '+' AND b.strand = '-')) AND b.pos - a.pos <= 60 WHERE {START2} - ({END1}) BETWEEN 0 AND 30"""
WITH = f"WITH s AS MATERIALIZED ({SITES}), pairs AS ({PAIRS})"
COUNTS = """SELECT threshold, conf, space, count(*) AS n FROM pairs JOIN (SELECT unnest([-8.0, -7.0, -6.0])::DOUBLE AS threshold) ON least(score1, score2) > threshold GROUP BY 1, 2, 3"""


def _sites(v):
    return mt.scan_pwm(v.seqs, v.short_model, LOW, with_kmer=False).select("seq_id", "pos", "strand", "score")


def _pairs(v):
    return sx.spacing_homotypic(_sites(v), L, 0, 30, 1, 2)


def _counts(v):
    return sx.spacing_counts(_pairs(v), CUTS)


@query("site_pairs", f"""WITH s AS MATERIALIZED ({SITES}) SELECT a.seq_id, a.pos::INT AS pos1, b.pos::INT AS pos2, a.strand AS strand1, b.strand AS strand2 FROM s a JOIN ({NEXT.format('s', 64)}) b
    ON a.seq_id = b.seq_id AND a.pos // 64 = b.kb AND (a.pos < b.pos OR (a.pos = b.pos AND a.strand = '+' AND b.strand = '-')) AND b.pos - a.pos <= 40""")
def _(v):
    return sx.site_pairs(_sites(v), 40).select("seq_id", "pos1", "pos2", "strand1", "strand2")


@query("spacing_homotypic", WITH + f""" SELECT seq_id, conf, space, {r('score1')} AS score1, {r('score2')} AS score2, pos1, pos2, corr_pos1, corr_pos2 FROM pairs""")
def _(v):
    return rounded(_pairs(v), "score1", "score2")


LONG = 11
HSITES = "SELECT seq_id, pos, strand, score FROM win_long WHERE score > -12"


def _long_sites(v):
    return mt.scan_pwm(v.seqs, v.model, -12.0, with_kmer=False).select("seq_id", "pos", "strand", "score")


def _one_way(x, y, size, lead, trail, opposed=True):
    conf = f"CASE WHEN a.strand = b.strand AND a.strand = '+' THEN '{lead}' WHEN a.strand = b.strand THEN '{trail}' WHEN a.strand = '-' THEN 'ER' ELSE 'IR' END"
    extra = "" if opposed else " AND a.strand = b.strand"
    return f"""SELECT a.seq_id, {conf} AS conf, (b.pos - a.pos - {size})::INT AS space, a.score AS sa, b.score AS sb, a.pos::INT AS pa, b.pos::INT AS pb FROM {x} a JOIN ({NEXT.format(y, 256)}) b
        ON a.seq_id = b.seq_id AND a.pos // 256 = b.kb AND b.pos - a.pos - {size} BETWEEN 0 AND 30{extra}"""


HETERO = f"""WITH x AS ({HSITES}), y AS ({SITES}), hp AS ({_one_way('x', 'y', LONG, 'DR12', 'DR21')}
    UNION ALL SELECT seq_id, conf, space, sb, sa, pb, pa FROM ({_one_way('y', 'x', L, 'DR21', 'DR12', False)}))"""


def _hetero(v):
    return sx.spacing_heterotypic(_long_sites(v), _sites(v), LONG, L, 0, 30)


@query("site_pairs_2", f"""WITH x AS ({HSITES}), y AS ({SITES}) SELECT a.seq_id, a.pos::INT AS pos1, b.pos::INT AS pos2, a.strand AS strand1, b.strand AS strand2
    FROM x a JOIN y b ON a.seq_id = b.seq_id AND abs(a.pos - b.pos) <= 40""")
def _(v):
    return sx.site_pairs_2(_long_sites(v), _sites(v), 40).select("seq_id", "pos1", "pos2", "strand1", "strand2")


@query("spacing_heterotypic", HETERO + f""" SELECT seq_id, conf, space, {r('sa')} AS score1, {r('sb')} AS score2, pa AS pos1, pb AS pos2 FROM hp""")
def _(v):
    return rounded(_hetero(v).select("seq_id", "conf", "space", "score1", "score2", "pos1", "pos2"), "score1", "score2")


@query("spacing_counts", WITH + f" SELECT threshold, conf, space, n FROM ({COUNTS})")
def _(v):
    return _counts(v)


@query("spacing_counts_heterotypic", HETERO + """ SELECT threshold, conf, space, count(*) AS n FROM hp JOIN (SELECT unnest([-8.0, -7.0])::DOUBLE AS threshold) ON least(sa, sb) > threshold GROUP BY 1, 2, 3""")
def _(v):
    return sx.spacing_counts(_hetero(v), [-8.0, -7.0])


@query("conformation_totals", WITH + f" SELECT threshold, conf, sum(n)::BIGINT AS total FROM ({COUNTS}) GROUP BY 1, 2")
def _(v):
    return sx.conformation_totals(_counts(v))


@query("collapse_ar", WITH + f" SELECT threshold, space, sum(n)::BIGINT AS n, 'AR' AS conf FROM ({COUNTS}) GROUP BY 1, 2")
def _(v):
    return sx.collapse_ar(_counts(v))


# Positive and negative sequences are those labelled good and bad.
LABELS = "SELECT doc_id AS seq_id, quality FROM labels"
SPLIT = WITH + f""", c AS (SELECT quality, threshold, conf, space, count(*) AS n FROM pairs JOIN ({LABELS}) USING (seq_id)
    JOIN (SELECT unnest([-8.0, -7.0])::DOUBLE AS threshold) ON least(score1, score2) > threshold GROUP BY 1, 2, 3, 4)"""


def _split_counts(v):
    tagged = _pairs(v).join(v.table("labels").select(F.col("doc_id").alias("seq_id"), "quality"), "seq_id")
    of = lambda q: sx.spacing_counts(tagged.where(F.col("quality") == q), [-8.0, -7.0])
    return of(1), of(0)


@query("relative_enrichment", SPLIT + f""", sh AS (SELECT quality, threshold, conf, space, n / sum(n) OVER (PARTITION BY quality, threshold) AS share FROM c),
    al AS (SELECT * FROM sh UNION ALL SELECT quality, threshold, 'ALL', space, sum(share) FROM sh GROUP BY 1, 2, 4)
    SELECT threshold, conf, space, {r('p.share')} AS pos_share, {r('n.share')} AS neg_share, {r('p.share / n.share')} AS enrichment
    FROM (SELECT * FROM al WHERE quality = 1) p FULL JOIN (SELECT * FROM al WHERE quality = 0) n USING (threshold, conf, space)""")
def _(v):
    return rounded(sx.relative_enrichment(*_split_counts(v)), "pos_share", "neg_share", "enrichment")


@query("absolute_rate", SPLIT + f""", len AS (SELECT quality, sum(greatest(length(seq) + 1 - {L}, 0)) AS l FROM seqs JOIN ({LABELS}) USING (seq_id) GROUP BY 1),
    t AS (SELECT quality, threshold, conf, sum(n) AS n FROM c GROUP BY 1, 2, 3)
    SELECT p.threshold, p.conf, {r('coalesce((p.n / n.n) / ((SELECT l FROM len WHERE quality = 1) / (SELECT l FROM len WHERE quality = 0)), 0)')} AS rate
    FROM t p LEFT JOIN t n ON n.quality = 0 AND p.threshold = n.threshold AND p.conf = n.conf WHERE p.quality = 1""")
def _(v):
    sized = v.labelled.select("label", F.length("seq").alias("seq_len"))
    length = lambda q: sized.where(F.col("label") == q).agg(sx.scannable_length(sized, L).alias("length"))
    return rounded(sx.absolute_rate(*_split_counts(v), length(1), length(0)), "rate")


STATS = f"""c AS ({COUNTS}), span AS (SELECT threshold, min(space) AS lo, max(space) AS hi FROM c GROUP BY 1),
    m AS (SELECT threshold, conf, median(n) AS u FROM c GROUP BY 1, 2),
    e AS (SELECT threshold, conf, any_value(u) AS u, median(abs(n - u)) * 1.4826 AS sigma FROM c JOIN m USING (threshold, conf) GROUP BY 1, 2),
    grid AS (SELECT threshold, conf, u, sigma, unnest(range(lo, hi + 1))::INT AS space FROM e JOIN span USING (threshold)),
    z AS (SELECT g.threshold, g.conf, g.space, coalesce(n, 0) AS n, coalesce(n, 0) / u AS fc, CASE WHEN sigma > 0 THEN (coalesce(n, 0) - u) / sigma END AS z
        FROM grid g LEFT JOIN c ON c.threshold = g.threshold AND c.conf = g.conf AND c.space = g.space)"""
PVALS = STATS + f""", p AS (SELECT *, CASE WHEN z IS NOT NULL THEN {normal_p_sql('z')} END AS p FROM z),
    q AS (SELECT *, least(1, p * count(p) OVER (PARTITION BY threshold)) AS p_adj FROM p)"""


@query("spacing_fc_z", WITH + f", {STATS} SELECT threshold, conf, space, n, {r('fc')} AS fc, {r('z')} AS z FROM z")
def _(v):
    return rounded(sx.spacing_fc_z(_counts(v)), "fc", "z")


@query("spacing_fc_z_mean", WITH + f""", c AS ({COUNTS}), span AS (SELECT threshold, min(space) AS lo, max(space) AS hi FROM c GROUP BY 1),
    e AS (SELECT threshold, conf, avg(n) AS u, stddev_samp(n) AS sigma FROM c GROUP BY 1, 2),
    grid AS (SELECT threshold, conf, u, sigma, unnest(range(lo, hi + 1))::INT AS space FROM e JOIN span USING (threshold))
    SELECT g.threshold, g.conf, g.space, coalesce(n, 0) AS n, {r('coalesce(n, 0) / u')} AS fc, CASE WHEN sigma > 0 THEN {r('(coalesce(n, 0) - u) / sigma')} END AS z
    FROM grid g LEFT JOIN c ON c.threshold = g.threshold AND c.conf = g.conf AND c.space = g.space""")
def _(v):
    return rounded(sx.spacing_fc_z(_counts(v), "mean"), "fc", "z")


@query("spacing_fc_z_uniform", WITH + f""", c AS ({COUNTS}), span AS (SELECT threshold, min(space) AS lo, max(space) AS hi FROM c GROUP BY 1),
    e AS (SELECT threshold, conf, sum(n) AS pop, 1.0::DOUBLE / (hi - lo + 1) AS p, lo, hi FROM c JOIN span USING (threshold) GROUP BY 1, 2, lo, hi),
    grid AS (SELECT *, unnest(range(lo, hi + 1))::INT AS space FROM e)
    SELECT g.threshold, g.conf, g.space, coalesce(n, 0) AS n, {r('coalesce(n, 0) / (pop * p)')} AS fc, {r('(coalesce(n, 0) - pop * p) / sqrt(pop * p * (1 - p))')} AS z
    FROM grid g LEFT JOIN c ON c.threshold = g.threshold AND c.conf = g.conf AND c.space = g.space""")
def _(v):
    return rounded(sx.spacing_fc_z(_counts(v), "uniform"), "fc", "z")


@query("spacing_fc_z_with_zeros", WITH + f""", c AS ({COUNTS}), span AS (SELECT threshold, min(space) AS lo, max(space) AS hi FROM c GROUP BY 1),
    grid AS (SELECT threshold, conf, unnest(range(lo, hi + 1))::INT AS space FROM (SELECT DISTINCT threshold, conf FROM c) JOIN span USING (threshold)),
    f AS (SELECT threshold, conf, space, coalesce(n, 0) AS n FROM grid LEFT JOIN c USING (threshold, conf, space)), m AS (SELECT threshold, conf, median(n) AS u FROM f GROUP BY 1, 2),
    e AS (SELECT threshold, conf, any_value(u) AS u, median(abs(n - u)) * 1.4826 AS sigma FROM f JOIN m USING (threshold, conf) GROUP BY 1, 2)
    SELECT threshold, conf, space, n, CASE WHEN u > 0 THEN {r('n / u')} END AS fc, CASE WHEN sigma > 0 THEN {r('(n - u) / sigma')} END AS z FROM f JOIN e USING (threshold, conf)""")
def _(v):
    return rounded(sx.spacing_fc_z(_counts(v), zeros=True), "fc", "z")


def _tested(v):
    return sx.spacing_pvalues(sx.spacing_fc_z(_counts(v)))


@query("spacing_pvalues", WITH + f", {PVALS} SELECT threshold, conf, space, {r('p')} AS p_value, {r('p_adj')} AS p_adj FROM q")
def _(v):
    return rounded(_tested(v).select("threshold", "conf", "space", "p_value", "p_adj"), "p_value", "p_adj")


SIG = "SELECT * FROM q WHERE n > 0 AND log2(fc) > 0.1 AND p_adj < 0.05"


@query("significant_spacings", WITH + f", {PVALS} SELECT threshold, conf, space, n FROM ({SIG})")
def _(v):
    return sx.significant_spacings(_tested(v), 0.1).select("threshold", "conf", "space", "n")


@query("spacing_candidates", WITH + f", {PVALS} SELECT conf, space, count(DISTINCT threshold) AS n_thresholds FROM ({SIG}) GROUP BY 1, 2 HAVING count(DISTINCT threshold) >= 2")
def _(v):
    return sx.spacing_candidates(sx.significant_spacings(_tested(v), 0.1))


# --- transcription starts --------------------------------------------------

# One start in the middle of each region, with a strand.
TSS = """SELECT chrom, ("start" + "end") // 2 AS pos, CASE WHEN seq_id % 2 = 0 THEN '+' ELSE '-' END AS strand FROM spots"""
TSITES = f"""SELECT s.seq_id, (t.pos - s."start" + 1)::INT AS pos, t.strand, -1.0::DOUBLE AS score FROM spots s JOIN ({TSS}) t ON t.chrom = s.chrom AND s."start" >= t.pos - 200 AND s."end" <= t.pos + 201"""
BSITES = """SELECT s.seq_id, (w.pos - s."start")::INT AS pos, w.strand, w.score FROM win_short w JOIN spots s ON w.seq_id = s.doc_id AND (w.pos - 1) // 300 = s.k WHERE w.score > -12 AND w.pos + 5 <= s."end" """
TPAIRS = f"""WITH x AS ({BSITES}), y AS ({TSITES}), tp AS ({_one_way('x', 'y', L, 'DR12', 'DR21').replace('AND 30', 'AND 200')}
    UNION ALL SELECT seq_id, conf, space, sb, sa, pb, pa FROM ({_one_way('y', 'x', 1, 'DR21', 'DR12').replace('AND 30', 'AND 200')}))"""


def _tss(v):
    return v.spots.select(
        "chrom", F.floor((F.col("start") + F.col("end")) / 2).alias("pos"), F.when(F.col("seq_id") % 2 == 0, "+").otherwise("-").alias("strand")
    )


def _tss_pairs(v):
    regions = sq.extract_sequences(v.spots, v.contigs)
    sites = mt.scan_pwm(regions, v.short_model, -12.0, with_kmer=False)
    return sx.spacing_to_tss(sites, sx.peaks_with_tss(v.spots, _tss(v), 200), L, 0, 200)


@query("peaks_with_tss", f"""SELECT seq_id, pos, strand, score FROM ({TSITES})""")
def _(v):
    return sx.peaks_with_tss(v.spots, _tss(v), 200)


@query("spacing_to_tss", TPAIRS + f""" SELECT seq_id, conf, space, {r('sa')} AS score1, pa AS pos1, pb AS pos2 FROM tp""")
def _(v):
    return rounded(_tss_pairs(v).select("seq_id", "conf", "space", "score1", "pos1", "pos2"), "score1")


SLIDE = TPAIRS + """, g AS (SELECT unnest(range(0, 201))::INT AS d), w AS (SELECT d, count(*) FILTER (WHERE conf = 'DR12') AS dr12, count(*) FILTER (WHERE conf = 'ER') AS er,
    count(*) FILTER (WHERE conf = 'DR21') AS dr21, count(*) FILTER (WHERE conf = 'IR') AS ir FROM g LEFT JOIN tp ON space BETWEEN d AND d + 9 GROUP BY 1),
    sl AS (SELECT 'before' AS side, d AS "start", d + 9 AS "end", dr12 AS same, er AS opposite FROM w UNION ALL SELECT 'after', d, d + 9, dr21, ir FROM w)"""


def _slide(v):
    return sx.sliding_orientation_counts(_tss_pairs(v), 10, 200)


@query("sliding_orientation_counts", SLIDE + ' SELECT * FROM sl')
def _(v):
    return _slide(v)


@query("orientation_tests", SLIDE + f""", t AS (SELECT *, same + opposite AS n FROM sl WHERE same + opposite > 0),
    yt AS (SELECT *, least(0.5, abs(same - opposite) / 2.0) AS y FROM t), xt AS (SELECT *, 4 * pow(abs(same - n / 2) - y, 2) / (n / 2) AS chi2 FROM yt),
    p AS (SELECT *, {normal_p_sql('sqrt(chi2)')} AS p FROM xt), w2 AS (SELECT *, p * count(*) OVER (PARTITION BY side) / count(*) OVER (PARTITION BY side ORDER BY round(p, 9) RANGE UNBOUNDED PRECEDING) AS raw FROM p)
    SELECT side, "start", "end", same, opposite, {r('chi2')} AS chi2, {r('p')} AS p_value, {r('least(1, min(raw) OVER (PARTITION BY side ORDER BY round(p, 9) DESC RANGE UNBOUNDED PRECEDING))', 5)} AS p_adj FROM w2""")
def _(v):
    out = sx.orientation_tests(_slide(v)).select("side", "start", "end", "same", "opposite", "chi2", "p_value", "p_adj")
    return rounded(rounded(out, "chi2", "p_value"), "p_adj", digits=5)


TSTATS = TPAIRS.replace("tp AS (", "pairs0 AS (") + """, pairs AS (SELECT *, sa AS score1, sa AS score2 FROM pairs0), """ + STATS.replace("[-8.0, -7.0, -6.0]", "[-12.0, -9.0]")


def _tss_stats(v):
    return sx.spacing_fc_z(sx.spacing_counts(_tss_pairs(v), [-12.0, -9.0], score="score1"))


@query("tss_candidate_table", TSTATS + f""", cand AS (SELECT conf, space FROM z WHERE z > 1 GROUP BY 1, 2)
    SELECT CASE WHEN conf IN ('DR12', 'ER') THEN -space ELSE space END AS distance, conf, conf IN ('DR12', 'DR21') AS same_orientation,
    CASE WHEN conf IN ('DR12', 'ER') THEN 'before' ELSE 'after' END AS position, {r('avg(z)')} AS mean_z FROM z JOIN cand USING (conf, space) GROUP BY conf, space HAVING avg(z) > 0""")
def _(v):
    stats = _tss_stats(v)
    cand = stats.where("z > 1").select("conf", "space").distinct()
    return rounded(sx.tss_candidate_table(stats, cand), "mean_z")


@query("orientation_global", TSTATS + f""", k AS (SELECT conf, space FROM z WHERE z > 1 GROUP BY 1, 2), cand AS (SELECT conf, space FROM z JOIN k USING (conf, space) GROUP BY 1, 2 HAVING avg(z) > 0),
    n AS (SELECT count(*) FILTER (WHERE conf IN ('DR12', 'ER')) AS x1, count(*) FILTER (WHERE conf NOT IN ('DR12', 'ER')) AS x2, count(*) AS n FROM cand)
    SELECT x1, x2, n, {r('x1 / n')} AS prop_1, {r('x2 / n')} AS prop_2 FROM n""")
def _(v):
    stats = _tss_stats(v)
    table = sx.tss_candidate_table(stats, stats.where("z > 1").select("conf", "space").distinct())
    return rounded(sx.orientation_global(table, "position", "before", "after").select("x1", "x2", "n", "prop_1", "prop_2"), "prop_1", "prop_2")


# --- other tables over pairs -----------------------------------------------


@query("pairs_to_regions", WITH + f""" SELECT seq_id::VARCHAR AS chrom, (least(pos1, pos2) - 1)::BIGINT AS "start", (greatest(pos1, pos2) + {L} - 1)::BIGINT AS "end",
    conf || '_' || space AS name, {r('score1 + score2')} AS score, '+' AS strand FROM pairs""")
def _(v):
    regions = v.seqs.select("seq_id", F.col("seq_id").cast("string").alias("chrom"), F.lit(0).cast("long").alias("start"))
    return rounded(sx.pairs_to_regions(_pairs(v), regions, L), "score")


@query("sites_per_model", f"""SELECT '{MOTIF_SHORT}' AS motif_id, count(*) AS n_sites FROM win_short WHERE score > -7
    UNION ALL SELECT '{MOTIF}', count(*) FROM win_long WHERE score > -7""")
def _(v):
    return sx.sites_per_model(mt.scan_pwm(v.seqs, v.models, LOW, with_kmer=False), -7.0)


# Sites of one kind of event each, met in windows of 20 kb.
ITEMS = """SELECT DISTINCT chrom || ':' || ("start" // 20000) AS w, track AS m FROM signal"""


RULES = f"""s AS ({ITEMS}), n AS (SELECT m, count(*) AS n FROM s GROUP BY 1), w AS (SELECT count(DISTINCT w) AS w FROM s),
    p AS (SELECT a.m AS tf1, b.m AS tf2, count(*) AS pair_count FROM s a JOIN s b USING (w) WHERE a.m < b.m GROUP BY 1, 2),
    j AS (SELECT p.*, x.n AS tf1_count, y.n AS tf2_count, w FROM p JOIN n x ON x.m = tf1 JOIN n y ON y.m = tf2 CROSS JOIN w)"""
ZSCORE = """CASE WHEN tf1_count < w AND tf2_count < w THEN (pair_count - tf1_count * tf2_count / w) / sqrt(tf1_count * tf2_count / w * (1 - tf1_count / w) * (1 - tf2_count / w) * w / (w - 1)) END"""


def _rules(v):
    window = F.concat_ws(":", "chrom", F.floor(F.col("start") / 20000).cast("string"))
    return sx.cooccurrence_rules(v.signal.select(window.alias("seq_id"), F.col("track").alias("motif_id")))


@query("cooccurrence_rules", f"""WITH {RULES} SELECT tf1, tf2, pair_count, tf1_count, tf2_count, {r('pair_count / w')} AS support, {r('pair_count / tf1_count')} AS confidence, {r('pair_count * w / (tf1_count * tf2_count)')} AS lift,
    {r('pair_count / sqrt(tf1_count * tf2_count)')} AS cosine, {r(ZSCORE)} AS zscore FROM j""")
def _(v):
    return rounded(_rules(v), "support", "confidence", "lift", "cosine", "zscore")


@query("significant_rules", f"""WITH {RULES}, r AS (SELECT tf1, tf2, {ZSCORE} AS z, pair_count / sqrt(tf1_count * tf2_count) AS c FROM j),
    cut AS (SELECT quantile_cont(round(z, 9), 0.6) AS z, quantile_cont(round(c, 9), 0.6) AS c FROM r) SELECT r.tf1, r.tf2, {r('r.z')} AS zscore, {r('r.c')} AS cosine FROM r, cut WHERE round(r.z, 9) >= cut.z AND round(r.c, 9) >= cut.c""")
def _(v):
    return rounded(sx.significant_rules(_rules(v), ["zscore", "cosine"], 0.4).select("tf1", "tf2", "zscore", "cosine"), "zscore", "cosine")


@query("cooccurrence_distances", """WITH s AS (SELECT chrom, "start" AS pos, track AS m FROM signal), near AS (SELECT *, unnest([pos // 4096 - 1, pos // 4096, pos // 4096 + 1]) AS kb FROM s)
    SELECT a.m AS tf1, b.m AS tf2, (abs(b.pos - a.pos) - 1)::BIGINT AS distance, count(*) AS n FROM s a JOIN near b ON a.chrom = b.chrom AND a.pos // 4096 = b.kb AND a.m < b.m AND abs(b.pos - a.pos) - 1 BETWEEN 0 AND 4000 GROUP BY 1, 2, 3""")
def _(v):
    sites = v.signal.select(F.col("chrom").alias("seq_id"), F.col("track").alias("motif_id"), F.col("start").alias("pos"), F.col("end").alias("stop"))
    return sx.cooccurrence_distances(sites, 0, 4000)


# Sites of both motifs; a walk in order of place from the first site of each sequence.
MIXED = f"""SELECT '{MOTIF}' AS motif_id, seq_id, pos, pos + {len(PFM)} AS stop, strand, round(score, 9) AS score FROM win_long WHERE score > {LOW}
    UNION ALL SELECT '{MOTIF_SHORT}', seq_id, pos, pos + {len(PFM_SHORT)}, strand, round(score, 9) FROM win_short WHERE score > {LOW}"""
RESOLVED = f"""WITH RECURSIVE best AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id, pos ORDER BY score DESC, stop, motif_id DESC, strand DESC) AS k FROM ({MIXED})) WHERE k = 1),
    nx AS MATERIALIZED (SELECT a.seq_id, a.pos, min(b.pos) AS taker, coalesce(bool_or(b.pos < a.stop AND b.score > a.score), false) AS beaten
        FROM best a LEFT JOIN best b ON a.seq_id = b.seq_id AND b.pos > a.pos AND (b.pos >= a.stop OR b.score > a.score) GROUP BY 1, 2),
    walk AS (SELECT seq_id, min(pos) AS pos FROM best GROUP BY 1 UNION ALL SELECT w.seq_id, n.taker FROM walk w JOIN nx n USING (seq_id, pos) WHERE n.taker IS NOT NULL),
    kept AS (SELECT best.* EXCLUDE (k) FROM best JOIN nx USING (seq_id, pos) JOIN walk USING (seq_id, pos) WHERE NOT beaten)"""


def _mixed(v):
    hits = mt.scan_pwm(v.seqs, v.models, LOW, with_kmer=False)
    return hits.select("motif_id", "seq_id", "pos", "stop", "strand", F.round("score", 9).alias("score"))


@query("resolve_overlaps", RESOLVED + f""" SELECT motif_id, seq_id, pos::INT AS pos, stop::INT AS stop, strand, {r('score')} AS score FROM kept""")
def _(v):
    return rounded(rs.resolve_overlaps(_mixed(v), ties=["motif_id", "strand"]), "score")


# Mean of the neighbourhood, less its least-squares line, in units of its spread; a top is above the distance before.
def _peaks_sql(curve: str, lowest: int, highest: int, smooth: int, least: float) -> str:
    return f"""f AS (SELECT p.tf1, p.tf2, p.d AS distance, coalesce(c.n, 0)::BIGINT AS n
        FROM (SELECT * FROM (SELECT DISTINCT tf1, tf2 FROM {curve}) CROSS JOIN (SELECT unnest(range({lowest}, {highest} + 1)) AS d)) p LEFT JOIN {curve} c ON c.tf1 = p.tf1 AND c.tf2 = p.tf2 AND c.distance = p.d),
    l AS (SELECT *, avg(n) OVER (PARTITION BY tf1, tf2 ORDER BY distance ROWS BETWEEN {smooth} PRECEDING AND {smooth} FOLLOWING) AS level FROM f),
    m AS (SELECT tf1, tf2, regr_slope(level, distance) AS slope, regr_intercept(level, distance) AS base FROM l GROUP BY 1, 2),
    a AS (SELECT l.*, round(level - (base + slope * distance), 9) AS above FROM l JOIN m USING (tf1, tf2)),
    z AS (SELECT *, stddev_pop(above) OVER (PARTITION BY tf1, tf2) AS spread, lag(above) OVER o AS b, lead(above) OVER o AS e FROM a WINDOW o AS (PARTITION BY tf1, tf2 ORDER BY distance))
    SELECT tf1, tf2, distance, n, {r('above')} AS above, {r('above / spread')} AS zscore FROM z WHERE spread > 1e-9 AND above / spread >= {least} AND (b IS NULL OR above > b) AND (e IS NULL OR above >= e)"""


TRACK_CURVE = """c0 AS (WITH s AS (SELECT chrom, "start" AS pos, track AS m FROM signal), near AS (SELECT *, unnest([pos // 4096 - 1, pos // 4096, pos // 4096 + 1]) AS kb FROM s)
    SELECT a.m AS tf1, b.m AS tf2, (abs(b.pos - a.pos) - 1)::BIGINT AS distance, count(*) AS n FROM s a JOIN near b ON a.chrom = b.chrom AND a.pos // 4096 = b.kb AND a.m < b.m AND abs(b.pos - a.pos) - 1 BETWEEN 0 AND 4000 GROUP BY 1, 2, 3)"""


@query("preferred_distances", f"WITH {TRACK_CURVE}, " + _peaks_sql("c0", 0, 4000, 20, 2.0))
def _(v):
    sites = v.signal.select(F.col("chrom").alias("seq_id"), F.col("track").alias("motif_id"), F.col("start").alias("pos"), F.col("end").alias("stop"))
    return rounded(rs.preferred_distances(sx.cooccurrence_distances(sites, 0, 4000), 0, 4000, 20), "above", "zscore")


SITE_CURVE = """c0 AS (SELECT a.motif_id AS tf1, b.motif_id AS tf2, greatest(a.pos, b.pos) - least(a.stop, b.stop) AS distance, count(*) AS n
    FROM kept a JOIN kept b ON a.seq_id = b.seq_id AND a.motif_id < b.motif_id AND greatest(a.pos, b.pos) - least(a.stop, b.stop) BETWEEN 0 AND 100 GROUP BY 1, 2, 3)"""


@query("cooccurrence_peaks", f"{RESOLVED}, {SITE_CURVE}, " + _peaks_sql("c0", 0, 100, 2, 1.5))
def _(v):
    from ..plans.cooccurrence import cooccurrence_peaks

    peaks = cooccurrence_peaks(_mixed(v), 0, 100, smooth=2, least=1.5, share=1.0, ties=["motif_id", "strand"])
    return rounded(peaks, "above", "zscore")


@query("preferred_spacing_flag", WITH + """ SELECT q.seq_id, t.threshold, CASE WHEN EXISTS (SELECT 1 FROM pairs p WHERE p.seq_id = q.seq_id AND least(score1, score2) >= t.threshold
    AND (conf || '_' || space) IN ('DR_2', 'ER_5', 'IR_0')) THEN 1 ELSE 0 END AS flag FROM seqs q CROSS JOIN (SELECT unnest([-8.0, -7.0, -6.0, -5.0])::DOUBLE AS threshold) t""")
def _(v):
    return sx.preferred_spacing_flag(v.seqs.select("seq_id"), _pairs(v), [("DR", 2), ("ER", 5), ("IR", 0)], [-8, -7, -6, -5])


DEC = """SELECT doc_id AS seq_id, least((row_number() OVER (ORDER BY n_chars, doc_id) - 1) // greatest(round(count(*) OVER () / 10), 1)::BIGINT + 1, 10)::INT AS decile FROM documents"""
DCOUNTS = f"""SELECT decile, threshold, conf, space, count(*) AS n FROM pairs JOIN ({DEC}) USING (seq_id) JOIN (SELECT unnest([-8.0])::DOUBLE AS threshold) ON least(score1, score2) > threshold GROUP BY 1, 2, 3, 4"""


@query("decile_spacing_matrix", WITH + f""", c AS ({DCOUNTS}), span AS (SELECT decile, threshold, min(space) AS lo, max(space) AS hi FROM c GROUP BY 1, 2),
    m AS (SELECT decile, threshold, conf, median(n) AS u FROM c GROUP BY 1, 2, 3),
    e AS (SELECT decile, threshold, conf, any_value(u) AS u, median(abs(n - u)) * 1.4826 AS sigma FROM c JOIN m USING (decile, threshold, conf) GROUP BY 1, 2, 3),
    grid AS (SELECT decile, threshold, conf, u, sigma, unnest(range(lo, hi + 1))::INT AS space FROM e JOIN span USING (decile, threshold))
    SELECT g.decile, g.threshold, g.conf, g.space, coalesce(n, 0) AS n, {r('coalesce(n, 0) / u')} AS fc, CASE WHEN sigma > 0 THEN {r('(coalesce(n, 0) - u) / sigma')} END AS z
    FROM grid g LEFT JOIN c ON c.decile = g.decile AND c.threshold = g.threshold AND c.conf = g.conf AND c.space = g.space""")
def _(v):
    from ..operators.normalise import ratio_deciles

    deciles = ratio_deciles(v.table("documents").select(F.col("doc_id").alias("seq_id"), F.col("n_chars").cast("double").alias("size")), "size", "seq_id")
    return rounded(sx.decile_spacing_matrix(_pairs(v), deciles, [-8.0]), "fc", "z")


@query("spacing_enrichment", WITH + f", {PVALS} SELECT threshold, conf, space, n, {r('fc')} AS fc, {r('z')} AS z, {r('p_adj')} AS p_adj FROM q")
def _(v):
    from ..plans.spacing import spacing_enrichment

    out = spacing_enrichment(v.seqs, v.short_model[0], CUTS, 0, 30, 1, 2)
    return rounded(out.select("threshold", "conf", "space", "n", "fc", "z", "p_adj"), "fc", "z", "p_adj")
