"""Queries on sequences, motifs, model evaluation, score distributions and sampling."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import dna
from ..operators import evaluation as ev
from ..operators import motifs as mt
from ..operators import sampling as sp
from ..operators import sequences as sq
from ..operators.overlap import COORDS
from ..runtime import cut_lineage
from .base import query, r, rounded
from .views import MOTIF, MOTIF_SHORT, PFM, PFM_SHORT, _log_scores, windows_sql

HIGH = -8.0

# --- sequences -------------------------------------------------------------


@query("extract_sequences", """SELECT seq_id, substr(seq, "start" + 1, "end" - "start") AS seq FROM spots""")
def _(v):
    return sq.extract_sequences(v.spots, v.contigs).select("seq_id", "seq")


GC = """CASE WHEN length(s) > 0 THEN (length(s) - length(translate(s, 'CG', ''))) / length(s) END"""


@query("gc_content", f"""SELECT seq_id, {r(GC)} AS gc FROM (SELECT seq_id, substr(seq, "start" + 1, "end" - "start") AS s FROM spots)""")
def _(v):
    return rounded(sq.with_gc(sq.extract_sequences(v.spots, v.contigs), 6).select("seq_id", "gc"), "gc")


@query("cg_count", """SELECT seq_id, length(seq) - length(translate(seq, 'CG', '')) AS cg FROM seqs""")
def _(v):
    return v.seqs.select("seq_id", dna.cg_count(F.col("seq")).cast("long").alias("cg"))


@query("reverse_complement", """SELECT seq_id, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS rc FROM seqs""")
def _(v):
    return v.seqs.select("seq_id", F.md5(dna.reverse_complement(F.col("seq"))).alias("rc"))


@query("augment_rc", """SELECT seq_id, unnest(['+', '-']) AS strand, unnest([md5(seq), md5(reverse(translate(seq, 'ACGT', 'TGCA')))]) AS seq FROM seqs WHERE length(seq) >= 100""")
def _(v):
    return sq.augment_rc(v.seqs.select("seq_id", "seq"), 100).withColumn("seq", F.md5("seq"))


@query("one_hot", """WITH b AS (SELECT seq_id, unnest(range(0, length(seq))) AS i, unnest(string_split(seq, '')) AS b FROM seqs WHERE length(seq) > 0)
    SELECT seq_id, (i // 500)::INT AS "window", count(*) FILTER (WHERE b = 'A')::DOUBLE AS a, count(*) FILTER (WHERE b = 'C')::DOUBLE AS c,
    count(*) FILTER (WHERE b = 'G')::DOUBLE AS g, count(*) FILTER (WHERE b = 'T')::DOUBLE AS t,
    (sum(CASE WHEN b = 'T' THEN 500 - i % 500 ELSE 0 END))::DOUBLE AS rc_a FROM b GROUP BY 1, 2""")
def _(v):
    hot = sq.one_hot(v.seqs.select("seq_id", "seq"), 500)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    spots = F.aggregate(
        F.transform(F.col("reverse")[0], lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda acc, x: acc + x
    )
    return hot.select(
        "seq_id", "window", *[total(F.col("forward")[i]).alias(b) for i, b in enumerate("acgt")], spots.alias("rc_a")
    )


KMERS = """SELECT seq_id, label, least(w, reverse(translate(w, 'ACGT', 'TGCA'))) AS kmer FROM (SELECT seq_id, label,
    b || lead(b, 1) OVER w || lead(b, 2) OVER w || lead(b, 3) OVER w || lead(b, 4) OVER w || lead(b, 5) OVER w AS w FROM (
    SELECT seq_id, label, unnest(range(0, length(seq))) AS i, unnest(string_split(seq, '')) AS b FROM labelled WHERE length(seq) > 0)
    WINDOW w AS (PARTITION BY seq_id ORDER BY i)) WHERE w IS NOT NULL"""


@query("kmer_enrichment", f"""WITH t AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM labelled)
    SELECT kmer, pos, neg, round(log2(((pos + 1) / (p + 1)) / ((neg + 1) / (n + 1))), 9) AS enrichment FROM (
    SELECT kmer, count(DISTINCT seq_id) FILTER (WHERE label = 1) AS pos, count(DISTINCT seq_id) FILTER (WHERE label = 0) AS neg FROM ({KMERS}) GROUP BY 1), t
    ORDER BY 4 DESC, 2 DESC, 1 LIMIT 50""")
def _(v):
    return sq.kmer_enrichment(v.labelled, "label", 6, 6, 50)


@query("kmer_score_sequences", f"""SELECT seq_id, {r('coalesce(s, 0)')} AS kmer_score FROM seqs LEFT JOIN (
    SELECT seq_id, sum(score) AS s FROM win_long WHERE score > {HIGH} GROUP BY 1) USING (seq_id)""")
def _(v):
    hits = mt.scan_pwm(v.seqs, v.model, HIGH)
    return rounded(sq.kmer_score_sequences(v.seqs.select("seq_id"), hits, "seq_id", "SUM"), "kmer_score")


@query("kmer_score_best", f"""SELECT seq_id, {r('coalesce(s, 0)')} AS kmer_score FROM seqs LEFT JOIN (
    SELECT seq_id, max(score) AS s FROM win_long WHERE score > {HIGH} GROUP BY 1) USING (seq_id)""")
def _(v):
    hits = mt.scan_pwm(v.seqs, v.model, HIGH)
    return rounded(sq.kmer_score_sequences(v.seqs.select("seq_id"), hits, "seq_id", "BEST"), "kmer_score")


@query("kmer_score_mean", f"""SELECT seq_id, {r('coalesce(s, 0)')} AS kmer_score FROM seqs LEFT JOIN (
    SELECT seq_id, avg(score) AS s FROM win_long WHERE score > {HIGH} GROUP BY 1) USING (seq_id)""")
def _(v):
    hits = mt.scan_pwm(v.seqs, v.model, HIGH)
    return rounded(sq.kmer_score_sequences(v.seqs.select("seq_id"), hits, "seq_id", "MEAN"), "kmer_score")


@query("labelled_sequences", """SELECT CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label, md5(substr(seq, "start" + 1, "end" - "start")) AS seq, chrom, "start", "end"
    FROM spots JOIN labels USING (doc_id)""")
def _(v):
    spots = v.spots.join(v.table("labels").select("doc_id", "quality"), "doc_id")
    out = sq.labelled_sequences(spots.where("quality = 1"), spots.where("quality = 0"), v.contigs)
    return out.withColumn("seq", F.md5("seq"))


# --- matrices --------------------------------------------------------------


@query("pfm_from_sites", f"""SELECT pos, count(*) FILTER (WHERE b = 'A') AS "A", count(*) FILTER (WHERE b = 'C') AS "C", count(*) FILTER (WHERE b = 'G') AS "G",
    count(*) FILTER (WHERE b = 'T') AS "T" FROM (SELECT unnest(range(1, {len(PFM) + 1}))::INT AS pos, unnest(string_split(kmer, '')) AS b FROM win_long WHERE score > {HIGH}) GROUP BY 1""")
def _(v):
    return mt.pfm_from_sites(mt.scan_pwm(v.seqs, v.model, HIGH), "kmer")


LEARNED = f"""SELECT pos, b, count(*) AS n FROM (SELECT unnest(range(1, {len(PFM) + 1}))::INT AS pos, unnest(string_split(kmer, '')) AS b
    FROM win_long WHERE score > {HIGH}) GROUP BY 1, 2"""
FULL = f"""SELECT p.pos, p.b AS base, coalesce(n, 0) AS n FROM (SELECT * FROM (SELECT unnest(range(1, {len(PFM) + 1}))::INT AS pos) CROSS JOIN (SELECT unnest(['A', 'C', 'G', 'T']) AS b)) p
    LEFT JOIN ({LEARNED}) l USING (pos, b)"""
LEARNED_PWM = f"""SELECT pos, base, n, ln((n / total + pc) / (max(n / total) OVER (PARTITION BY pos) + pc)) AS score FROM (
    SELECT *, CASE WHEN min(n) OVER () = 0 THEN 1 / max(total) OVER () ELSE 0 END AS pc FROM (SELECT *, sum(n) OVER (PARTITION BY pos) AS total FROM ({FULL})))"""


def _learned(v):
    """Count matrix of the sites found in all sequences."""
    wide = mt.pfm_from_sites(mt.scan_pwm(v.seqs, v.model, HIGH), "kmer")
    long = wide.select("pos", F.explode(F.create_map(*[x for b in "ACGT" for x in (F.lit(b), F.col(b))])).alias("base", "n"))
    return long.select(
        F.lit("learned").alias("motif_id"), F.lit("learned").alias("name"), F.lit("COUNT").alias("kind"), F.lit("ASYMMETRIC").alias("symmetry"),
        F.lit(0).alias("block"), F.col("pos").cast("int").alias("row"), "base", F.col("n").cast("double").alias("value"), F.lit(None).cast("array<int>").alias("positions"),
    )


@query("pfm_to_pwm", f"""SELECT pos AS "row", base, {r('score')} AS value FROM ({LEARNED_PWM})""")
def _(v):
    return rounded(mt.pfm_to_pwm(_learned(v)).select("row", "base", "value"), "value")


@query("rc_matrix", f"""SELECT ({len(PFM) + 1} - pos)::INT AS "row", translate(base, 'ACGT', 'TGCA') AS base, n::DOUBLE AS value FROM ({FULL})""")
def _(v):
    return mt.rc_matrix(_learned(v)).select("row", "base", "value")


@query("compose_dimers", f"""WITH m AS ({FULL}), c AS (SELECT 'ER' AS conf, 7 AS s UNION ALL SELECT 'DR', 5 UNION ALL SELECT 'IR', 0)
    SELECT 'learned_' || conf || '_' || s AS motif_id, pos::INT AS "row", CASE WHEN conf = 'ER' THEN translate(base, 'ACGT', 'TGCA') ELSE base END AS base, n::DOUBLE AS value
        FROM (SELECT conf, s, CASE WHEN conf = 'ER' THEN 12 - pos ELSE pos END AS pos, base, n FROM m CROSS JOIN c)
    UNION ALL SELECT 'learned_' || conf || '_' || s, (11 + greatest(s - 2, 0) + pos)::INT, CASE WHEN conf = 'IR' THEN translate(base, 'ACGT', 'TGCA') ELSE base END, n::DOUBLE
        FROM (SELECT conf, s, CASE WHEN conf = 'IR' THEN 12 - pos ELSE pos END AS pos, base, n FROM m CROSS JOIN c)
    UNION ALL SELECT 'learned_' || conf || '_' || s, (11 + i)::INT, b, 1.0 FROM (SELECT conf, s, unnest(range(1, s - 1)) AS i FROM c WHERE s > 2) CROSS JOIN (SELECT unnest(['A', 'C', 'G', 'T']) AS b)""")
def _(v):
    wish = v.spark.createDataFrame([("learned", "ER", 7), ("learned", "DR", 5), ("learned", "IR", 0)], "motif_id string, conf string, spacing int")
    return mt.compose_dimers(_learned(v), wish, 1, 1).select("motif_id", "row", "base", "value")


@query("compose_hetero", f"""WITH a AS ({FULL}), z AS (SELECT pos, base, n FROM (VALUES {", ".join(f"({i + 1}, '{b}', {c})" for i, row in enumerate(PFM_SHORT) for b, c in zip("ACGT", row))}) t(pos, base, n))
    SELECT 'learned_{MOTIF_SHORT}_DR21_4' AS motif_id, pos::INT AS "row", base, n::DOUBLE AS value FROM z
    UNION ALL SELECT 'learned_{MOTIF_SHORT}_DR21_4', (6 + 4 + pos)::INT, base, n::DOUBLE FROM a
    UNION ALL SELECT 'learned_{MOTIF_SHORT}_DR21_4', (6 + i)::INT, b, 1.0 FROM (SELECT unnest(range(1, 5)) AS i) CROSS JOIN (SELECT unnest(['A', 'C', 'G', 'T']) AS b)
    UNION ALL SELECT 'learned_{MOTIF_SHORT}_ER_3', (12 - pos)::INT, translate(base, 'ACGT', 'TGCA'), n::DOUBLE FROM a
    UNION ALL SELECT 'learned_{MOTIF_SHORT}_ER_3', (11 + 3 + pos)::INT, base, n::DOUBLE FROM z
    UNION ALL SELECT 'learned_{MOTIF_SHORT}_ER_3', (11 + i)::INT, b, 1.0 FROM (SELECT unnest(range(1, 4)) AS i) CROSS JOIN (SELECT unnest(['A', 'C', 'G', 'T']) AS b)""")
def _(v):
    both = _learned(v).unionByName(v.motifs.where(F.col("motif_id") == MOTIF_SHORT))
    wish = v.spark.createDataFrame(
        [("learned", MOTIF_SHORT, "DR21", 4), ("learned", MOTIF_SHORT, "ER", 3)], "motif_1 string, motif_2 string, conf string, spacing int"
    )
    return mt.compose_hetero(both, wish).select("motif_id", "row", "base", "value")


# --- scanning --------------------------------------------------------------


@query("scan_pwm", f"""SELECT '{MOTIF}' AS motif_id, seq_id, pos::INT AS pos, (pos + {len(PFM)})::INT AS stop, strand, kmer, 'PWM' AS type, {len(PFM)} AS motif_len, {r('score')} AS score
    FROM win_long WHERE score > {HIGH}
    UNION ALL SELECT '{MOTIF_SHORT}', seq_id, pos::INT, (pos + {len(PFM_SHORT)})::INT, strand, kmer, 'PWM', {len(PFM_SHORT)}, {r('score')} FROM win_short WHERE score > {HIGH}""")
def _(v):
    return rounded(mt.scan_pwm(v.seqs, v.models, HIGH), "score")


@query("filter_sites", f"""SELECT seq_id, pos::INT AS pos, strand, {r('score')} AS score FROM win_long WHERE score > -6""")
def _(v):
    from ..operators.filters import filter_sites

    sites = filter_sites(mt.scan_pwm(v.seqs, v.model, HIGH), -6.0)
    return rounded(sites.select("seq_id", "pos", "strand", "score"), "score")


# One dependency block: positions 3 and 4 are scored together.
DEPENDENT = [[1 + (5 * i + 3 * j) % 11 for j in range(4)] for i in range(4)]


def _dependent_score(reverse: bool) -> str:
    rows = _log_scores(PFM)
    n = len(PFM)
    if reverse:
        rows = [row[::-1] for row in rows[::-1]]
    first = n - 4 if reverse else 2
    plain = [
        "CASE b{} {} END".format(j, " ".join(f"WHEN '{b}' THEN {t}" for b, t in zip("ACGT", row)))
        for j, row in enumerate(rows) if j not in (first, first + 1)
    ]
    comp = dict(zip("ACGT", "TGCA"))
    cells = []
    for i, a in enumerate("ACGT"):
        most = max(DEPENDENT[i])
        for j, b in enumerate("ACGT"):
            word = comp[b] + comp[a] if reverse else a + b
            cells.append(f"WHEN '{word}' THEN ln({DEPENDENT[i][j]} / {most}::DOUBLE)")
    return " + ".join(plain) + f" + CASE b{first} || b{first + 1} {' '.join(cells)} END"


def _dependent_windows() -> str:
    n = len(PFM)
    leads = ", ".join(f"lead(b, {j}) OVER w AS b{j}" for j in range(n))
    return f"""SELECT seq_id, pos, unnest(['+', '-']) AS strand, unnest([{_dependent_score(False)}, {_dependent_score(True)}]) AS score
        FROM (SELECT seq_id, pos, {leads} FROM (SELECT seq_id, unnest(range(1, length(seq) + 1)) AS pos, unnest(string_split(seq, '')) AS b FROM seqs WHERE length(seq) >= {n})
        WINDOW w AS (PARTITION BY seq_id ORDER BY pos)) WHERE b{n - 1} IS NOT NULL"""


@query("scan_pwm_dependency", f"""SELECT seq_id, pos::INT AS pos, strand, {r('score')} AS score FROM ({_dependent_windows()}) WHERE score > -7""")
def _(v):
    block = [
        (MOTIF, MOTIF, "COUNT", "ASYMMETRIC", 1, i + 1, b, float(DEPENDENT[i][j]), [3, 4]) for i in range(4) for j, b in enumerate("ACGT")
    ]
    rows = mt.motif_rows(MOTIF, "COUNT", "ASYMMETRIC", PFM) + block
    models = mt.collect_models(mt.pfm_to_pwm(v.spark.createDataFrame(rows, mt.MOTIF_SCHEMA)))
    return rounded(mt.scan_pwm(v.seqs, models, -7.0).select("seq_id", "pos", "strand", "score"), "score")


BEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY round(score, 9) DESC, pos, strand) AS k FROM {}) WHERE k = 1"""
SHORT_SEQS = f"""SELECT seq_id, 1 AS pos, substr(seq, 1, 1) AS kmer, -66.0 AS score FROM seqs WHERE length(seq) < {len(PFM)}"""


@query("best_site", f"""SELECT seq_id, {r('score')} AS score FROM ({BEST.format('win_long')})
    UNION ALL SELECT seq_id, score FROM ({SHORT_SEQS})""")
def _(v):
    return rounded(mt.scan_best(v.seqs, v.model).select("seq_id", "score"), "score")


@query("best_site_of_hits", f"""SELECT seq_id, {r('score')} AS score FROM ({BEST.format(f'(SELECT * FROM win_long WHERE score > {HIGH})')})""")
def _(v):
    return rounded(mt.best_site(mt.scan_pwm(v.seqs, v.model, HIGH)).select("seq_id", "score"), "score")


@query("occupancy", f"""SELECT seq_id, {r('sum(e / (1 + e))')} AS occupancy FROM (SELECT seq_id, exp(score - 0.5) * exp(0.5) AS e FROM win_long
    UNION ALL SELECT seq_id, exp(-66.5) * exp(0.5) FROM ({SHORT_SEQS}) CROSS JOIN (SELECT unnest([1, 2]))) GROUP BY 1""")
def _(v):
    return rounded(mt.scan_occupancy(v.seqs, v.model, 1.0, 0.5).select("seq_id", "occupancy"), "occupancy")


@query("occupancy_of_hits", f"""SELECT seq_id, {r('sum(e / (1 + e))')} AS occupancy FROM (SELECT seq_id, exp(score) AS e FROM win_long WHERE score > {HIGH}) GROUP BY 1""")
def _(v):
    return rounded(mt.occupancy(mt.scan_pwm(v.seqs, v.model, HIGH)).select("seq_id", "occupancy"), "occupancy")


SPOT_SEQS = """SELECT seq_id, substr(seq, "start" + 1, "end" - "start") AS seq FROM spots"""


def _spot_seqs(v):
    return sq.extract_sequences(v.spots, v.contigs)


@query("site_to_genome", f"""SELECT s.seq_id, chrom, "start" + pos - 1 AS "start", "start" + pos - 1 + {len(PFM)} AS "end", strand FROM ({windows_sql(PFM, f'({SPOT_SEQS})')}) w JOIN spots s USING (seq_id)
    WHERE score > -15""")
def _(v):
    regions = _spot_seqs(v)
    sites = mt.scan_pwm(regions, v.model, -15.0)
    return mt.site_to_genome(sites, regions).select("seq_id", *COORDS, "strand")


@query("add_scores_to_table", f"""WITH a AS (SELECT seq_id, max(score) AS s, sum(exp(score) / (1 + exp(score))) AS o FROM ({windows_sql(PFM, f'({SPOT_SEQS})')}) GROUP BY 1),
    b AS (SELECT seq_id, max(score) AS s, sum(exp(score) / (1 + exp(score))) AS o FROM ({windows_sql(PFM_SHORT, f'({SPOT_SEQS})')}) GROUP BY 1)
    SELECT seq_id, chrom, "start", "end", {r('coalesce(a.s, -66)')} AS long_score, {r('coalesce(b.s, -66)')} AS short_score,
    {r('coalesce(a.o, 0)')} AS long_occupancy, {r('coalesce(b.o, 0)')} AS short_occupancy FROM spots LEFT JOIN a USING (seq_id) LEFT JOIN b USING (seq_id)""")
def _(v):
    out = mt.add_scores_to_table(v.spots, _spot_seqs(v), v.models, with_occupancy=True)
    names = {f"{m}_{c}": f"{tag}_{c}" for m, tag in ((MOTIF, "long"), (MOTIF_SHORT, "short")) for c in ("score", "occupancy")}
    out = out.select("seq_id", *COORDS, *[F.col(a).alias(b) for a, b in names.items()])
    return rounded(out, *names.values())


@query("score_with_model", """SELECT seq_id, length(seq)::BIGINT AS n, ((length(seq) - length(translate(seq, 'CG', ''))) / greatest(length(seq), 1) > 0.5) AS rich FROM seqs""")
def _(v):
    def batch(frame: pd.DataFrame) -> pd.DataFrame:
        n = frame["seq"].str.len()
        rich = frame["seq"].str.count("[CG]") / n.clip(lower=1) > 0.5
        return pd.DataFrame({"seq_id": frame["seq_id"], "n": n, "rich": rich})

    return mt.score_with_model(v.seqs.select("seq_id", "seq"), batch, "seq_id long, n long, rich boolean")


@query("train_site_classifier")
def _(v):
    best = mt.scan_best(v.labelled, v.models).groupBy("seq_id").agg(
        *[F.max(F.when(F.col("motif_id") == m.motif_id, F.col("score"))).alias(f"f{i}") for i, m in enumerate(v.models)]
    )
    data = best.join(v.labelled.select("seq_id", "label", F.length("seq").cast("double").alias("size")), "seq_id")
    model, scored = mt.train_site_classifier(data, ["f0", "f1", "size"], "label")
    return scored


# --- evaluation ------------------------------------------------------------

# Scores are rounded so that both engines see the same ties.
SCORED = f"""SELECT model, seq_id, label, round(score, 6) AS score FROM (
    SELECT '{MOTIF}' AS model, seq_id, label, coalesce(max(score), -66) AS score FROM labelled LEFT JOIN ({windows_sql(PFM, 'labelled')}) USING (seq_id) GROUP BY 2, 3
    UNION ALL SELECT '{MOTIF_SHORT}', seq_id, label, coalesce(max(score), -66) FROM labelled LEFT JOIN ({windows_sql(PFM_SHORT, 'labelled')}) USING (seq_id) GROUP BY 2, 3)"""
ROC = f"""SELECT model, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS "P", sum(neg) OVER (PARTITION BY model) AS "N"
    FROM (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM ({SCORED}) GROUP BY 1, 2) WINDOW w AS (PARTITION BY model ORDER BY score DESC)"""
AUC = 'sum(neg / "N" * (2 * tp - pos) / (2 * "P"))'
PAUC = """sum(CASE WHEN f0 >= 0.1 THEN 0 WHEN f1 <= 0.1 THEN (f1 - f0) * (t0 + t1) / 2 ELSE (0.1 - f0) * (t0 + t0 + (t1 - t0) * (0.1 - f0) / (f1 - f0)) / 2 END)"""
EDGES = f"""SELECT *, (fp - neg) / "N" AS f0, fp / "N" AS f1, (tp - pos) / "P" AS t0, tp / "P" AS t1 FROM ({ROC})"""


def _scored(v):
    best = mt.scan_best(v.labelled, v.models).select(F.col("motif_id").alias("model"), "seq_id", (F.round("score", 6) + F.lit(0.0)).alias("score"))
    return best.join(v.labelled.select("seq_id", "label"), "seq_id")


@query("roc_points", f"""SELECT model, score + 0.0 AS score, {r('fp / "N"')} AS fpr, {r('tp / "P"')} AS tpr FROM ({ROC})""")
def _(v):
    points = ev.roc_points(_scored(v), keys=["model"])
    return rounded(points.select("model", "score", "fpr", "tpr"), "fpr", "tpr")


@query("auc", f"""SELECT model, {r(AUC, 3)} AS auc FROM ({ROC}) GROUP BY 1""")
def _(v):
    return rounded(ev.auc(ev.roc_points(_scored(v), keys=["model"]), ["model"]), "auc", digits=3)


@query("partial_auc", f"""SELECT model, {r(PAUC, 3)} AS partial_auc FROM ({EDGES}) GROUP BY 1""")
def _(v):
    return rounded(ev.partial_auc(ev.roc_points(_scored(v), keys=["model"]), 0.1, ["model"]), "partial_auc", digits=3)


@query("average_precision", f"""SELECT model, {r('sum(tp / (tp + fp) * pos / "P")')} AS average_precision FROM ({ROC}) GROUP BY 1""")
def _(v):
    return rounded(ev.average_precision(ev.roc_points(_scored(v), keys=["model"]), ["model"]), "average_precision")


@query("multi_model_roc", f"""SELECT model, {r(AUC)} AS auc, {r(PAUC)} AS partial_auc, {r('sum(tp / (tp + fp) * pos / "P")')} AS average_precision FROM ({EDGES}) GROUP BY 1""")
def _(v):
    return rounded(ev.multi_model_roc(_scored(v), 0.1), "auc", "partial_auc", "average_precision")


SWEEP = f"""SELECT g.model, g.step / 100.0::DOUBLE AS threshold, tp, fp, "P", "N" FROM (
    SELECT s.model, s."P", s."N", s.step, (SELECT count(*) FROM c WHERE c.model = s.model AND c.label = 1 AND c.cell >= s.step) AS tp,
        (SELECT count(*) FROM c WHERE c.model = s.model AND c.label = 0 AND c.cell >= s.step) AS fp FROM (
        SELECT model, unnest(range((round(min(score)) * 100)::BIGINT, floor(max(score) * 100)::BIGINT + 1)) AS step, count(*) FILTER (WHERE label = 1) AS "P", count(*) FILTER (WHERE label = 0) AS "N"
        FROM c GROUP BY model) s) g"""
SWEEP_COLS = f"""model, threshold, (tp + fp)::BIGINT AS retrieved, CASE WHEN tp + fp > 0 THEN {r('tp / (tp + fp)')} END AS "precision", {r('tp / "P"')} AS recall,
    {r('tp / (tp + 0.5 * fp + 0.5 * ("P" - tp))')} AS f1, {r('tp / (tp + 0.2 * fp + 0.8 * ("P" - tp))')} AS f2, {r('tp / (tp + 0.1 * fp + 0.9 * ("P" - tp))')} AS f3, {r('("N" - fp) / "N"')} AS specificity"""


@query("threshold_sweep", f"""WITH c AS (SELECT *, floor(score * 100)::BIGINT AS cell FROM ({SCORED})) SELECT {SWEEP_COLS} FROM ({SWEEP})""")
def _(v):
    out = ev.threshold_sweep(_scored(v), keys=["model"])
    return rounded(out, "precision", "recall", "f1", "f2", "f3", "specificity")


@query("best_thresholds", f"""WITH c AS (SELECT *, floor(score * 100)::BIGINT AS cell FROM ({SCORED})), s AS (SELECT {SWEEP_COLS} FROM ({SWEEP}))
    SELECT model, arg_max(threshold, f1 - threshold * 1e-9) AS best_f1, arg_max(threshold, f2 - threshold * 1e-9) AS best_f2, arg_max(threshold, f3 - threshold * 1e-9) AS best_f3 FROM s GROUP BY 1""")
def _(v):
    sweep = rounded(ev.threshold_sweep(_scored(v), keys=["model"]), "f1", "f2", "f3")
    return ev.best_thresholds(sweep, ["model"])


@query("sensitivity_specificity", f"""SELECT model, threshold, {r('count(*) FILTER (WHERE label = 1 AND score >= threshold) / count(*) FILTER (WHERE label = 1)')} AS se,
    {r('count(*) FILTER (WHERE label = 0 AND score >= threshold) / count(*) FILTER (WHERE label = 0)')} AS one_minus_sp FROM ({SCORED}) CROSS JOIN (SELECT unnest([-9.0, -7.0, -5.0, -3.0])::DOUBLE AS threshold) GROUP BY 1, 2""")
def _(v):
    out = ev.sensitivity_specificity(_scored(v), [-9, -7, -5, -3], keys=["model"])
    return rounded(out, "se", "one_minus_sp")


@query("rank_pair", f"""WITH k AS (SELECT label, score, row_number() OVER (PARTITION BY label ORDER BY score DESC, seq_id) AS "rank" FROM ({SCORED}) WHERE model = '{MOTIF}')
    SELECT "rank", a.score AS positive, b.score AS negative FROM (SELECT * FROM k WHERE label = 1) a FULL JOIN (SELECT * FROM k WHERE label = 0) b USING ("rank")""")
def _(v):
    return ev.rank_pair(_scored(v).where(F.col("model") == MOTIF))


# --- score distributions ---------------------------------------------------

ALL = f"""SELECT '{MOTIF}' AS motif_id, strand, round(score, 6) AS score FROM win_long
    UNION ALL SELECT '{MOTIF}', unnest(['+', '-']), -66.0::DOUBLE FROM seqs WHERE length(seq) < {len(PFM)}"""
GENOME = "(SELECT sum(length(seq)) FROM seqs)"


def _counts(v):
    """Counted scores of all windows; a sequence too short for the motif counts once a strand."""
    counts = mt.scan_score_counts(v.seqs, v.model)
    return counts.withColumn("score", F.round("score", 6) + F.lit(0.0))


def _genome(v):
    return v.seqs.agg(F.sum(F.length("seq")).cast("double").alias("g"))


@query("score_quantiles", f"""SELECT motif_id, p AS prob, {r('quantile_cont(score, p)')} AS quantile FROM ({ALL}) CROSS JOIN (SELECT unnest([0.99, 0.992, 0.995, 0.997, 0.999])::DOUBLE AS p) GROUP BY 1, 2""".replace(
    "quantile_cont(score, p)", "list_extract(list_sort(list(score)), (floor((count(*) - 1) * p) + 1)::BIGINT) + ((count(*) - 1) * p - floor((count(*) - 1) * p)) * (list_extract(list_sort(list(score)), (ceil((count(*) - 1) * p) + 1)::BIGINT) - list_extract(list_sort(list(score)), (floor((count(*) - 1) * p) + 1)::BIGINT))"))
def _(v):
    return rounded(ev.score_quantiles(_counts(v), [0.99, 0.992, 0.995, 0.997, 0.999]), "quantile")


RANKED = f"""d AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM ({ALL}))"""


def _interpolate(source: str, prob: str, total: str) -> str:
    """Linear-interpolation quantile by two ranked lookups."""
    h = f"({total} - 1) * {prob}"
    return f"lo.score + ({h} - floor({h})) * (hi.score - lo.score)", f"JOIN {source} lo ON lo.i = floor({h})::BIGINT JOIN {source} hi ON hi.i = ceil({h})::BIGINT"


_Q, _J = _interpolate("d", "g.prob", "g.n")


@query("quantile_density_grid", f"""WITH {RANKED}, g AS (SELECT round(0.9 + k / 10000.0::DOUBLE, 4) AS prob, (SELECT any_value(n) FROM d) AS n FROM (SELECT unnest(range(750, 1000)) AS k)),
    c AS (SELECT g.prob, {_Q} AS th FROM g {_J}), plus AS (SELECT score, count(*) AS n FROM ({ALL}) WHERE strand = '+' GROUP BY 1)
    SELECT '{MOTIF}' AS motif_id, {r('th')} AS threshold, prob, {r(f'(SELECT coalesce(sum(n), 0) FROM plus WHERE plus.score >= c.th) / ({GENOME} / 1000)')} AS sites_per_kb FROM c""")
def _(v):
    # the genome length is one number
    g = _genome(v).first().g
    return rounded(ev.quantile_density_grid(_counts(v), g), "threshold", "sites_per_kb")


_QP, _JP = _interpolate("d", "g.prob", "g.n")


@query("density_to_threshold", f"""WITH d AS MATERIALIZED (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM ({ALL}) WHERE strand = '+'),
    g AS (SELECT k / 100.0::DOUBLE AS sites_per_kb, n, greatest(1 - (k / 100.0::DOUBLE) * ({GENOME} / 1000.0::DOUBLE) / n, 0) AS prob FROM (SELECT unnest(range(1, 501)) AS k), (SELECT any_value(n) AS n FROM d))
    SELECT '{MOTIF}' AS motif_id, {r(_QP)} AS threshold, {r('g.prob')} AS prob, sites_per_kb FROM g {_JP}""")
def _(v):
    g = _genome(v).first().g
    return rounded(ev.density_to_threshold(_counts(v), g), "threshold", "prob")


@query("score_histogram", f"""SELECT motif_id, CASE WHEN score < -40 THEN 0 WHEN score >= 0 THEN 41 ELSE floor(score + 40)::BIGINT + 1 END AS bin, count(*) AS n FROM ({ALL}) GROUP BY 1, 2""")
def _(v):
    return ev.score_histogram(_counts(v), -40.0, 0.0, 40, ["motif_id"], weight=F.col("n"))


@query("ecdf", f"""SELECT motif_id, score + 0.0 AS score, {r('sum(n) OVER (ORDER BY score) / sum(n) OVER ()')} AS ecdf FROM (SELECT motif_id, score, count(*) AS n FROM ({ALL}) GROUP BY 1, 2)""")
def _(v):
    return rounded(ev.ecdf(_counts(v), ["motif_id"]), "ecdf")


_QT, _JT = _interpolate("d", "g.prob", "g.n")


@query("lookup_thresholds", f"""WITH {RANKED}, g AS (SELECT unnest([0.995, 0.997, 0.999])::DOUBLE AS prob, (SELECT any_value(n) FROM d) AS n), c AS (SELECT g.prob, {r(_QT)} AS th FROM g {_JT})
    SELECT '{MOTIF}' AS motif_id, max(th) FILTER (WHERE prob = 0.995) AS th_0_995, max(th) FILTER (WHERE prob = 0.997) AS th_0_997, max(th) FILTER (WHERE prob = 0.999) AS th_0_999 FROM c""")
def _(v):
    counts = _counts(v)
    cuts = rounded(ev.score_quantiles(counts, [0.99, 0.992, 0.995, 0.997, 0.999]), "quantile")
    return ev.lookup_thresholds(counts.select("motif_id").distinct(), cuts)


# --- sampling --------------------------------------------------------------


@query("split_top", """WITH k AS (SELECT id, row_number() OVER (ORDER BY signal_value DESC, id) AS k FROM peaks)
    SELECT id, 'train' AS part FROM k WHERE k <= 600 UNION ALL SELECT id, 'test' FROM k WHERE k > 600""")
def _(v):
    return sp.split_top(v.peaks.select("id", "signal_value"), 600, "signal_value", "id").select("id", "part")


@query("split_percent", """SELECT seq_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY d, seq_id) <= floor(count(*) OVER (PARTITION BY label) * 80.0 / 100) THEN 'train' ELSE 'test' END AS part
    FROM (SELECT seq_id, label, ('0x' || substr(md5(concat_ws(':', seq_id, 42)), 1, 12))::BIGINT AS d FROM labelled)""")
def _(v):
    return sp.split_percent(v.labelled.select("seq_id", "label"), 80, 42, "seq_id", ["label"])


@query("split_fixed", """SELECT id, CASE WHEN row_number() OVER (ORDER BY id) <= 1000 THEN 'train' ELSE 'test' END AS part FROM peaks""")
def _(v):
    return sp.split_fixed(v.peaks.select("id"), 1000, "id")


@query("remix_samples", """WITH p AS (SELECT 't:' || o_orderkey AS uid, o_orderkey AS id FROM orders WHERE o_orderpriority < '3' UNION ALL SELECT 'c:' || o_orderkey, o_orderkey FROM orders WHERE o_orderpriority >= '3')
    SELECT id, CASE WHEN row_number() OVER (ORDER BY ('0x' || substr(md5(concat_ws(':', uid, 3)), 1, 12))::BIGINT, uid) <= (SELECT count(*) FROM orders WHERE o_orderpriority < '3') THEN 'treatment' ELSE 'control' END AS remix FROM p""")
def _(v):
    sets = v.peaks.select("id", "set")
    return sp.remix_samples(sets.where("set = 'A'").select("id"), sets.where("set = 'B'").select("id"), 3, "id")


TYPED = f"""SELECT b.chrom, b."start", b."end", coalesce(f.type, 'intergenic') AS type FROM b LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY chrom, "start" ORDER BY o DESC, fs, fe, type) AS k FROM (
    SELECT b.chrom, b."start", f."start" AS fs, f."end" AS fe, f.type, least(b."end", f."end") - greatest(b."start", f."start") AS o FROM b JOIN f ON b.chrom = f.chrom AND b."start" < f."end" AND f."start" < b."end")
    WHERE o >= 0.1 * 200) f ON f.chrom = b.chrom AND f."start" = b."start" AND f.k = 1"""
def _annotation(v):
    """Annotated stretches on the sequences, a third of each one apart."""
    size = F.length("seq").cast("long")
    kinds = F.array(*[F.lit(t) for t in ("exon", "intron", "promoter")])
    return v.seqs.where(size >= 3).select(
        F.col("seq_id").cast("string").alias("chrom"), size.alias("size"), "seq_id", F.posexplode(kinds).alias("i", "type")
    ).select("chrom", F.floor(F.col("size") * F.col("i") / 3).alias("start"), F.floor(F.col("size") * (F.col("i") + 1) / 3).alias("end"),
             F.when((F.col("seq_id") + F.col("i")) % 4 == 0, "5UTR").otherwise(F.col("type")).alias("type"))


def _library(v, simple=True, probes=None, annotation=None):
    sizes = v.seqs.where(F.length("seq") > 0).select(F.col("seq_id").cast("string").alias("chrom"), F.length("seq").cast("long").alias("length"))
    return sp.genome_bin_library(sizes, annotation or _annotation(v), v.contigs, 200, probes or v.probes, simple)


def _typed(v):
    """Probes with GC and type, and the probes and annotation, written as all are read several times."""
    from ..operators.reports import annotate_peaks

    probes, annotation = cut_lineage(v.probes), cut_lineage(_annotation(v))
    positives = cut_lineage(sq.with_gc(sq.extract_sequences(probes, v.contigs)).select("seq_id", *COORDS, "gc"))
    return annotate_peaks(positives, annotation).drop("overlap"), probes, annotation


ANNOT = """SELECT seq_id::VARCHAR AS chrom, length(seq) * i // 3 AS "start", length(seq) * (i + 1) // 3 AS "end", CASE WHEN (seq_id + i) % 4 = 0 THEN '5UTR' ELSE ['exon', 'intron', 'promoter'][i + 1] END AS type
    FROM seqs CROSS JOIN (SELECT unnest([0, 1, 2]) AS i) WHERE length(seq) >= 3"""
BINS = """SELECT u.chrom, s AS "start", s + 200 AS "end", substr(u.seq, s + 1, 200) AS q FROM (SELECT seq_id::VARCHAR AS chrom, seq, unnest(range(0, length(seq), 200)) AS s FROM seqs) u
    LEFT JOIN probes p ON p.chrom = u.chrom AND greatest(p."start" - 1, 0) < s + 200 AND s < p."end" + 1 WHERE s + 200 <= length(u.seq) AND p.chrom IS NULL"""


@query("genome_bin_library", f"""WITH b AS ({BINS}), f AS ({ANNOT}), t AS ({TYPED})
    SELECT t.chrom, t."start", t."end", t.type, floor((200 - length(translate(q, 'CG', ''))) / 2.0::DOUBLE + 0.5) / 100 AS gc, 200 AS length FROM t JOIN b USING (chrom, "start")""")
def _(v):
    return _library(v)


@query("simplify_types", f"""WITH b AS ({BINS}), f AS ({ANNOT}), p AS (SELECT b.chrom, b."start", f.type FROM b JOIN f ON b.chrom = f.chrom AND b."start" < f."end" AND f."start" < b."end"
    AND least(b."end", f."end") - greatest(b."start", f."start") >= 20),
    t AS (SELECT chrom, "start", string_agg(DISTINCT type, ';' ORDER BY type) AS type FROM p GROUP BY 1, 2), n AS (SELECT type, count(*) AS n FROM t GROUP BY 1), k AS (SELECT type FROM n WHERE n >= 100)
    SELECT type, CASE WHEN type IN (SELECT type FROM k) THEN type
        WHEN NOT contains(type, ';') THEN 'intergenic'
        ELSE (SELECT coalesce(min(c.rest) FILTER (WHERE c.ok AND c.o = lo), min(c.rest) FILTER (WHERE c.o = first)) FROM (
            SELECT rest, o, ok, min(o) FILTER (WHERE ok) OVER () AS lo, min(o) OVER () AS first FROM (
            SELECT d.o, array_to_string(list_filter(string_split(n.type, ';'), lambda x: x <> d.t), ';') AS rest, array_to_string(list_filter(string_split(n.type, ';'), lambda x: x <> d.t), ';') IN (SELECT type FROM k) AS ok
            FROM (SELECT unnest(['intergenic', '3UTR', '5UTR', 'exon', 'intron', 'promoter']) AS t, unnest([1, 2, 3, 4, 5, 6]) AS o) d WHERE list_contains(string_split(n.type, ';'), d.t))) c) END AS simple FROM n""")
def _(v):
    return sp.simplify_types(_library(v, simple=False), min_bins=100)


@query("matched_negatives")
def _(v):
    typed, probes, annotation = _typed(v)
    return sp.matched_negatives(typed, _library(v, True, probes, annotation), 5, id_col="seq_id")


@query("n_negative_sets")
def _(v):
    typed, probes, annotation = _typed(v)
    return sp.n_negative_sets(typed, _library(v, True, probes, annotation), 2, 5, id_col="seq_id")
