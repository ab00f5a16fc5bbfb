"""Queries on methylation, annotation and conservation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import motifs as mt
from ..operators import reports as rp
from ..operators import sequences as sq
from ..operators.overlap import COORDS
from ..runtime import cut_lineage
from ..sources.gff import parse_gff3
from .base import query, r, rounded, t_p_sql
from .views import PFM, windows_sql

#: Kinds of events, each a track.
TRACKS = ["click", "error", "purchase", "signup", "view"]
OV = 'a.chrom = b.chrom AND a."start" < b."end" AND b."start" < a."end"'
LEN = 'least(a."end", b."end") - greatest(a."start", b."start")'


@query("methylated_sites_in_regions", """SELECT p.id, count(m.pos) AS meth_sites FROM peaks p LEFT JOIN methyl m ON m.chrom = p.chrom AND m.pos - 1 >= p."start" AND m.pos - 1 < p."end" AND m.prob > 0.5 GROUP BY 1""")
def _(v):
    return rp.methylated_sites_in_regions(v.peaks.select("id", *COORDS), v.methyl).select("id", "meth_sites")


# Probabilities on the sequences themselves: a value on the C and G of each region.
SMETH = """SELECT chrom, s + 1 AS pos, ((seq_id * 31 + s * 17) % 100) / 99.0::DOUBLE AS prob FROM (SELECT seq_id, chrom, unnest(range("start", "end")) AS s, unnest(string_split(substr(seq, "start" + 1, "end" - "start"), '')) AS b FROM spots) WHERE b IN ('C', 'G')"""


def _methylation(v, regions):
    bases = regions.select("chrom", "seq_id", "start", F.posexplode(F.split("seq", "")).alias("i", "b")).where(F.col("b").isin("C", "G"))
    at = F.col("start") + F.col("i")
    return bases.select("chrom", (at + 1).alias("pos"), ((F.col("seq_id") * 31 + at * 17) % 100 / 99.0).alias("prob"))


@query("lookup_value", f"""WITH m AS ({SMETH}) SELECT seq_id, string_agg(coalesce(round(prob, 4)::VARCHAR, '-'), ',' ORDER BY s) AS vals FROM (SELECT seq_id, chrom, unnest(range("start", "end")) AS s FROM spots) x
    LEFT JOIN m ON m.chrom = x.chrom AND m.pos = x.s + 1 GROUP BY 1""")
def _(v):
    regions = sq.extract_sequences(v.spots, v.contigs)
    out = rp.lookup_value(v.spots, _methylation(v, regions))
    text = F.transform("values", lambda x: F.coalesce(F.round(x, 4).cast("string"), F.lit("-")))
    return out.select("seq_id", F.array_join(text, ",").alias("vals"))


SPOT_SEQS = """SELECT seq_id, substr(seq, "start" + 1, "end" - "start") AS seq FROM spots"""
BEST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY round(score, 9) DESC, pos, strand) AS k FROM ({windows_sql(PFM, f'({SPOT_SEQS})')}) WHERE score > -30) WHERE k = 1"""
TABLE = f"""m AS ({SMETH}), b AS ({BEST}), t AS (SELECT s.seq_id, s.chrom, s."start", s."end", (s.seq_id * 13 % 50)::DOUBLE AS cov_a, (s.seq_id * 29 % 70)::DOUBLE AS cov_b,
    (SELECT count(*) FROM m WHERE m.chrom = s.chrom AND prob > 0.5 AND m.pos - 1 >= s."start" AND m.pos - 1 < s."end") AS meth_sites, length(q.seq) - length(translate(q.seq, 'CG', '')) AS cg_count,
    round(b.score, 9) AS site_score, s."start" + b.pos - 1 AS site_start, s."start" + b.pos - 1 + {len(PFM)} AS site_end, b.strand AS site_strand, b.kmer AS motif_seq,
    CASE WHEN b.pos IS NOT NULL THEN (SELECT count(*) FROM m WHERE m.chrom = s.chrom AND prob > 0.5 AND m.pos - 1 >= s."start" + b.pos - 1 AND m.pos - 1 < s."start" + b.pos - 1 + {len(PFM)}) END AS meth_sites_in_motif
    FROM spots s JOIN ({SPOT_SEQS}) q USING (seq_id) LEFT JOIN b USING (seq_id))"""


def _table(v):
    # Read for the peaks, the scan, the sites and the methylation.
    regions = cut_lineage(sq.extract_sequences(v.spots, v.contigs).select("seq_id", *COORDS, "seq"))
    peaks = regions.withColumns(
        {"cov_a": (F.col("seq_id") * 13 % 50).cast("double"), "cov_b": (F.col("seq_id") * 29 % 70).cast("double")}
    )
    # Ties between rounded scores go by position, as everywhere.
    sites = mt.scan_pwm(regions, v.model, -30.0).withColumn("score", F.round("score", 9))
    return rp.peak_site_methylation_table(peaks, sites, _methylation(v, regions), -30.0)


@query("peak_site_methylation_table", f"""WITH {TABLE} SELECT seq_id, cov_a, cov_b, meth_sites, cg_count, {r('site_score', 9)} AS site_score, site_start, site_end, site_strand, motif_seq, meth_sites_in_motif FROM t""")
def _(v):
    out = _table(v).withColumn("cg_count", F.col("cg_count").cast("long"))
    return rounded(out.select("seq_id", "cov_a", "cov_b", "meth_sites", "cg_count", "site_score", "site_start", "site_end", "site_strand", "motif_seq", "meth_sites_in_motif"), "site_score", digits=9)


RATIO = "log10((cov_a + (SELECT min(cov_a) FROM t WHERE cov_a <> 0)) / (cov_b + (SELECT min(cov_b) FROM t WHERE cov_b <> 0)))"


@query("log_signal_ratio", f"""WITH t AS (SELECT o_orderkey AS id, o_totalprice % 50 AS cov_a, o_totalprice % 70 AS cov_b FROM orders) SELECT id, {r(RATIO)} AS log_ratio FROM t""")
def _(v):
    data = v.table("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") % 50).alias("cov_a"), (F.col("o_totalprice") % 70).alias("cov_b"))
    return rounded(rp.log_signal_ratio(data, "cov_a", "cov_b").select("id", "log_ratio"), "log_ratio")


@query("methylation_correlations", f"""WITH {TABLE}, y AS (SELECT *, {RATIO} AS y FROM t), w AS (SELECT 'peak_density' AS what, meth_sites / ("end" - "start")::DOUBLE AS x, y FROM y WHERE site_score IS NOT NULL
    UNION ALL SELECT 'site_count', meth_sites_in_motif::DOUBLE, y FROM y WHERE site_score IS NOT NULL
    UNION ALL SELECT CASE WHEN site_strand = '+' THEN b ELSE translate(b, 'CG', 'GC') END || CASE WHEN site_strand = '+' THEN i + 1 ELSE {len(PFM)} - i END, prob, y FROM (
        SELECT y.*, unnest(range(0, {len(PFM)})) AS i, unnest(string_split(motif_seq, '')) AS b FROM y WHERE site_score IS NOT NULL) z LEFT JOIN m ON m.chrom = z.chrom AND m.pos = z.site_start + z.i + 1 WHERE b IN ('C', 'G')),
    c AS (SELECT what, corr(x, y) AS r0, count(*) AS n FROM w WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1), d AS (SELECT what, n, CASE WHEN n > 10 THEN r0 END AS r FROM c)
    SELECT what, {r('r')} AS r, CASE WHEN r IS NOT NULL THEN {r(t_p_sql('(r * sqrt((n - 2) / (1 - r * r)))', '(n - 2)', 2000))} END AS p_value, n FROM d""")
def _(v):
    table = rp.log_signal_ratio(_table(v), "cov_a", "cov_b")
    return rounded(rp.methylation_correlations(table), "r", "p_value")


@query("methylation_correlations_symmetric", f"""WITH {TABLE}, y AS (SELECT *, {RATIO} AS y FROM t), w AS (SELECT 'peak_density' AS what, meth_sites / ("end" - "start")::DOUBLE AS x, y FROM y WHERE site_score IS NOT NULL
    UNION ALL SELECT 'site_count', meth_sites_in_motif::DOUBLE, y FROM y WHERE site_score IS NOT NULL
    UNION ALL SELECT n1 || (i + 1) || n2 || ({len(PFM)} - i), greatest(a.prob, b.prob), y FROM (SELECT y.*, unnest(range(0, {len(PFM) // 2 + 1})) AS i FROM y WHERE site_score IS NOT NULL) z
        CROSS JOIN (SELECT unnest(['C', 'G']) AS n1, unnest(['G', 'C']) AS n2) LEFT JOIN m a ON a.chrom = z.chrom AND a.pos = z.site_start + z.i + 1
        LEFT JOIN m b ON b.chrom = z.chrom AND b.pos = z.site_start + {len(PFM)} - z.i WHERE substr(motif_seq, i + 1, 1) = n1 OR substr(motif_seq, {len(PFM)} - i, 1) = n2),
    c AS (SELECT what, corr(x, y) AS r0, count(*) AS n FROM w WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1), d AS (SELECT what, n, CASE WHEN n > 10 THEN r0 END AS r FROM c)
    SELECT what, {r('r')} AS r, CASE WHEN r IS NOT NULL THEN {r(t_p_sql('(r * sqrt((n - 2) / (1 - r * r)))', '(n - 2)', 2000))} END AS p_value, n FROM d""")
def _(v):
    table = rp.log_signal_ratio(_table(v), "cov_a", "cov_b")
    return rounded(rp.methylation_correlations(table, symmetric=True), "r", "p_value")


# --- annotation ------------------------------------------------------------


def _gff_lines(v):
    """Genes with two exons each, written as GFF3 text from the features."""
    f = v.features
    third = F.floor((F.col("end") - F.col("start")) / 3)
    row = lambda kind, s, e, attr: F.concat_ws(
        "\t", "chrom", F.lit("src"), F.lit(kind), (s + 1).cast("string"), e.cast("string"), F.lit("."), "strand", F.lit("."), attr
    )
    gene = F.concat(F.lit("g"), "id")
    rows = F.array(
        row("gene", F.col("start"), F.col("end"), F.concat(F.lit("ID="), gene, F.lit(";Name="), gene)),
        row("mRNA", F.col("start"), F.col("end"), F.concat(F.lit("ID="), gene, F.lit(".1;Parent="), gene)),
        row("exon", F.col("start"), F.col("start") + third, F.concat(F.lit("ID=e1;Parent="), gene, F.lit(".1"))),
        row("exon", F.col("end") - third, F.col("end"), F.concat(F.lit("ID=e2;Parent="), gene, F.lit(".1"))),
        row("exon", F.col("start"), F.col("end"), F.concat(F.lit("ID=e3;Parent="), gene, F.lit(".2"))),
    )
    return f.select(F.explode(rows).alias("value"))


GFF = """f AS (SELECT *, ("end" - "start") // 3 AS third FROM features), g AS (
    SELECT id, chrom, 'gene' AS type, "start" AS s, "end" AS e, strand, 'ID=g' || id || ';Name=g' || id AS attr FROM f
    UNION ALL SELECT id, chrom, 'mRNA', "start", "end", strand, 'ID=g' || id || '.1;Parent=g' || id FROM f
    UNION ALL SELECT id, chrom, 'exon', "start", "start" + third, strand, 'ID=e1;Parent=g' || id || '.1' FROM f
    UNION ALL SELECT id, chrom, 'exon', "end" - third, "end", strand, 'ID=e2;Parent=g' || id || '.1' FROM f
    UNION ALL SELECT id, chrom, 'exon', "start", "end", strand, 'ID=e3;Parent=g' || id || '.2' FROM f)"""


def _gff(v):
    return parse_gff3(_gff_lines(v))


@query("read_gff3", f"""WITH {GFF} SELECT chrom, type, s AS "start", e AS "end", strand, attr FROM g""")
def _(v):
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda x: F.concat_ws("=", x["key"], x["value"]))
    return _gff(v).select("chrom", "type", "start", "end", "strand", F.array_join(pairs, ";").alias("attr"))


@query("primary_transcripts", f"""WITH {GFF} SELECT chrom, type, s AS "start", e AS "end" FROM g WHERE attr NOT LIKE '%.2'""")
def _(v):
    from ..operators.filters import primary_transcripts

    return primary_transcripts(_gff(v)).select("chrom", "type", "start", "end")


def _union_sql(name: str, source: str) -> str:
    """Merged stretches of a CTE with chrom, s, e."""
    return f"""{name} AS (SELECT chrom, min(s) AS s, max(e) AS e FROM (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isle FROM (
        SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM {source})) GROUP BY chrom, isle)"""


def _gap_sql(name: str, merged: str) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT chrom, e AS s, coalesce(lead(s) OVER (PARTITION BY chrom ORDER BY s), length) AS e FROM {merged} JOIN sizes USING (chrom)
        UNION ALL SELECT chrom, 0, min(s) FROM {merged} GROUP BY chrom) WHERE s < e)"""


ANNOTATION = f"""{GFF}, prim AS (SELECT * FROM g WHERE attr NOT LIKE '%.2'), prom AS (SELECT * FROM (SELECT chrom, CASE WHEN strand = '+' THEN greatest(s - 1000, 0) ELSE e END AS s,
        CASE WHEN strand = '+' THEN s ELSE least(e + 1000, 10000500) END AS e FROM prim WHERE type = 'gene') WHERE s < e),
    {_union_sql('body', "(SELECT chrom, s, e FROM prim)")}, {_gap_sql('off', 'body')}, {_union_sql('all1', "(SELECT chrom, s, e FROM prim UNION ALL SELECT * FROM prom)")}, {_gap_sql('inter', 'all1')},
    {_union_sql('ex', "(SELECT chrom, s, e FROM prim WHERE type = 'exon' UNION ALL SELECT * FROM off)")}, {_gap_sql('intr', 'ex')},
    ann AS (SELECT chrom, s AS "start", e AS "end", 'intron' AS type FROM intr UNION ALL SELECT chrom, s, e, 'intergenic' FROM inter UNION ALL SELECT chrom, s, e, 'promoter' FROM prom UNION ALL SELECT chrom, s, e, 'exon' FROM prim WHERE type = 'exon')"""


@query("build_annotation", f"""WITH {ANNOTATION} SELECT * FROM ann""")
def _(v):
    return rp.build_annotation(_gff(v), v.sizes, 1000)


@query("exon_gap_introns", f"""WITH {GFF} SELECT chrom, "start" + third AS "start", "end" - third AS "end", 'g' || id || '.1' AS transcript FROM f WHERE "start" + third < "end" - third""")
def _(v):
    return rp.exon_gap_introns(_gff(v))


ANNOTATED = f"""SELECT id, type, overlap FROM (SELECT a.id, coalesce(b.type, 'intergenic') AS type, CASE WHEN b.type IS NULL THEN 0 ELSE {LEN} END AS overlap,
    row_number() OVER (PARTITION BY a.id ORDER BY {LEN} DESC, b."start", b."end", b.type) AS k FROM peaks a LEFT JOIN features b ON {OV}) WHERE k = 1"""


@query("annotate_peaks", ANNOTATED)
def _(v):
    return rp.annotate_peaks(v.peaks.select("id", *COORDS), v.features).select("id", "type", "overlap")


@query("feature_percentages", f"""SELECT type, count(*) AS n, {r('100.0 * count(*) / sum(count(*)) OVER ()')} AS percent FROM ({ANNOTATED}) GROUP BY 1""")
def _(v):
    return rounded(rp.feature_percentages(rp.annotate_peaks(v.peaks.select("id", *COORDS), v.features)), "percent")


@query("merge_annotations_per_region", f"""SELECT a.id, coalesce(string_agg(DISTINCT b.type, ';' ORDER BY b.type), 'intergenic') AS types FROM peaks a LEFT JOIN features b ON {OV} AND {LEN} >= 0.1 * (a."end" - a."start") GROUP BY 1""")
def _(v):
    return rp.merge_annotations_per_region(v.peaks.select("id", *COORDS), v.features).select("id", "types")




@query("conservation_profile", f"""WITH a AS (SELECT chrom, ("start" + "end") // 2 AS pos FROM features), m AS (SELECT chrom, (spot + spot + len) // 2 AS pos FROM (SELECT f.chrom, f."end" - f."start" AS len,
        ('0x' || substr(md5(concat_ws(':', id, 13)), 1, 12))::BIGINT % (length - (f."end" - f."start") + 1) AS spot FROM features f JOIN sizes USING (chrom))),
    x AS (SELECT track, b."start" - a.pos AS "offset", avg(value) AS sites FROM a JOIN signal b ON a.chrom = b.chrom AND b."start" >= a.pos - 300 AND b."start" < a.pos + 300 GROUP BY 1, 2),
    y AS (SELECT track, b."start" - a.pos AS "offset", avg(value) AS shuffled FROM m a JOIN signal b ON a.chrom = b.chrom AND b."start" >= a.pos - 300 AND b."start" < a.pos + 300 GROUP BY 1, 2)
    SELECT track, "offset", {r('sites')} AS sites, {r('shuffled')} AS shuffled FROM x FULL JOIN y USING (track, "offset")""")
def _(v):
    tracks = {t: v.signal.where(F.col("track") == t) for t in TRACKS}
    out = rp.conservation_profile(v.features.select("id", *COORDS), tracks, v.sizes, 300, 300, 13)
    return rounded(out, "sites", "shuffled")


@query("add_chromosome_rows", f"""WITH {GFF} SELECT chrom, type, s AS "start", e AS "end" FROM g UNION ALL SELECT seq_id::VARCHAR, 'chromosome', 0, length(seq) FROM seqs WHERE length(seq) > 0""")
def _(v):
    return rp.add_chromosome_rows(_gff(v), v.contigs).select("chrom", "type", "start", "end")
