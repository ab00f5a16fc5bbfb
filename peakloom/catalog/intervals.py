"""Queries on interval tables: joins, set operations, tracks, reads and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as flt
from ..operators import overlap as ov
from ..operators import reads as rd
from ..operators import segments as sg
from .base import query, r, rounded

OV = 'a.chrom = b.chrom AND a."start" < b."end" AND b."start" < a."end"'
LEN = 'least(a."end", b."end") - greatest(a."start", b."start")'

# --- joins -----------------------------------------------------------------


@query("overlap_join", f"""SELECT a.id, b.id AS b_id, b.type AS b_type, {LEN} AS overlap FROM peaks a JOIN features b ON {OV}""")
def _(v):
    return ov.overlap_join(v.peaks.select("id", *ov.COORDS), v.features, in_runs=True).select("id", "b_id", "b_type", "overlap")


@query("overlap_join_left", f"""SELECT a.id, b.id AS b_id, CASE WHEN b.id IS NULL THEN 0 ELSE {LEN} END AS overlap FROM peaks a LEFT JOIN features b ON {OV}""")
def _(v):
    return ov.overlap_join(v.peaks.select("id", *ov.COORDS), v.features, "left", in_runs=True).select("id", "b_id", "overlap")


@query("overlap_anti", f"""SELECT id, chrom, "start", "end" FROM peaks a WHERE NOT EXISTS (SELECT 1 FROM features b WHERE {OV})""")
def _(v):
    return ov.overlap_anti(v.peaks.select("id", *ov.COORDS), v.features)


@query("overlap_anti_fraction", f"""SELECT id, chrom, "start", "end" FROM peaks a WHERE NOT EXISTS (
    SELECT 1 FROM features b WHERE {OV} AND {LEN} >= 0.9 * (a."end" - a."start"))""")
def _(v):
    return ov.overlap_anti(v.peaks.select("id", *ov.COORDS), v.features, 0.9)


@query("overlap_semi", f"""SELECT name, chrom, "start", "end" FROM reads a WHERE EXISTS (SELECT 1 FROM peaks b WHERE {OV})""")
def _(v):
    return ov.overlap_semi(v.reads.select("name", *ov.COORDS), v.peaks)


@query("overlap_min_fraction", f"""SELECT a.id, b.id AS b_id, {LEN} AS overlap FROM peaks a JOIN features b ON {OV}
    WHERE {LEN} >= 0.1 * (a."end" - a."start")""")
def _(v):
    return ov.overlap_join(v.peaks.select("id", *ov.COORDS), v.features, min_frac_a=0.1, in_runs=True).select("id", "b_id", "overlap")


@query("overlap_containment", f"""SELECT a.id, b.id AS b_id FROM peaks a JOIN features b ON {OV}
    WHERE b."start" <= a."start" AND a."end" <= b."end" """)
def _(v):
    return ov.overlap_join(v.peaks.select("id", *ov.COORDS), v.features, min_frac_a=1.0, in_runs=True).select("id", "b_id")


@query("subtract_whole", f"""SELECT id, chrom, "start", "end", type FROM features a WHERE NOT EXISTS (SELECT 1 FROM peaks b WHERE {OV})""")
def _(v):
    return ov.subtract_whole(v.features.select("id", *ov.COORDS, "type"), v.peaks)


@query("best_overlap", f"""SELECT id, b_id, overlap FROM (SELECT a.id, b.id AS b_id, CASE WHEN b.id IS NULL THEN 0 ELSE {LEN} END AS overlap,
    row_number() OVER (PARTITION BY a.id ORDER BY {LEN} DESC, b."start", b."end", b.id) AS k
    FROM peaks a LEFT JOIN features b ON {OV}) WHERE k = 1""")
def _(v):
    return ov.best_overlap(v.peaks.select("id", *ov.COORDS), v.features, ["id"]).select("id", "b_id", "overlap")


@query("join_on_peak", f"""WITH n AS (SELECT a.id, count(b.name) AS n FROM peaks a LEFT JOIN reads b ON {OV} GROUP BY 1),
    m AS (SELECT a.id, max(b.value) AS top FROM peaks a JOIN signal b ON {OV} GROUP BY 1)
    SELECT n.id, n.n AS counts_n, m.top AS signal_top FROM n JOIN m USING (id)""")
def _(v):
    p = v.peaks.select("id", *ov.COORDS)
    counts = ov.count_in_regions(p, v.reads).select("id", "n")
    tops = ov.map_signal(p, v.signal, {"top": "max"}).where("top is not null").select("id", "top")
    return flt.join_on_key({"counts": counts, "signal": tops}, ["id"])


@query("multi_key_join", """SELECT a.chrom, a.reads_n, b.peaks_n, c.features_n FROM (SELECT chrom, count(*) AS reads_n FROM reads GROUP BY 1) a
    JOIN (SELECT chrom, count(*) AS peaks_n FROM peaks GROUP BY 1) b USING (chrom)
    JOIN (SELECT chrom, count(*) AS features_n FROM features GROUP BY 1) c USING (chrom)""")
def _(v):
    n = lambda df: df.groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))
    return flt.join_on_key({"reads": n(v.reads), "peaks": n(v.peaks), "features": n(v.features)}, ["chrom"])


@query("points_in_intervals", """SELECT a.chrom, a.pos, b.id AS b_id FROM (SELECT chrom, pos - 1 AS pos FROM methyl) a
    JOIN peaks b ON a.chrom = b.chrom AND a.pos >= b."start" AND a.pos < b."end" """)
def _(v):
    points = v.methyl.select("chrom", (F.col("pos") - 1).alias("pos"))
    return ov.points_in_intervals(points, v.peaks).select("chrom", "pos", "b_id")


# --- counts and signal -----------------------------------------------------


@query("count_in_regions", f"""SELECT a.id, count(b.name) AS n FROM peaks a LEFT JOIN reads b ON {OV} GROUP BY 1""")
def _(v):
    return ov.count_in_regions(v.peaks.select("id", *ov.COORDS), v.reads).select("id", "n")


@query("count_contained", f"""SELECT a.id, {r('count(b.name) * 0.5')} AS n FROM peaks a
    LEFT JOIN reads b ON {OV} AND b."start" >= a."start" AND b."end" <= a."end" GROUP BY 1""")
def _(v):
    return rounded(ov.count_contained(v.peaks.select("id", *ov.COORDS), v.reads, 0.5).select("id", "n"), "n")


@query("map_signal", f"""SELECT a.id, max(b.value) AS top, {r('avg(b.value)')} AS mean, count(b.value) AS n
    FROM peaks a LEFT JOIN signal b ON {OV} GROUP BY 1""")
def _(v):
    out = ov.map_signal(v.peaks.select("id", *ov.COORDS), v.signal, {"top": "max", "mean": "mean", "n": "count"})
    return rounded(out.select("id", "top", "mean", "n"), "mean")


@query("signal_area", f"""SELECT a.id, {r(f'coalesce(sum(b.value * ({LEN})), 0) * 1000 / (a."end" - a."start")')} AS area
    FROM features a LEFT JOIN signal b ON {OV} GROUP BY a.id, a."start", a."end" """)
def _(v):
    return rounded(ov.signal_area(v.features.select("id", *ov.COORDS), v.signal, "rpkm").select("id", "area"), "area")


@query("argmax_position", f"""SELECT id, (s + e) // 2 AS position, value AS max_value FROM (
    SELECT a.id, b."start" AS s, b."end" AS e, b.value, row_number() OVER (PARTITION BY a.id ORDER BY b.value DESC, b."start") AS k
    FROM features a JOIN signal b ON {OV}) WHERE k = 1""")
def _(v):
    return ov.argmax_position(v.features.select("id", *ov.COORDS), v.signal).select("id", "position", "max_value")


# --- set operations --------------------------------------------------------

ISLES = """SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY "start", "end", id ROWS UNBOUNDED PRECEDING) AS isle FROM (
    SELECT *, CASE WHEN "start" <= max("end") OVER (PARTITION BY chrom ORDER BY "start", "end", id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    THEN 0 ELSE 1 END AS fresh FROM peaks)"""


@query("merge_intervals", f"""SELECT chrom, min("start") AS "start", max("end") AS "end" FROM ({ISLES}) GROUP BY chrom, isle""")
def _(v):
    return sg.merge_intervals(v.peaks)


@query("merge_intervals_payload", f"""SELECT chrom, min("start") AS "start", max("end") AS "end", count(*) AS n, {r('avg(signal_value)', 9)} AS mean_signal,
    string_agg(DISTINCT batch, ';' ORDER BY batch) AS batches FROM ({ISLES}) GROUP BY chrom, isle""")
def _(v):
    aggs = {
        "n": F.count(F.lit(1)), "mean_signal": F.avg("signal_value"),
        "batches": F.array_join(F.array_sort(F.collect_set("batch")), ";"),
    }
    return rounded(sg.merge_intervals(v.peaks, aggs), "mean_signal", digits=9)


@query("merge_intervals_distance", """SELECT chrom, min("start") AS "start", max("end") AS "end" FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY "start", "end", id ROWS UNBOUNDED PRECEDING) AS isle FROM (
    SELECT *, CASE WHEN "start" <= 500 + max("end") OVER (PARTITION BY chrom ORDER BY "start", "end", id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    THEN 0 ELSE 1 END AS fresh FROM peaks)) GROUP BY chrom, isle""")
def _(v):
    return sg.merge_intervals(v.peaks, distance=500)


@query("cluster_intervals", f"""SELECT id, min("start") OVER (PARTITION BY chrom, isle) AS cluster_start,
    max("end") OVER (PARTITION BY chrom, isle) AS cluster_end FROM ({ISLES})""")
def _(v):
    return sg.cluster_intervals(v.peaks.select("id", *ov.COORDS)).select("id", "cluster_start", "cluster_end")


MERGED = f"""SELECT chrom, min("start") AS s, max("end") AS e FROM ({ISLES}) GROUP BY chrom, isle"""


@query("complement", f"""WITH m AS ({MERGED}), g AS (
    SELECT chrom, e AS "start", lead(s) OVER (PARTITION BY chrom ORDER BY s) AS "end" FROM m
    UNION ALL SELECT chrom, 0, min(s) FROM m GROUP BY chrom)
    SELECT g.chrom, g."start", coalesce(g."end", length) AS "end" FROM g JOIN sizes USING (chrom) WHERE g."start" < coalesce(g."end", length)""")
def _(v):
    return sg.complement(v.peaks, v.sizes)


DEPTH = """SELECT chrom, pos AS "start", lead(pos) OVER w AS "end", sum(step) OVER w AS depth FROM (
    SELECT chrom, pos, sum(step)::BIGINT AS step FROM (SELECT chrom, "start" AS pos, 1 AS step FROM reads UNION ALL SELECT chrom, "end", -1 FROM reads)
    GROUP BY 1, 2 HAVING sum(step) <> 0) WINDOW w AS (PARTITION BY chrom ORDER BY pos)"""


@query("pileup", f"""SELECT chrom, "start", "end", {r('depth * 1e6 / (SELECT count(*) FROM reads)')} AS value FROM ({DEPTH}) WHERE depth > 0""")
def _(v):
    n = v.reads.agg((F.lit(1e6) / F.count(F.lit(1))).alias("rate"))
    track = sg.pileup(v.reads).crossJoin(F.broadcast(n))
    return rounded(sg.scale_track(track, F.col("rate")).drop("rate"), "value")


@query("pileup_keep_zero", f"""WITH d AS ({DEPTH}) SELECT chrom, "start", "end", depth::DOUBLE AS value FROM d WHERE "end" IS NOT NULL
    UNION ALL SELECT chrom, 0, min("start"), 0.0 FROM d GROUP BY chrom HAVING min("start") > 0
    UNION ALL SELECT chrom, max(d."start"), length, 0.0 FROM d JOIN sizes USING (chrom) GROUP BY chrom, length HAVING max(d."start") < length""")
def _(v):
    return sg.pileup(v.reads, v.sizes, keep_zero=True)


@query("pileup_per_sample", """SELECT sample, chrom, sum(("end" - "start") * depth)::BIGINT AS bases, max(depth)::BIGINT AS top FROM (
    SELECT sample, chrom, pos AS "start", lead(pos) OVER w AS "end", sum(step) OVER w AS depth FROM (
    SELECT sample, chrom, pos, sum(step) AS step FROM (SELECT sample, chrom, "start" AS pos, 1 AS step FROM reads UNION ALL SELECT sample, chrom, "end", -1 FROM reads)
    GROUP BY 1, 2, 3 HAVING sum(step) <> 0) WINDOW w AS (PARTITION BY sample, chrom ORDER BY pos)) WHERE depth > 0 GROUP BY 1, 2""")
def _(v):
    track = sg.pileup(v.reads, keys=["sample", "chrom"])
    return track.groupBy("sample", "chrom").agg(
        F.sum((F.col("end") - F.col("start")) * F.col("value")).cast("long").alias("bases"), F.max("value").cast("long").alias("top")
    )


SAMPLES = ["s0", "s1", "s2", "s3", "s4", "s5"]


def _tracks(v):
    keys = ["sample", "chrom"]
    return sg.pileup(v.reads, keys=keys).withColumnRenamed("sample", "track")


COMBINED = """WITH e AS (SELECT sample, chrom, "start" AS pos, 1 AS step FROM reads
    UNION ALL SELECT sample, chrom, "end", -1 FROM reads),
    st AS (SELECT sample, chrom, pos, sum(step)::BIGINT AS step FROM e GROUP BY 1, 2, 3 HAVING sum(step) <> 0),
    pts AS (SELECT DISTINCT chrom, pos FROM st),
    lv AS (SELECT p.chrom, p.pos, s.sample, coalesce(t.step, 0) AS step FROM pts p CROSS JOIN (SELECT DISTINCT sample FROM st) s
        LEFT JOIN st t ON t.chrom = p.chrom AND t.pos = p.pos AND t.sample = s.sample),
    cum AS (SELECT chrom, pos, sample, sum(step) OVER (PARTITION BY chrom, sample ORDER BY pos) AS depth FROM lv),
    comb AS (SELECT chrom, pos, avg(depth) AS m, max(depth) AS x FROM cum GROUP BY 1, 2)"""


@query("combine_tracks_mean", COMBINED + f""" SELECT chrom, "start", "end", {r('m')} AS value FROM (
    SELECT chrom, pos AS "start", lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS "end", m FROM comb) WHERE "end" IS NOT NULL""")
def _(v):
    return rounded(sg.combine_tracks(_tracks(v), SAMPLES, "mean"), "value")


@query("combine_tracks_max", COMBINED + """ SELECT chrom, "start", "end", x::DOUBLE AS value FROM (
    SELECT chrom, pos AS "start", lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS "end", x FROM comb) WHERE "end" IS NOT NULL""")
def _(v):
    return sg.combine_tracks(_tracks(v), SAMPLES, "max")


@query("scale_track", f"""SELECT chrom, "start", "end", {r('value * 2.5')} AS value FROM signal""")
def _(v):
    return rounded(sg.scale_track(v.signal.drop("track"), 2.5), "value")


@query("track_noise", f"""SELECT track, {r('sum(value * ("end" - "start")) / sum("end" - "start")')} AS noise FROM signal GROUP BY 1""")
def _(v):
    return rounded(sg.track_noise(v.signal, ["track"]), "noise")


@query("make_bins", """SELECT chrom, s AS "start", least(s + 50000, length) AS "end" FROM (
    SELECT chrom, length, unnest(range(0, length, 50000)) AS s FROM sizes)""")
def _(v):
    return sg.make_bins(v.sizes, 50000)


DRAWN = """SELECT chrom, pmod - lane AS "start", pmod - lane + 500 AS "end" FROM (
    SELECT ('0x' || substr(md5(concat_ws(':', id, 7)), 1, 12))::BIGINT % (SELECT sum(length - 499) FROM sizes)::BIGINT AS pmod FROM peaks) d
    JOIN (SELECT chrom, sum(length - 499) OVER (ORDER BY chrom)::BIGINT - (length - 499) AS lane, sum(length - 499) OVER (ORDER BY chrom)::BIGINT AS upto FROM sizes) l
    ON pmod >= lane AND pmod < upto"""


@query("random_windows", f"""SELECT chrom, min("start") AS "start", max("end") AS "end" FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY "start" ROWS UNBOUNDED PRECEDING) AS isle FROM (
    SELECT *, CASE WHEN "start" <= max("end") OVER (PARTITION BY chrom ORDER BY "start" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
    FROM ({DRAWN}))) GROUP BY chrom, isle""")
def _(v):
    return sg.random_windows(v.peaks.select("id"), v.sizes, 500, seed=7)


@query("shuffle_intervals", """SELECT id, chrom, spot AS "start", spot + len AS "end" FROM (SELECT id, p.chrom, p."end" - p."start" AS len,
    ('0x' || substr(md5(concat_ws(':', id, 11)), 1, 12))::BIGINT % (length - (p."end" - p."start") + 1) AS spot FROM peaks p JOIN sizes USING (chrom))""")
def _(v):
    return sg.shuffle_intervals(v.peaks.select("id", *ov.COORDS), v.sizes, seed=11)


@query("shuffle_intervals_within", """WITH fit AS (SELECT l.chrom, l.len, w.s, w.e - w.s - l.len + 1 AS room FROM
    (SELECT DISTINCT chrom, "end" - "start" AS len FROM peaks) l JOIN (SELECT chrom, 100000 * k AS s, 100000 * k + 50000 AS e FROM sizes, (SELECT unnest(range(0, 100)) AS k)) w USING (chrom)),
    lane AS (SELECT *, sum(room) OVER (PARTITION BY chrom, len ORDER BY s)::BIGINT AS upto, sum(room) OVER (PARTITION BY chrom, len)::BIGINT AS total FROM fit),
    aim AS (SELECT p.id, p.chrom, p."end" - p."start" AS len, ('0x' || substr(md5(concat_ws(':', id, 5)), 1, 12))::BIGINT % t.total AS spot
        FROM peaks p JOIN (SELECT DISTINCT chrom, len, total FROM lane) t ON t.chrom = p.chrom AND t.len = p."end" - p."start")
    SELECT id, aim.chrom, s + spot - (upto - room) AS "start", s + spot - (upto - room) + aim.len AS "end" FROM aim JOIN lane
    ON lane.chrom = aim.chrom AND lane.len = aim.len AND spot >= upto - room AND spot < upto""")
def _(v):
    bins = sg.make_bins(v.sizes, 100000).where("start < 10000000").withColumn("end", F.col("start") + 50000)
    return sg.shuffle_intervals(v.peaks.select("id", *ov.COORDS), v.sizes, seed=5, within=bins)


# Regions of many lengths, some of them too short; places are numbered from the longest region on.
RAGGED = """SELECT chrom, 100000 * k AS s, 100000 * k + 150 + (k * 7919) % 911 AS e FROM sizes, (SELECT unnest(range(0, 100)) AS k)"""


@query("shuffle_intervals_ragged", f"""WITH fit AS (SELECT l.chrom, l.len, w.s, w.e, w.e - w.s - l.len + 1 AS room FROM
    (SELECT DISTINCT chrom, "end" - "start" AS len FROM peaks) l JOIN ({RAGGED}) w USING (chrom) WHERE w.e - w.s >= l.len),
    lane AS (SELECT *, sum(room) OVER (PARTITION BY chrom, len ORDER BY e - s DESC, s)::BIGINT AS upto, sum(room) OVER (PARTITION BY chrom, len)::BIGINT AS total FROM fit),
    aim AS (SELECT p.id, p.chrom, p."end" - p."start" AS len, ('0x' || substr(md5(concat_ws(':', id, 9)), 1, 12))::BIGINT % t.total AS spot
        FROM peaks p JOIN (SELECT DISTINCT chrom, len, total FROM lane) t ON t.chrom = p.chrom AND t.len = p."end" - p."start")
    SELECT id, aim.chrom, s + spot - (upto - room) AS "start", s + spot - (upto - room) + aim.len AS "end" FROM aim JOIN lane
    ON lane.chrom = aim.chrom AND lane.len = aim.len AND spot >= upto - room AND spot < upto""")
def _(v):
    bins = sg.make_bins(v.sizes, 100000).where("start < 10000000")
    k = F.floor(F.col("start") / 100000)
    return sg.shuffle_intervals(v.peaks.select("id", *ov.COORDS), v.sizes, seed=9, within=bins.withColumn("end", F.col("start") + 150 + k * 7919 % 911))


ANCHORS = """SELECT chrom, ("start" + "end") // 2 AS pos, id FROM features"""


@query("meta_profile", f"""WITH a AS ({ANCHORS}) SELECT b."start" - a.pos AS "offset", {r('avg(b.value)')} AS mean, {r('median(b.value)')} AS median,
    {r('stddev_samp(b.value)')} AS sd, count(*) AS n FROM a JOIN signal b ON a.chrom = b.chrom AND b."start" >= a.pos - 500 AND b."start" < a.pos + 500 GROUP BY 1""")
def _(v):
    anchors = v.features.select("chrom", F.floor((F.col("start") + F.col("end")) / 2).alias("pos"))
    return rounded(sg.meta_profile(anchors, v.signal, 500, 500, expanded=True), "mean", "median", "sd")


@query("signal_matrix", f"""WITH a AS ({ANCHORS}), h AS (SELECT a.id, b.track, (b."start" - a.pos + 500) // 100 AS bin, b.value FROM a JOIN signal b
    ON a.chrom = b.chrom AND b."start" >= a.pos - 500 AND b."start" < a.pos + 500), c AS (SELECT id, track, bin, sum(value) / 100 AS signal FROM h GROUP BY 1, 2, 3)
    SELECT c.id, c.track, c.bin, {r('c.signal')} AS signal, {r('coalesce(s.s, 0)')} AS sort_value FROM c
    LEFT JOIN (SELECT id, sum(signal) / 10 AS s FROM c WHERE track = 'click' GROUP BY 1) s USING (id)""")
def _(v):
    anchors = v.features.select("chrom", F.floor((F.col("start") + F.col("end")) / 2).alias("pos"), "id")
    return rounded(sg.signal_matrix(anchors, v.signal, 500, 500, 100, "click"), "signal", "sort_value")


@query("interval_union_all", """SELECT chrom, "start", "end", 'peaks' AS "set" FROM peaks UNION ALL SELECT chrom, "start", "end", 'features' FROM features""")
def _(v):
    return sg.interval_union_all({"peaks": v.peaks, "features": v.features})


# --- reads -----------------------------------------------------------------


def _stacked(v):
    """Reads drawn together so that locations repeat."""
    at = F.floor(F.col("start") / 20000) * 20000
    return v.reads.withColumns({"start": at, "end": at + 100})


STACK = """SELECT chrom, "start" // 20000 * 20000 AS "start", "start" // 20000 * 20000 + 100 AS "end", strand, name, weight, sample FROM reads"""


@query("dedup_reads", f"""SELECT chrom, "start", "end", strand, name FROM (SELECT *, row_number() OVER (
    PARTITION BY chrom, "start", "end", strand ORDER BY name, weight) AS k FROM ({STACK})) WHERE k <= 2""")
def _(v):
    return rd.dedup_reads(_stacked(v), 2, ["name", "weight"]).select("chrom", "start", "end", "strand", "name")


PLACES = f"""SELECT chrom, "start", "end", strand, count(*) AS n FROM ({STACK}) GROUP BY 1, 2, 3, 4"""


@query("duplicate_histogram", f"""SELECT 'before' AS stage, n AS multiplicity, count(*) AS locations FROM ({PLACES}) GROUP BY 2
    UNION ALL SELECT 'after', least(n, 2), count(*) FROM ({PLACES}) GROUP BY 2""")
def _(v):
    reads = _stacked(v)
    before = rd.duplicate_histogram(reads).withColumn("stage", F.lit("before"))
    return before.unionByName(rd.duplicate_histogram(reads, keep=2).withColumn("stage", F.lit("after")))


@query("duplication_rate", f"""SELECT sample, sum(n)::BIGINT AS total, count(*) AS "unique", {r('(sum(n) - count(*)) / sum(n)')} AS dup_rate FROM (
    SELECT sample, chrom, "start", "end", strand, count(*) AS n FROM ({STACK}) GROUP BY 1, 2, 3, 4, 5) GROUP BY 1""")
def _(v):
    return rounded(rd.duplication_rate(_stacked(v), ["sample"]), "dup_rate")


ALN = """SELECT l_orderkey, 's' || (l_partkey % 6) AS sample, (CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END) + (CASE WHEN l_returnflag = 'R' THEN 0 ELSE 2 END)
    + (CASE WHEN l_linestatus = 'O' THEN 256 ELSE 0 END) + (CASE WHEN l_tax < 0.02 THEN 4 ELSE 0 END) AS flag, l_partkey % 61 AS mapq, (l_suppkey % 5)::INT AS mismatches,
    CASE WHEN l_linenumber % 3 = 0 THEN -1 ELSE 1 END * (l_quantity::BIGINT * 10) AS tlen FROM lineitem"""


def _alignments(v):
    flag = (
        F.when(F.col("l_linenumber") % 2 == 1, 64).otherwise(128) + F.when(F.col("l_returnflag") == "R", 0).otherwise(2)
        + F.when(F.col("l_linestatus") == "O", 256).otherwise(0) + F.when(F.col("l_tax") < 0.02, 4).otherwise(0)
    )
    return v.table("lineitem").select(
        "l_orderkey", F.concat(F.lit("s"), F.col("l_partkey") % 6).alias("sample"), flag.alias("flag"), (F.col("l_partkey") % 61).alias("mapq"),
        (F.col("l_suppkey") % 5).cast("int").alias("mismatches"),
        (F.when(F.col("l_linenumber") % 3 == 0, -1).otherwise(1) * (F.col("l_quantity").cast("long") * 10)).alias("tlen"),
    )


@query("filter_alignments", f"""SELECT l_orderkey, flag, mapq, mismatches FROM ({ALN}) WHERE mapq > 30 AND mismatches <= 2 AND (flag & 256) = 0""")
def _(v):
    return flt.filter_alignments(_alignments(v)).select("l_orderkey", "flag", "mapq", "mismatches")


@query("insert_size_stats", f"""SELECT sample, {r('avg(abs(tlen))')} AS mean_insert, {r('stddev_pop(abs(tlen))')} AS sd_insert, count(*) AS pairs
    FROM ({ALN}) WHERE (flag & 66) = 66 GROUP BY 1""")
def _(v):
    return rounded(rd.insert_size_stats(_alignments(v), ["sample"]), "mean_insert", "sd_insert")


@query("library_size", f"""SELECT sample, count(*) AS library_size, {r('1e6 / count(*)')} AS scale FROM reads GROUP BY 1""")
def _(v):
    return rounded(rd.library_size(v.reads), "scale")


HIT = f"""SELECT a.sample, EXISTS (SELECT 1 FROM peaks b WHERE {OV}) AS hit FROM reads a"""


@query("frip", f"""SELECT sample, count(*) AS total, count(*) FILTER (WHERE hit) AS in_peaks, {r('100.0 * count(*) FILTER (WHERE hit) / count(*)')} AS frip
    FROM ({HIT}) GROUP BY 1""")
def _(v):
    return rounded(rd.frip(v.reads, v.peaks), "frip")


@query("mapping_stats", f"""WITH d AS (SELECT sample, sum(n)::BIGINT AS tot_frag, count(*) AS uniq_frag FROM (
    SELECT sample, chrom, "start", "end", strand, count(*) AS n FROM ({STACK}) GROUP BY 1, 2, 3, 4, 5) GROUP BY 1),
    i AS (SELECT sample, avg(abs(tlen)) AS mi, stddev_pop(abs(tlen)) AS si, count(*) AS pairs FROM ({ALN}) WHERE (flag & 66) = 66 GROUP BY 1),
    m AS (SELECT sample, count(*) FILTER (WHERE (flag & 64) <> 0) AS read1, count(*) FILTER (WHERE (flag & 128) <> 0) AS read2,
        count(*) FILTER (WHERE (flag & 4) = 0) AS mapped FROM ({ALN}) GROUP BY 1)
    SELECT sample, read1, read2, mapped, {r('mi')} AS mean_insert, {r('si')} AS sd_insert, pairs, tot_frag, uniq_frag,
    {r('(tot_frag - uniq_frag) / tot_frag')} AS dup_rate FROM m JOIN i USING (sample) JOIN d USING (sample)""")
def _(v):
    return rounded(rd.mapping_stats(_alignments(v), _stacked(v)), "mean_insert", "sd_insert", "dup_rate")


@query("sample_stats", f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY sample, chrom, "start", "end", strand ORDER BY name, weight) AS k FROM ({STACK})),
    h AS (SELECT a.sample, EXISTS (SELECT 1 FROM peaks b WHERE {OV}) AS hit FROM f a WHERE k = 1)
    SELECT t.sample, t.total_tags, k.filtered_tags, k.in_peaks, {r('100.0 * k.in_peaks / k.filtered_tags')} AS frip, (SELECT count(*) FROM peaks) AS n_peaks
    FROM (SELECT sample, count(*) AS total_tags FROM reads GROUP BY 1) t
    JOIN (SELECT sample, count(*) AS filtered_tags, count(*) FILTER (WHERE hit) AS in_peaks FROM h GROUP BY 1) k USING (sample)""")
def _(v):
    stacked = _stacked(v)
    kept = rd.dedup_reads(stacked, 1, ["name", "weight"], ["sample"])
    return rounded(rd.sample_stats(stacked, kept, v.peaks), "frip")


# --- filters and projections -----------------------------------------------


@query("extend_reads", """SELECT name, chrom, CASE WHEN strand = '-' THEN greatest("start" - 200, 0) ELSE "start" END AS "start",
    CASE WHEN strand = '+' THEN "end" + 200 ELSE "end" END AS "end" FROM reads""")
def _(v):
    return flt.extend_reads(v.reads, 200).select("name", *ov.COORDS)


@query("clamp_start", """SELECT id, chrom, greatest("start" - 5000, 0) AS "start", "end" FROM peaks""")
def _(v):
    moved = v.peaks.withColumn("start", F.col("start") - 5000)
    return flt.clamp_start(moved).select("id", *ov.COORDS)


@query("resize_on_summit", """SELECT id, chrom, "start" + summit_offset - 200 AS "start", "start" + summit_offset + 200 AS "end" FROM peaks""")
def _(v):
    return flt.resize_on_summit(v.peaks).select("id", *ov.COORDS)


@query("resize_on_position", """SELECT id, chrom, ("start" + "end") // 2 - 200 AS "start", ("start" + "end") // 2 + 200 AS "end" FROM peaks""")
def _(v):
    return flt.resize_on_position(v.peaks).select("id", *ov.COORDS)


@query("filter_signal", """SELECT id, signal_value FROM peaks WHERE signal_value > 3""")
def _(v):
    return flt.filter_signal(v.peaks).select("id", "signal_value")


WIDE = f"""SELECT a.id, count(b.name) FILTER (WHERE sample = 's0') AS s0, count(b.name) FILTER (WHERE sample = 's1') AS s1, count(b.name) FILTER (WHERE sample = 's2') AS s2
    FROM peaks a LEFT JOIN reads b ON {OV} GROUP BY 1"""


def _wide(v):
    one = lambda s: (F.col("sample") == s).cast("long")
    p = v.peaks.select("id", *ov.COORDS)
    return ov.count_many_in_regions(p, v.reads, {s: one(s) for s in ("s0", "s1", "s2")}).select("id", "s0", "s1", "s2")


@query("filter_height", f"""SELECT * FROM ({WIDE}) WHERE s0 > 0 AND s1 > 0 AND s2 > 0""")
def _(v):
    return flt.filter_height(_wide(v), ["s0", "s1", "s2"], 0)


@query("filter_min_coverage", f"""SELECT * FROM ({WIDE}) WHERE s0 > 1 OR s1 > 1""")
def _(v):
    return flt.filter_min_coverage(_wide(v), "s0", "s1", 1)


@query("filter_chrom", """SELECT id, chrom FROM peaks WHERE chrom IN ('chr1', 'chr2', 'chr3') AND chrom <> 'chr2'""")
def _(v):
    return flt.filter_chrom(v.peaks, ["chr1", "chr2", "chr3"], ["chr2"]).select("id", "chrom")


@query("derive_tss", """SELECT id, chrom, CASE WHEN strand = '+' THEN "start" ELSE "end" - 1 END AS pos,
    greatest(CASE WHEN strand = '+' THEN "start" ELSE "end" - 1 END - 1000, 0) AS "start",
    CASE WHEN strand = '+' THEN "start" ELSE "end" - 1 END + 1001 AS "end" FROM features""")
def _(v):
    return flt.derive_tss(v.features, 1000).select("id", "chrom", "pos", "start", "end")


@query("derive_promoters", """SELECT * FROM (SELECT id, chrom, CASE WHEN strand = '+' THEN greatest("start" - 1000, 0) ELSE "end" END AS "start",
    CASE WHEN strand = '+' THEN "start" ELSE "end" + 1000 END AS "end" FROM features) WHERE "end" > "start" """)
def _(v):
    return flt.derive_promoters(v.features, 1000).select("id", *ov.COORDS)


@query("distinct_regions", f"""SELECT DISTINCT chrom, "start", "end" FROM ({STACK})""")
def _(v):
    return flt.distinct_regions(_stacked(v))


@query("select_columns", """SELECT chrom, "start", "end", signal_value FROM peaks""")
def _(v):
    return flt.select_columns(v.peaks, ["chrom", "start", "end", "signal_value"])


@query("label_peak_origin", """SELECT id, 'urgent' AS origin FROM peaks""")
def _(v):
    return flt.label_peak_origin(v.peaks.select("id"), "urgent", "origin")


@query("normalise_chrom", """SELECT id, 'Chr' || substr(chrom, 4) AS chrom FROM peaks""")
def _(v):
    mixed = v.peaks.withColumn(
        "chrom", F.when(F.col("id") % 3 == 0, F.substring("chrom", 4, 10)).when(F.col("id") % 3 == 1, F.initcap("chrom")).otherwise(F.col("chrom"))
    )
    return flt.normalise_chrom(mixed, "Chr").select("id", "chrom")
