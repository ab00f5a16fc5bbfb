"""Genomic views over the given tables, for Spark and for the checking SQL.

The tables hold no genomes, so their keys are spread over five chromosomes of ten million
positions and the letters of their texts over the four bases.  Every view covers every
row of its table.
"""

from __future__ import annotations

from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..operators.motifs import MOTIF_SCHEMA, collect_models, motif_rows, pfm_to_pwm
from ..operators.sequences import CHUNK, chunk_sequences

SPAN = 10_000_000
LENGTH = SPAN + 500
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASES = ("ACGT" * 13)[:52]
_TO_BASES = bytes.maketrans(LETTERS.encode(), BASES.encode())
_NO_LETTERS = bytes(c for c in range(256) if chr(c) not in LETTERS)
TYPES = ["intergenic", "promoter", "5UTR", "3UTR", "intron", "exon"]

SITES = 600
#: The searched motif, and of 600 sites the share in per cent with its letter at each position.
MOTIF = "TGGACGTCATC"
SHARES = [40, 65, 90, 98, 99, 99, 98, 99, 60, 92, 55]


def count_matrix(motif: str, shares: list[int]) -> list[list[int]]:
    """Counts of A, C, G and T; the three other letters share the rest 3 : 2 : 1, in order after the motif's."""
    rows = []
    for letter, share in zip(motif, shares):
        most = SITES * share // 100
        at = "ACGT".index(letter)
        row = [0] * 4
        for k, parts in enumerate((3, 2, 1), 1):
            row[(at + k) % 4] = (SITES - most) * parts // 6
        row[at] = SITES - sum(row)
        rows.append(row)
    return rows


PFM = count_matrix(MOTIF, SHARES)
#: A second, shorter motif: the positions of the first that matter most.
MOTIF_SHORT = MOTIF[2:8]
PFM_SHORT = PFM[2:8]

SQL_VIEWS = {
    "reads": """SELECT 'chr' || (l_suppkey % 5 + 1) AS chrom,
        (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 10000000 AS "start",
        (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 10000000 + l_quantity::BIGINT * 10 + 1 AS "end",
        concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS name,
        CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand,
        's' || (l_partkey % 6) AS sample, l_extendedprice AS weight FROM lineitem""",
    "peaks": """SELECT o_orderkey AS id, 'chr' || (o_custkey % 5 + 1) AS chrom, (o_orderkey * 6151) % 10000000 AS "start",
        (o_orderkey * 6151) % 10000000 + 200 + o_orderkey % 201 AS "end",
        CASE WHEN o_orderpriority < '3' THEN 'A' ELSE 'B' END AS "set", substr(o_orderpriority, 1, 1) AS batch,
        o_totalprice / 50000 AS signal_value, (o_orderkey * 7) % 200 AS summit_offset FROM orders""",
    "features": """SELECT p_partkey AS id, 'chr' || (p_partkey % 5 + 1) AS chrom, (p_partkey * 4999) % 10000000 AS "start",
        least((p_partkey * 4999) % 10000000 + 300 * p_size, 10000500) AS "end",
        CASE p_partkey % 6 WHEN 0 THEN 'intergenic' WHEN 1 THEN 'promoter' WHEN 2 THEN '5UTR' WHEN 3 THEN '3UTR'
            WHEN 4 THEN 'intron' ELSE 'exon' END AS type,
        CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part""",
    "signal": """SELECT 'chr' || (user_id % 5 + 1) AS chrom, (event_id * 977) % 10000000 AS "start",
        (event_id * 977) % 10000000 + 1 AS "end", value, event_type AS track FROM events""",
    "methyl": """SELECT 'chr' || (user_id % 5 + 1) AS chrom, (event_id * 977) % 10000000 + 1 AS pos,
        ((event_id * 37) % 100) / 99.0::DOUBLE AS prob FROM events""",
    "sizes": "SELECT 'chr' || (r_regionkey + 1) AS chrom, 10000500::BIGINT AS length FROM region",
    "seqs": f"""SELECT doc_id AS seq_id,
        translate(regexp_replace(text, '[^A-Za-z]', '', 'g'), '{LETTERS}', '{BASES}') AS seq, lang FROM documents""",
    "labelled": "SELECT seq_id, seq, quality AS label FROM seqs JOIN labels ON doc_id = seq_id",
    "spots": """SELECT doc_id, doc_id * 100000 + k AS seq_id, doc_id::VARCHAR AS chrom, k * 300 AS "start", least(k * 300 + 300, length(seq)) AS "end", k, seq
        FROM (SELECT seq_id AS doc_id, seq, unnest(range(0, (length(seq) + 299) // 300)) AS k FROM seqs)""",
    "probes": """SELECT seq_id, seq_id::VARCHAR AS chrom, (seq_id * 7919) % greatest(length(seq) - 1, 1) AS "start",
        least((seq_id * 7919) % greatest(length(seq) - 1, 1) + 300, length(seq)) AS "end" FROM seqs WHERE length(seq) > 0""",
}


@F.arrow_udf(StringType())
def to_bases(text: pa.Array) -> pa.Array:
    """The letters A-Z and a-z of each text as bases, a byte at a time: queries read the texts several times."""
    return pa.array([t if t is None else t.translate(_TO_BASES, _NO_LETTERS) for t in text.cast(pa.binary()).to_pylist()], pa.binary()).cast(pa.string())


class Views:
    """The same views as DataFrames; only the columns a query uses are read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def reads(self) -> DataFrame:
        start = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31) % SPAN
        return self.table("lineitem").select(
            F.concat(F.lit("chr"), F.col("l_suppkey") % 5 + 1).alias("chrom"), start.alias("start"),
            (start + F.col("l_quantity").cast("long") * 10 + 1).alias("end"),
            F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("name"),
            F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise("+").alias("strand"),
            F.concat(F.lit("s"), F.col("l_partkey") % 6).alias("sample"), F.col("l_extendedprice").alias("weight"),
        )

    @cached_property
    def peaks(self) -> DataFrame:
        key = F.col("o_orderkey")
        start = (key * 6151) % SPAN
        return self.table("orders").select(
            key.alias("id"), F.concat(F.lit("chr"), F.col("o_custkey") % 5 + 1).alias("chrom"), start.alias("start"),
            (start + 200 + key % 201).alias("end"),
            F.when(F.col("o_orderpriority") < "3", "A").otherwise("B").alias("set"),
            F.substring("o_orderpriority", 1, 1).alias("batch"),
            (F.col("o_totalprice") / 50000).alias("signal_value"), ((key * 7) % 200).alias("summit_offset"),
        )

    @cached_property
    def features(self) -> DataFrame:
        key = F.col("p_partkey")
        start = (key * 4999) % SPAN
        kind = F.array(*[F.lit(t) for t in TYPES])[(key % 6).cast("int")]
        return self.table("part").select(
            key.alias("id"), F.concat(F.lit("chr"), key % 5 + 1).alias("chrom"), start.alias("start"),
            F.least(start + 300 * F.col("p_size"), F.lit(LENGTH)).alias("end"), kind.alias("type"),
            F.when(key % 2 == 0, "+").otherwise("-").alias("strand"),
        )

    @cached_property
    def signal(self) -> DataFrame:
        pos = (F.col("event_id") * 977) % SPAN
        return self.table("events").select(
            F.concat(F.lit("chr"), F.col("user_id") % 5 + 1).alias("chrom"), pos.alias("start"), (pos + 1).alias("end"),
            "value", F.col("event_type").alias("track"),
        )

    @cached_property
    def methyl(self) -> DataFrame:
        return self.table("events").select(
            F.concat(F.lit("chr"), F.col("user_id") % 5 + 1).alias("chrom"),
            ((F.col("event_id") * 977) % SPAN + 1).alias("pos"), ((F.col("event_id") * 37 % 100) / 99.0).alias("prob"),
        )

    @cached_property
    def sizes(self) -> DataFrame:
        return self.table("region").select(
            F.concat(F.lit("chr"), F.col("r_regionkey") + 1).alias("chrom"), F.lit(LENGTH).cast("long").alias("length")
        )

    @cached_property
    def seqs(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("seq_id"), to_bases("text").alias("seq"), "lang")

    @cached_property
    def labelled(self) -> DataFrame:
        labels = self.table("labels").select(F.col("doc_id").alias("seq_id"), F.col("quality").alias("label"))
        return self.seqs.select("seq_id", "seq").join(labels, "seq_id")

    @cached_property
    def spots(self) -> DataFrame:
        """Regions of 300 bp end to end over each whole sequence, the sequences acting as contigs."""
        sized = self.seqs.select(F.col("seq_id").alias("doc_id"), F.length("seq").cast("long").alias("size")).where("size > 0")
        return sized.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / 300)))).select(
            "doc_id", (F.col("doc_id") * 100000 + F.col("k")).alias("seq_id"), F.col("doc_id").cast("string").alias("chrom"),
            (F.col("k") * 300).alias("start"), F.least(F.col("k") * 300 + 300, "size").alias("end"),
        )

    @cached_property
    def probes(self) -> DataFrame:
        """One 300 bp region in each sequence; what lies outside them is the background."""
        size = F.length("seq")
        start = (F.col("seq_id") * 7919) % F.greatest(size - 1, F.lit(1))
        return self.seqs.where(size > 0).select(
            "seq_id", F.col("seq_id").cast("string").alias("chrom"), start.alias("start"),
            F.least(start + 300, size.cast("long")).alias("end"),
        )

    @cached_property
    def contigs(self) -> DataFrame:
        return chunk_sequences(self.seqs, "seq_id", "seq", CHUNK)

    @cached_property
    def motifs(self) -> DataFrame:
        rows = motif_rows(MOTIF, "COUNT", "ASYMMETRIC", PFM) + motif_rows(MOTIF_SHORT, "COUNT", "ASYMMETRIC", PFM_SHORT)
        return self.spark.createDataFrame(rows, MOTIF_SCHEMA)

    @cached_property
    def models(self):
        """[short motif, long motif] as score matrices."""
        return collect_models(pfm_to_pwm(self.motifs))

    @property
    def model(self):
        return [m for m in self.models if m.motif_id == MOTIF]

    @property
    def short_model(self):
        return [m for m in self.models if m.motif_id == MOTIF_SHORT]


def _log_scores(pfm) -> list[list[str]]:
    """SQL terms of the log scores of a count matrix without zeros."""
    return [[f"ln({c}/{sum(row)}::DOUBLE/({max(row)}/{sum(row)}::DOUBLE))" for c in row] for row in pfm]


def _score_sql(pfm, reverse: bool) -> str:
    rows = _log_scores(pfm)
    if reverse:
        rows = [row[::-1] for row in rows[::-1]]
    return " + ".join(
        "CASE b{} {} END".format(j, " ".join(f"WHEN '{b}' THEN {t}" for b, t in zip("ACGT", row)))
        for j, row in enumerate(rows)
    )


def windows_sql(pfm, source: str = "seqs") -> str:
    """All windows of a motif on both strands: seq_id, pos, strand, kmer, score."""
    n = len(pfm)
    leads = ", ".join(f"lead(b, {j}) OVER w AS b{j}" for j in range(n))
    kmer = " || ".join(f"b{j}" for j in range(n))
    return f"""SELECT seq_id, pos, unnest(['+', '-']) AS strand, {kmer} AS kmer,
        unnest([{_score_sql(pfm, False)}, {_score_sql(pfm, True)}]) AS score
        FROM (SELECT seq_id, pos, {leads} FROM (
            SELECT seq_id, unnest(range(1, length(seq) + 1)) AS pos, unnest(string_split(seq, '')) AS b FROM {source} WHERE length(seq) >= {n})
            WINDOW w AS (PARTITION BY seq_id ORDER BY pos)) WHERE b{n - 1} IS NOT NULL"""


SQL_VIEWS["win_long"] = windows_sql(PFM)
SQL_VIEWS["win_short"] = windows_sql(PFM_SHORT)
