"""Registered queries of this folder: each operator over its whole table with its default parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontamination, embedding_dedup, fingerprints, language_id, license_scan, lm_scoring, packing, periodic_runs, simhash_dedup, substring_dedup, token_counts, toxicity, vector_codes
from .common import documents, remainder

TOKEN_LIMIT = 4096


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every text."""
    return license_scan.scan(documents(spark, sf_dir))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return decontamination.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of passages that start earlier, taken out of every document."""
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches of every document and of its edited text."""
    return fingerprints.edited_neighbours(documents(spark, sf_dir))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document; a seventh of them is held out."""
    return lm_scoring.score(documents(spark, sf_dir), remainder(7) == 2)


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def toxic_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = documents(spark, sf_dir)
    return toxicity.severity(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a third of them is held out."""
    docs = documents(spark, sf_dir)
    texts = language_id.learn(docs.filter(remainder(3) != 1))
    out = language_id.predict(docs, texts)
    return out.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "phrases", "letters")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return simhash_dedup.near_duplicates(documents(spark, sf_dir))


def counted_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and what of it fits the limit."""
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), TOKEN_LIMIT)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors."""
    return embedding_dedup.near_duplicates(embeddings(spark, sf_dir))


def vector_codes_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors, their errors and the digest of the codebooks."""
    coded = vector_codes.compress(embeddings(spark, sf_dir))
    digits = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select("vec_id", digits.alias("code"), "error", "label_error", "codebooks_sha256")


def repeated_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, after a tenth of them got a periodic tail."""
    found = periodic_runs.find_runs(periodic_runs.with_periodic_tails(documents(spark, sf_dir)))
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    out = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), digest(listed).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"), "n_words",
    )
    return out.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words",
    )


QUERIES = {
    "op1_license_scans": license_scans,
    "op2_decontamination": benchmark_decontamination,
    "op3_substring_dedup": repeated_passages,
    "op4_fingerprints": document_fingerprints,
    "op5_lm_scoring": lm_scores,
    "op6_packing": packed_sequences,
    "op7_toxicity": toxic_severity,
    "op8_language_id": languages,
    "op9_simhash_dedup": near_duplicates,
    "op10_token_counts": counted_tokens,
    "op11_embedding_dedup": near_vectors,
    "op12_vector_codes": vector_codes_of_all,
    "op13_periodic_runs": repeated_stretches,
}

ORACLES = {
    "op1_license_scans": license_scan.scan_sql(),
    "op11_embedding_dedup": embedding_dedup.near_duplicates_sql(),
    "op12_vector_codes": vector_codes.codes_sql(),
    "op13_periodic_runs": periodic_runs.runs_sql(),
}
