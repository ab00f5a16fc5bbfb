"""From raw documents to packed training sequences.

``STAGES`` are applied one after another; each takes (spark, docs, sf_dir), works on all documents that its
predecessor kept and is written as Parquet before the next reads it.  All but the last return the columns of
``documents``, whatever they are; only doc_id, text, lang and n_chars are looked at.

Empty tables pass through.  Rows without a doc_id cannot be compared with others: near-duplicate detection
and what follows leaves them out.  Rows that repeat a doc_id go on as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from peakloom.llm import decontamination, language_id, packing, simhash_dedup, substring_dedup
from peakloom.llm.common import cut_lineage, documents, nested, one_per_id, unnested
from peakloom.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language, with the one found as lang; those in none (no text or no letter) go.

    Learns from the documents' own labels.  Without any label languages cannot be told apart: then only
    documents without a letter go.
    """
    texts = language_id.learn(docs)
    if not texts:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return language_id.in_some_language(docs, texts)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    groups = simhash_dedup.near_duplicates(one_per_id(docs))
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("kept"))
    rows = one_per_id(nested(docs), "row")
    return unnested(rows.join(kept, F.col("doc_id") == F.col("kept")), docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without passages that start earlier; a text that keeps all its words stays as it is."""
    return substring_dedup.cut_documents(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: Tokenizers and 64-bit SimHash are not to be had in SQL; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
