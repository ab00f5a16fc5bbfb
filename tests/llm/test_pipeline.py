"""Stages of the pipeline beside plain versions, and on odd tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from peakloom.llm import packing
from peakloom.llm.queries import tokenizer_path

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
STAGES = dict(corpus_pipeline.STAGES)


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}


def test_whole_pipeline(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = [(d, t) for d, t in docs if any(c.isalpha() for c in t or "")]
    kept = {d for d, _, c in brute.near_duplicates(docs) if c == d}
    docs = [(d, t) for d, t in docs if d in kept]
    texts = dict(docs)
    docs = [(d, t if n else texts[d]) for d, _, n, t in brute.repeats(docs)]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    common = [set(brute.shingles(brute.words(t, brute.MARKS, True))) for _, t in items]
    some = [(d, t) for d, t in docs if any(c & set(brute.shingles(brute.words(t, brute.MARKS, True))) for c in common)]
    bad = {d for d, _ in brute.leaks(some, items)}
    docs = [(d, t) for d, t in docs if d not in bad]
    want = []
    for (d, t), ids in zip(docs, packing.encode(tokenizer_path("word_bpe_49k.json"), [t.encode() for _, t in docs])):
        at = 0
        for n in packing.piece_lengths(len(ids) // 4 + 1, 2048):
            want.append((d, at, n))
            at += n
    got = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, `row` int, kept string, `a.b` map<string,int>"
    rows = [
        (1, "the and of that with " * 30, "en", "s", 1, 1, "k", {"x": 1}), (2, "the and of that with " * 30, "en", None, None, None, None, None), (3, None, None, None, None, 2, "", {}),
        (4, "", "de", "s", 0, 3, None, None), (5, "der die und das ist nicht ein", "de", "s", 29, 4, "k", None), (5, None, "de", "s", 0, 5, "k", None), (6, "123 456", "en", "s", 7, 6, "k", None),
    ]
    docs = spark.createDataFrame(rows, schema)
    for name in ("language_id", "near_duplicates", "repeated_passages", "decontamination"):
        out = STAGES[name](spark, docs, SF)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
        assert STAGES[name](spark, docs.limit(0), SF).count() == 0
        out.collect()
    assert {r["doc_id"] for r in STAGES["language_id"](spark, docs, SF).collect()} == {1, 2, 5}
    assert {r["doc_id"] for r in STAGES["near_duplicates"](spark, docs, SF).collect()} == {1, 3, 5, 6}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in STAGES["language_id"](spark, unlabelled, SF).collect()} == {1, 2, 5}
