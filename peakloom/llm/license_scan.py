"""License scans: phrases in place, and an exact set-similarity join of text blocks with templates.

A block is a line of a text, a run of words of a longer line, or a run of words over several lines, seen as
the set of its words; a template is the set of words of a licence notice.  Runs are twice as long as the
longest template and each overlaps the next by half, so a notice in a long line or wrapped over lines lies in
one, and words scattered over a longer line are no notice.  A run over lines meets a template only if none
of the lines in it (as far as they are in it) does so alone; runs that follow one another and meet the same
template count as one block.  A block meets a template if it holds at least ``threshold`` of the template's words.  All such
pairs are found, without comparing each block with each template:

* only words of some template count for a block, and blocks with fewer of them than the shortest
  requirement are passed over (length filter);
* words are ordered by how many blocks hold them, rarest first; a block and a template that share the
  required number of words share one among the first |set| - required + 1 of either (prefix filter);
* at the first shared word, enough words must be left on both sides (positional filter);
* the pairs that remain are verified by intersection.

Words are runs of characters outside x00-x2F, x3A-x60 and x7B-x7F after A-Z became a-z.  A null text is
empty.  Every row gives one row; rows that repeat doc_id and text get the same answer, rows without
doc_id too.  Extra columns are not looked at.  The templates are a bounded parameter, and so is what is
broadcast: their words with counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut_lineage

# Phrases whose places are reported, and the licence each names.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that licence texts ask to be put into files, and the licence each names.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

THRESHOLD = 0.9
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """The text with A-Z as a-z, as far as words of ASCII letters go.

    Only two other characters have lower forms with an ASCII letter; texts without them take the fast way.
    """
    odd = F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ"))
    return F.when(odd, F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BETWEEN), "")


def _places(found: Column, phrase: str) -> Column:
    """Starts of a phrase in an array of words."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        same = F.get(found, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            same = same & F.coalesce(F.get(found, i + k) == p, F.lit(False))
        return same

    return F.filter(F.sequence(F.lit(0), F.size(found) - len(parts)), here)


def phrase_places(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, text_hash, n_words, n_base, first_word, last_word and base (sorted labels) of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), lowered(F.col("text")).alias("low"))
    rows = rows.select("doc_id", "text_hash", words(F.col("low")).alias("found"), *(F.contains("low", F.lit(p.split()[-1])).alias(f"has{i}") for i, p in enumerate(phrases)))
    none = F.array().cast("array<int>")
    rows = rows.select("doc_id", "text_hash", F.size("found").cast("long").alias("n_words"), *(
        F.when(F.col(f"has{i}") & (F.size("found") >= len(p.split())), _places(F.col("found"), p)).otherwise(none).alias(f"at{i}") for i, p in enumerate(phrases)))
    at = [F.col(f"at{i}") for i in range(len(phrases))]
    every = F.concat(*at)
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(at, phrases.values()))))))
    return rows.select(
        "doc_id", "text_hash", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), labels.alias("base"))


def blocks_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, block_no and block: the lines of each text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), lowered(F.col("text").cast("string")).alias("low")).filter("low is not null")
    return rows.select("doc_id", "text_hash", F.posexplode(F.split("low", r"[\n\r]+")).alias("block_no", "block"))


def runs_of(docs: DataFrame, longest: int) -> DataFrame:
    """doc_id, text_hash, block_no (from -2 downwards) and block: runs of 2 * ``longest`` words over lines, one from each ``longest``-th word on."""
    low = lowered(F.col("text").cast("string"))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), low.alias("low"))
    rows = rows.filter(F.contains("low", F.lit("\n")) | F.contains("low", F.lit("\r")))
    word = BETWEEN.replace("[", "[^", 1)
    parts = F.regexp_extract_all("low", F.lit(f"(?:{word}+{BETWEEN[:-1]}*+){{1,{longest}}}"), F.lit(0))
    rows = rows.select("doc_id", "text_hash", parts.alias("parts")).filter(F.size("parts") > 0)
    runs = F.transform(F.slice("parts", F.lit(1), F.greatest(F.size("parts") - 1, F.lit(1))), lambda p, i: F.concat(p, F.coalesce(F.get("parts", i + 1), F.lit(""))))
    rows = rows.select("doc_id", "text_hash", F.posexplode(runs).alias("k", "block"))
    return rows.filter(F.contains("block", F.lit("\n")) | F.contains("block", F.lit("\r"))).select("doc_id", "text_hash", (-2 - F.col("k")).alias("block_no"), "block")


def _literals(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def _held_by_lines(blocks: DataFrame, sets: list[list[str]], need: list[int], known: Column, longest: int) -> DataFrame:
    """doc_id, text_hash, block_no and held: known words of lines, or of the runs of lines of over 2 * ``longest`` words.

    A long line is cut only if it holds enough words of some template as a whole; else no run of it does.
    """
    here = ("doc_id", "text_hash", "block_no")
    rows = blocks.select(*here, F.split("block", BETWEEN).alias("parts"))
    rows = rows.select(*here, "parts", F.array_intersect("parts", known).alias("held"))
    # Where a line begins or ends with a separator, the part beside it is empty.
    n_words = F.size("parts") - (F.get("parts", F.lit(0)) == "").cast("int") - (F.get("parts", F.size("parts") - 1) == "").cast("int")
    some = F.lit(False)
    for s, n in zip(sets, need):
        some = some | (F.size(F.array_intersect("held", _literals(s))) >= n)
    said = F.array_remove("parts", "")
    cut = F.transform(F.sequence(F.lit(0), F.ceil(n_words / longest).cast("int") - 2), lambda k: F.array_intersect(F.slice(said, k * longest + 1, 2 * longest), known))
    enough = F.size("held") >= min(need)
    pieces = F.when(enough & (n_words <= 2 * longest), F.array("held")).when(enough, F.when(some, cut))
    rows = rows.select(*here, pieces.alias("pieces"))
    return rows.select(*here, F.explode("pieces").alias("held")).filter(F.size("held") >= min(need))


def similarity_join(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, block_no, template, label and containment of every block and template that meet."""
    sets = [sorted(set(t.split())) for _, t in templates]
    need = [max(1, math.ceil(threshold * len(s) - 1e-9)) for s in sets]
    vocabulary = sorted(set().union(*sets))
    known = _literals(vocabulary)

    def words_held(blocks: DataFrame) -> DataFrame:
        return blocks.withColumn("held", F.array_intersect(F.split("block", BETWEEN), known)).filter(F.size("held") >= min(need))

    # Of runs, also the words of each line.
    lines = F.transform(F.split("block", r"[\n\r]+"), lambda line: F.array_intersect(F.split(line, BETWEEN), known))
    longest = max(len(t.split()) for _, t in templates)
    runs = words_held(runs_of(docs, longest)).withColumn("lines", lines).drop("block")
    held = _held_by_lines(blocks_of(docs), sets, need, known, longest).withColumn("lines", F.lit(None).cast(runs.schema["lines"].dataType)).unionByName(runs)
    held = cut_lineage(held)

    # At most one row for each word of the templates.
    counts = {r["word"]: r["n"] for r in held.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for t, (s, n) in enumerate(zip(sets, need)):
        ranked = sorted(rank[w] for w in s)
        index += [(r, t, len(s) - 1 - i, n) for i, r in enumerate(ranked[: len(s) - n + 1])]
    spark = docs.sparkSession
    prefix = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, index)) + " AS t(rank, template, after_there, need)")
    facts = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"({t}, '{label}', array({', '.join(str(rank[w]) for w in s)}), array({', '.join(repr(w) for w in s)}))" for t, ((label, _), s) in enumerate(zip(templates, sets))) + " AS t(template, label, there, said)")

    ranks = F.create_map(*(x for w, i in rank.items() for x in (F.lit(w), F.lit(i))))
    ranked = held.select("doc_id", "text_hash", "block_no", "lines", F.array_sort(F.transform("held", lambda w: F.element_at(ranks, w))).alias("here"))
    firsts = ranked.select("*", F.posexplode(F.slice("here", F.lit(1), F.size("here") - min(need) + 1)).alias("i", "rank"))
    met = firsts.join(F.broadcast(prefix), "rank")
    met = met.filter((F.size("here") >= F.col("need")) & (F.least(F.size("here") - 1 - F.col("i"), F.col("after_there")) + 1 >= F.col("need")))
    pairs = met.select("doc_id", "text_hash", "block_no", "template", "need", "here", "lines").distinct()
    pairs = pairs.join(F.broadcast(facts), "template")
    shared = F.size(F.array_intersect("here", "there"))
    alone = F.exists("lines", lambda line: F.size(F.array_intersect(line, F.col("said"))) >= F.col("need"))
    pairs = pairs.filter(shared >= F.col("need")).filter(F.col("lines").isNull() | ~alone)
    return pairs.select("doc_id", "text_hash", "block_no", "template", "label", (shared / F.size("there")).alias("containment"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for every row of ``docs`` with phrase places, labels and score.

    labels are those of phrases and of templates met; score is the greatest containment of a template
    met, 1 where a phrase stands.
    """
    met = similarity_join(docs, templates, threshold)
    # The run before, if it meets the same template, is the same block.
    before = F.lag("block_no").over(Window.partitionBy("doc_id", "text_hash", "template").orderBy(F.desc("block_no")))
    met = met.withColumn("before", before)
    opens = (F.col("block_no") >= 0) | F.col("before").isNull() | (F.col("before") != F.col("block_no") + 1)
    met = met.groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"), F.countDistinct(F.when(opens, F.col("block_no"))).alias("n_blocks"))
    met = met.select(F.col("doc_id").alias("met_id"), F.col("text_hash").alias("met_hash"), "more", "best", "n_blocks")
    base = phrase_places(docs)
    both = base.join(met, base["doc_id"].eqNullSafe(met["met_id"]) & (base["text_hash"] == met["met_hash"]), "left")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"), F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))


def scan_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same in SQL, each line or run of a long line beside each template."""
    def places(phrase: str) -> str:
        parts = phrase.split()
        return "list_filter(range(len(w)), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts)) + ")"

    lists = ", ".join(f"{places(p)} AS at{i}" for i, p in enumerate(PHRASES))
    every = " || ".join(f"at{i}" for i in range(len(PHRASES)))
    labels = " || ".join(f"(CASE WHEN len(at{i}) > 0 THEN ['{label}'] ELSE [] END)" for i, label in enumerate(PHRASES.values()))
    rows = ", ".join(f"('{label}', {sorted(set(t.split()))})" for label, t in templates)
    cut = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    longest = max(len(t.split()) for _, t in templates)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS low FROM documents),
w AS (SELECT r, doc_id, list_filter(regexp_split_to_array(low, {cut}), lambda x: x <> '') AS w FROM d),
p AS (SELECT r, doc_id, len(w) AS n_words, {lists} FROM w),
b AS (SELECT r, doc_id, n_words, {every} AS every, {labels} AS base FROM p),
t AS (SELECT * FROM (VALUES {rows}) AS v(label, words)),
l AS (SELECT r, no, list_filter(regexp_split_to_array(block, {cut}), lambda y: y <> '') AS w
  FROM (SELECT r, unnest(range(len(bs))) AS no, unnest(bs) AS block FROM (SELECT r, regexp_split_to_array(low, '[\\n\\r]+') AS bs FROM d))),
x AS (SELECT r, no, list_distinct(piece) AS held
  FROM (SELECT r, no, unnest(CASE WHEN len(w) > {2 * longest} THEN [w[k * {longest} + 1 : (k + 2) * {longest}] FOR k IN range((len(w) + {longest - 1}) // {longest} - 1)] ELSE [w] END) AS piece FROM l)),
m AS (SELECT r, list(DISTINCT label) AS more, max(share) AS best, count(DISTINCT no) AS n_blocks
  FROM (SELECT r, no, label, len(list_intersect(held, words)) / len(words) AS share FROM x, t) WHERE share >= {threshold} - 1e-9 GROUP BY r)
SELECT doc_id, n_words, len(every) AS n_base, list_min(every) AS first_word, list_max(every) AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') AS labels,
  CASE WHEN len(every) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score, coalesce(n_blocks, 0) AS n_blocks
FROM b LEFT JOIN m USING (r)"""
