"""The operators beside plain versions of them."""

import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import rows_of
from peakloom.llm import decontamination, fingerprints, graphs, language_id, license_scan, lm_scoring, packing, simhash_dedup, substring_dedup, token_counts, toxicity, words
from peakloom.llm.common import one_per_id, remainder

from . import brute

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
IDS = public_tokenizers.path("word_bpe_49k.json")


def test_hashes_are_those_of_words(rows):
    import pyarrow as pa

    texts = [t for _, t in rows]
    got = words.words_of(pa.record_batch({"text": pa.array(texts)}), lower=True)
    flat = [w for t in texts for w in brute.words(t, lower=True)]
    assert [got.data[s:e].tobytes().decode() for s, e in zip(got.start, got.end)] == flat
    by_word = dict(zip(flat, got.hashes().tolist()))
    assert [by_word[w] for w in flat] == got.hashes().tolist() and len(set(by_word.values())) == len(by_word)


def test_license_scan_against_sql(spark, docs, rows):
    df = license_scan.scan(docs)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas().astype({"text": object}).where(lambda d: d.notna(), None))
    cur = con.execute(license_scan.scan_sql())
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in cur.description], cur.fetchall())
    one = df.filter("doc_id = 9008").first()
    assert (one["n_base"], one["first_word"], one["base_labels"], one["score"]) == (4, 3, "cc-by,gpl,mit", 1.0)


def test_license_null_ids_and_repeats(spark):
    text = "Licensed under the Apache License, Version 2.0"
    got = license_scan.scan(spark.createDataFrame([(None, text), (1, text), (1, text)], "doc_id long, text string")).collect()
    assert [(r["labels"], r["n_words"]) for r in got] == [("apache", 8)] * 3


def test_license_in_long_lines(spark):
    rng = random.Random(5)
    notices = [t.split() for _, t in license_scan.TEMPLATES]
    texts = []
    for i in range(120):
        notice = notices[i % len(notices)]
        filler = [f"w{rng.randrange(60)}" for _ in range(rng.choice([5, 40, 59, 90, 300]))]
        if i % 3 == 0:
            # Scattered: one word of the notice, then far more than a run of others.
            texts.append(" ".join(w for n in notice for w in [n, *filler, *["x"] * 60]))
        else:
            at = rng.randrange(len(filler) + 1)
            texts.append(" ".join(filler[:at] + notice + filler[at:]) + rng.choice(["", ".", "\nx"]))
    texts += ["mit " * 3000, ", " * 500, "released under the mit " + "x " * 40 + "license", "." + " ".join(["y"] * 58) + ".", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(df).collect()}
    for i in range(120):
        label = license_scan.TEMPLATES[i % len(notices)][0]
        if i % 3:
            assert label in got[i]["labels"].split(",") and got[i]["score"] == 1.0
        else:
            assert got[i]["labels"] == "" and got[i]["score"] == 0.0
    assert got[122]["labels"] == "mit" and got[120]["labels"] == ""
    con = duckdb.connect()
    documents = df.toPandas()
    con.register("documents", documents)
    cur = con.execute(license_scan.scan_sql())
    names = [d[0] for d in cur.description]
    assert {r[0]: dict(zip(names, r)) for r in cur.fetchall()} == {k: r.asDict() for k, r in got.items()}


def test_license_wrapped_over_lines(spark):
    mit = "/* Permission is hereby granted, free of charge, to any\n * person obtaining a copy of this software and\n * associated documentation files (the \"Software\") */"
    bsd = "# Redistribution and use in source and binary forms, with or without\r\n#\r\n# modification, are permitted provided that the following\r\n# conditions are met:"
    one = mit.replace("\n *", "")
    pad = "\n".join(f"x{i} y{i}" for i in range(70))
    texts = [mit, bsd, f"{pad}\n{mit}\n{pad}\n{bsd}", f"{pad}\n{one}\n{pad}", f"{one}\n{pad}\n{mit}", mit.replace("\n", " ZZ\n" + pad + "\n")]
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r["labels"], r["n_blocks"]) for r in got] == [("mit", 1), ("bsd", 1), ("bsd,mit", 2), ("mit", 1), ("mit", 2), ("", 0)]
    assert [r["score"] for r in got] == [1.0] * 5 + [0.0]
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:at]) + "\n" + bsd + "\n" + " ".join(words[at:]) for at in range(60)]
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r["labels"], r["n_blocks"]) for r in got} == {("bsd", 1)}


def test_leaks_against_every_window(spark, rows):
    import random

    draw = random.Random(2)
    items = [(i, " ".join(draw.choice("pqrstuvw") + str(draw.randint(0, 9)) for _ in range(draw.randint(6, 40)))) for i in range(12)] + [(90, "a b c"), (91, ""), (92, None), (93, "x " * 9)]
    planted = []
    for k in range(80):
        ws = brute.words(draw.choice(items[:12])[1])
        for _ in range(draw.randint(0, 2)):
            j = draw.randrange(len(ws))
            ws[j:j + 1] = draw.choice([[], ["zz"], [ws[j], "q"]])
        planted.append((7000 + k, " ".join(brute.words(rows[k][1])[:draw.choice([0, 25])] + ws + ["end"] * draw.choice([0, 12]))))
    texts = planted + [(d, t) for d, t in rows if d >= 8060 or d < 0] + [(7900, "a B, c!"), (7901, "x " * 8)]
    got = decontamination.find_leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute.leaks(texts, items)
    assert len(want) > 30
    assert {(r["doc_id"], r["item_id"]): (r["start_word"], r["n_words"], pytest.approx(r["similarity"])) for r in got.collect()} == want


def test_leaks_in_slices_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SLICE_CHARS", 40)
    items = spark.createDataFrame([(i, f"w{i} alpha beta gamma delta epsilon") for i in range(6)], "item_id long, text string")
    texts = spark.createDataFrame([(i, f"so w{i} alpha beta gamma delta epsilon it is") for i in range(6)] + [(9, "clean text of no item at all")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(texts, items, threshold=1.0).collect()) == [(i, i) for i in range(6)]
    assert [r["doc_id"] for r in decontamination.without_leaks(texts, items, threshold=1.0).collect()] == [9]


@pytest.mark.parametrize("flush,asked", [(4 << 20, 4096), (3000, 2)])
def test_repeats_against_all_windows(docs, rows, monkeypatch, flush, asked):
    monkeypatch.setattr(substring_dedup, "FLUSH", flush)
    monkeypatch.setattr(substring_dedup, "ASKED", asked)
    got = sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()))
    assert got == [(d, n, m, brute.sha(t)) for d, n, m, t in brute.repeats(rows)]


def test_cut_documents_keep_their_columns(docs, rows):
    out = substring_dedup.cut_documents(docs)
    texts = dict(rows)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {d: t if m else texts[d] for d, n, m, t in brute.repeats(rows)}


def test_edited_neighbours(docs, rows):
    got = {r["doc_id"]: r for r in fingerprints.edited_neighbours(docs).collect()}
    assert len(got) == len(rows)
    for doc, text, changed, follow in brute.edited(rows):
        r = got[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.sha(changed))
        assert abs(r["near_edited"] - brute.jaccard(text, changed)) < 0.25 and abs(r["near_next"] - brute.jaccard(text, follow)) < 0.25
    assert got[9006]["fingerprint"] == got[9007]["fingerprint"] and got[9000]["fingerprint"] == got[9004]["fingerprint"] == ""


def test_sketches_merge_and_estimate(spark):
    a, b = " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1500, 6000))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = fingerprints.with_sketch(fingerprints.with_sketch(df, "a", "sa", 256), "b", "sb", 256)
    r = df.select(
        fingerprints.distinct_count(F.col("sa"), 256).alias("n"), fingerprints.resemblance(F.col("sa"), F.col("sb"), 256).alias("j"),
        fingerprints.containment(F.col("sa"), F.col("sb"), 256).alias("c"), fingerprints.merge(F.col("sa"), F.col("sb"), 256).alias("m"), "sa").first()
    assert r["n"] == pytest.approx(2996, rel=0.25) and r["j"] == pytest.approx(0.25, abs=0.1) and r["c"] == pytest.approx(0.5, abs=0.2)
    assert len(r["m"]) == 256 and r["m"] == sorted(r["m"])


@pytest.mark.parametrize("head", [lm_scoring.HEAD, 4])
def test_base_scores(docs, rows, head):
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, remainder(7) == 2, bits=1 << 20, head=head).collect()}
    want = brute.base_scores(rows)
    assert set(got) == set(want)
    for doc, (n, known, total, base) in want.items():
        r = got[doc]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, zlib.crc32(str(doc).encode()) % 7 == 2)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_filter_levels(spark):
    text = "a a a a a b b c " * 3
    train = spark.createDataFrame([(1, text)], "doc_id long, text string")
    held = lm_scoring.build_filter(train, lm_scoring.count_words(train), bits=1 << 18)
    import pyarrow as pa

    tokens, first = lm_scoring._token_hashes(pa.record_batch({"text": pa.array(["a b c zz"])}))
    assert lm_scoring.levels(held, lm_scoring._unigrams(tokens)).tolist() == [3, 2, 1, 0, 0]
    assert lm_scoring.levels(held, lm_scoring._bigrams(tokens, first)).tolist() == [0, 1, 1, 0, 0]


def test_filter_grows_with_its_entries(spark):
    train = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 20 * 1000, i % 20 * 1000 + 1000))) for i in range(40)], "doc_id long, text string")
    for docs, most in ((train, 1 << 20), (train.filter("doc_id % 20 < 2"), 1 << 17)):
        held = lm_scoring.build_filter(docs, lm_scoring.count_words(docs))
        share = np.unpackbits(held.view(np.uint8)).mean()
        assert 0.1 < share < 0.4 and len(held) * 64 <= most
        unseen = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
        assert (lm_scoring.entries(held, unseen) > 0).mean() < 0.03


def test_scores_by_join_with_the_filter(docs, monkeypatch):
    want = sorted(map(tuple, lm_scoring.score(docs, remainder(7) == 2, bits=1 << 20).collect()))
    monkeypatch.setattr(lm_scoring, "SHARED_BITS", 0)
    monkeypatch.setattr(lm_scoring, "CELL_BLOCKS", 4)
    monkeypatch.setattr(lm_scoring, "PORTION", 5000)
    got = sorted(map(tuple, lm_scoring.score(docs, remainder(7) == 2, bits=1 << 20).collect()))
    assert [r[:6] for r in got] == [r[:6] for r in want] and [r[6] for r in got] == pytest.approx([r[6] for r in want], rel=1e-12)


def test_what_is_seen_once_is_told_from_what_is_not(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c d e f g h", "a b", "b a", "h", "z"])], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs, F.col("doc_id") > 0, weight=1.0).collect()}
    assert got[1] > got[2] and got[3] > got[4]


def test_model_is_a_probability(spark):
    train = spark.createDataFrame([(i, "a b a c") for i in range(40)], "doc_id long, text string")
    each = [(100 + i, f"{x}") for i, x in enumerate("abc")]
    docs = train.unionByName(spark.createDataFrame(each, "doc_id long, text string"))
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs, F.col("doc_id") >= 100, bits=1 << 18, weight=1.0).collect()}
    assert sum(10 ** got[100 + i] for i in range(3)) <= 1 and got[0] > 5 * got[100] * 5


def test_pieces(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(IDS)
    out = packing.pack(docs, IDS, with_ids=True).collect()
    assert len({r["sequence_id"] for r in out}) == len(out)
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted((r for r in out if r["doc_id"] == doc), key=lambda r: r["start"])
        assert [i for r in mine for i in r["ids"]] == ids and [r["length"] for r in mine] == packing.piece_lengths(len(ids), 2048)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["doc_tokens"] == len(ids) and r["length"].bit_count() == 1 for r in mine)


def test_severity(spark):
    import random

    draw = random.Random(1)
    made = [(i, " ".join(draw.choice(["it", "was", "fine", "so", "on"]) for _ in range(30)) + (" idiot" if i % 5 == 0 else "") + (" spamword" if i % 10 == 0 else ""), int(i % 5 == 0), int(i % 10 != 0)) for i in range(600)]
    docs = spark.createDataFrame([m[:2] for m in made] + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(m[0], m[3], m[2]) for m in made if m[0] % 3] + [(None, 1, 1), (5000, 0, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.severity(docs, toxicity.fit(docs, labels)).collect()}
    held = [m for m in made if m[0] % 3 == 0]
    assert all(got[m[0]]["toxic"] == bool(m[2]) for m in held)
    assert all(got[m[0]]["grade"] == (0 if not m[2] else 2 - m[3]) for m in held)
    assert not got[9000]["toxic"] and got[9000]["expected_severity"] == got[9001]["expected_severity"] < 0.5
    none = toxicity.severity(docs, toxicity.fit(docs, labels.limit(0))).first()
    assert none["expected_severity"] < 1e-9 and none["grade"] == 0


def test_automaton_holds_all_substrings():
    text = "abracadabra banana"
    automaton = language_id.Automaton(text)

    def has(s):
        state = 0
        for c in map(ord, s):
            state = automaton.go.get(state << 21 | c)
            if state is None:
                return False
        return True

    parts = {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)}
    assert all(map(has, parts)) and not has("ad b") and not has("anab") and not has("z")

    def greedy(word):
        marked, n, at = f" {word} ", 0, 0
        while at < len(marked):
            size = next((k for k in range(len(marked) - at, 0, -1) if marked[at:at + k] in parts), 1)
            n, at = n + 1, at + size
        return n

    for word in ("banana", "abra", "xyz", "nanab", "cadabrab", "b", "éa"):
        assert language_id.phrase_count(automaton, word) == greedy(word), word


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_languages_held_out(spark):
    out = entry.queries()["op8_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert len(held) > 30 and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.93 * len(held)


def test_languages_of_odd_texts(spark, nothing):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "der und die"), (None, "the and of")], "doc_id long, text string")
    out = language_id.predict(docs, {"de": " der die das und ", "en": " the and of to "}).collect()
    assert [r["lang_pred"] for r in out] == ["und", "und", "und", "de", "en"] and all(0 <= r["score"] <= 1 for r in out)
    assert language_id.learn(nothing) == {}
    assert {r["lang_pred"] for r in language_id.predict(docs, {}).collect()} == {"und"}


@pytest.mark.parametrize("crowd", [64, 1])
def test_near_duplicates(docs, rows, crowd):
    got = sorted(map(tuple, simhash_dedup.near_duplicates(docs, crowd=crowd).collect()))
    assert got == sorted(brute.near_duplicates(rows))


@pytest.mark.parametrize("crowd", [64, 3])
def test_links_of_crowded_fingerprints(spark, crowd):
    draw = np.random.default_rng(0)
    found = set()
    for base in draw.integers(0, 2**63, 3).tolist():
        for _ in range(80):
            for bit in draw.integers(0, 63, draw.integers(0, 5)).tolist():
                base ^= 1 << bit if draw.random() < 0.2 else 0
            x = base
            for bit in draw.integers(0, 63, draw.integers(0, 4)).tolist():
                x ^= 1 << bit
            found.add(x)
    found = sorted(found)
    want = brute.classes(found, lambda a, b: (a ^ b).bit_count() <= 2)
    got = {r["node"]: r["root"] for r in graphs.components(simhash_dedup.links(spark.createDataFrame([(x,) for x in found], "fp long"), crowd)).collect()}
    assert [got.get(x, x) for x in found] == [found[w] for w in want]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(7, j) for j in range(1000, 1300)] + [(5, 5), (7, 1000)]
    got = {r["node"]: r["root"] for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 401)} | {j: 7 for j in [7, *range(1000, 1300)]}


def test_token_counts(docs, rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs, PIECES, 50).collect()}
    for doc, text in rows:
        text = text or ""
        n = len(model.encode(text))
        assert (got[doc]["n_tokens"], got[doc]["n_bytes"], got[doc]["over_limit"]) == (n, len(text.encode()), n > 50)
        assert len(model.encode(text[:got[doc]["fit_chars"]])) == got[doc]["fit_tokens"] <= 50
    cut = {r["doc_id"]: r["text"] for r in token_counts.truncate(docs, PIECES, 50).collect()}
    assert all(cut[d] == (t or "")[:got[d]["fit_chars"]] for d, t in rows)


def test_every_prefix(rows):
    import random

    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rnd = random.Random(10)
    letters = ["the", "ing", "qu", "xz", "a", "e", "T", " ", "  ", "▁", "\n", "é", "ё", "शब्द", "字", "𐍈", "\t", "!!", "00", "<s>", "\x00", "\u3000"]
    drawn = ["".join(rnd.choices(letters, k=rnd.randint(1, 30))) for _ in range(300)]
    texts = [t for _, t in rows if t and len(t) < 300][:12] + ["a  b\n\n ▁▁c", "\n x", "<s> é́", " " * 70 + "x" * 90 + "=" * 200, "ab" * 300] + drawn
    for text in texts:
        right = [len(model.encode(text[:k])) for k in range(len(text) + 1)]
        table = token_counts.Table(PIECES, text)
        assert table.every().tolist() == right and table.total == right[-1]
        assert [table.at(k) for k in range(len(text) + 1)] == right
        for limit in (0, 1, 2, 5, right[-1] // 2, max(right[-1] - 1, 0), right[-1], right[-1] + 1):
            chars = max(k for k, n in enumerate(right) if n <= limit)
            assert table.fit(limit) == (chars, right[chars])


def test_prefixes_of_documents(spark, docs, rows, monkeypatch):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted((r["doc_id"], list(r["counts"])) for r in token_counts.prefix_counts(docs, PIECES).collect())
    assert [(d, len(c), c[-1]) for d, c in got] == sorted((d, len(t or "") + 1, len(model.encode(t or ""))) for d, t in rows)
    # Little memory changes the work, not the counts.
    worker = token_counts.PrefixCounts(PIECES)
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    words = [s for _, t in rows for s in token_counts.segments((t or "")[:400])]
    small = token_counts.PrefixCounts(PIECES)
    assert [small.of(s) for s in words] == [worker.of(s) for s in words] and len(small.known) <= 3 and len(small.pairs) <= 3


def test_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (None, "x"), (2, None), (1, "b")], "doc_id long, text string")
    assert sorted(map(tuple, one_per_id(docs).collect())) == [(1, "b"), (2, None)]
    assert [r["doc_id"] for r in substring_dedup.remove_repeats(docs).orderBy("doc_id").collect()] == [1, 2]
    assert fingerprints.edited_neighbours(docs).count() == 2
    assert simhash_dedup.near_duplicates(docs).count() == 6
    assert packing.pack(docs, IDS).select("doc_id").count() >= 6


def test_empty_tables(spark, nothing):
    assert license_scan.scan(nothing).count() == 0
    assert decontamination.find_leaks(nothing, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0
    assert decontamination.find_leaks(nothing, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert fingerprints.edited_neighbours(nothing).count() == 0
    assert lm_scoring.score(nothing, remainder(7) == 2, bits=1 << 18).count() == 0
    assert packing.pack(nothing, IDS).count() == 0
    assert toxicity.severity(nothing, toxicity.fit(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int"))).count() == 0
    assert language_id.predict(nothing, language_id.learn(nothing)).count() == 0
    assert simhash_dedup.near_duplicates(nothing).count() == 0
    assert token_counts.token_counts(nothing, PIECES, 5).count() == 0


def test_packing_added_tokens_in_any_case():
    import random

    from tokenizers import Tokenizer

    tokenizer, draw = Tokenizer.from_file(IDS), random.Random(3)
    bits = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARToftext|>", "<|", "|>", "a", "B", " ", "\n", "É", "é", "3", "'S", "'s", "don't.", "x,", "İ", "ſ", "中", "😀", ".", ",", "K"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 9))) for _ in range(20_000)]
    for text, ids in zip(texts, packing.encode(IDS, [t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_letters_marks_and_numerals(spark):
    schema = "doc_id long, text string, lang string, grade string, chosen string, `of` string, toxic int"
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", "g", "c", "o", 1) for i in range(20)]
    rows += [(100, "½ ²", "en", "g", "c", "o", 1), (101, "Ⅷ 12 _", "de", None, None, None, None), (102, "́ ̀", "en", "g", "c", "o", 1), (103, "हिन्दी", "hi", "g", "c", "o", 0)]
    docs = spark.createDataFrame(rows, schema)
    texts = language_id.learn(docs)
    assert texts["hi"] == " हिन्दी "
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, texts).collect()}
    assert [got[k] for k in (100, 101, 102, 103, 0, 1)] == ["und", "und", "und", "hi", "de", "en"]
    assert language_id._words()("é́x ½a हिन्दी 3b_c") == ["é́x", "a", "हिन्दी", "b", "c"]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    assert toxicity.severity(docs, toxicity.fit(docs, labels)).count() == len(rows)
