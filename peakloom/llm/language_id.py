"""Language of texts by cross-parsing against labelled text.

For each language a suffix automaton is built over labelled words.  A text is parsed greedily into
phrases, each the longest match that the automaton holds; the fewer phrases a language needs for a
text, the lower the cross entropy between them.  Phrases end at word ends, so the phrases of a word
do not depend on its neighbours and are counted once for all its occurrences.

Learning looks at a bounded sample of labelled rows (``sample_rows`` a language, by a hash of the id,
and ``sample_chars`` characters of distinct words of them, parameters); every row and every whole
text is predicted.

Null or letterless texts get ``und`` and score 0.  Repeated rows and null ids are predicted each on
its own.  Rows without text or label are not learnt from.  Without any labelled row every text is
``und``.  Equal counts go to the language that comes first by name.  Other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from .common import in_worker, map_rows
from .words import chunks

SAMPLE_ROWS = 96
SAMPLE_CHARS = 80_000
#: Words kept with their phrases in a worker; later ones are parsed each time.
REMEMBERED = 300_000
UNDECIDED = "und"
_SHIFT = 21
_FIELD = 48


@functools.cache
def _words():
    """Finds the words of a text: a letter and the letters and marks after it.

    Word characters that are no digits or lines are the letters and some numerals; only texts with such a
    numeral or a mark need the pattern of ranges, which is slower.
    """
    kinds = [unicodedata.category(chr(c)) for c in range(sys.maxunicode + 1)]

    def ranges(wanted: str) -> str:
        out, at = [], 0
        for is_in, run in itertools.groupby(kinds, lambda k: k[0] in wanted):
            n = len(list(run))
            if is_in:
                out.append(f"\\U{at:08x}-\\U{at + n - 1:08x}")
            at += n
        return "".join(out)

    odd = frozenset(chr(c) for c, k in enumerate(kinds) if k[0] == "M" or k in ("Nl", "No"))
    plain, exact = re.compile(r"[^\W\d_]+").findall, re.compile(f"[{ranges('L')}][{ranges('LM')}]*").findall
    return lambda text: plain(text) if odd.isdisjoint(text) else exact(text)


class Automaton:
    """Suffix automaton of a text: the set of its substrings, with transitions in one table."""

    def __init__(self, text: str):
        #: (state << 21 | character) to state.
        self.go: dict[int, int] = {}
        link, length = [-1], [0]
        out: list[list[int]] = [[]]
        last = 0
        go = self.go
        for c in map(ord, text):
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            out.append([])
            p = last
            while p >= 0 and (p << _SHIFT | c) not in go:
                go[p << _SHIFT | c] = new
                out[p].append(c)
                p = link[p]
            if p >= 0:
                q = go[p << _SHIFT | c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    out.append(list(out[q]))
                    for x in out[q]:
                        go[copy << _SHIFT | x] = go[q << _SHIFT | x]
                    while p >= 0 and go.get(p << _SHIFT | c) == q:
                        go[p << _SHIFT | c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new


def phrase_count(automaton: Automaton, word: str) -> int:
    """Phrases of the greedy parse of ``word`` between word ends, which the sample holds as spaces.

    Each is the longest match from where the last one ended; an unknown character is one alone.
    """
    go, state, n, at = automaton.go, 0, 0, 0
    marked = [32, *map(ord, word), 32]
    while at < len(marked):
        step = go.get(state << _SHIFT | marked[at])
        if step is not None:
            state = step
            at += 1
        elif state:
            n += 1
            state = 0
        else:
            n += 1
            at += 1
    return n + bool(state)


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """``lang`` and ``text`` of at most ``rows`` labelled rows a language, chosen by a hash of the id.

    A language may hold most rows: its candidates are ranked in parts first.
    """
    ids = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ids = ids.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct()
    ids = ids.withColumn("part", F.pmod(F.col("h"), F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))
        ids = ids.withColumn("rank", rank).filter(F.col("rank") <= rows).drop("rank")
    chosen = ids.select(F.col("doc_id").alias("chosen"), F.col("lang").alias("of"))
    found = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), (F.col("doc_id") == F.col("chosen")) & (F.col("lang") == F.col("of")))
    return found.select("lang", "doc_id", F.lower("text").alias("text"))


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """For each language the distinct words of its sample, in order of a hash, up to ``chars`` characters."""
    words = sample(labelled, rows).select("lang", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\p{L}[\p{L}\p{M}]*)"), 1))).alias("word")).distinct()
    words = words.withColumn("h", F.xxhash64("word"))
    before = F.sum(F.length("word") + 1).over(Window.partitionBy("lang").orderBy("h", "word"))
    words = words.withColumn("before", before).filter(F.col("before") <= chars)
    out: dict[str, list] = {}
    for r in words.select("lang", "h", "word").collect():
        out.setdefault(r["lang"], []).append((r["h"], r["word"]))
    return {lang: " " + " ".join(w for _, w in sorted(ws)) + " " for lang, ws in sorted(out.items())}


class _Phrases(dict):
    """Phrases of words in all languages, as one number with ``_FIELD`` bits a language.

    So those of a text are one sum over its words.
    """

    def __init__(self, texts: dict[str, str]):
        super().__init__()
        self.automata = [Automaton(t) for t in texts.values()]

    def __missing__(self, word: str) -> int:
        n = sum(phrase_count(a, word) << _FIELD * i for i, a in enumerate(self.automata))
        if len(self) < REMEMBERED:
            self[word] = n
        return n


class _Parser:
    """Predictions of texts inside a worker."""

    def __init__(self, key: str, texts: dict[str, str]):
        self.phrases = in_worker(("languages", key), lambda: _Phrases(texts))
        self.langs = list(texts)

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, int, int]]:
        """Language, score, phrases and letters of each text."""
        known, langs, find = self.phrases, self.langs, _words()
        out = []
        for text in texts:
            words = find((text or "").lower())
            letters = sum(map(len, words))
            if not words or not langs:
                out.append((UNDECIDED, 0.0, 0, letters))
                continue
            packed = sum(map(known.__getitem__, words))
            total = [packed >> _FIELD * i & (1 << _FIELD) - 1 for i in range(len(langs))]
            order = sorted(range(len(langs)), key=total.__getitem__)
            best = order[0]
            out.append((langs[best], 1.0 if len(langs) == 1 else 1 - total[best] / total[order[1]], total[best], letters))
        return out


def _shared(docs: DataFrame, texts: dict[str, str]):
    key = hashlib.sha256(repr(sorted(texts.items())).encode()).hexdigest()
    return key, docs.sparkSession.sparkContext.broadcast(texts)


def predict(docs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """doc_id, lang_pred, score, phrases and letters of every row of ``docs``.

    score is 1 - (phrases of the best language / phrases of the next one); with one language 1.
    """
    key, shared = _shared(docs, texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = _Parser(key, shared.value)
        for batch in chunks(batches, 4 << 20):
            lang, score, phrases, letters = zip(*parse(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(phrases, pa.int64()), pa.array(letters, pa.int64())],
                ["doc_id", "lang_pred", "score", "phrases", "letters"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, phrases long, letters long")


def in_some_language(docs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """The rows whose language is not ``und``, all columns, with the language found as ``lang``."""
    key, shared = _shared(docs, texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = _Parser(key, shared.value)
        for batch in chunks(batches, 4 << 20):
            lang = [x[0] for x in parse(batch.column("text").to_pylist())]
            batch = batch.set_column(batch.schema.get_field_index("lang"), "lang", pa.array(lang, pa.string()).cast(batch.schema.field("lang").type))
            yield batch.filter(pa.array([x != UNDECIDED for x in lang]))

    return map_rows(docs, run)
