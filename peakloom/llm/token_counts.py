"""Exact token counts at every prefix, for a sentencepiece model of byte pair encoding.

The encoding of a prefix is that of a shorter prefix and one token more.  Which token it is follows
from pairs alone: a sequence of tokens is an encoding if any two neighbours are the encoding of their
joined text.  So, going through the characters from left to right,

    last(i)  = the token t that ends at i and agrees with last(i - len(t))
    count(i) = count(i - len(t)) + 1

A piece of the vocabulary never holds a word separator after another character, nor a line end.  So
texts fall into segments (a run of separators with the characters after it, or a line end with the
characters after it) whose encodings follow each other; a segment's counts are worked out once and
shared by all its places, and the count of a prefix is the sum over whole segments plus the count at
its place in the segment it ends in.  That answers "how many tokens", "does it fit" and "where to cut"
at every character without encoding anything again.  These conditions are read from the vocabulary when
the model is loaded; a model that fails them is refused.  What has no piece is spelt in bytes, a token each.

Texts that are null are empty; an empty text has no tokens and one prefix, the empty one.  Every row
of the input gives one row, repeated rows and null ids included; other columns are not looked at.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_worker
from .words import chunks

SEPARATOR = "▁"
#: Segments kept with their counts in a worker, and pairs of tokens kept with their answer; where more
#: are met the older ones are let go and worked out again.
REMEMBERED = 400_000
_SEGMENT = re.compile(f"[ {SEPARATOR}]+[^ {SEPARATOR}\n]*|\n[^ {SEPARATOR}\n]*")


def _crosses(piece: str) -> bool:
    body = piece.lstrip(SEPARATOR)
    return SEPARATOR in body or "\n" in piece


class PrefixCounts:
    """Tokens of every prefix of a segment."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        own = [i for i in every if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in own}
        if any(map(_crosses, self.score)):
            raise ValueError("a piece of the vocabulary crosses a word separator or a line end")
        if not any(map(model.is_byte, every)) or any(map(model.is_unused, every)):
            raise ValueError("the vocabulary spells no bytes, or has unused pieces")
        #: Tokens by number; 0 stands before the first one.  Characters without a piece get numbers as they come.
        self.tokens, self.cost = ["", *self.score], [0] + [1] * len(self.score)
        #: The pieces read from their last character: a character leads to the number of the piece that
        #: begins there (0: none) and to the characters before it.
        self.endings: dict[str, list] = {}
        for number, token in enumerate(self.tokens):
            step = [0, self.endings]
            for letter in reversed(token):
                step = step[1].setdefault(letter, [0, {}])
            step[0] = number
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, array] = {}

    def _agree(self, left: int, right: int) -> bool:
        """Whether the tokens ``left, right`` are the encoding of their joined text (0: ``right`` alone)."""
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        answer = self.pairs[left << 32 | right] = self._merges_to(self.tokens[left], self.tokens[right])
        return answer

    def _merges_to(self, left: str, right: str) -> bool:
        parts, border = list(left + right), len(left)
        while True:
            # The best pair of neighbours is joined, the first one of equals.
            best, at, place = None, -1, 0
            for i in range(len(parts) - 1):
                place += len(parts[i])
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at, end = score, i, place
            if best is None:
                return parts == ([left, right] if left else [right])
            if end == border:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def of(self, segment: str) -> array:
        """Counts of the prefixes of 0, 1, ... characters."""
        counts = self.known.get(segment)
        if counts is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            counts = self._counts(segment)
            # A segment as long as many words would only fill the memory.
            if len(segment) <= 64:
                self.known[segment] = counts
        return counts

    def _counts(self, segment: str) -> array:
        segment = segment.replace(" ", SEPARATOR)
        endings, known, cost = self.endings, self.pairs.get, self.cost
        counts, last = [0], [0]
        for i, letter in enumerate(segment):
            if letter not in endings or not endings[letter][0]:
                self._spell(letter)
            before = endings
            for j in range(i, -1, -1):
                token, before = before[segment[j]]
                if token:
                    agrees = known(last[j] << 32 | token)
                    if agrees or agrees is None and self._agree(last[j], token):
                        break
            else:
                raise ValueError("no token ends here")
            counts.append(counts[j] + cost[token])
            last.append(token)
        return array("i", counts)

    def _spell(self, letter: str) -> None:
        """Give a character without a piece a number; it costs a token a byte."""
        self.endings.setdefault(letter, [0, {}])[0] = len(self.tokens)
        self.tokens.append(letter)
        self.cost.append(len(letter.encode()))


def _worker(path: str) -> PrefixCounts:
    return in_worker(("prefixes", path), lambda: PrefixCounts(path))


def segments(text: str) -> list[str]:
    """The segments of a text; the first starts with the separator that the model puts before it."""
    return _SEGMENT.findall(" " + text) if text else []


class Table:
    """Tokens of every prefix of a text: sums at the ends of segments, and the counts inside each.

    ``ends`` and ``sums`` hold characters and tokens up to each segment, from the empty prefix on.
    """

    def __init__(self, path: str, text: str | None):
        worker = _worker(path)
        self.segments = segments(text or "")
        self.inside = list(map(worker.known.get, self.segments))
        if None in self.inside:
            self.inside = [worker.of(s) if c is None else c for s, c in zip(self.segments, self.inside)]
        self.ends = np.zeros(len(self.segments) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, self.segments), np.int64, len(self.segments)), out=self.ends[1:])
        self.ends[1:] -= 1
        self.sums = np.zeros(len(self.segments) + 1, np.int64)
        np.cumsum(np.fromiter((c[-1] for c in self.inside), np.int64, len(self.inside)), out=self.sums[1:])

    @property
    def total(self) -> int:
        return int(self.sums[-1])

    def at(self, n_chars: int) -> int:
        """Tokens of the first ``n_chars`` characters."""
        if n_chars <= 0:
            return 0
        whole = int(np.searchsorted(self.ends, n_chars, "right")) - 1
        if whole == len(self.segments):
            return self.total
        # The first segment starts with a separator that is no character of the text.
        return int(self.sums[whole]) + self.inside[whole][n_chars - int(self.ends[whole]) + (whole == 0)]

    def every(self) -> np.ndarray:
        """Tokens of the prefixes of 0, 1, ... characters."""
        parts = [np.zeros(1, np.int64)]
        for k, (before, counts) in enumerate(zip(self.sums, self.inside)):
            parts.append(before + np.frombuffer(counts, np.int32)[1 + (k == 0):])
        return np.concatenate(parts)

    def fit(self, limit: int) -> tuple[int, int]:
        """Characters and tokens of the longest prefix within ``limit`` tokens.

        Counts fall where a longer token takes the place of shorter ones, so the last place counts.
        """
        whole = max(int(np.searchsorted(self.sums, limit, "left")) - 1, 0)
        if whole < len(self.segments):
            # Each prefix of a later segment has more than ``limit`` tokens.
            counts, skip = self.inside[whole], int(whole == 0)
            for i in range(len(counts) - 1, skip, -1):
                if self.sums[whole] + counts[i] <= limit:
                    return int(self.ends[whole]) + i - skip, int(self.sums[whole]) + counts[i]
        return int(self.ends[whole]), int(self.sums[whole])


def count_at(path: str, text: str, n_chars: int) -> int:
    """Tokens of ``text[:n_chars]``."""
    return Table(path, text).at(n_chars)


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``counts``: the tokens of the first 0, 1, ... characters of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1 << 20):
            counts = [Table(path, text).every() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "counts"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, counts array<bigint>")


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """Tokens of each text and what of it fits ``limit`` tokens.

    Returns doc_id, n_bytes, n_tokens, over_limit, fit_chars and fit_tokens: the longest prefix
    within the limit, in characters and tokens.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 4 << 20):
            total, chars, tokens = [], [], []
            for text in batch.column("text").to_pylist():
                table = Table(path, text)
                fit = table.fit(limit)
                total.append(table.total)
                chars.append(fit[0])
                tokens.append(fit[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(total, pa.int64()), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "fit_chars", "fit_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, fit_chars long, fit_tokens long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars", "fit_tokens")


def truncate(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """``doc_id`` and ``text`` cut to the longest prefix within ``limit`` tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            cut = [(t or "")[: Table(path, t).fit(limit)[0]] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cut, pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text string")
