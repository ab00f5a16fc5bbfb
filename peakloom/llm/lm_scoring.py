"""Language-model scores from a log-frequency Bloom filter.

The filter holds, for every unigram and bigram of the training texts, its count quantised on a log
scale: an n-gram of level q (count from BASE**q up to BASE**(q + 1)) is entered q + 1 times, as (n-gram, 1) to
(n-gram, q + 1), so that one that occurs once is told from one that never does.  A worker finds the number of
entries by probing (n-gram, 1), (n-gram, 2) and so on until one is missing.  The filter has ``ENTRY_BITS``
bits at least for each entry, counted before it is filled, so its error does not grow with the corpus: at
most 0.4 of the bits are set, and a missing entry is found with a chance of at most 0.4**4.  It is cut into
blocks by hash, filled by the tasks that have the blocks' n-grams.  A filter of up to ``SHARED_BITS`` is
broadcast; a larger one stays a table, and the different n-grams of each portion of text are joined with
its blocks.

Probabilities are those of bigrams smoothed by unigrams,

    p(w | v) = (n(v, w) + WEIGHT * p(w)) / (N(v) + WEIGHT),  p(w) = (n(w) + 1) / (S + V + 1)

with n the lowest count of a level, N its highest (both 0 for what is not entered), V the distinct tokens and S the sum of their n, so they
sum to at most one.  Beside them stands the base: exact unigram counts with one added, from a join.  The ``HEAD`` most frequent words travel to the
workers with their counts; the others, whose counts are small, go through the join.

Words are lower-cased (A-Z) runs outside space and x09-x0D, and each text ends with one end token.  Null
texts are empty: the end alone.  Without training rows every count is 0.  Rows that repeat a doc_id are
one document with the greatest text, rows without doc_id are left out (see ``one_per_id``).  Other
columns are not looked at.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage, one_per_id
from .words import chunks, mix, text_buffers, words_of

#: Bits for each entry at least; the filter has the next power of two.
ENTRY_BITS = 8
#: Bits of the largest filter that is broadcast (128 MB).
SHARED_BITS = 1 << 30
#: Blocks that are joined as one, and tokens whose n-grams are asked together.
CELL_BLOCKS = 128
PORTION = 1 << 18
#: Groups by which n-grams meet to be counted.
MEETINGS = 4096
BLOCK_BITS = 1 << 16  # fixed: places in a block have 16 bits
BASE = 2.0
WEIGHT = 2000.0
HEAD = 1 << 17
#: Longer words are never in the head, which bounds it in bytes.
HEAD_CHARS = 64
#: Tokens whose n-grams a task counts together before they are dealt out.
FLUSH = 4_000_000
END = "\n"
_PROBES = 4
_TOP_LEVEL = 50
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_END = np.uint64(0x2545F4914F6CDD1D)
_BEGIN = np.uint64(0x27D4EB2F165667C5)


def _token_hashes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, the end of each included, and the first token of each text."""
    words = words_of(batch, lower=True, column=column)
    n = np.diff(words.bounds)
    first = np.cumsum(n + 1) - (n + 1)
    out = np.full(int(n.sum() + len(n)), _END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[first + n] = False
    out[inside] = words.hashes()
    return out, first


def _unigrams(tokens: np.ndarray) -> np.ndarray:
    """Numbers of unigrams, in one space with those of bigrams."""
    return mix(tokens ^ np.uint64(0xA0761D6478BD642F))


def _bigrams(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of the bigram that ends with each token; the first of a text has the begin before it."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first] = _BEGIN
    return mix(before * np.uint64(0xE7037ED1A0B428DB) + tokens)


def _block(gram: np.ndarray, blocks: int) -> np.ndarray:
    return (gram >> np.uint64(33)) & np.uint64(blocks - 1)


def _spread(gram: np.ndarray, level: int | np.ndarray) -> np.ndarray:
    """A number whose four parts of 16 bits are the places of (gram, level) in its block."""
    return mix(gram + np.asarray(level).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def entries(held: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Entries of each n-gram by repeated probes of the filter, given as 64-bit words; 0 for what is missing."""
    out = np.zeros(len(gram), np.int64)
    left, here = np.arange(len(gram)), gram
    base = (_block(gram, len(held) * 64 // BLOCK_BITS) * np.uint64(BLOCK_BITS // 64)).view(np.int64)
    for level in range(1, _TOP_LEVEL + 1):
        spread = _spread(here, level)
        found = np.ones(len(here), np.uint64)
        for i in range(_PROBES):
            at = (spread >> np.uint64(16 * i)) & np.uint64(0xFFFF)
            found &= held[base + (at >> np.uint64(6)).view(np.int64)] >> (at & np.uint64(63))
        # What is left is picked once a level: most pass all probes or none.
        ok = np.flatnonzero(found)
        if len(ok) < len(left):
            left, here, base = left[ok], here[ok], base[ok]
        if not len(left):
            break
        out[left] = level
    return out


def levels(held: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Level of each n-gram; 0 for counts of one and for what is missing."""
    return np.maximum(entries(held, gram) - 1, 0)


def count_grams(train: DataFrame, counts: DataFrame) -> DataFrame:
    """``gram`` and ``n``, written: the entered unigrams and bigrams of the texts of ``train``, given the ``counts`` of their tokens.

    Tasks count bigrams in flushes, and the counts meet by hash.
    """
    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, column="token"):
            tokens, first = _token_hashes(batch, "token")
            # A token as a text is that token and an end; the end itself is the end alone.
            gram = _unigrams(tokens[first])
            yield pa.RecordBatch.from_arrays([pa.array(_block(gram, MEETINGS).astype(np.int32)), pa.array(gram.view(np.int64)), batch.column("c")], ["meeting", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            gram, n = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(gram), 100_000):
                g = gram[a : a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(_block(g, MEETINGS).astype(np.int32)), pa.array(g.view(np.int64)), pa.array(n[a : a + 100_000])], ["meeting", "gram", "n"])

        for batch in chunks(batches):
            tokens, first = _token_hashes(batch)
            held.append(_bigrams(tokens, first))
            total += len(tokens)
            if total >= FLUSH:
                yield from flush()
                held, total = [], 0
        if held:
            yield from flush()

    counted = train.select(F.col("text").cast("string")).mapInArrow(count, "meeting int, gram long, n long")
    counted = counted.unionByName(counts.mapInArrow(known, "meeting int, gram long, n long"))
    return cut_lineage(counted.repartition("meeting").groupBy("meeting", "gram").agg(F.sum("n").alias("n")).select("gram", "n"))


def _level(n: Column) -> Column:
    return F.floor(F.log(n) / F.lit(math.log(BASE)) + 1e-9)


def needed_bits(grams: DataFrame) -> int:
    """Bits of a filter for all entries of ``grams``: the next power of two, one block at least."""
    needed = grams.agg(F.sum(_level(F.col("n")) + 1).alias("n")).first()["n"] or 0
    return max(BLOCK_BITS, 1 << math.ceil(math.log2(max(1, needed * ENTRY_BITS))))


def fill_blocks(grams: DataFrame, bits: int) -> DataFrame:
    """``block`` and ``bytes`` of a filter of ``bits`` bits; rows of one block from several tasks are to be joined by OR."""
    blocks = bits // BLOCK_BITS

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            gram = batch.column("gram").to_numpy().view(np.uint64)
            block = _block(gram, blocks).astype(np.int64)
            times = np.floor(np.log(batch.column("n").to_numpy()) / math.log(BASE) + 1e-9).astype(np.int64) + 1
            which = np.repeat(np.arange(len(gram)), times)
            step = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + 1
            for b in np.unique(block).tolist():
                if b not in parts:
                    parts[b] = np.zeros(BLOCK_BITS // 8, np.uint8)
            owner = block[which]
            order = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[order], prepend=-1))
            spread = _spread(gram[which], step)[order]
            for i in range(_PROBES):
                inside = ((spread >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64)
                for a, z in zip(cuts, np.r_[cuts[1:], len(order)]):
                    x = inside[a:z]
                    np.bitwise_or.at(parts[int(owner[order[a]])], x >> 3, (1 << (x & 7)).astype(np.uint8))
        names = list(parts)
        for a in range(0, len(names), 1024):
            some = names[a : a + 1024]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[b].tobytes() for b in some], pa.binary())], ["block", "bytes"])

    return grams.mapInArrow(fill, "block int, bytes binary")


def gathered_filter(grams: DataFrame, bits: int) -> np.ndarray:
    """The filter of ``bits`` bits (a power of two) as 64-bit words, at the driver."""
    out = np.zeros(bits // 64, "<u8")
    size = BLOCK_BITS // 64
    filled = fill_blocks(grams, bits).toArrow()
    for block, held in zip(filled.column("block").to_pylist(), filled.column("bytes")):
        out[block * size : (block + 1) * size] |= np.frombuffer(held.as_buffer(), "<u8")
    return out


def build_filter(train: DataFrame, counts: DataFrame, bits: int | None = None) -> np.ndarray:
    """The filter as 64-bit words, from the texts of ``train`` and the ``counts`` of their tokens; of ``bits`` bits if given."""
    grams = count_grams(train, counts)
    return gathered_filter(grams, bits or needed_bits(grams))


def frequent(counts: DataFrame, head: int = HEAD) -> pa.Table:
    """Tokens and counts of all tokens from some count on: at most ``head``, found by a histogram of levels."""
    short = counts.filter(F.length("token") <= HEAD_CHARS)
    level = F.floor(F.log("c") / F.lit(math.log(1.02))).alias("level")
    left, least = head, None
    for r in sorted(short.groupBy(level).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect(), key=lambda r: -r["level"]):
        left -= r["n"]
        if left < 0:
            break
        least = r["c"]
    return short.filter(F.col("c") >= F.lit(least)).toArrow() if least else short.limit(0).toArrow()


def _tokens(text: bytes) -> list[bytes]:
    found = text.translate(_LOWER).split()
    found.append(END.encode())
    return found


def count_words(train: DataFrame) -> DataFrame:
    """``token`` and ``c`` of every token of the training texts, ends included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            items = list(counts.items())
            for a in range(0, len(items), 100_000):
                part = items[a : a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in part], pa.binary()).cast(pa.string()), pa.array([c for _, c in part], pa.int64())], ["token", "c"])

        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                counts.update(_tokens(text))
            if len(counts) > HEAD:
                yield from out()
                counts.clear()
        yield from out()

    return train.select(F.col("text").cast("binary")).mapInArrow(run, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def base_sums(docs: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """doc_id, known and logs: of its tokens, how many are counted, and the sum of log10(c + 1)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent(counts, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(zip(shared.value.column("token").cast(pa.binary()).to_pylist(), (math.log10(c + 1) for c in shared.value.column("c").to_pylist())))
        for batch in chunks(batches):
            which, token, times, logs, hits = [], [], [], [], []
            ids = batch.column("doc_id").to_pylist()
            for d, text in enumerate(batch.column("text").to_pylist()):
                at, log, hit = len(which), 0.0, 0
                for t, n in Counter(_tokens(text)).items():
                    each = known.get(t)
                    if each is None:
                        which.append(d)
                        token.append(t)
                        times.append(n)
                    else:
                        log += n * each
                        hit += n
                if len(which) == at:
                    # No rare token carries the sums; tokens hold no space, so this key meets none and is no one's hot key.
                    which.append(d)
                    token.append(b" %d" % (ids[d] or 0))
                    times.append(0)
                rest = len(which) - at - 1
                logs += [log] + [0.0] * rest
                hits += [hit] + [0] * rest
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(which, pa.int64())), pa.array(token, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()), pa.array(logs, pa.float64()), pa.array(hits, pa.int64())],
                ["doc_id", "token", "n", "logs", "known"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, token string, n long, logs double, known long")
    rare = rows.join(counts, "token", "left")
    return rare.groupBy("doc_id").agg(
        F.sum(F.col("known") + F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("logs") + F.when(F.col("c").isNotNull(), F.col("n") * F.log10(F.col("c") + 1)).otherwise(0.0)).alias("logs"))


def _text_scores(one: np.ndarray, two: np.ndarray, first: np.ndarray, total: float, distinct: int, texts: int, weight: float) -> np.ndarray:
    """log10 of the probability of each text, from the entries of its tokens' unigrams and bigrams."""
    low = np.r_[0.0, np.ceil(BASE ** np.arange(0, _TOP_LEVEL))]
    high = np.r_[0.0, np.ceil(BASE ** np.arange(1, _TOP_LEVEL + 1)) - 1]
    # What the word before was seen at most; never less than the bigram.
    most = np.empty(len(one))
    most[1:] = high[one[:-1]]
    most[first] = texts
    alone = (low[one] + 1) / (total + distinct + 1)
    p = (low[two] + weight * alone) / (np.maximum(most, low[two]) + weight)
    return np.add.reduceat(np.log10(p), first)


_SCORES = "doc_id long, n_tokens long, score double"


def model_scores(docs: DataFrame, filter_words: np.ndarray, total: float, distinct: int, texts: int, weight: float = WEIGHT) -> DataFrame:
    """doc_id, n_tokens and score: log10 of the model's probability of each text.

    ``total`` is the sum of the unigrams' quantised counts, ``distinct`` their number, ``texts`` that of the
    training texts, as often as the begin of a text was seen.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filter_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in chunks(batches):
            tokens, first = _token_hashes(batch)
            different, where = np.unique(_unigrams(tokens), return_inverse=True)
            one = entries(held, different)[where]
            two = entries(held, _bigrams(tokens, first))
            n = np.diff(np.r_[first, len(tokens)])
            found = _text_scores(one, two, first, total, distinct, texts, weight)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(found, pa.float64())], ["doc_id", "n_tokens", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, _SCORES)


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Rows ``values[cuts[i]:cuts[i + 1]]`` as bytes."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def joined_scores(docs: DataFrame, filled: DataFrame, bits: int, total: float, distinct: int, texts: int, weight: float = WEIGHT) -> DataFrame:
    """The same by a join with the blocks of the filter, of which a task holds ``CELL_BLOCKS`` at a time.

    The different n-grams of a portion of text travel by cell, and the numbers of their entries come back to the portion.
    """
    blocks = bits // BLOCK_BITS
    wide = min(CELL_BLOCKS, blocks)
    names = ["part", "cell", "grams", "ids", "sizes", "places"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def portion() -> pa.RecordBatch:
            ids = np.concatenate([i for i, _, _ in held])
            sizes = np.concatenate([np.diff(np.r_[f, len(t)]) for _, t, f in held])
            grams = np.concatenate([_unigrams(t) for _, t, _ in held] + [_bigrams(t, f) for _, t, f in held])
            gram, place = np.unique(grams, return_inverse=True)
            cell = (_block(gram, blocks) // np.uint64(wide)).astype(np.int32)
            order = np.argsort(cell, kind="stable")
            back = np.empty(len(order), np.int32)
            back[order] = np.arange(len(order), dtype=np.int32)
            cells, heads = np.unique(cell[order], return_index=True)
            n = len(cells)
            nulls = [None] * n
            # Written before it is read, so a portion keeps its number.
            part = uuid.uuid4().int >> 65
            asked = _binaries(gram[order], np.r_[heads, len(order)])
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * (n + 1), pa.int64()), pa.array([-1, *cells.tolist()], pa.int32()), pa.concat_arrays([pa.nulls(1, pa.binary()), asked])]
                + [pa.array([x.tobytes(), *nulls], pa.binary()) for x in (ids, sizes.astype(np.int64), back[place])], names)

        for batch in chunks(batches):
            tokens, first = _token_hashes(batch)
            held.append((batch.column("doc_id").to_numpy(), tokens, first))
            total += len(tokens)
            if total >= PORTION:
                yield portion()
                held, total = [], 0
        if held:
            yield portion()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = -1, np.zeros(0, np.uint64)
        size = BLOCK_BITS // 64
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            edges = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
            for a, z in zip(edges[:-1], edges[1:]):
                rows = batch.slice(a, z - a)
                if cell[a] != at:
                    at, held = cell[a], np.zeros(wide * size, np.uint64)
                # The blocks come first, as their part is null.
                own = rows.column("part").null_count
                for block, filled in zip(rows.column("block")[:own].to_pylist(), rows.column("grams")[:own]):
                    block %= wide
                    held[block * size : (block + 1) * size] |= np.frombuffer(filled.as_buffer(), "<u8")
                rows = rows.slice(own)
                if rows.num_rows:
                    data, offsets = text_buffers(rows.column("grams"))
                    found = entries(held, np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), "<u8")).astype(np.uint8)
                    yield pa.RecordBatch.from_arrays([rows.column("part"), rows.column("cell"), _binaries(found, (offsets - offsets[0]) // 8)], ["part", "cell", "found"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, found = None, []

        def done() -> pa.RecordBatch:
            ids, sizes, places = (np.frombuffer(asked[c], t) for c, t in (("ids", np.int64), ("sizes", np.int64), ("places", np.int32)))
            times = np.frombuffer(b"".join(found), np.uint8)[places]
            scores = _text_scores(times[: len(times) // 2], times[len(times) // 2 :], np.cumsum(sizes) - sizes, total, distinct, texts, weight)
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sizes), pa.array(scores, pa.float64())], ["doc_id", "n_tokens", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("cell")[i].as_py() < 0:
                    if asked:
                        yield done()
                    asked, found = {c: batch.column(c)[i].as_py() for c in ("ids", "sizes", "places")}, []
                else:
                    found.append(batch.column("found")[i].as_py())
        if asked:
            yield done()

    asked = cut_lineage(docs.select("doc_id", "text").mapInArrow(ask, "part long, cell int, grams binary, ids binary, sizes binary, places binary"))
    none = F.lit(None)
    own = filled.select(none.cast("long").alias("part"), F.floor(F.col("block") / wide).cast("int").alias("cell"), "block", F.col("bytes").alias("grams"))
    rows = own.unionByName(asked.filter("cell >= 0").select("part", "cell", none.cast("int").alias("block"), "grams"))
    answers = rows.repartition("cell").sortWithinPartitions("cell", "part").mapInArrow(answer, "part long, cell int, found binary")
    answers = answers.select("*", *(none.cast("binary").alias(c) for c in names[3:]))
    back = answers.unionByName(asked.filter("cell < 0").select("part", "cell", none.cast("binary").alias("found"), *names[3:]))
    return back.repartition("part").sortWithinPartitions("part", "cell").mapInArrow(settle, _SCORES)


def score(docs: DataFrame, held_out: Column, bits: int | None = None, head: int = HEAD, weight: float = WEIGHT) -> DataFrame:
    """Scores of all documents by a model of those that are not ``held_out``.

    The filter has ``bits`` bits, or as many as its entries need.  Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    """
    docs = one_per_id(docs).select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    train = docs.filter(~held_out)
    counts = cut_lineage(count_words(train))
    rounded = F.ceil(F.pow(F.lit(BASE), _level(F.col("c"))))
    texts = F.max(F.when(F.col("token") == END, F.col("c")))
    sizes = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(rounded).alias("s"), texts.alias("texts")).first()
    total, distinct = sizes["n"] or 0, sizes["v"]
    grams = count_grams(train, counts)
    bits = bits or needed_bits(grams)
    known = float(sizes["s"] or 0), distinct, sizes["texts"] or 0, weight
    scored = model_scores(docs, gathered_filter(grams, bits), *known) if bits <= SHARED_BITS else joined_scores(docs, fill_blocks(grams, bits), bits, *known)
    rows = scored.join(base_sums(docs, counts, head), "doc_id")
    base = F.col("logs") - F.col("n_tokens") * F.lit(math.log10(total + distinct + 1))
    return rows.select("doc_id", held_out.alias("held_out"), "n_tokens", F.col("known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
