"""Repeated passages across documents, from a de Bruijn graph of token k-mers.

Edges are the k-mers (windows of ``size`` consecutive words) of all texts; an edge that occurs again
is a repeated one, and its place in the graph is its earliest source coordinate (document, word).

1. *Edges.*  A task keeps the first occurrence of each window it sees; later ones are settled there.
   A window travels with the others of its minimiser (the smallest of its short word runs), so a
   run of windows is one row, and equal windows always meet: same words, same minimiser.
2. *Meeting.*  Rows are dealt out and sorted by minimiser; equal windows get their earliest source.
   A window that any number of documents share sends one row a task at most.
3. *Compaction.*  Edges that follow one another both in their document and in their source are a
   nonbranching path; paths are joined through window functions into spans.
4. *Verification.*  Spans and the source spans they name are joined to the texts, and digests of the
   words on both sides are compared.  Windows were matched by 48 bits beside a 64-bit minimiser; if
   ever a span is not word for word its source, the whole is done again with another seed.

Words are runs of bytes other than space and x09-x0D, taken unchanged.  Null texts have no words; a text
shorter than a window has none.  Rows that repeat a doc_id are one document with the greatest text, rows
without doc_id are left out (see ``one_per_id``).  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T, Window

from .common import cut_lineage, nested, one_per_id, release_worker, trim_worker, unnested, with_fields
from .words import chunks, grams, mix, text_buffers, words_of

WINDOW = 20
#: Words of the short runs among which a window's minimiser is chosen.
SHORT = 5
#: Bytes of text whose windows a task settles together.
FLUSH = 4 << 20
#: Source spans asked of one row of a text; more are spread over several.
ASKED = 4096
_BYTES = 6

EDGES = "key long, doc_id long, start int, windows binary, source struct<doc_id:long,start:int,words:int>"
SPANS = "doc_id long, start int, words int, src_id long, src_start int"


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows in portions of about ``size`` bytes of text, each in order of doc_id."""
    held, total = [], 0

    def portion() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
        return table.take(pa.array(order)).combine_chunks().to_batches()[0]

    for batch in chunks(batches):
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield portion()
            held, total = [], 0
    if held:
        yield portion()


def _spans(doc: np.ndarray, start: np.ndarray, src: np.ndarray, src_start: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Windows in order of place, joined where both sides go on by one word."""
    if not len(doc):
        return {"doc_id": doc, "start": start, "words": start, "src_id": src, "src_start": src_start}
    new = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1) | (src[1:] != src[:-1]) | (src_start[1:] != src_start[:-1] + 1)
    heads = np.flatnonzero(np.r_[True, new])
    words = np.diff(np.r_[heads, len(doc)]) + size - 1
    return {"doc_id": doc[heads], "start": start[heads], "words": words, "src_id": src[heads], "src_start": src_start[heads]}


def _edge_rows(batch: pa.RecordBatch, size: int, short: int, seed: int) -> pa.RecordBatch:
    """First occurrences of the windows of some documents by minimiser, and spans already settled."""
    hashes, bounds = [], [np.zeros(1, np.int64)]
    for part in chunks([batch]):
        words = words_of(part)
        hashes.append(words.hashes())
        bounds.append(words.bounds[1:] + bounds[-1][-1])
    ids = batch.column("doc_id").to_numpy()
    bounds, hashes = np.concatenate(bounds), np.concatenate(hashes)
    if seed:
        hashes = mix(hashes + np.uint64(seed))
    first, window = grams(hashes, bounds, size)
    at, small = grams(hashes, bounds, short)
    every = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    every[at] = small
    wide = size - short + 1
    if len(first):
        chosen = np.lib.stride_tricks.sliding_window_view(every, wide).argmin(1)[first] + first
    else:
        chosen = first
    doc = np.searchsorted(bounds, first, "right") - 1
    place = first - bounds[doc]

    order = np.argsort(window, kind="stable")
    ordered = window[order]
    head = np.ones(len(order), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    source = np.empty(len(order), np.int64)
    source[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    again = np.flatnonzero(source != np.arange(len(order)))
    found = source[again]
    settled = _spans(ids[doc[again]], place[again], ids[doc[found]], place[found], size)

    once = np.flatnonzero(source == np.arange(len(order)))
    new = np.ones(len(once), bool)
    new[1:] = (chosen[once[1:]] != chosen[once[:-1]]) | (first[once[1:]] != first[once[:-1]] + 1)
    heads = np.flatnonzero(new)
    runs = once[heads]
    blob = np.ascontiguousarray(window[once].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES])
    cuts = (np.r_[heads, len(once)] * _BYTES).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(runs), [None, pa.py_buffer(cuts), pa.py_buffer(blob)])

    n, m = len(runs), len(settled["doc_id"])
    edges = pa.RecordBatch.from_arrays(
        [pa.array(every[chosen[runs]].view(np.int64)), pa.array(ids[doc[runs]]), pa.array(place[runs].astype(np.int32)), blobs, pa.nulls(n, _SOURCE)],
        schema=_EDGES)
    spread = mix(settled["doc_id"].astype(np.uint64) * np.uint64(31) + settled["start"].astype(np.uint64)).view(np.int64)
    source_of = pa.StructArray.from_arrays(
        [pa.array(settled["src_id"].astype(np.int64)), pa.array(settled["src_start"].astype(np.int32)), pa.array(settled["words"].astype(np.int32))], fields=list(_SOURCE))
    done = pa.RecordBatch.from_arrays(
        [pa.array(spread), pa.array(settled["doc_id"].astype(np.int64)), pa.array(settled["start"].astype(np.int32)), pa.nulls(m, pa.binary()), source_of], schema=_EDGES)
    return pa.Table.from_batches([edges, done]).combine_chunks()


_SOURCE = pa.struct([("doc_id", pa.int64()), ("start", pa.int32()), ("words", pa.int32())])
_EDGES = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("windows", pa.binary()), ("source", _SOURCE)])
_SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("src_id", pa.int64()), ("src_start", pa.int32())])


def _met(rows: pa.Table, size: int) -> pa.RecordBatch:
    """Spans of windows that start earlier elsewhere, among rows of whole minimisers in order."""
    key = rows.column("key").to_numpy()
    alone = np.ones(len(key), bool)
    same = key[1:] == key[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    rows = rows.filter(pa.array(~alone)).combine_chunks()
    key, doc, start = (rows.column(c).to_numpy() for c in ("key", "doc_id", "start"))
    lengths = np.zeros(0, np.int64)
    data = np.zeros(0, np.uint8)
    if len(key):
        data, offsets = text_buffers(rows.column("windows").chunk(0))
        data, lengths = data[offsets[0] : offsets[-1]], np.diff(offsets) // _BYTES
    wide = np.zeros((len(data) // _BYTES, 8), np.uint8)
    wide[:, :_BYTES] = data.reshape(-1, _BYTES)
    window = wide.view("<u8").ravel()
    row = np.repeat(np.arange(len(key)), lengths)
    place = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    group = np.cumsum(np.r_[True, key[1:] != key[:-1]])[row] if len(key) else row
    order = np.lexsort((place, doc[row], window, group))
    head = np.ones(len(order), bool)
    head[1:] = (window[order[1:]] != window[order[:-1]]) | (group[order[1:]] != group[order[:-1]])
    source = np.empty(len(order), np.int64)
    source[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    again = np.flatnonzero(source != np.arange(len(order)))
    found = source[again]
    spans = _spans(doc[row[again]], place[again], doc[row[found]], place[found], size)
    return pa.RecordBatch.from_arrays([pa.array(spans[f.name]).cast(f.type) for f in _SPANS], schema=_SPANS)


def _meet(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Spans, from rows in order of key."""
    held: list[pa.RecordBatch] = []

    def edges_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(batch.column("windows").is_valid())

    for batch in batches:
        done = batch.filter(batch.column("source").is_valid())
        if done.num_rows:
            s = done.column("source")
            yield pa.RecordBatch.from_arrays([done.column("doc_id"), done.column("start"), s.field("words"), s.field("doc_id"), s.field("start")], schema=_SPANS)
        batch = edges_of(batch)
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        if last or (held and held[-1].column("key")[-1].as_py() != key[0]):
            held.append(batch.slice(0, last))
            yield _met(pa.Table.from_batches(held), size)
            held = []
        held.append(batch.slice(last))
    if held:
        yield _met(pa.Table.from_batches(held), size)


def repeated_spans(docs: DataFrame, size: int = WINDOW, short: int = SHORT, seed: int = 0) -> DataFrame:
    """doc_id, start, words, src_id, src_start: spans of words that start earlier at the source.

    ``docs`` has each doc_id once.  Spans of one document may overlap where sources differ.
    """
    short = min(short, size)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in _gathered(batches, FLUSH):
            for part in _edge_rows(batch, size, short, seed).to_batches(max_chunksize=20_000):
                yield part
        trim_worker()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        yield from _meet(batches, size)
        trim_worker()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(edges, EDGES)
    pieces = rows.repartition("key").sortWithinPartitions("key").mapInArrow(meet, SPANS)
    path = pieces.withColumn("shift", F.col("src_start") - F.col("start"))
    here = Window.partitionBy("doc_id", "src_id", "shift").orderBy("start")
    reach = F.max(F.col("start") + F.col("words") - size + 1).over(here.rowsBetween(Window.unboundedPreceding, -1))
    path = path.withColumn("opens", F.when(F.col("start") <= reach, 0).otherwise(1))
    path = path.withColumn("path", F.sum("opens").over(here))
    spans = path.groupBy("doc_id", "src_id", "shift", "path").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("words")).alias("end"))
    return spans.select("doc_id", "start", (F.col("end") - F.col("start")).alias("words"), "src_id", (F.col("start") + F.col("shift")).alias("src_start"))


def _asked(spans: DataFrame) -> DataFrame:
    """For each document the spans to take out and the source spans to compare, in rows of bounded length."""
    cut = spans.select("doc_id", F.lit(0).cast("long").alias("part"), F.struct("start", "words", "src_id", "src_start", F.lit(True).alias("cut")).alias("ask"))
    source = spans.select("src_id", "src_start", "words").distinct()
    parts = source.groupBy("src_id").agg(F.ceil(F.count("*") / F.lit(ASKED)).alias("parts"))
    source = source.join(parts, "src_id").select(
        F.col("src_id").alias("doc_id"), F.pmod(F.xxhash64("src_start", "words"), F.col("parts")).alias("part"),
        F.struct(F.col("src_start").alias("start"), "words", "src_id", "src_start", F.lit(False).alias("cut")).alias("ask"))
    asked = cut.unionByName(source).groupBy("doc_id", "part").agg(F.collect_list("ask").alias("asks"))
    # Part 0 of a document holds its result, so there is one even where hashes leave it empty.
    first = parts.filter("parts > 1").select(F.col("src_id").alias("doc_id"), F.lit(0).cast("long").alias("part"), F.lit(None).cast(asked.schema["asks"].dataType).alias("asks"))
    return asked.unionByName(first.join(asked.filter("part = 0").select("doc_id"), "doc_id", "left_anti"))


_SEEN = pa.struct([("src_id", pa.int64()), ("src_start", pa.int32()), ("words", pa.int32()), ("cut", pa.bool_()), ("digest", pa.binary())])
_CUT = "doc_id long, part long, n_words long, n_removed long, kept_sha256 string, seen array<struct<src_id:long,src_start:int,words:int,cut:boolean,digest:binary>>"


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of documents from their texts and what is asked of them; with whole rows, these cut too."""
    release_worker()
    for batch in chunks(_with_text(batches)):
        words = words_of(batch)
        joined, first, last = words.joined()
        held = joined.tobytes()
        out = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "seen")}
        texts = []
        for d, asks in enumerate(batch.column("asks").to_pylist()):
            lo, hi = int(words.bounds[d]), int(words.bounds[d + 1])
            gone = np.zeros(hi - lo, bool)
            seen = []
            for a in asks or ():
                s, e = lo + a["start"], lo + a["start"] + a["words"]
                if a["cut"]:
                    gone[a["start"] : a["start"] + a["words"]] = True
                digest = hashlib.blake2b(held[first[s] : last[e - 1]], digest_size=16).digest()
                seen.append({"src_id": a["src_id"], "src_start": a["src_start"], "words": a["words"], "cut": a["cut"], "digest": digest})
            edge = np.flatnonzero(np.diff(np.r_[False, ~gone, False].astype(np.int8))) + lo
            kept = b" ".join(held[first[s] : last[e - 1]] for s, e in edge.reshape(-1, 2).tolist())
            out["n_words"].append(hi - lo)
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["seen"].append(seen)
            texts.append(kept.decode("utf-8") if gone.any() else None)
        columns = [batch.column("doc_id"), batch.column("part"), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string()), pa.array(out["seen"], pa.list_(_SEEN))]
        names = ["doc_id", "part", "n_words", "n_removed", "kept_sha256", "seen"]
        if "row" in batch.schema.names:
            cut = pa.array(texts, pa.string())
            whole = batch.column("row")
            new = {"text": pc.coalesce(cut, batch.column("text"))}
            if "n_chars" in [f.name for f in whole.type]:
                at = [f.name for f in whole.type].index("n_chars")
                new["n_chars"] = pc.coalesce(pc.utf8_length(cut).cast(whole.type.field(at).type), whole.field(at))
            # Only part 0 carries the row on.
            first_part = pc.equal(batch.column("part"), 0)
            columns.append(pc.if_else(first_part, with_fields(whole, **new), pa.nulls(batch.num_rows, whole.type)))
            names.append("row")
        yield pa.RecordBatch.from_arrays(columns, names)
    trim_worker()


def _with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with a column ``text``, from that of whole rows if they come with these."""
    for batch in batches:
        if "row" in batch.schema.names:
            row = batch.column("row")
            text = row.field([f.name for f in row.type].index("text"))
            batch = pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "text"])
        yield batch


def _settled(docs: DataFrame, size: int, short: int) -> DataFrame:
    """Written results of documents (doc_id, text and perhaps row), verified."""
    rowed = "row" in docs.columns
    seed = 0
    while True:
        spans = cut_lineage(repeated_spans(docs, size, short, seed))
        rows = docs.join(_asked(spans), "doc_id", "left").select("doc_id", F.coalesce("part", F.lit(0)).alias("part"), "row" if rowed else "text", "asks")
        fields = T.StructType.fromDDL(_CUT)
        if rowed:
            fields = fields.add("row", docs.schema["row"].dataType)
        done = cut_lineage(rows.mapInArrow(_cut_rows, fields))
        seen = done.select(F.explode("seen").alias("s")).select("s.*")
        digests = seen.filter("cut").select("src_id", "src_start", "words", "digest").distinct()
        source = seen.filter("not cut").select("src_id", "src_start", "words", F.col("digest").alias("there"))
        if digests.join(source, ["src_id", "src_start", "words"]).filter("digest <> there").limit(1).isEmpty():
            # A source of many spans has further rows, which hold digests only.
            return done.filter("part = 0")
        seed += 1


def remove_repeats(docs: DataFrame, size: int = WINDOW, short: int = SHORT) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document.

    A word goes if a window over it starts earlier elsewhere; the digest is that of the words left, joined
    by one space.
    """
    docs = one_per_id(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _settled(docs, size, short).select("doc_id", "n_words", "n_removed", "kept_sha256")


def cut_documents(docs: DataFrame, size: int = WINDOW, short: int = SHORT) -> DataFrame:
    """The documents, all columns, without repeated words.

    A text that keeps all its words stays as it is; another one is its words left, joined by one space, and
    n_chars (if there is such a column) its length.
    """
    rows = one_per_id(nested(docs), "row").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "row")
    done = _settled(rows, size, short)
    return unnested(done, docs)
