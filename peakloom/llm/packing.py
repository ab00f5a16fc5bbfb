"""Sequences for training by power-of-two pieces.

Each document is cut into pieces whose lengths are powers of two: as many of the longest length as
fit, then the binary digits of the rest, from large to small.  A piece is a sequence of its own, so no
sequence crosses documents and none needs padding; pieces of one length form a bucket, from which
batches of equal length are drawn.

A null text is empty; an empty text is the end id alone.  Repeated rows are packed each on its own,
null ids stay null.  Other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_worker, trim_worker
from .words import chunks

#: Words kept with their ids in a worker (about 200 bytes each); later ones are encoded once a batch.
REMEMBERED = 400_000
#: A point or comma after an ASCII letter or digit, at the end of a word: a word of its own to the vocabulary.
_STOPPED = re.compile(rb"[0-9a-z][.,]\Z")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class _Known(dict):
    """Ids of words; those asked for in vain are noted in ``new`` and give None."""

    new: dict[bytes, None]

    def __missing__(self, word: bytes) -> None:
        self.new[word] = None


def _tokenizer(path: str):
    """The tokenizer, the words known so far, which ids end a word, and the added tokens in lower case."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    ends[[i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
    added = [t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, _Known(), ends, added


def _encode_words(tokenizer, ends: np.ndarray, words: list[bytes]) -> dict[bytes, bytes]:
    """Ids of words.  A word of letters is one run to the vocabulary and has one token that ends it, so
    many are encoded as one text and told apart by these; other words are encoded one by one."""
    out: dict[bytes, bytes] = {}
    letters, others = [], []
    for w in words:
        (letters if w.decode("utf-8").isalpha() else others).append(w)
    for at in range(0, len(letters), 256):
        part = letters[at : at + 256]
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(part).decode("utf-8")], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ends[ids]) + 1
        if len(cuts) != len(part):
            others += part
            continue
        held, cuts = ids.tobytes(), (cuts * 4).tolist()
        out.update(zip(part, [held[a:z] for a, z in zip([0, *cuts], cuts)]))
    for at in range(0, len(others), 4096):
        part = others[at : at + 4096]
        for w, e in zip(part, tokenizer.encode_batch_fast([w.decode("utf-8") for w in part], add_special_tokens=False)):
            out[w] = np.array(e.ids, "<u4").tobytes()
    return out


def encode(path: str, texts: list[bytes]) -> list[bytes]:
    """Ids of each text as little-endian 32-bit numbers.

    The vocabulary drops white space and letter case and no token reaches over white space, so words
    are encoded once and their ids strung together.  Added tokens are looked for before letter case is
    dropped: a text with one in any case is cut as it is.
    """
    tokenizer, known, ends, added = in_worker(("ids", path), lambda: _tokenizer(path))
    known.new = {}
    lower = [t.lower() for t in texts]
    words = [(t if any(a in low for a in added) else low).split() for t, low in zip(texts, lower)]
    found = [list(map(known.__getitem__, ws)) for ws in words]
    new = known.new
    stems = {w[:-1] if _STOPPED.search(w, len(w) - 2) else w for w in new} | {b".", b","}
    fresh = {w: known[w] for w in stems if w in known}
    fresh |= _encode_words(tokenizer, ends, [w for w in stems if w not in fresh])
    for w in new:
        if w not in fresh:
            fresh[w] = fresh[w[:-1]] + fresh[w[-1:]]
    out = [b"".join([fresh[w] if i is None else i for i, w in zip(ids, ws)]) if None in ids else b"".join(ids) for ids, ws in zip(found, words)]
    if len(known) < REMEMBERED:
        known.update(fresh)
    return out


def piece_lengths(n: int, longest: int) -> list[int]:
    """Powers of two up to ``longest`` that sum to ``n``, from large to small."""
    out = [longest] * (n // longest)
    rest = n % longest
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, longest: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket.

    ``with_ids`` adds the ids themselves, for writing.  ``longest`` is a power of two.  A piece's
    sequence_id is its own and its offset 0; bucket is its length.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest is not a power of two")
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            which, start, length, crc, total, ids = [], [], [], [], [], []
            for d, packed in enumerate(encode(path, batch.column("text").to_pylist())):
                packed += last
                at, n = 0, len(packed) // 4
                for size in piece_lengths(n, longest):
                    part = packed[at * 4 : (at + size) * 4]
                    which.append(d)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                    at += size
            columns = [batch.column("doc_id").take(pa.array(which, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        trim_worker()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    pieces = rows.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))
    # Ids by scan partition and row: unique without an exchange, the same when a task runs again.
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.col("length")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write pieces with their ids, a folder for each length."""
    pieces.write.partitionBy("bucket").parquet(path)
