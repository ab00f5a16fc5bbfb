"""Near duplicates by SimHash, found through deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits, fewer than the three that an exact match of
a segment would need for two differing bits: of two differing bits, one segment holds at most one.
Each segment is indexed under its 32 variants with one bit wiped, so fingerprints that differ by at
most two bits share a variant.  An equality join on the variants and a bit count find the links.

Equal fingerprints are one class before the join.  A variant shared by more than ``crowd`` classes is
not joined with itself: its classes are indexed whole, under every value one bit away.  Two of them
share such a value exactly if they differ by at most two bits, a value has at most 65 classes, and
linking each class to the smallest of its value keeps every component without writing all pairs.

A text without words has fingerprint 0 and is linked like any other; null is a text without words.
Rows are fingerprinted each on its own, so repeated rows land in one component; a null id takes part
in links but names no component unless all ids of it are null.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from .common import cut_lineage, release_worker, trim_worker
from .graphs import components
from .words import chunks, words_of

SEED = 42
#: Shingles whose bits are summed at once.
STEP = 1 << 18


def fingerprint_array(batch: pa.RecordBatch, size: int = 3) -> np.ndarray:
    """SimHash of each text: bit j is set if over half of its shingle hashes have it."""
    import xxhash

    words = words_of(batch, lower=True)
    data, first, last = words.joined()
    n = np.diff(words.bounds)
    at = words.bounds[:-1]
    # Shingles of a text with fewer words than ``size``: the whole sequence, or none.
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    which = np.repeat(np.arange(len(n)), per)
    begin = np.arange(len(which)) - np.repeat(np.cumsum(per) - per, per) + at[which]
    end = np.minimum(begin + size, words.bounds[1:][which]) - 1
    held = data.tobytes()
    xxh = xxhash.xxh64_intdigest
    ones = np.zeros((len(n), 64), np.int64)
    for a in range(0, len(which), STEP):
        part = slice(a, a + STEP)
        hashes = np.array([xxh(held[x:y], SEED) for x, y in zip(first[begin[part]].tolist(), last[end[part]].tolist())], np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        docs = which[part]
        heads = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
        ones[docs[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    return np.packbits(ones * 2 > per[:, None], axis=1).view(">u8").ravel().astype(np.int64, casting="unsafe")


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed number) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprint_array(batch, size), pa.int64())], ["doc_id", "fp"])
        trim_worker()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def links(classes: DataFrame, crowd: int = 64) -> DataFrame:
    """Pairs ``a`` > ``b`` of distinct values of ``fp`` that connect all that differ by at most two bits."""
    variant = F.col("variant")
    segment = F.when(variant < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    wiped = segment.bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, variant % 32)")))
    index = classes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("variant"))
    index = index.select("fp", F.expr("shiftleft(cast(variant as bigint), 32)").bitwiseOR(wiped).alias("key"))
    index = index.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1")
    index = cut_lineage(index)

    few = index.filter(F.col("n") <= crowd)
    left, right = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    pairs = left.join(right, "key").filter("a > b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).select("a", "b")

    many = index.filter(F.col("n") > crowd).select("fp").distinct()
    near = many.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit"))
    near = near.select("fp", F.when(F.col("bit") == 64, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(F.expr("shiftleft(1L, bit % 64)"))).alias("value"))
    met = near.groupBy("value").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).filter("a > b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, size: int = 3, crowd: int = 64) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable) of every row."""
    found = cut_lineage(fingerprints(docs, size))
    classes = cut_lineage(found.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows")))
    roots = components(links(classes, crowd))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")
