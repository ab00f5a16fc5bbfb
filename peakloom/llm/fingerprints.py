"""Bottom-k sketches of documents.

The sketch of a text is the sorted array of the ``k`` smallest hashes of its distinct shingles (five
lower-cased words; of a text with fewer words the whole sequence; of one without words nothing).  The
sketch of a union is the bottom k of the union of sketches, so sketches of parts merge without the texts.
Sketches estimate resemblance, containment and the number of distinct shingles, exactly while a union
has at most k shingles.

Null texts are empty.  Two empty sketches are alike (1), an empty and another one are not (0).  Rows that
repeat a doc_id are one document with the greatest text, rows without doc_id are left out (see
``one_per_id``).  Other columns are not looked at.  Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from .common import cut_lineage, one_per_id

K = 128
SHINGLE = 5
_BETWEEN = r"[\x20\x09-\x0D]+"


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, size: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of column ``text`` as column ``out``.

    Word hashes become a column of their own first, so that a shingle reads ``size`` numbers.
    """
    hashed = f"{out}_words"
    df = df.withColumn(hashed, F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), ""), lambda w: F.xxhash64(w)))
    n = F.size(hashed)
    rolled = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*(F.get(F.col(hashed), i + j) for j in range(size))))
    shingles = F.when(n >= size, rolled).when(n > 0, F.array(F.xxhash64(F.col(hashed)))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)).drop(hashed)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(F.try_divide(shared.cast("double"), F.size(both)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    reach = (F.array_max(a).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.try_divide(shared, distinct_count(a, k))))


def printed(a: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, sketch and the estimated number of distinct shingles of every row of ``docs``."""
    out = with_sketch(docs.select("doc_id", F.col("text").cast("string").alias("text")), "text", "sketch", k)
    return out.select("doc_id", "sketch", distinct_count(F.col("sketch"), k).alias("n_shingles"))


def followers(ids: DataFrame) -> DataFrame:
    """For each row of ``ids`` (unique doc_id) the next doc_id in descending order; after the last, the first.

    Ids are ranged over partitions and written with their partition's number.  Inside a partition a window
    finds the next one; the last of a partition takes the first of the one below, from a table of one row
    a partition.
    """
    spark = ids.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(ids.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()))
    down = Window.partitionBy("part").orderBy(F.desc("doc_id"))
    tops = ranged.groupBy("part").agg(F.max("doc_id").alias("top"))
    tops = tops.select("part", F.lag("top").over(Window.orderBy("part")).alias("below"))
    first = ranged.agg(F.max("doc_id").alias("first"))
    next_id = F.coalesce(F.lead("doc_id").over(down), F.col("below"), F.col("first"))
    return ranged.join(F.broadcast(tops), "part").crossJoin(F.broadcast(first)).select("*", next_id.alias("next_id")).drop("part", "below", "first")


def edited_neighbours(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness to it and to the next one's.

    Edited: the last third of the characters gives way to as many of the next document's first ones.  Texts
    are dealt out by doc_id once; what the next document contributes, its beginning and its sketch, is
    carried to the one before it.
    """
    docs = one_per_id(docs).select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = docs.select("doc_id", F.char_length("text").alias("n"))
    pairs = cut_lineage(followers(ids).select("doc_id", "next_id", F.floor(F.col("n") / 3).cast("int").alias("cut")))

    asked = pairs.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("before"), "cut")
    given = with_sketch(docs.join(asked, "doc_id"), "text", "next_sketch", k)
    given = given.select(F.col("before").alias("doc_id"), "cut", F.expr("substring(text, 1, cut)").alias("begin"), "next_sketch")

    rows = docs.join(given, "doc_id")
    n = F.char_length("text")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - F.col("cut")), "begin"))
    rows = with_sketch(with_sketch(rows, "text", "sketch", k), "edited", "edited_sketch", k)
    own = F.col("sketch")
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), printed(own).alias("fingerprint"), printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(own, F.col("edited_sketch"), k).alias("near_edited"), resemblance(own, F.col("next_sketch"), k).alias("near_next"))
