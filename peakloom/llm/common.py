"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..runtime import cut_lineage, fresh_path

__all__ = ["cut_lineage", "fresh_path", "documents", "one_per_id", "remainder", "in_worker", "release_worker", "trim_worker", "nested", "unnested", "map_rows", "with_fields"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table ``documents`` of a folder of tables."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def one_per_id(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` and ``more``, one row for each id.

    Rows without an id have no name in a result and are left out.  Rows that repeat an id are one
    document with the greatest text (null comes last; of equal texts, the greatest of ``more`` as JSON).
    Only ids are read to see whether any repeats.
    """
    docs = docs.select("doc_id", "text", *more).filter(F.col("doc_id").isNotNull())
    twice = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1)
    if twice.isEmpty():
        return docs
    columns = [c for c in docs.columns if c != "doc_id"]
    order = F.struct(F.col("text").isNotNull(), "text", F.to_json(F.struct(*columns)))
    best = docs.groupBy("doc_id").agg(F.max_by(F.struct(*columns), order).alias("best"))
    return best.select("doc_id", *(F.col("best")[c].alias(c) for c in columns))


_held: dict = {}


def in_worker(key, make):
    """What ``make`` gives, kept in a worker process between tasks until another key is asked for.

    Workers serve all stages of a session; only the tables of the stage at hand stay in memory.
    """
    if key not in _held:
        release_worker()
        _held[key] = make()
    return _held[key]


def release_worker() -> None:
    """Give back what earlier stages keep in this worker, to the system too: freed memory that the
    allocators of Python and Arrow hold on to counts against the executor."""
    _held.clear()
    trim_worker()


def trim_worker() -> None:
    """Give memory that a task has freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def nested(docs: DataFrame) -> DataFrame:
    """Whole rows as column ``row`` beside doc_id and text, so that no column of theirs meets another of its name."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def unnested(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``row``."""
    return rows.select(*(F.col("row")[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def map_rows(docs: DataFrame, change: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``docs`` with its batches changed by a function that keeps the columns, whatever their names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (pa.RecordBatch.from_struct_array(b.column("row")) for b in batches)
        for batch in change(flat):
            yield pa.RecordBatch.from_arrays([batch.to_struct_array()], ["row"])
        trim_worker()

    rows = nested(docs).select("row")
    return unnested(rows.mapInArrow(run, rows.schema), docs)


def with_fields(row: pa.StructArray, **new: pa.Array) -> pa.StructArray:
    """Rows with new values of some fields, for use inside tasks."""
    fields = list(row.type)
    return pa.StructArray.from_arrays([new[f.name].cast(f.type) if f.name in new else row.field(i) for i, f in enumerate(fields)], fields=fields)
