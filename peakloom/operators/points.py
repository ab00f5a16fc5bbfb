"""Points in packed lists by tile, and rows that read them.

A point costs a byte or two of a shuffle: its distance from the one before, and the number of its value among the
values of its list.  Lists are made from the batches a task reads, without sorting the task's points.  What asks
for points is dealt to the same tiles and meets a tile's lists one row after the other; only the first row of a
tile carries them into Python.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Points that are packed at a time.
PACKED_ROWS = 1 << 18
#: Values laid out at a time, and bytes of answers that go back at once.
ANSWER_VALUES = 1 << 20
ANSWER_BYTES = 1 << 24


def _numbers_packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as compressed byte planes."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _lists(table: pa.Table, width: int, margin: int) -> pa.RecordBatch:
    """One row for each sequence and tile of a table of points."""
    pos = table.column("pos").to_numpy()
    tile = pos // width
    off = pos - tile * width
    if (again := np.flatnonzero(off < margin)).size:
        table = pa.concat_tables([table, table.take(pa.array(again))])
        tile, off = np.append(tile, tile[again] - 1), np.append(off, off[again] + width)
    names = table.column("chrom").combine_chunks().dictionary_encode()
    if isinstance(names, pa.ChunkedArray):
        names = names.combine_chunks()
    code, kind = names.indices.to_numpy(), table.schema.field("_v").type if "_v" in table.column_names else None
    step = [c[1:] != c[:-1] for c in (code, tile)]
    if np.any((code[1:] < code[:-1]) | ~step[0] & (tile[1:] < tile[:-1]) | ~step[0] & ~step[1] & (off[1:] < off[:-1])):
        order = np.lexsort((off, tile, code))
        table, code, tile, off = table.take(pa.array(order)), code[order], tile[order], off[order]
    starts = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (tile[1:] != tile[:-1])))
    steps = np.diff(off, prepend=0)
    steps[starts] = off[starts]
    ends = np.append(starts[1:], len(off))
    places = [_numbers_packed(steps[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
    fields = [pa.array(places, pa.binary())]
    if kind is not None:
        value, codes, known = table.column("_v").combine_chunks(), [], []
        plain = pa.types.is_nested(kind)
        for a, b in zip(starts.tolist(), ends.tolist()):
            here = value.slice(a, b - a)
            some = None if plain else here.dictionary_encode(null_encoding="encode")
            codes.append(_numbers_packed(np.arange(b - a) if plain else some.indices.to_numpy()))
            known.append(here if plain else some.dictionary)
        sizes = np.append(0, np.cumsum([len(k) for k in known]))
        fields += [pa.array(codes, pa.binary()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.concat_arrays(known))]
    entry = pa.StructArray.from_arrays(fields, ["places", "codes", "known"][:len(fields)])
    chrom = names.dictionary.take(pa.array(code[starts])).cast(pa.string())
    return pa.RecordBatch.from_arrays([chrom, pa.array(tile[starts], pa.int64()), entry], ["chrom", "_tile", "_e"])


def listed_points(points: DataFrame, width: int, margin: int = 0, value: str | None = None) -> DataFrame:
    """Points (``chrom, pos`` 0-based) in packed lists by tile of ``width``: ``chrom, _tile, _points``.

    A tile has also the points less than ``margin`` (at most ``width``) behind its end.  With ``value`` lists hold the values too.
    """
    placed = points.where("chrom IS NOT NULL AND pos IS NOT NULL").select(
        F.col("chrom").cast("string").alias("chrom"), F.col("pos").cast("long").alias("pos"), *([F.col(value).alias("_v")] if value else [])
    )
    held = f", codes: binary, known: array<{placed.schema['_v'].dataType.simpleString()}>" if value else ""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                rows += batch.num_rows
            if rows >= PACKED_ROWS:
                yield _lists(pa.Table.from_batches(waiting), width, margin)
                waiting, rows = [], 0
        if rows:
            yield _lists(pa.Table.from_batches(waiting), width, margin)

    packed = placed.mapInArrow(pack, f"chrom string, _tile long, _e struct<places: binary{held}>")
    return packed.groupBy("chrom", "_tile").agg(F.collect_list("_e").alias("_points"))


def unpacked(entries: list[dict], kind: pa.DataType | None = None) -> tuple[np.ndarray, pa.Array | None]:
    """Places of the points of a tile in order, and their values; those of one place null first, then ascending."""
    places = [np.cumsum(_numbers(e["places"])) for e in entries]
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    if kind is None:
        return np.sort(place), None
    held = [pa.array(e["known"], kind).take(pa.array(_numbers(e["codes"]))) for e in entries]
    value = pa.concat_arrays(held) if held else pa.array([], kind)
    if np.any(place[1:] <= place[:-1]):
        rank = np.zeros(len(place), np.int64)
        if not pa.types.is_nested(kind):
            # The order of Spark: null, numbers, NaN.
            at = pc.sort_indices(value, null_placement="at_end").to_numpy()
            rank[at] = np.arange(len(at))
            rank[pc.is_null(value).to_numpy(zero_copy_only=False)] = -1
        order = np.lexsort((rank, place))
        place, value = place[order], value.take(pa.array(order))
    return place, value


def beside_points(
    asked: DataFrame, listed: DataFrame, schema: str, answer: Callable[[pa.RecordBatch, list[dict], int], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """What ``answer(rows, lists, tile)`` gives for the rows of ``asked`` (with ``start, end`` and ``_tile``) of one tile.

    Rows of a tile follow each other, so its lists go into Python once, with the first of them.
    """
    place = ["chrom", "_tile"]
    rows = asked.withColumn("_first", F.row_number().over(W.partitionBy(*place).orderBy("start", "end")) == 1)
    met = rows.join(listed.hint("merge"), place, "left").withColumn("_points", F.when(F.col("_first"), F.col("_points")))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[dict] = []
        for batch in batches:
            answers, held = [], 0
            first = np.flatnonzero(batch.column("_first").to_numpy(zero_copy_only=False))
            edges = np.unique(np.concatenate([[0], first, [batch.num_rows]]))
            slim = batch.select([n for n in batch.schema.names if n not in ("_first", "_points")])
            points, tiles = batch.column("_points"), batch.column("_tile")
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                if batch.column("_first")[a].as_py():
                    entries = points[a].as_py() or []
                for part in answer(slim.slice(a, b - a), entries, tiles[a].as_py()):
                    answers.append(part)
                    held += part.nbytes
                if held >= ANSWER_BYTES:
                    yield from pa.Table.from_batches(answers).combine_chunks().to_batches()
                    answers, held = [], 0
            if answers:
                yield from pa.Table.from_batches(answers).combine_chunks().to_batches()

    return met.mapInArrow(meet, schema)


def value_lists(sites: DataFrame, points: DataFrame, value: str, name: str, tile: int) -> DataFrame:
    """``sites`` (coordinates first) with the values of ``points`` (``chrom, pos`` 0-based) at every base in order, null where there is none."""
    low, high = F.least("start", F.col("end") - 1), F.greatest("start", F.col("end") - 1)
    # A site is read in the tile where it begins, which is as wide as the longest and holds as much of the next.
    longest = sites.agg(F.max(high - low + 1)).first()[0] or 1
    width = max(tile, longest)
    coords = ["chrom", "start", "end"]
    known = F.col("start").isNotNull() & F.col("end").isNotNull()
    asked = sites.select(*coords, *[c for c in sites.columns if c not in coords], F.when(known, F.floor(low / width)).alias("_tile"))
    out = [c for c in asked.columns if c != "_tile"]
    kinds = {f.name: f.dataType.simpleString() for f in asked.schema} | {name: f"array<{points.schema[value].dataType.simpleString()}>"}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*out, name])
    kind = to_arrow_type(points.schema[value].dataType)
    state: list = [None, None]

    def answer(rows: pa.RecordBatch, entries: list[dict], at: int | None) -> Iterator[pa.RecordBatch]:
        if state[0] is not entries:
            place, held = unpacked(entries, kind)
            count = np.bincount(place, minlength=width + longest) if len(place) else np.zeros(width + longest, np.int64)
            state[:] = entries, (count, np.cumsum(count) - count, held)
        count, begin, held = state[1]
        sides = [rows.column(c) for c in ("start", "end")]
        ok = np.ones(len(rows), bool)
        for c in (rows.column("chrom"), *sides):
            ok &= pc.is_valid(c).to_numpy(zero_copy_only=False)
        start, last = (pc.fill_null(c, 0).to_numpy().astype(np.int64) - d for c, d in zip(sides, (0, 1)))
        size = np.where(ok, np.abs(last - start) + 1, 0)
        left = np.where(ok, np.minimum(start, last) - (at or 0) * width, 0)
        share = np.append(0, np.cumsum(size) // ANSWER_VALUES)
        cuts = [0, *(np.flatnonzero(share[1:] != share[:-1]) + 1).tolist(), len(rows)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            n = size[a:b]
            base = np.repeat(left[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            times = np.maximum(count[base], 1)
            item = np.repeat(begin[base], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            none = np.repeat(count[base] == 0, times)
            values = held.take(pa.array(np.where(none, 0, item), mask=none)) if held is not None and len(held) else pa.nulls(len(item), kind)
            total = np.append(0, np.cumsum(times))
            offsets = total[np.append(0, np.cumsum(n))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(~ok[a:b]))
            part = rows.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in out], lists], [*out, name])

    listed = listed_points(points, width, min(longest, width), value)
    return beside_points(asked, listed, schema, answer)


def counts_in(regions: DataFrame, points: DataFrame, tile: int) -> DataFrame:
    """``chrom, start, end, _n``: points between start and end of each different region, less than none where they are in turn."""
    sides = [F.floor(F.col(c) / tile) for c in ("start", "end")]
    asked = regions.select(F.col("chrom").cast("string").alias("chrom"), "start", "end").where("chrom IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL").distinct().withColumn("_tile", F.explode(F.sequence(*sides)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema if f.name != "_tile") + ", _n long"
    state: list = [None, None]

    def answer(rows: pa.RecordBatch, entries: list[dict], at: int) -> Iterator[pa.RecordBatch]:
        if state[0] is not entries:
            state[:] = entries, unpacked(entries)[0]
        upto = [np.searchsorted(state[1], rows.column(c).to_numpy().astype(np.int64) - at * tile, "left") for c in ("start", "end")]
        yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in ("chrom", "start", "end")], pa.array((upto[1] - upto[0]).astype(np.int64))], ["chrom", "start", "end", "_n"])

    return beside_points(asked, listed_points(points, tile), schema, answer).groupBy("chrom", "start", "end").agg(F.sum("_n").alias("_n"))
