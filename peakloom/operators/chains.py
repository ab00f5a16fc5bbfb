"""Choices along chains: who is still free when its turn comes, in a fixed number of stages.

Nodes of a key are taken in order.  A node that no earlier chooser has claimed chooses, and claims the one
later node that it wishes for.  So a node chooses exactly if none of those that wish for it chooses:

    chooses(i) = not any(chooses(k) for k with wish(k) = i)

Each node has one wish, so the wishes are a forest, and a chain of them may run through a whole chromosome.
It is not followed step by step.  Nodes are cut into tiles of ``width`` ranks.  What a tile does is told for
every state that can enter it: a node that is wished for from outside is open, and a stretch without other
open inputs passes its input on or turns it round, so it shrinks to one link with a flag; a node that a
surely choosing one claims is settled whatever enters.  Only links between open and meeting nodes and those
that leave the tile remain, at most twice as many as wishes cross into tiles.  They are the same kind of
problem with wider tiles, and are shrunk again; the last level is small and is settled for a key at once.
Then its answers enter the tiles below, level by level.  A task sees one tile.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import cut_lineage

#: Ranks of a tile by level; what is left of the last level is one group a key.
WIDTHS = (1 << 14, 1 << 20)

LINK, CLAIM, OPEN = 0, 1, 2
_ROW = "kind int, child long, parent long, turned int"

#: Rows that one call into Python takes, of many small groups or of one large one.
BATCH_ROWS = 1 << 16


def batch_of(df: DataFrame, *group: Column) -> Column:
    """Number of the batch that a group is dealt to, so that a batch holds some ``BATCH_ROWS`` rows.

    A call into Python costs as much as some thousand rows; tables of many short keys pay it once a batch.
    ``df`` is a written table.
    """
    return F.pmod(F.xxhash64(*group), F.lit(df.count() // BATCH_ROWS + 1))


def each_group(frame: pd.DataFrame, names: Sequence[str]) -> list[tuple[int, int]]:
    """Bounds of the groups by ``names`` in a frame whose rows are sorted by them."""
    if not len(frame):
        return []
    new = np.zeros(len(frame), bool)
    new[0] = True
    for name in names:
        column = frame[name].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(new).tolist()
    return list(zip(starts, [*starts[1:], len(frame)]))


def shrink(rows: Iterable[tuple[int, int, int, int]], inside: Callable[[int], bool], settle: bool = False):
    """Rows (kind, child, parent, turned) of a tile for every state that can enter it.

    A link brings to its parent whether its child chooses, or the opposite if turned; a claim brings a yes
    to its parent; an open parent has inputs from outside.  Parent -1 is nobody.  ``settle`` takes nothing
    as open and gives a dict of which children choose.
    """
    links, claimed, opened = [], set(), set()
    for kind, child, parent, turned in rows:
        if kind == LINK:
            links.append((child, parent, turned))
        elif kind == CLAIM:
            claimed.add(parent)
        elif not settle:
            opened.add(parent)
    links.sort()
    inputs: dict[int, list[tuple[int, int]]] = {}
    out, chooses = [], {}
    for child, parent, turned in links:
        here = inputs.pop(child, ())
        known, root, flag = None, child, 0
        if child in claimed:
            known = 0
        elif child in opened or len(here) > 1:
            out += [(LINK, r, child, f) for r, f in here]
        elif here:
            root, flag = here[0][0], here[0][1] ^ 1
        else:
            known = 1
        chooses[child] = known
        if parent < 0:
            continue
        if known is not None:
            if known ^ turned:
                if inside(parent):
                    claimed.add(parent)
                else:
                    out.append((CLAIM, -1, parent, 0))
        elif inside(parent):
            inputs.setdefault(parent, []).append((root, flag ^ turned))
        else:
            out.append((LINK, root, parent, flag ^ turned))
    return chooses if settle else out


def _per_group(frame: pd.DataFrame, group: Sequence[str], keys: Sequence[str], columns: Sequence[str], run: Callable) -> pd.DataFrame:
    """``run(rows, tile)`` of every group of a batch, with the keys in front of what it gives."""
    frame = frame.sort_values(list(group), kind="stable")
    lists = [frame[c].tolist() for c in ("kind", "child", "parent", "turned")]
    tiles = frame["tile"].tolist() if "tile" in group else None
    out, owner = [], []
    for start, end in each_group(frame, group):
        made = run(list(zip(*(c[start:end] for c in lists))), tiles[start] if tiles else None)
        out += made
        owner += [start] * len(made)
    made = pd.DataFrame(out, columns=list(columns))
    for n, k in enumerate(keys):
        made.insert(n, k, frame[k].to_numpy()[owner])
    return made


def choosers(links: DataFrame, keys: Sequence[str], node: str = "node", wish: str = "wish", widths: Sequence[int] = WIDTHS) -> DataFrame:
    """``keys`` and ``node`` of the rows of ``links`` that choose.

    ``node`` is a rank inside the keys, one row each, ``wish`` a greater one or null.  Keys are not null.
    """
    keys = list(keys)
    head = ", ".join(f"`{k}` {links.schema[k].dataType.simpleString()}" for k in keys)
    base = links.select(*keys, F.lit(LINK).alias("kind"), F.col(node).cast("long").alias("child"), F.coalesce(F.col(wish).cast("long"), F.lit(-1)).alias("parent"), F.lit(0).alias("turned"))
    levels = [cut_lineage(base)]
    tile = lambda c, width: F.floor(F.col(c) / width)

    def crossing(rows: DataFrame, width: int) -> DataFrame:
        return rows.where((F.col("kind") == LINK) & (F.col("parent") >= 0) & (tile("child", width) != tile("parent", width)))

    def dealt(rows: DataFrame, level: DataFrame, width: int | None, run: Callable, columns: Sequence[str], schema: str) -> DataFrame:
        """``run`` on each tile of ``width`` ranks, or on each key as a whole; most rows are those of ``level``."""
        group = keys if width is None else [*keys, "tile"]
        if width is not None:
            rows = rows.withColumn("tile", F.when(F.col("kind") == LINK, tile("child", width)).otherwise(tile("parent", width)))
        batched = rows.withColumn("_batch", batch_of(level, *[F.col(c) for c in group]))
        return batched.groupBy("_batch").applyInPandas(lambda frame: _per_group(frame, group, keys, columns, run), f"{head}, {schema}")

    def claims(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("kind") == CLAIM)

    columns = ["kind", "child", "parent", "turned"]
    for width in widths:
        rows = levels[-1]
        entered = crossing(rows, width).select(*keys, F.lit(OPEN).alias("kind"), F.lit(-1).cast("long").alias("child"), "parent", F.lit(0).alias("turned")).distinct()
        up = lambda here, at, width=width: shrink(here, lambda p: p // width == at)
        levels.append(cut_lineage(dealt(rows.unionByName(entered), rows, width, up, columns, _ROW)))

    def brought(here: list, below: int, inside: Callable[[int], bool]) -> list:
        """Claims of those that choose on nodes of other tiles of the level below."""
        chooses = shrink(here, inside, settle=True)
        links_of = ((c, p, t) for k, c, p, t in here if k == LINK and p >= 0)
        return sorted({(CLAIM, -1, p, 0) for c, p, t in links_of if chooses[c] ^ t and c // below != p // below})

    top = lambda here, _: brought(here, widths[-1], lambda p: True)
    entering = dealt(levels[-1], levels[-1], None, top, columns, _ROW).unionByName(claims(levels[-1]))
    for n in range(len(widths) - 1, 0, -1):
        entering = cut_lineage(entering)
        down = lambda here, at, n=n: brought(here, widths[n - 1], lambda p: p // widths[n] == at)
        found = dealt(levels[n].unionByName(entering), levels[n], widths[n], down, columns, _ROW)
        entering = entering.unionByName(found).unionByName(claims(levels[n]))
    entering = cut_lineage(entering.distinct())

    def answer(here: list, at: int) -> list:
        chooses = shrink(here, lambda p: p // widths[0] == at, settle=True)
        return [(c,) for c, known in chooses.items() if known]

    return dealt(levels[0].unionByName(entering), levels[0], widths[0], answer, [node], f"`{node}` long")
