"""Overlapping sites: which of them stay when the highest score decides."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..runtime import cut_lineage
from .chains import batch_of, choosers, each_group

TILE = 1 << 16


def _later(pos: np.ndarray, stop: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sites in order of place: the row that takes over from each (or -1), whether by a higher score, and
    whether no earlier site reaches it."""
    n = len(pos)
    higher = np.full(n, n, np.int64)
    waiting: list[int] = []
    for i, value in enumerate(score.tolist()):
        while waiting and score[waiting[-1]] < value:
            higher[waiting.pop()] = i
        waiting.append(i)
    free = np.searchsorted(pos, stop, "left")
    takes = np.minimum(higher, free)
    first = np.ones(n, bool)
    first[1:] = pos[1:] >= np.maximum.accumulate(stop)[:-1]
    return np.where(takes < n, takes, -1), higher < free, first


def resolve_overlaps(
    sites: DataFrame, keys: Sequence[str] = ("seq_id",), score: str = "score", ties: Sequence[str] = (), tile: int = TILE
) -> DataFrame:
    """The sites that stay where sites (``pos, stop``, half open) of a key overlap and the higher score wins.

    Sites meet in order of place: the one that stands is replaced by an overlapping one with a higher score,
    outlasts one without, and stays for good once a site comes that it does not reach.  Of sites with one
    start only the best counts (then the shorter, then by ``ties``), so these collapse before anything meets.
    Who takes over from a site lies within two site lengths, so tiles with such a margin tell it; which
    sites are ever reached is settled along the chains tile by tile (see :mod:`.chains`), so a cluster of any
    length is in no one task.  A null score is the lowest.  Rows without key or place are no sites and go;
    places are not negative and a site has at least one base.
    """
    keys = list(keys)
    worth = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    placed = sites.dropna(subset=[*keys, "pos", "stop"])
    order = F.struct(worth, -F.col("stop"), *[F.col(c) for c in ties])
    best = placed.groupBy(*keys, "pos").agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in sites.columns]), order).alias("_row"))
    best = cut_lineage(best)
    slim = best.select(*keys, F.col("pos").cast("long").alias("pos"), F.col("_row.stop").cast("long").alias("stop"), F.coalesce(F.col("_row")[score].cast("double"), F.lit(float("-inf"))).alias("worth"))
    longest = F.broadcast(slim.agg(F.coalesce(F.max(F.col("stop") - F.col("pos")), F.lit(1)).alias("_long")))
    wide = slim.crossJoin(longest).withColumn("_width", F.greatest(F.lit(tile), 2 * F.col("_long")))
    at = lambda place: F.floor(place / F.col("_width"))
    home = at(F.col("pos"))
    near = F.array_distinct(F.array(home, at(F.col("pos") + F.col("_long")), at(F.greatest(F.col("pos") - 2 * F.col("_long"), F.lit(0)))))
    dealt = wide.withColumn("_home", home).withColumn("_tile", F.explode(near)).drop("_width", "_long")

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        group = [*keys, "_tile"]
        frame = frame.sort_values([*group, "pos"])
        pos, stop = frame["pos"].to_numpy(np.int64), frame["stop"].to_numpy(np.int64)
        worth = frame["worth"].to_numpy(float)
        taker, beaten, first = np.zeros(len(frame), np.int64), np.zeros(len(frame), bool), np.zeros(len(frame), bool)
        none = np.zeros(len(frame), bool)
        for start, end in each_group(frame, group):
            here = slice(start, end)
            takes, beaten[here], first[here] = _later(pos[here], stop[here], worth[here])
            none[here] = takes < 0
            taker[here] = pos[here][takes]
        out = frame[keys].copy()
        out["pos"], out["taker"] = pos, pd.array(taker, dtype="Int64")
        out.loc[none, "taker"] = pd.NA
        out["beaten"], out["opens"] = beaten, first
        return out[(frame["_home"] == frame["_tile"]).to_numpy()]

    head = ", ".join(f"`{k}` {slim.schema[k].dataType.simpleString()}" for k in keys)
    batched = dealt.withColumn("_batch", batch_of(best, *[F.col(c) for c in [*keys, "_tile"]]))
    met = cut_lineage(batched.groupBy("_batch").applyInPandas(links, f"{head}, pos long, taker long, beaten boolean, opens boolean"))

    # A site stands if it opens a cluster or one that stands hands over to it.  For choosers, which turn what
    # they are told round: 3 pos speaks for an opening, 3 pos + 1 is "does not stand", 3 pos + 2 "stands".
    base = 3 * F.col("pos")
    step = lambda node, wish: F.struct(node.alias("node"), wish.alias("wish"))
    opening = F.when(F.col("opens"), step(base, base + 1))
    turns = F.array_compact(F.array(opening, step(base + 1, base + 2), step(base + 2, 3 * F.col("taker") + 1)))
    told = choosers(met.select(*keys, F.explode(turns).alias("t")).select(*keys, "t.node", "t.wish"), keys)
    stands = told.where(F.col("node") % 3 == 2).select(*keys, F.floor(F.col("node") / 3).alias("pos"))
    stay = met.where(~F.col("beaten")).select(*keys, "pos").join(stands, [*keys, "pos"])
    kept = best.withColumn("pos", F.col("pos").cast("long")).join(stay, [*keys, "pos"], "left_semi")
    return kept.select("_row.*").select(*sites.columns)


def preferred_distances(
    curve: DataFrame, lowest: int, highest: int, smooth: int = 3, least: float = 2.0, keys: Sequence[str] = ("tf1", "tf2")
) -> DataFrame:
    """Peaks of curves of counts by distance (``keys, distance, n``), above their background.

    A curve holds every distance from ``lowest`` to ``highest``, 0 where there is no row.  It is averaged over
    ``smooth`` distances on both sides, its least-squares line is taken off as background, and the rest is
    divided by its spread.  A peak is higher than the distance before it, not lower than the one after, and
    has a z score of at least ``least``; of a level stretch the first distance counts.  A curve without
    spread has none.  A curve has at most ``highest - lowest + 1`` rows.
    """
    keys = list(keys)
    counts = curve.where(F.col("distance").between(lowest, highest)).groupBy(*keys, F.col("distance").cast("long").alias("distance")).agg(F.sum("n").alias("n"))
    grid = counts.select(*keys).distinct().withColumn("distance", F.explode(F.sequence(F.lit(lowest).cast("long"), F.lit(highest).cast("long"))))
    full = grid.join(counts, [*keys, "distance"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    along = W.partitionBy(*keys).orderBy("distance")
    level = full.withColumn("level", F.avg("n").over(along.rowsBetween(-smooth, smooth)))
    line = level.groupBy(*keys).agg(F.regr_slope("level", "distance").alias("_slope"), F.regr_intercept("level", "distance").alias("_base"))
    above = level.join(line, keys).withColumn("above", F.round(F.col("level") - F.coalesce(F.col("_base") + F.col("_slope") * F.col("distance"), F.col("level")), 9))
    whole = W.partitionBy(*keys)
    scored = above.withColumn("_spread", F.stddev_pop("above").over(whole)).select(
        *keys, "distance", "n", "above", F.when(F.col("_spread") > 1e-9, F.col("above") / F.col("_spread")).alias("zscore"),
        F.lag("above").over(along).alias("_before"), F.lead("above").over(along).alias("_after"),
    )
    top = (F.col("_before").isNull() | (F.col("above") > F.col("_before"))) & (F.col("_after").isNull() | (F.col("above") >= F.col("_after")))
    return scored.where(top & (F.col("zscore") >= least)).drop("_before", "_after")
