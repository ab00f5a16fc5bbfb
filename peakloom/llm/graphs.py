"""Connected components of large graphs by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for the nodes of ``edges`` (columns a, b).

    A large star links the greater neighbours of each node to its smallest neighbour, a small star the
    others; the edges settle into one star a component after a logarithmic number of rounds.  Each
    round is two group minima and joins back, so no component is ever gathered in one task.
    Self links and repeated links do no harm; no links give no rows.
    """
    here = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    here = cut_lineage(here)
    mark = None
    while True:
        now = here.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == mark:
            break
        mark = now
        both = here.unionByName(here.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        here = cut_lineage(small.distinct())
    stars = here.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
