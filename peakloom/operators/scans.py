"""Running aggregates, ranks and exact quantiles without one task per key.

A plain window over ``partitionBy(chrom)`` sends a whole chromosome to one task.
Everything here works on two levels instead: rows are cut into ordered tiles, each
tile is scanned on its own, and a small table of tile totals supplies what the
earlier tiles contribute.  A task sees one tile; the tile table has one row per
key and tile, which is bounded by the key space and not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..runtime import cut_lineage

#: Subdivisions of each power of two used when ordering doubles into buckets.
PER_OCTAVE = 64


def value_bucket(value: Column, per_octave: int = PER_OCTAVE) -> Column:
    """Order-preserving bucket number of a double: ``a <= b`` implies ``bucket(a) <= bucket(b)``.

    Buckets are logarithmic, so values of any scale spread out; no pass over the
    data is needed to place the cuts and a recomputed task finds the same ones.
    """
    v = value.cast("double")
    size = F.floor((F.log2(F.abs(v)) + 1100) * per_octave).cast("long")
    return F.when(v == 0, F.lit(0).cast("long")).otherwise(F.signum(v).cast("long") * size)


def draw(seed: int, *key: Column) -> Column:
    """A 48-bit pseudo-random integer that depends only on the seed and the row key."""
    text = F.concat_ws(":", *[k.cast("string") for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


_FOLD = {
    "sum": (F.sum, lambda carry, here: F.coalesce(carry, F.lit(0)) + here),
    "max": (F.max, lambda carry, here: F.greatest(carry, here)),
    "min": (F.min, lambda carry, here: F.least(carry, here)),
}


def tiled_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tile: Column,
    running: Mapping[str, tuple[str, Column]] | None = None,
    following: Mapping[str, Column] | None = None,
    preceding: Mapping[str, Column] | None = None,
    filled: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ordered running columns to ``df``.

    running    ``{name: (fn, col)}`` inclusive running sum, max or min
    following  ``{name: col}`` value of ``col`` on the next row of the key
    preceding  ``{name: col}`` value of ``col`` on the previous row
    filled     ``{name: col}`` last non-null ``col`` up to this row

    ``tile`` must not decrease along ``order`` within a key, and ``order`` must be total.
    """
    running, following = dict(running or {}), dict(following or {})
    preceding, filled = dict(preceding or {}), dict(filled or {})
    rank = F.struct(*[F.col(f"_o{i}") for i in range(len(order))])
    base = df.select(
        "*",
        tile.alias("_tile"),
        *[c.alias(f"_o{i}") for i, c in enumerate(order)],
        *[c.alias(f"_r_{n}") for n, (_, c) in running.items()],
        *[c.alias(f"_f_{n}") for n, c in following.items()],
        *[c.alias(f"_p_{n}") for n, c in preceding.items()],
        *[c.alias(f"_l_{n}") for n, c in filled.items()],
    )
    group = [*keys, "_tile"]
    totals = base.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        *[_FOLD[fn][0](f"_r_{n}").alias(f"_t_r_{n}") for n, (fn, _) in running.items()],
        *[F.min_by(F.struct(f"_f_{n}"), rank).alias(f"_t_f_{n}") for n in following],
        *[F.max_by(F.struct(f"_p_{n}"), rank).alias(f"_t_p_{n}") for n in preceding],
        *[
            F.max_by(f"_l_{n}", F.when(F.col(f"_l_{n}").isNotNull(), rank)).alias(f"_t_l_{n}")
            for n in filled
        ],
    )
    part = [F.col(k) for k in keys] or [F.lit(0)]
    along = W.partitionBy(*part).orderBy("_tile")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        *group,
        *[_FOLD[fn][0](f"_t_r_{n}").over(before).alias(f"_c_r_{n}") for n, (fn, _) in running.items()],
        *[F.lead(f"_t_f_{n}").over(along).alias(f"_c_f_{n}") for n in following],
        *[F.lag(f"_t_p_{n}").over(along).alias(f"_c_p_{n}") for n in preceding],
        *[F.last(f"_t_l_{n}", ignorenulls=True).over(before).alias(f"_c_l_{n}") for n in filled],
    )
    inside = W.partitionBy(*group).orderBy(*[f"_o{i}" for i in range(len(order))])
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    # Both are dealt by tile, as the windows need the rows dealt so; a side that is broadcast would grow with its table.
    out = base.join(carry.hint("shuffle_hash"), group).select(
        *[F.col(c) for c in df.columns],
        *[
            _FOLD[fn][1](F.col(f"_c_r_{n}"), _FOLD[fn][0](f"_r_{n}").over(upto)).alias(n)
            for n, (fn, _) in running.items()
        ],
        *[
            F.coalesce(F.lead(F.struct(f"_f_{n}")).over(inside), F.col(f"_c_f_{n}"))
            .getField(f"_f_{n}").alias(n)
            for n in following
        ],
        *[
            F.coalesce(F.lag(F.struct(f"_p_{n}")).over(inside), F.col(f"_c_p_{n}"))
            .getField(f"_p_{n}").alias(n)
            for n in preceding
        ],
        *[
            F.coalesce(F.last(f"_l_{n}", ignorenulls=True).over(upto), F.col(f"_c_l_{n}")).alias(n)
            for n in filled
        ],
    )
    return out


def row_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tile: Column, name: str = "row_index"
) -> DataFrame:
    """1-based position of each row inside its key, along ``order``."""
    return tiled_scan(df, keys, order, tile, running={name: ("sum", F.lit(1).cast("long"))})


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based position of each row inside its key, along a total ``order``, for any number of rows.

    Rows are range-partitioned by key and order, so neither a key nor a value that very many rows
    share is one task's: ties go on by the last columns of ``order``.  The partitions are written with
    their numbers; their row counts, one row a partition and key, give what comes before.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    along = [f"_o{i}" for i in range(len(order))]
    rows = df.select("*", *[c.alias(o) for c, o in zip(order, along)])
    rows = cut_lineage(rows.repartitionByRange(parts, *keys, *along).withColumn("_part", F.spark_partition_id()))
    counts = rows.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
    over = W.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)]).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        F.col("_part").alias("_there"), *[F.col(k).alias(f"_k_{k}") for k in keys], F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_before")
    )
    same = F.col("_part") == F.col("_there")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = W.partitionBy("_part", *keys).orderBy(*along)
    here = rows.withColumn("_here", F.row_number().over(inside)).join(before, same)
    return here.select(*[F.col(c) for c in df.columns], (F.col("_before") + F.col("_here")).alias(name))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per key with the number of rows below and up to each.

    Equal values collapse before the shuffle, so a value shared by a third of all
    rows costs one row.  Adds ``n``, ``upto`` and ``below``.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    scanned = tiled_scan(
        counts, keys, [F.col(value)], value_bucket(F.col(value)), running={"upto": ("sum", F.col("n"))}
    )
    return scanned.withColumn("below", F.col("upto") - F.col("n"))


def quantiles_of_counts(
    ran: DataFrame, totals: DataFrame, keys: Sequence[str], value: str, probs: Column
) -> DataFrame:
    """Linear-interpolation quantiles (R type 7) from running counts, rows ``(keys, prob, quantile)``.

    ``ran`` has ``below`` and ``upto`` per distinct value, ``totals`` one row per key with
    ``_total``.  The two order statistics around each target rank are looked up by rank
    bin: the targets are a few rows per key, and no task holds the values of a key.
    """
    width = F.greatest(F.ceil(F.col("_total") / 4096), F.lit(1))
    wanted = totals.select(*keys, width.alias("_width"), "_total", F.explode(probs).alias("prob"))
    wanted = wanted.withColumn("_h", (F.col("_total") - 1) * F.col("prob"))
    points = wanted.select(
        *keys, "prob", "_h", F.explode(F.array(F.floor("_h"), F.ceil("_h"))).alias("_at"), "_width"
    ).withColumn("_bin", F.floor(F.col("_at") / F.col("_width"))).drop("_width")
    sized = totals.select(*keys, width.alias("_width"))
    rows = ran.join(sized, list(keys)) if keys else ran.crossJoin(F.broadcast(sized))
    rows = rows.select(
        *keys, F.col(value).alias("_v"), "below", "upto",
        F.explode(
            F.sequence(F.floor(F.col("below") / F.col("_width")), F.floor((F.col("upto") - 1) / F.col("_width")))
        ).alias("_bin"),
    )
    hits = rows.join(points, [*keys, "_bin"]).where((F.col("_at") >= F.col("below")) & (F.col("_at") < F.col("upto")))
    at = lambda rank: F.max(F.when(F.col("_at") == rank, F.col("_v")))
    ends = hits.groupBy(*keys, "prob", "_h").agg(at(F.floor("_h")).alias("_lo"), at(F.ceil("_h")).alias("_hi"))
    frac = F.col("_h") - F.floor("_h")
    return ends.select(*keys, "prob", (F.col("_lo") + frac * (F.col("_hi") - F.col("_lo"))).alias("quantile"))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]
) -> DataFrame:
    """Exact type-7 quantiles of a column per key, see :func:`quantiles_of_counts`."""
    keys = list(keys)
    data = df.where(F.col(value).isNotNull())
    totals = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    return quantiles_of_counts(value_counts(data, keys, value), totals, keys, value, wanted)
