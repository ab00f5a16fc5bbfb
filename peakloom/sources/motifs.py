"""Motif matrix files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Fixed values of the first line.
KINDS, SYMMETRIES, STRUCTURES = ["SCORE", "FREQUENCY", "COUNT"], ["SYMMETRIC", "ASYMMETRIC"], ["SIMPLE", "DEPENDENCY"]


def parse_motifs(files: DataFrame) -> DataFrame:
    """Long motif table from whole matrix files (``path, value``), one job for all of them.

    A file with a wrong header is reported in ``error`` and gives no matrix rows.  A
    dependency block starts with ``DEPENDENCY (positions)``; its rows may carry a label.
    """
    lines = F.filter(F.transform(F.split("value", r"\r?\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    # Only a first line may be a note on correlation.
    noted = F.coalesce(F.try_element_at("lines", F.lit(1)).contains("CORRELATION"), F.lit(False))
    rest = F.slice("lines", F.when(noted, 2).otherwise(1), F.greatest(F.size("lines"), F.lit(1)))
    raw = files.select("path", lines.alias("lines")).withColumn("lines", rest).withColumn("head", F.split(F.col("lines")[0], r"\s+"))
    head = lambda i: F.try_element_at("head", F.lit(i))
    error = (
        F.when((F.size("head") != 5) | (head(1) != "MATRIX"), "first line is not a MATRIX header")
        .when(~F.coalesce(head(2).isin(*KINDS), F.lit(False)), "unknown matrix kind")
        .when(~F.coalesce(head(3).isin(*SYMMETRIES), F.lit(False)), "unknown symmetry")
        .when(~F.coalesce(head(5).isin(*STRUCTURES), F.lit(False)), "neither SIMPLE nor DEPENDENCY")
        .when(F.regexp_replace(F.try_element_at("lines", F.lit(2)), r"\s", "") != "ACGT", "second line is not A C G T")
    )
    meta = raw.withColumn("error", error)
    bad = meta.where("error is not null").select("path", "error")
    body = F.filter(F.slice("lines", 3, F.size("lines")), lambda x: F.regexp_replace(x, r"\s", "") != "ACGT")
    good = meta.where("error is null").select(
        "path", head(4).alias("name"), head(2).alias("kind"), head(3).alias("symmetry"), body.alias("body")
    )
    # The block of a line is the number of DEPENDENCY lines up to it.
    rows = good.select("path", "name", "kind", "symmetry", "body", F.posexplode("body").alias("at", "line"))
    is_block = lambda x: x.startswith("DEPENDENCY")
    upto = F.slice("body", 1, F.col("at") + 1)
    rows = rows.withColumn("block", F.size(F.filter(upto, is_block)))
    last = F.coalesce(
        F.array_max(F.transform(F.filter(F.transform(upto, lambda x, i: F.struct(is_block(x).alias("b"), i.alias("i"))), lambda s: s["b"]), lambda s: s["i"])),
        F.lit(-1),
    )
    rows = rows.withColumn("head_at", last).where(F.col("at") != F.col("head_at"))
    spots = F.transform(
        F.split(F.regexp_extract(F.col("body")[F.col("head_at")], r"\(([^)]*)\)", 1), r"[\s,]+"), lambda x: x.cast("int")
    )
    rows = rows.withColumn("positions", F.when(F.col("head_at") >= 0, spots))
    rows = rows.withColumn("row", F.col("at") - F.col("head_at"))
    numbers = F.split(F.regexp_replace("line", r"^[ACGT]+\s+", ""), r"\s+")
    cells = rows.select(
        F.col("name").alias("motif_id"), "name", "kind", "symmetry", "block", F.col("row").cast("int").alias("row"),
        F.posexplode(numbers).alias("j", "v"), "positions", "path",
    )
    return cells.select(
        "motif_id", "name", "kind", "symmetry", "block", "row", F.substring(F.lit("ACGT"), F.col("j") + 1, F.lit(1)).alias("base"),
        F.col("v").cast("double").alias("value"), "positions", "path", F.lit(None).cast("string").alias("error"),
    ).unionByName(bad, allowMissingColumns=True)


def read_motif_collection(spark: SparkSession, glob) -> DataFrame:
    """All matrix files that match ``glob``; unusable ones raise with their names."""
    files = spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("path"), "value")
    parsed = parse_motifs(files)
    wrong = parsed.where("error is not null").select("path", "error").collect()
    if wrong:
        raise ValueError("; ".join(f"{r.path}: {r.error}" for r in wrong))
    return parsed.drop("path", "error")


def motif_text(motifs: DataFrame) -> DataFrame:
    """Matrix files as text (``motif_id, value``) from the long table, block 0."""
    line = motifs.where("block = 0").groupBy("motif_id", "name", "kind", "symmetry", "row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("base", "value"))), lambda x: x["value"].cast("string")), "\t").alias("line")
    )
    body = line.groupBy("motif_id", "name", "kind", "symmetry").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda x: x["line"]), "\n").alias("body")
    )
    head = F.concat_ws("\t", F.lit("MATRIX"), "kind", "symmetry", "name", F.lit("SIMPLE"))
    return body.select("motif_id", F.concat_ws("\n", head, F.lit("A\tC\tG\tT"), "body").alias("value"))
