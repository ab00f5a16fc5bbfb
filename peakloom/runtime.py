"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators count on.  Skewed join partitions are split and small
#: shuffle partitions are merged while the query runs.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: Folders of sessions on one machine, by application.
_own: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    A session on one machine that names none gets a folder of its own; on a cluster, where executors
    do not share local folders, that is an error.  The session's settings stay as they are.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="peakloom-")
    return _own[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Spark measures a batch for Python after each row unless its limit is this.
_BATCH_BYTES, _UNMEASURED = "spark.sql.execution.arrow.maxBytesPerBatch", str((1 << 31) - 1)


def cut_lineage(df: DataFrame, slim: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Later steps read the result instead of repeating what led to it, and a lost executor
    costs its own tasks only.  ``slim`` tells that rows on their way into Python are small, so that ten thousand
    of them need not be measured one by one; the setting holds for this write only.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, "step")
    before = spark.conf.get(_BATCH_BYTES, None)
    if slim:
        spark.conf.set(_BATCH_BYTES, _UNMEASURED)
    try:
        df.write.parquet(path)
    finally:
        if slim and before is None:
            spark.conf.unset(_BATCH_BYTES)
        elif slim:
            spark.conf.set(_BATCH_BYTES, before)
    return spark.read.schema(df.schema).parquet(path)
