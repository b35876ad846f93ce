"""Shared storage for intermediate tables.

Intermediate results that must be computed once (and survive a lost executor)
are written as parquet to the shared folder the session names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one only in local mode."""
    folder = spark.conf.get(_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_KEY} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="loomhouse-")
    spark.conf.set(_KEY, folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder name under the shared folder that nobody has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, name: str = "stage", partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage and pins values that would differ between two
    evaluations of one plan (range-partition bounds, row positions). Filters
    on the ``partition_by`` columns then skip whole folders. The shuffle files
    of the write go with it, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(folder, partitionBy=list(partition_by) or None)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)
