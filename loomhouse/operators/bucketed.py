"""Tables in key buckets that a batch changes by copy on write.

A table is a folder. ``data`` holds one folder per batch and bucket, ``versions``
one small manifest per version, which names the folder of each bucket. A batch
reads and rewrites only the buckets its keys fall into, into a folder of its
own, and then publishes the next manifest by one rename. Readers see all of a
batch or nothing of it; a batch that failed anywhere before the rename has left
only files no manifest names; a batch that a manifest lists is not applied
again; of two writers that start from one version, the second is refused.

The manifest has one line per bucket, however large the table is. A bucket is
meant to be some hundred MB; its rows are split over several files by size.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomhouse.operators.sinks import upsert
from loomhouse.session import materialize
from loomhouse.sources.store import Store

_BUCKET = "bucket"


class BucketedTable:
    """The newest version of a table in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.store = spark, Store(spark, folder)
        versions = [n for n in self.store.names("versions") if n.endswith(".json")]
        if not versions:
            raise FileNotFoundError(f"no table in {folder}")
        self.version = int(versions[-1].removesuffix(".json"))
        self.manifest = json.loads(self.store.read_text(f"versions/{versions[-1]}"))

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        keys: list[str],
        buckets: int,
    ) -> BucketedTable:
        """An empty table; ``buckets`` is fixed for good."""
        first = {
            "schema": json.loads(schema.json()), "keys": keys, "count": buckets,
            "buckets": {}, "batches": [],
        }
        Store(spark, folder).publish(f"versions/{0:010d}.json", json.dumps(first))
        return cls(spark, folder)

    @classmethod
    def exists(cls, spark: SparkSession, folder: str) -> bool:
        return bool(Store(spark, folder).names("versions"))

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.manifest["schema"])

    @property
    def keys(self) -> list[str]:
        return self.manifest["keys"]

    def bucket_of(self) -> Column:
        """The bucket of a row, by its keys."""
        keys = [F.col(f"`{k}`") for k in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.manifest["count"])).cast("int")

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows of the table, or of some of its buckets."""
        held = self.manifest["buckets"]
        wanted = held if buckets is None else [str(b) for b in buckets if str(b) in held]
        folders = [self.store.path(held[b]) for b in wanted]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def apply(
        self,
        batch: str,
        changes: DataFrame,
        merge: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> BucketedTable:
        """The table after ``merge(old, changes)`` of the buckets that change.

        ``merge`` gets all rows of these buckets and the changes, which have at
        least the key columns, and returns the new rows. ``changes`` are
        computed once.
        """
        if batch in self.manifest["batches"]:
            return self
        placed = materialize(changes.withColumn(_BUCKET, self.bucket_of()), "batch")
        # at most one number per bucket
        touched = sorted(r[0] for r in placed.select(_BUCKET).distinct().collect())
        folder = f"data/{self.version + 1:010d}-{uuid.uuid4().hex}"
        if touched:
            merged = merge(self.rows(touched), placed.drop(_BUCKET)).select(
                *[F.col(f"`{c}`") for c in self.schema.names]
            )
            (
                merged.withColumn(_BUCKET, self.bucket_of())
                .hint("rebalance", _BUCKET)
                .write.partitionBy(_BUCKET)
                .parquet(self.store.path(folder))
            )
        # a bucket that lost all rows has no folder
        written = {
            n.partition("=")[2]: f"{folder}/{n}"
            for n in self.store.names(folder)
            if n.startswith(f"{_BUCKET}=")
        }
        kept = {b: f for b, f in self.manifest["buckets"].items() if int(b) not in touched}
        after = self.manifest | {
            "buckets": kept | written, "batches": [*self.manifest["batches"], batch],
        }
        self.store.publish(f"versions/{self.version + 1:010d}.json", json.dumps(after))
        return BucketedTable(self.spark, self.store.path())


def upsert_bucketed(
    table: BucketedTable, batch: str, updates: DataFrame, keep: list[str], order: list[str]
) -> BucketedTable:
    """``table`` with ``updates`` merged by key.

    As ``upsert``: existing rows take every column but ``keep`` from the update,
    unknown keys are appended, several updates of a key are reduced to the last
    along ``order``.
    """
    return table.apply(batch, updates, lambda old, new: upsert(old, new, table.keys, keep, order))
