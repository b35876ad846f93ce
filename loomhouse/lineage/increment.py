"""A lineage graph that takes documents batch by batch.

What the merge needs of all mentions is an aggregate that combines: of each
vertex the first mention and whether a file forced its type, of each property
of a derivation the last value present, always with the place of the writer
(file name, column, source). These states are kept in bucketed tables, so a
batch rewrites only the buckets of the keys it mentions, and the graph of the
batches is the graph of all their documents, in whatever order they arrive. A
batch sent again, or a document in two batches, changes nothing. A document
that changed under its old name adds to what it said before; nothing is taken
back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomhouse.lineage.documents import PROPERTIES, derivations, source_entries
from loomhouse.lineage.graph import edges, vertex_mentions
from loomhouse.operators.bucketed import BucketedTable
from loomhouse.session import materialize


def vertex_states(mentions: DataFrame) -> DataFrame:
    """First mention with its place, and the forced type, of each vertex."""
    return mentions.groupBy("label", "key").agg(
        F.min_by(F.struct("name", "type"), "seq").alias("first"),
        F.min("seq").alias("first_at"),
        F.max(F.when(F.col("forced"), F.col("type"))).alias("forced"),
    )


def combined_vertices(states: DataFrame) -> DataFrame:
    return states.groupBy("label", "key").agg(
        F.min_by("first", "first_at").alias("first"),
        F.min("first_at").alias("first_at"),
        F.max("forced").alias("forced"),
    )


def vertices_of(states: DataFrame) -> DataFrame:
    """``(label, key, name, type)`` as ``graph.vertices`` gives them."""
    return states.select(
        "label", "key", F.col("first.name").alias("name"),
        F.coalesce("forced", "first.type").alias("type"),
    )


def derivation_states(derived: DataFrame) -> DataFrame:
    """The last value present of each property, with its place, per derivation."""
    seq = F.struct("file_name", "col_pos", "src_pos")
    aggs = []
    for p in PROPERTIES:
        at = F.when(F.col(p).isNotNull(), seq)
        aggs += [F.max_by(F.col(p), at).alias(p), F.max(at).alias(f"{p}_at")]
    return derived.groupBy(
        F.col("target_full").alias("target_column"), F.col("source_full").alias("source_column")
    ).agg(*aggs)


def combined_derivations(states: DataFrame) -> DataFrame:
    aggs = []
    for p in PROPERTIES:
        aggs += [F.max_by(p, f"{p}_at").alias(p), F.max(f"{p}_at").alias(f"{p}_at")]
    return states.groupBy("target_column", "source_column").agg(*aggs)


_PARTS = {
    "vertices": (["label", "key"], combined_vertices),
    "derivations": (["target_column", "source_column"], combined_derivations),
    "edges": (["edge_type", "src", "dst"], DataFrame.distinct),
}


@dataclass(frozen=True)
class StoredGraph:
    """The newest version of a graph in ``folder``."""

    spark: SparkSession
    folder: str

    def table(self, part: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.folder}/{part}")

    def vertices(self) -> DataFrame:
        return vertices_of(self.table("vertices").rows())

    def derivations(self) -> DataFrame:
        """As ``graph.merged_derivations``."""
        return self.table("derivations").rows().select("target_column", "source_column", *PROPERTIES)

    def edges(self) -> DataFrame:
        return self.table("edges").rows()


def merge_documents(
    spark: SparkSession,
    folder: str,
    batch: str,
    documents: DataFrame,
    *dependencies: DataFrame,
    derived: DataFrame | None = None,
    buckets: int = 64,
) -> StoredGraph:
    """The graph in ``folder`` after the documents of ``batch``; made by the first batch.

    Each of its three tables takes the batch by a rename of its own; after a
    failure in between, the batch is sent again and reaches those it missed.
    """
    if derived is None:
        derived = materialize(derivations(source_entries(documents)), "derivations")
    found = {
        "vertices": vertex_states(vertex_mentions(documents, derived)),
        "derivations": derivation_states(derived),
        "edges": edges(documents, *dependencies, derived=derived),
    }
    for part, (keys, combine) in _PARTS.items():
        at, states = f"{folder}/{part}", found[part]
        if BucketedTable.exists(spark, at):
            table = BucketedTable(spark, at)
        else:
            table = BucketedTable.create(spark, at, states.schema, keys, buckets)
        table.apply(batch, states, lambda old, new, c=combine: c(old.unionByName(new)))
    return StoredGraph(spark, folder)
