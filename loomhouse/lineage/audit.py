"""Audits of the graph: extracts, directions, classes, run differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.operators.skew import salted_join

# Lineage classes.
ROLE_CLASSES = {
    "join key": ("INDIRECT", "Join"),
    "group key": ("INDIRECT", "GroupBy"),
    "filter": ("INDIRECT", "Filter"),
    "order key": ("INDIRECT", "Order"),
    "partition key": ("INDIRECT", "Window"),
    "used in condition": ("INDIRECT", "Conditional"),
    "aggregation input": ("DIRECT", "Aggregation"),
}
TYPE_CLASSES = {
    "DIRECT INPUT": ("DIRECT", "Identity"),
    "RENAME": ("DIRECT", "Identity"),
    "FILE_LOAD": ("DIRECT", "Identity"),
    "JOIN_LOOKUP": ("DIRECT", "Identity"),
    "AGGREGATION": ("DIRECT", "Aggregation"),
}
OTHER_TYPE = ("DIRECT", "Transformation")


def script_extract(
    texts: DataFrame, script_columns: DataFrame, derived: DataFrame
) -> DataFrame:
    """Per script its text row and one row per non-trivial derivation.

    A derivation belongs to every script that generates its target and reads
    its source; ``DIRECT INPUT`` and untyped ones are left out. The join goes
    through the target column, which few scripts generate, and then tests the
    reads, so a source column that many scripts share never multiplies rows.
    """
    interesting = derived.where(F.col("transformation_type") != "DIRECT INPUT").select(
        "target_column", "source_column", "transformation_type", "transformation_logic"
    )
    generates = script_columns.where("edge_type = 'GENERATES'").select(
        "script", F.col("column").alias("target_column")
    )
    reads = script_columns.where("edge_type = 'READS_FROM'").select(
        "script", F.col("column").alias("source_column")
    )
    candidates = salted_join(interesting, generates, ["target_column"])
    rows = salted_join(candidates, reads, ["script", "source_column"], "left_semi")
    header = texts.select(F.col("name").alias("script"), F.col("content").alias("sql_content"))
    return header.unionByName(rows, allowMissingColumns=True).select(
        "script", "sql_content", "source_column", "target_column", "transformation_type",
        "transformation_logic",
    )


def edge_directions(rows: DataFrame, triples: DataFrame) -> DataFrame:
    """Mark edges ``ok``, ``flip`` or ``invalid`` against the allowed triples.

    ``rows`` has ``from_label``, ``edge_type`` and ``to_label``; an empty one
    matches anything. Every allowed triple is expanded with its wildcard forms
    (eight per triple), so both tests are equi joins.
    """
    names = ["from_label", "edge_type", "to_label"]
    allowed = triples.select(*names)
    for c in names:
        allowed = allowed.withColumn(c, F.explode(F.array(F.col(c), F.lit(""))))
    allowed = allowed.distinct()
    blank = rows.fillna("", subset=names)
    straight = salted_join(
        blank, allowed.withColumn("_ok", F.lit(True)), names, "left"
    )
    turned = allowed.select(
        F.col("to_label").alias("from_label"), "edge_type",
        F.col("from_label").alias("to_label"), F.lit(True).alias("_flip"),
    )
    return (
        salted_join(straight, turned, names, "left", profile=blank)
        .withColumn(
            "verdict",
            F.when(F.col("_ok"), "ok").when(F.col("_flip"), "flip").otherwise("invalid"),
        )
        .drop("_ok", "_flip")
    )


def _lookup(column: str, table: dict[str, tuple[str, str]], part: int):
    out = F
    for value, classes in table.items():
        out = out.when(F.col(column) == value, F.lit(classes[part]))
    return out


def classify(derived: DataFrame) -> DataFrame:
    """Add ``lineage_class`` and ``lineage_subclass`` by role, then by type.

    Partition keys, join keys and conditions influence a column indirectly;
    everything else derives it directly.
    """

    def pick(part: int):
        by_role = _lookup("role", ROLE_CLASSES, part)
        by_type = _lookup("transformation_type", TYPE_CLASSES, part)
        return F.coalesce(by_role, by_type, F.lit(OTHER_TYPE[part]))

    return derived.withColumns({"lineage_class": pick(0), "lineage_subclass": pick(1)})


def class_counts(derived: DataFrame) -> DataFrame:
    """Derivations per target table and lineage class."""
    table = F.regexp_replace("target_column", r"\.[^.]*$", "")
    return (
        classify(derived)
        .groupBy(table.alias("table_full_name"), "lineage_class", "lineage_subclass")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def run_difference(before: DataFrame, after: DataFrame, properties: list[str]) -> DataFrame:
    """Derivations added, removed or changed between two runs.

    Both runs hold one row per (target column, source column).
    """
    keys = ["target_column", "source_column"]
    a = before.select(*keys, F.struct(*properties).alias("_a"))
    b = after.select(*keys, F.struct(*properties).alias("_b"))
    change = (
        F.when(F.col("_a").isNull(), "added")
        .when(F.col("_b").isNull(), "removed")
        .when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    )
    return (
        a.join(b, keys, "full_outer")
        .select(*keys, change.alias("change"))
        .where(F.col("change").isNotNull())
    )
