"""Vertex and edge tables of the lineage graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomhouse.lineage.documents import (
    PROPERTIES,
    derivations,
    documented_tables,
    mapping_pairs,
    script_tables,
    source_entries,
    target_columns,
)
from loomhouse.lineage.identifiers import split_table
from loomhouse.operators.skew import salted_join
from loomhouse.session import materialize

# Unique key of each vertex label and the pairs of labels an edge joins.
VERTEX_KEYS = {
    "Pipeline": "name",
    "Script": "name",
    "Schema": "name",
    "Table": "full_name",
    "Column": "full_name",
}
EDGE_LABELS = {
    "CONTAINS_SCRIPT": [("Pipeline", "Script")],
    "IN_SCHEMA": [("Table", "Schema")],
    "IN_TABLE": [("Column", "Table")],
    "DERIVED_FROM": [("Column", "Column")],
    "READS_FROM": [("Script", "Column")],
    "GENERATES": [("Script", "Column")],
    "PRODUCES_OUTPUT_TABLE": [("Script", "Table")],
    "USES_INPUT_TABLE": [("Script", "Table")],
    "DEPENDS_ON": [("Pipeline", "Pipeline"), ("Script", "Script")],
}
EDGE_TRIPLES = [(a, kind, b) for kind, pairs in EDGE_LABELS.items() for a, b in pairs]


def _vertex(label: str, key: Column, name: Column, kind: Column, forced: bool, *seq) -> Column:
    return F.struct(
        F.lit(label).alias("label"),
        key.alias("key"),
        name.alias("name"),
        kind.cast("string").alias("type"),
        F.lit(forced).alias("forced"),
        F.struct(*[s.alias(f"s{i}") for i, s in enumerate(seq)]).alias("seq"),
    )


def _file_parts() -> tuple[Column, Column, Column]:
    schema, table = F.col("file.schema"), F.col("file.table")
    return schema, table, F.when(F.col("file").isNotNull(), F.concat_ws(".", schema, table))


def vertex_mentions(documents: DataFrame, derived: DataFrame) -> DataFrame:
    """``(label, key, name, type, forced, seq)``: one small row per mention."""
    none = F.lit(None)
    place = F.col("file_name")
    zero = F.lit(0)
    schema, table = split_table(F.col("target"))
    f_schema, f_table, f_full = _file_parts()
    per_document = documents.select(
        F.explode(
            F.array(
                _vertex("Pipeline", F.col("pipeline"), F.col("pipeline"), none, False, place, zero, zero, zero),
                _vertex("Script", F.col("script"), F.col("script"), F.lit("SQL"), False, place, zero, zero, zero),
                _vertex("Schema", f_schema, f_schema, none, False, place, F.lit(1), zero, zero),
                _vertex("Table", f_full, f_table, F.lit("FILE"), True, place, F.lit(1), zero, zero),
                _vertex("Schema", schema, schema, none, False, place, F.lit(2), zero, zero),
                _vertex("Table", F.col("target"), table, none, False, place, F.lit(2), zero, zero),
            )
        ).alias("v")
    )
    per_target = target_columns(documents).select(
        _vertex(
            "Column", F.concat_ws(".", "target", "target_column"), F.col("target_column"),
            none, False, place, F.lit(3), F.col("col_pos"), F.lit(-1),
        ).alias("v")
    )
    at = (place, F.lit(3), F.col("col_pos"), F.col("src_pos"))
    per_source = derived.select(
        F.explode(
            F.array(
                _vertex("Schema", F.col("source_schema"), F.col("source_schema"), none, False, *at),
                _vertex("Table", F.col("source_table_full"), F.col("source_table"), F.lit("TABLE"), False, *at),
                _vertex("Column", F.col("source_full"), F.col("source_column"), none, False, *at),
            )
        ).alias("v")
    )
    mentions = per_document.unionByName(per_target).unionByName(per_source).select("v.*")
    return mentions.where(F.coalesce("key", F.lit("")) != "")


def vertices(documents: DataFrame, derived: DataFrame | None = None) -> DataFrame:
    """``(label, key, name, type)``: every vertex the documents mention.

    The first mention in document order sets name and type; a file source
    makes its table a FILE whatever came first. Each mention becomes one small
    row and the merge is a plain aggregate. ``derived`` are the derivation rows
    of the documents, where they are stored already.
    """
    if derived is None:
        derived = derivations(source_entries(documents))
    forced = F.max(F.when(F.col("forced"), F.col("type")))
    return (
        vertex_mentions(documents, derived)
        .groupBy("label", "key")
        .agg(
            F.min_by("name", "seq").alias("name"),
            F.coalesce(forced, F.min_by("type", "seq")).alias("type"),
        )
    )


def merged_derivations(derived: DataFrame) -> DataFrame:
    """One row per (target column, source column).

    Each property keeps the last value present, in document order.
    """
    seq = F.struct("file_name", "col_pos", "src_pos")
    return derived.groupBy(
        F.col("target_full").alias("target_column"), F.col("source_full").alias("source_column")
    ).agg(
        *[
            F.max_by(F.col(p), F.when(F.col(p).isNotNull(), seq)).alias(p)
            for p in PROPERTIES
        ]
    )


def script_columns(derived: DataFrame) -> DataFrame:
    """Distinct ``(script, edge_type, column)``: columns read and generated."""
    pair = F.explode(
        F.array(
            F.struct(F.lit("READS_FROM").alias("edge_type"), F.col("source_full").alias("column")),
            F.struct(F.lit("GENERATES").alias("edge_type"), F.col("target_full").alias("column")),
        )
    )
    return derived.select("script", pair.alias("e")).select("script", "e.*").distinct()


def edges(
    documents: DataFrame, *dependencies: DataFrame, derived: DataFrame | None = None
) -> DataFrame:
    """``(edge_type, src, dst)`` of all edges.

    Structure, derivations and the tables of a script come from the documents;
    ``dependencies`` are frames ``(src, dst)`` of pipelines or scripts, as
    ``dependency_edges`` gives them; ``derived`` as for ``vertices``.
    """
    if derived is None:
        derived = derivations(source_entries(documents))

    def edge(kind: str, src: Column, dst: Column) -> Column:
        return F.struct(F.lit(kind).alias("edge_type"), src.alias("src"), dst.alias("dst"))

    schema, _ = split_table(F.col("target"))
    f_schema, _, f_full = _file_parts()
    per_document = documents.select(
        F.explode(
            F.array(
                edge("CONTAINS_SCRIPT", F.col("pipeline"), F.col("script")),
                edge("IN_SCHEMA", f_full, f_schema),
                edge("IN_SCHEMA", F.col("target"), schema),
            )
        ).alias("e")
    )
    per_target = target_columns(documents).select(
        edge("IN_TABLE", F.concat_ws(".", "target", "target_column"), F.col("target")).alias("e")
    )
    per_source = derived.select(
        F.explode(
            F.array(
                edge("IN_SCHEMA", F.col("source_table_full"), F.col("source_schema")),
                edge("IN_TABLE", F.col("source_full"), F.col("source_table_full")),
                edge("DERIVED_FROM", F.col("target_full"), F.col("source_full")),
                edge("READS_FROM", F.col("script"), F.col("source_full")),
                edge("GENERATES", F.col("script"), F.col("target_full")),
            )
        ).alias("e")
    )
    per_table = script_tables(documents).select(
        "edge_type", F.col("script").alias("src"), F.col("table_full_name").alias("dst")
    )
    present = (F.coalesce("src", F.lit("")) != "") & (F.coalesce("dst", F.lit("")) != "")
    found = per_document.unionByName(per_target).unionByName(per_source).select("e.*")
    found = found.unionByName(per_table)
    for needs in dependencies:
        found = found.unionByName(needs.select(F.lit("DEPENDS_ON").alias("edge_type"), "src", "dst"))
    return found.where(present).distinct()


def enrich_columns(documents: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog columns (type, key text, comment) of every documented table."""
    return salted_join(catalog, documented_tables(documents), ["table_full_name"]).select(
        "table_full_name",
        F.concat_ws(".", "table_full_name", "column").alias("column_full_name"),
        F.col("column").alias("name"),
        "type",
        "description",
        "comment",
    )


def vertex_properties(vertex_rows: DataFrame, columns: DataFrame, texts: DataFrame) -> DataFrame:
    """Vertices with what the catalog and the script files know of them.

    ``columns`` are catalog columns as ``enrich_columns`` gives them; a column
    no document mentions becomes a vertex. ``texts`` has ``name``, ``path`` and
    ``content`` of script files, at most one row per name; files without vertex
    are left out. One aggregate over all rows, one row per vertex and origin.
    """
    known = vertex_rows.select("label", "key", "name", "type", F.lit(0).alias("origin"))
    described = columns.select(
        F.lit("Column").alias("label"), F.col("column_full_name").alias("key"), "name", "type",
        "description", "comment", F.lit(1).alias("origin"),
    )
    written = texts.select(
        F.lit("Script").alias("label"), F.col("name").alias("key"),
        F.col("path").alias("path_to_sql"), F.col("content").alias("sql_content"),
        F.lit(2).alias("origin"),
    )
    rows = known.unionByName(described, allowMissingColumns=True).unionByName(
        written, allowMissingColumns=True
    )
    typed = F.when(F.col("type").isNotNull(), F.col("origin"))
    return (
        rows.groupBy("label", "key")
        .agg(
            F.min("origin").alias("_origin"),
            F.min_by("name", "origin").alias("name"),
            F.max_by("type", typed).alias("type"),
            *[F.max(c).alias(c) for c in ("description", "comment", "path_to_sql", "sql_content")],
        )
        .where("_origin < 2")
        .drop("_origin")
    )


def dependency_edges(
    texts: DataFrame, names: DataFrame, name: str, last_only: bool = False
) -> DataFrame:
    """Distinct ``(src, dst)`` dependencies whose ends both exist in ``names``.

    ``texts`` holds ``{name: [prerequisite, ...]}``. ``last_only`` keeps just
    the last prerequisite of each name, as the graph loader does.
    """
    pairs = mapping_pairs(texts).select(
        F.col("parent").alias("src"), F.col("child").alias("dst"), "position"
    )
    if last_only:
        pairs = pairs.groupBy("src").agg(F.max_by("dst", "position").alias("dst"))
    pairs = materialize(pairs.select("src", "dst").distinct(), "dependencies")
    known = names.select(name).distinct()
    both = salted_join(pairs, known.select(F.col(name).alias("src")), ["src"], "left_semi")
    found = salted_join(both, known.select(F.col(name).alias("dst")), ["dst"], "left_semi")
    return found.select("src", "dst")


def schema_triples(edge_rows: DataFrame, vertex_rows: DataFrame) -> DataFrame:
    """Distinct ``(from_label, edge_type, to_label)`` of a graph.

    Edge ends are matched to vertices by key within the labels the edge type
    may join.
    """
    may_join = F
    for kind, pairs in EDGE_LABELS.items():
        ends = [F.struct(F.lit(a).alias("from_label"), F.lit(b).alias("to_label")) for a, b in pairs]
        may_join = may_join.when(F.col("edge_type") == kind, F.array(*ends))
    labelled = edge_rows.select("edge_type", "src", "dst", F.explode(may_join).alias("l")).select(
        "edge_type", "src", "dst", "l.*"
    )
    starts = vertex_rows.select(F.col("label").alias("from_label"), F.col("key").alias("src"))
    ends = vertex_rows.select(F.col("label").alias("to_label"), F.col("key").alias("dst"))
    with_start = salted_join(labelled, starts, ["from_label", "src"], "left_semi")
    with_both = salted_join(
        with_start, ends, ["to_label", "dst"], "left_semi", profile=labelled
    )
    return with_both.select("from_label", "edge_type", "to_label").distinct()


def duplicate_keys(vertex_rows: DataFrame) -> DataFrame:
    """Vertex keys that occur more than once per label."""
    return (
        vertex_rows.groupBy("label", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def attach_texts(scripts: DataFrame, texts: DataFrame) -> DataFrame:
    """Script vertices with the path and text of their file, where there is one.

    ``texts`` has at most one row per name.
    """
    side = texts.select(
        F.col("name").alias("script"),
        F.col("path").alias("path_to_sql"),
        F.col("content").alias("sql_content"),
    )
    return salted_join(scripts, side, ["script"], "left")


def text_counts(scripts: DataFrame, texts: DataFrame) -> DataFrame:
    """How many script files found their vertex and how many did not."""
    known = scripts.select("script", F.lit(True).alias("_known")).distinct()
    names = texts.select(F.col("name").alias("script"))
    return salted_join(names, known, ["script"], "left").agg(
        F.count("_known").alias("updated"),
        F.count(F.when(F.col("_known").isNull(), 1)).alias("not_found"),
    )
