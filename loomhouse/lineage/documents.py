"""Lineage documents: parsing, script resolution and derivation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.lineage.identifiers import (
    file_table,
    normalize_table,
    parse_column,
    rewrite_csv_call,
)
from loomhouse.operators.skew import salted_join
from loomhouse.session import materialize

# Document structure.
_SIDE = "struct<identifier:string,path:array<string>>"
_NOTES = "transformation_type:string,transformation_logic:string,notes:string"
DOCUMENT_SCHEMA = f"""
    target_table string,
    sources_summary array<struct<type:string,name:string,alias_or_cte:string>>,
    lineage map<string,struct<
        sources:array<struct<source_identifier:string,path:array<string>,role:string,
            join_info:struct<type:string,left_source:{_SIDE},right_source:{_SIDE}>,{_NOTES}>>,
        {_NOTES}>>,
    _corrupt string
"""
PROPERTIES = ["transformation_type", "transformation_logic", "path", "role", "join_info", "notes"]


def parse_documents(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents and rejects from ``(name, content)`` rows.

    A document keeps its file name, and its ``read_csv`` source names are
    rewritten to file names. Malformed JSON goes to the rejects. The parsed
    rows are written once, so no text is parsed again by what follows.
    """
    parsed = materialize(
        texts.select(
            F.col("name").alias("file_name"),
            F.from_json(
                "content",
                DOCUMENT_SCHEMA,
                {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
            ).alias("d"),
        ),
        "parsed-documents",
    )
    broken = F.col("d").isNull() | F.col("d._corrupt").isNotNull()
    renamed = F.transform(
        "sources_summary", lambda s: s.withField("name", rewrite_csv_call(s["name"]))
    )
    documents = (
        parsed.where(~broken)
        .select("file_name", "d.target_table", "d.sources_summary", "d.lineage")
        .withColumn("sources_summary", renamed)
        .withColumn(
            "file",
            file_table(
                F.get(
                    F.filter(
                        "sources_summary",
                        lambda s: (s["type"] == "FILE") & (F.coalesce(s["name"], F.lit("")) != ""),
                    ),
                    F.lit(0),
                )["name"]
            ),
        )
        .withColumn("target", normalize_table(F.col("target_table")))
    )
    rejects = parsed.where(broken).select("file_name", F.col("d._corrupt").alias("content"))
    return documents, rejects


def script_pipelines(mapping_texts: DataFrame) -> DataFrame:
    """``(script, pipeline, position)`` from ``{pipeline: [script, ...]}`` texts.

    ``mapping_texts`` has ``name`` (order of the texts) and ``content``. A
    script listed more than once keeps its first position and its last
    pipeline.
    """
    pairs = mapping_pairs(mapping_texts)
    return pairs.groupBy(F.col("child").alias("script")).agg(
        F.max_by("parent", "position").alias("pipeline"), F.min("position").alias("position")
    )


def mapping_pairs(texts: DataFrame) -> DataFrame:
    """``(child, parent, position)`` rows of ``{parent: [child, ...]}`` texts."""
    return (
        texts.select("name", F.from_json("content", "map<string,array<string>>").alias("m"))
        .select("name", F.posexplode("m").alias("p", "parent", "children"))
        .select("name", "p", "parent", F.posexplode("children").alias("c", "child"))
        .select("child", "parent", F.struct("name", "p", "c").alias("position"))
    )


def resolve_scripts(
    stems: DataFrame, scripts: DataFrame, stem: str = "stem", spread: list[str] | None = None
) -> DataFrame:
    """Add ``script`` and ``pipeline`` to the stems that belong to a script.

    A stem is its script's name, or else starts with the script's name without
    ``.sql``; the first such script in mapping order wins. Stems without script
    are left out. The prefix test is an equi join on the prefixes of the stem
    that are as long as some script name.
    """
    names = scripts.select(
        "script", "pipeline", "position",
        F.explode(
            F.array(
                F.struct(F.col("script").alias("_prefix"), F.lit(0).alias("_rank")),
                F.struct(F.regexp_replace("script", r"\.sql", "").alias("_prefix"), F.lit(1).alias("_rank")),
            )
        ).alias("n"),
    ).select("n.*", "script", "pipeline", "position")
    candidates = stems.select(F.col(stem).alias("_stem")).distinct()
    # as many lengths as file names can have
    lengths = names.agg(F.collect_set(F.length("_prefix"))).scalar()
    prefixes = (
        candidates.select("_stem", F.explode(lengths).alias("_n"))
        .where(F.col("_n") <= F.length("_stem"))
        .select("_stem", F.substring("_stem", F.lit(1), F.col("_n")).alias("_prefix"))
    )
    hits = salted_join(
        prefixes, names, ["_prefix"],
        extra=(F.col("_rank") == 1) | (F.col("_stem") == F.col("_prefix")),
    )
    best = hits.groupBy("_stem").agg(
        F.min_by(F.struct("script", "pipeline"), F.struct("_rank", "position")).alias("s")
    )
    return salted_join(
        stems,
        best.select(F.col("_stem").alias(stem), "s.script", "s.pipeline"),
        [stem],
        spread=spread,
    )


def attach_scripts(documents: DataFrame, scripts: DataFrame) -> DataFrame:
    """Documents with their script and pipeline; others are left out."""
    stems = documents.withColumn("stem", F.regexp_replace("file_name", r"\.json$", ""))
    return resolve_scripts(stems, scripts, spread=["file_name"]).drop("stem")


def target_columns(documents: DataFrame) -> DataFrame:
    """One row per document and target column, in document order."""
    usable = documents.where(F.col("target") != "")
    return usable.select(
        "file_name", "script", "target", "file",
        F.posexplode("lineage").alias("col_pos", "target_column", "entry"),
    )


def source_entries(documents: DataFrame) -> DataFrame:
    """One row per source entry, with the parsed identifier and properties.

    A property of the source entry wins over the one of its column. ``parsed``
    is null for entries without a usable identifier.
    """
    rows = target_columns(documents).select(
        "file_name", "script", "target", "target_column", "col_pos", "file", "entry",
        F.posexplode("entry.sources").alias("src_pos", "s"),
    )
    identifier = F.col("s.source_identifier")
    logic = F.coalesce("s.transformation_logic", "entry.transformation_logic")
    kind = F.coalesce("s.transformation_type", "entry.transformation_type")
    is_copy = identifier.startswith("file.") & F.contains(logic, F.lit("COPY from file"))
    return rows.select(
        "file_name", "script", "target", "target_column", "col_pos", "src_pos",
        identifier.alias("source_identifier"),
        parse_column(identifier, F.col("file")).alias("parsed"),
        F.when(is_copy, F.lit("FILE_LOAD")).otherwise(kind).alias("transformation_type"),
        logic.alias("transformation_logic"),
        F.col("s.path").alias("path"),
        F.col("s.role").alias("role"),
        F.to_json("s.join_info").alias("join_info"),
        F.coalesce("s.notes", "entry.notes").alias("notes"),
    )


def derivations(entries: DataFrame) -> DataFrame:
    """Derivation rows: target column, source column and their position."""
    source_table = F.concat_ws(".", "parsed.schema", "parsed.table")
    return entries.where(F.col("parsed").isNotNull()).select(
        "file_name", "script", "col_pos", "src_pos", "target",
        F.concat_ws(".", "target", "target_column").alias("target_full"),
        F.col("parsed.schema").alias("source_schema"),
        F.col("parsed.table").alias("source_table"),
        F.col("parsed.column").alias("source_column"),
        source_table.alias("source_table_full"),
        F.concat_ws(".", source_table, "parsed.column").alias("source_full"),
        *PROPERTIES,
    )


def rejected_entries(entries: DataFrame) -> DataFrame:
    """Source entries that name no column (missing or bare identifiers)."""
    return entries.where(F.col("parsed").isNull()).select(
        "file_name", "script", "target", "target_column", "src_pos", "source_identifier"
    )


def documented_tables(documents: DataFrame) -> DataFrame:
    """Distinct tables named by the documents, as target or in the summary."""
    names = F.concat(F.array("target_table"), F.coalesce("sources_summary.name", F.array()))
    named = documents.select(F.explode(names).alias("n")).select(
        normalize_table(F.col("n")).alias("table_full_name")
    )
    usable = F.contains("table_full_name", F.lit(".")) & ~F.col("table_full_name").startswith(
        "csv_files."
    )
    return named.where(usable).distinct()


def script_tables(documents: DataFrame) -> DataFrame:
    """Tables a script produces and uses, with the alias of a used table.

    Of several documents or mentions the last alias that is present wins.
    """
    produced = documents.where(F.col("target") != "").select(
        "script", F.lit("PRODUCES_OUTPUT_TABLE").alias("edge_type"),
        F.col("target").alias("table_full_name"), F.lit(None).cast("string").alias("alias_or_cte"),
        F.struct("file_name", F.lit(-1).alias("p")).alias("seq"),
    )
    mentions = documents.select(
        "script", "file_name", F.posexplode("sources_summary").alias("p", "s")
    ).where((F.col("s.type") == "TABLE") & (F.coalesce("s.name", F.lit("")) != ""))
    first = (
        mentions.groupBy("script", "file_name", normalize_table(F.col("s.name")).alias("t"))
        .agg(F.min(F.struct("p", F.col("s.alias_or_cte").alias("alias"))).alias("m"))
        .select(
            "script", F.lit("USES_INPUT_TABLE").alias("edge_type"),
            F.col("t").alias("table_full_name"), F.col("m.alias").alias("alias_or_cte"),
            F.struct("file_name", "m.p").alias("seq"),
        )
    )
    alias = F.nullif("alias_or_cte", F.lit(""))
    return (
        produced.unionByName(first)
        .groupBy("script", "edge_type", "table_full_name")
        .agg(F.max_by(alias, F.when(alias.isNotNull(), F.col("seq"))).alias("alias_or_cte"))
    )
