"""Lineage documents of orders, their graph, walks and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.bindings.history import TABLES
from loomhouse.bindings.registry import query, stored, table
from loomhouse.bindings.scripts import padded
from loomhouse.lineage import graph as lg
from loomhouse.lineage.audit import class_counts, edge_directions, run_difference, script_extract
from loomhouse.lineage.closure import derivation_paths, reachable, relational_edges
from loomhouse.lineage.cycles import reachable_in_order
from loomhouse.lineage.documents import (
    attach_scripts,
    derivations,
    parse_documents,
    rejected_entries,
    script_pipelines,
    script_tables,
    source_entries,
)
from loomhouse.lineage.increment import StoredGraph, merge_documents
from loomhouse.lineage.identifiers import (
    normalize_table,
    parse_column,
    parse_quoted,
    rewrite_csv_call,
)
from loomhouse.lineage.retrieval import nearest, nearest_many, with_neighbours
from loomhouse.lineage.vector_index import build_index, recall
from loomhouse.session import fresh_folder, materialize
from loomhouse.sources.catalog import catalog_of, register_files, session_catalog
from loomhouse.sources.files import read_whole_texts, write_folders


def document_texts(spark, sf) -> DataFrame:
    """The document files, written once."""
    return stored(spark, sf, "document-texts", lambda: _document_texts(spark, sf))


def _document_texts(spark, sf) -> DataFrame:
    """One lineage document per order.

    The target is a table of the ordering customer, so the documents of a
    customer merge. Every tenth document is cut off and does not parse.
    """
    key = F.col("o_orderkey")
    status, digit = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    own = F.concat(F.lit("c"), "o_custkey")
    none = F.lit(None).cast("string")
    paths = F.array(F.lit("s.price"))
    side = "struct<identifier:string,path:array<string>>"

    def source(identifier, role, kind=none, logic=none, notes=none, path=None, join=False):
        empty = F.lit(None)
        join_info = F.struct(
            F.lit("INNER JOIN").alias("type"),
            F.struct(F.lit("a.k").alias("identifier"), F.array(F.lit("k")).alias("path")).alias("left_source"),
            F.struct(F.lit("b.k").alias("identifier"), F.array(F.lit("k")).alias("path")).alias("right_source"),
        )
        info = f"struct<type:string,left_source:{side},right_source:{side}>"
        return F.struct(
            identifier.alias("source_identifier"),
            (paths if path else empty.cast("array<string>")).alias("path"),
            F.lit(role).alias("role"),
            (join_info if join else empty).cast(info).alias("join_info"),
            kind.alias("transformation_type"), logic.alias("transformation_logic"),
            notes.alias("notes"),
        )

    def column(kind, logic, *sources):
        return F.struct(
            F.array(*sources).alias("sources"), kind.alias("transformation_type"),
            logic.alias("transformation_logic"), none.alias("notes"),
        )

    price = column(
        F.lit("CAST"),
        F.concat(F.lit("cast "), key),
        source(F.concat(F.lit("wh.src_"), status, F.lit(".price")), "direct input",
               notes=F.when(key % 2 == 0, F.concat(F.lit("n"), key)), path=True),
        source(F.lit("stage.total"), "join key", F.lit("JOIN_LOOKUP"), join=True),
    )
    prio = column(
        F.lit("DIRECT INPUT"),
        F.when(digit == "1", F.lit("COPY from file")),
        source(F.concat(F.lit("file.c"), digit), "direct input"),
        source(F.lit("1"), "constant"),
    )
    mentions = F.array(
        F.struct(F.lit("TABLE").alias("type"), F.concat(F.lit("wh.src_"), status).alias("name"),
                 F.when(key % 3 == 0, F.concat(F.lit("a"), key)).alias("alias_or_cte")),
        F.struct(F.when(status == "O", "CTE").otherwise("FILE").alias("type"),
                 F.concat(F.lit("data\\in"), digit, F.lit("/p"), digit, F.lit(".csv")).alias("name"),
                 none.alias("alias_or_cte")),
    )
    doc = F.to_json(
        F.struct(
            F.when(status == "P", own).otherwise(F.concat(F.lit("wh."), own)).alias("target_table"),
            mentions.alias("sources_summary"),
            F.create_map(F.lit("price"), price, F.lit("prio"), prio).alias("lineage"),
        )
    )
    cut = F.when(key % 10 == 9, doc.substr(F.lit(1), F.length(doc) - 5)).otherwise(doc)
    return table(spark, sf, "orders").repartition("o_orderkey").select(
        F.concat(F.lit("cust"), padded("o_custkey"), F.lit("_"), padded("o_orderkey"), F.lit(".json")).alias("name"),
        cut.alias("content"),
    )


def script_map(spark, sf) -> DataFrame:
    """A script per customer with positive balance, in its nation's pipeline."""
    texts = table(spark, sf, "customer").where("c_acctbal > 0").select(
        padded("c_custkey").alias("name"),
        F.to_json(
            F.create_map(
                F.concat(F.lit("load_"), "c_nationkey"),
                F.array(F.concat(F.lit("cust"), padded("c_custkey"), F.lit(".sql"))),
            )
        ).alias("content"),
    )
    return script_pipelines(texts)


def documents(spark, sf) -> DataFrame:
    """The documents with their script, loaded once and read by every query."""

    def build():
        parsed, _ = parse_documents(document_texts(spark, sf))
        return attach_scripts(parsed, script_map(spark, sf))

    return stored(spark, sf, "documents", build)


def derived(spark, sf) -> DataFrame:
    return stored(
        spark, sf, "derivations", lambda: derivations(source_entries(documents(spark, sf)))
    )


def merged(spark, sf) -> DataFrame:
    return stored(
        spark, sf, "merged-derivations", lambda: lg.merged_derivations(derived(spark, sf))
    )


def io_columns(spark, sf) -> DataFrame:
    return stored(spark, sf, "script-columns", lambda: lg.script_columns(derived(spark, sf)))


def vertex_table(spark, sf) -> DataFrame:
    return stored(
        spark, sf, "vertices", lambda: lg.vertices(documents(spark, sf), derived(spark, sf))
    )


def edge_table(spark, sf) -> DataFrame:
    return stored(
        spark,
        sf,
        "edges",
        lambda: lg.edges(
            documents(spark, sf),
            pipeline_needs(spark, sf),
            script_needs(spark, sf),
            derived=derived(spark, sf),
        ),
    )


def needs_of(spark, sf, rows: DataFrame, key: str, prefix: str, end: str, names: str) -> DataFrame:
    """Each key needs the key before it and one that nobody knows."""

    def node(k):
        return F.concat(F.lit(prefix), k, F.lit(end))

    before = F.lpad((F.col(key) - 1).cast("string"), 10, "0") if end else F.col(key) - 1
    own = padded(key) if end else F.col(key)
    texts = rows.select(
        padded(key).alias("name"),
        F.to_json(F.create_map(node(own), F.array(node(before), F.lit("absent")))).alias("content"),
    )
    return lg.dependency_edges(texts, documents(spark, sf), names)


def pipeline_needs(spark, sf) -> DataFrame:
    return needs_of(spark, sf, table(spark, sf, "nation"), "n_nationkey", "load_", "", "pipeline")


def script_needs(spark, sf) -> DataFrame:
    return needs_of(spark, sf, table(spark, sf, "customer"), "c_custkey", "cust", ".sql", "script")


# The documents as rows: doc = parsed documents with a script, e = source entries.
_DOCS_SQL = """
    doc AS (
        SELECT *, substr(o_orderpriority, 1, 1) AS digit,
               CASE WHEN o_orderstatus = 'P' THEN 'main.c' ELSE 'wh.c' END || o_custkey AS target,
               'cust' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '.sql' AS script,
               'load_' || c_nationkey AS pipeline,
               'cust' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '_'
                   || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.json' AS file_name,
               CASE WHEN o_orderstatus <> 'O' THEN 'data.in' || substr(o_orderpriority, 1, 1)
               END AS fschema,
               CASE WHEN o_orderstatus <> 'O' THEN 'p' || substr(o_orderpriority, 1, 1) || '.csv'
               END AS ftable
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderkey % 10 <> 9 AND c_acctbal > 0),
    e AS (
        SELECT doc.*, 0 AS col_pos, 0 AS src_pos, target || '.price' AS tgt, 'wh' AS sschema,
               'src_' || o_orderstatus AS stable, 'price' AS scol,
               'CAST' AS transformation_type, 'cast ' || o_orderkey AS transformation_logic,
               's.price' AS path, 'direct input' AS role, FALSE AS has_join,
               CASE WHEN o_orderkey % 2 = 0 THEN 'n' || o_orderkey END AS notes FROM doc
        UNION ALL
        SELECT doc.*, 0, 1, target || '.price', 'main', 'stage', 'total', 'JOIN_LOOKUP',
               'cast ' || o_orderkey, NULL, 'join key', TRUE, NULL FROM doc
        UNION ALL
        SELECT doc.*, 1, 0, target || '.prio', coalesce(fschema, 'main'), coalesce(ftable, 'file'),
               'c' || digit, CASE WHEN digit = '1' THEN 'FILE_LOAD' ELSE 'DIRECT INPUT' END,
               CASE WHEN digit = '1' THEN 'COPY from file' END, NULL, 'direct input', FALSE, NULL
        FROM doc),
    ed AS (SELECT *, sschema || '.' || stable || '.' || scol AS src FROM e)"""

# Dependencies of pipelines and scripts that both occur in the documents.
_NEEDS_SQL = """
    known AS (SELECT DISTINCT c_nationkey AS n, o_custkey AS c, pipeline, script FROM doc),
    needs AS (
        SELECT DISTINCT 'Pipeline' AS label, a.pipeline AS src, b.pipeline AS dst
        FROM known a JOIN known b ON b.n = a.n - 1
        UNION SELECT 'Script', a.script, b.script FROM known a JOIN known b ON b.c = a.c - 1)"""

_MERGED_SQL = """
    mg AS (
        SELECT tgt AS target_column, src AS source_column,
               arg_max(transformation_type, file_name) AS transformation_type,
               arg_max(transformation_logic, file_name) AS transformation_logic,
               arg_max(path, file_name) AS path, arg_max(role, file_name) AS role,
               bool_or(has_join) AS has_join, arg_max(notes, file_name) AS notes
        FROM ed GROUP BY ALL)"""


# A join as the documents write it.
_JOIN_SQL = """'{"type":"INNER JOIN","left_source":{"identifier":"a.k","path":["k"]},'
    || '"right_source":{"identifier":"b.k","path":["k"]}}'"""


@query(
    "lineage_docs_parse",
    rf"""
    SELECT 'cust' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '_'
               || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.json' AS file_name,
           CASE WHEN o_orderkey % 10 = 9 THEN NULL WHEN o_orderstatus = 'P' THEN 'main.c' || o_custkey
                ELSE 'wh.c' || o_custkey END AS target,
           CASE WHEN o_orderkey % 10 <> 9 THEN '[{{"type":"TABLE","name":"wh.src_' || o_orderstatus || '"'
               || CASE WHEN o_orderkey % 3 = 0 THEN ',"alias_or_cte":"a' || o_orderkey || '"' ELSE '' END
               || '}},{{"type":"' || CASE WHEN o_orderstatus = 'O' THEN 'CTE' ELSE 'FILE' END
               || '","name":"data\\in' || substr(o_orderpriority, 1, 1) || '/p'
               || substr(o_orderpriority, 1, 1) || '.csv"}}]' END AS summary,
           CASE WHEN o_orderkey % 10 <> 9 THEN '{{"price":{{"sources":[{{"source_identifier":"wh.src_'
               || o_orderstatus || '.price","path":["s.price"],"role":"direct input"'
               || CASE WHEN o_orderkey % 2 = 0 THEN ',"notes":"n' || o_orderkey || '"' ELSE '' END
               || '}},{{"source_identifier":"stage.total","role":"join key","join_info":' || {_JOIN_SQL}
               || ',"transformation_type":"JOIN_LOOKUP"}}],"transformation_type":"CAST",'
               || '"transformation_logic":"cast ' || o_orderkey
               || '"}},"prio":{{"sources":[{{"source_identifier":"file.c' || substr(o_orderpriority, 1, 1)
               || '","role":"direct input"}},{{"source_identifier":"1","role":"constant"}}],'
               || '"transformation_type":"DIRECT INPUT"'
               || CASE WHEN starts_with(o_orderpriority, '1')
                  THEN ',"transformation_logic":"COPY from file"' ELSE '' END || '}}}}' END AS lineage,
           o_orderkey % 10 = 9 AS rejected
    FROM orders""",
)
def q_docs_parse(spark, sf):
    parsed, rejects = parse_documents(document_texts(spark, sf))
    good = parsed.select(
        "file_name", "target", F.to_json("sources_summary").alias("summary"),
        F.to_json("lineage").alias("lineage"), F.lit(False).alias("rejected"),
    )
    bad = rejects.select("file_name", F.lit(True).alias("rejected"))
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    "lineage_docs_read",
    """
    SELECT 'd' || s_suppkey || '.json' AS file_name, 'wh.s' || s_nationkey AS target,
           unnest(['balance', 'name']) AS target_column,
           unnest(['stage.' || s_suppkey, 'src.people.name']) AS source_identifier,
           unnest(['wh', 'copied']) AS role
    FROM supplier""",
)
def q_docs_read(spark, sf):
    """One JSON file per supplier, in a folder each, read whole and parsed."""

    def column(identifier, role: str):
        source = F.struct(identifier.alias("source_identifier"), F.lit(role).alias("role"))
        return F.struct(F.array(source).alias("sources"))

    doc = F.struct(
        F.concat(F.lit("wh.s"), "s_nationkey").alias("target_table"),
        F.create_map(
            F.lit("balance"), column(F.concat(F.lit("stage."), "s_suppkey"), "wh"),
            F.lit("name"), column(F.lit("src.people.name"), "copied"),
        ).alias("lineage"),
    )
    folder = fresh_folder(spark, "documents")
    write_folders(
        table(spark, sf, "supplier").select(F.to_json(doc).alias("value"), F.col("s_suppkey").alias("k")),
        "k", folder,
    )
    number = F.regexp_extract("path", r"k=(\d+)/", 1)
    texts = read_whole_texts(spark, folder, "*.txt").select(
        F.concat(F.lit("d"), number, F.lit(".json")).alias("name"), "content"
    )
    parsed, _ = parse_documents(texts)
    entries = source_entries(parsed.withColumn("script", F.lit(None).cast("string")))
    return entries.select("file_name", "target", "target_column", "source_identifier", "role")


@query(
    "lineage_identifier_parse",
    """
    WITH i AS (SELECT o_orderkey, o_orderkey % 6 AS f, o_custkey AS k,
                      o_orderstatus <> 'O' AS has_file FROM orders)
    SELECT o_orderkey,
           CASE f WHEN 0 THEN 's' || k WHEN 1 THEN 'main'
                  WHEN 2 THEN CASE WHEN has_file THEN 'dir' ELSE 'main' END
                  WHEN 3 THEN 'a.b' END AS schema_name,
           CASE f WHEN 0 THEN 't' WHEN 1 THEN 't' || k
                  WHEN 2 THEN CASE WHEN has_file THEN 'x.csv' ELSE 'file' END
                  WHEN 3 THEN 'f' || k END AS table_name,
           CASE f WHEN 0 THEN 'c' WHEN 1 THEN 'c' WHEN 2 THEN 'c' || k
                  WHEN 3 THEN 'file_content' END AS column_name
    FROM i""",
)
def q_identifier_parse(spark, sf):
    """Three parts, two parts, file placeholder, quoted file, constant, missing."""
    k, form = F.col("o_custkey"), F.col("o_orderkey") % 6
    identifier = (
        F.when(form == 0, F.concat(F.lit("s"), k, F.lit(".t.c")))
        .when(form == 1, F.concat(F.lit("t"), k, F.lit(".c")))
        .when(form == 2, F.concat(F.lit("file.c"), k))
        .when(form == 3, F.concat(F.lit('"a.b.f'), k, F.lit('.csv"')))
        .when(form == 4, F.concat(F.lit("constant_value_"), k))
    )
    file = F.when(
        F.col("o_orderstatus") != "O",
        F.struct(F.lit("dir").alias("schema"), F.lit("x.csv").alias("table")),
    )
    parsed = parse_column(identifier, file)
    return table(spark, sf, "orders").select(
        "o_orderkey", parsed["schema"].alias("schema_name"), parsed["table"].alias("table_name"),
        parsed["column"].alias("column_name"),
    )


@query(
    "lineage_identifier_quoted",
    """
    WITH i AS (SELECT o_orderkey, o_orderkey % 6 AS f, o_custkey AS k FROM orders)
    SELECT o_orderkey,
           CASE f WHEN 0 THEN 'my.schema' || k WHEN 1 THEN 'main' WHEN 2 THEN 'db.s' || k
                  WHEN 3 THEN 'a"b' WHEN 4 THEN 's' END AS schema_name,
           CASE f WHEN 0 THEN 't' WHEN 1 THEN 'my.t' || k WHEN 2 THEN 't' WHEN 3 THEN 'x.y'
                  WHEN 4 THEN 't' END AS table_name,
           CASE f WHEN 0 THEN 'c' WHEN 1 THEN 'c' WHEN 2 THEN 'c' WHEN 3 THEN 'd' || k
                  WHEN 4 THEN 'c' || k END AS column_name
    FROM i""",
)
def q_identifier_quoted(spark, sf):
    """Quoted parts with dots and doubled quotes, four parts, an open quote."""
    k, form = F.col("o_custkey"), F.col("o_orderkey") % 6
    identifier = (
        F.when(form == 0, F.concat(F.lit('"my.schema'), k, F.lit('".t.c')))
        .when(form == 1, F.concat(F.lit('"my.t'), k, F.lit('"."c"')))
        .when(form == 2, F.concat(F.lit("db.s"), k, F.lit(".t.c")))
        .when(form == 3, F.concat(F.lit('"a""b"."x.y"."d'), k, F.lit('"')))
        .when(form == 4, F.concat(F.lit("s.t.c"), k))
        .otherwise(F.concat(F.lit('"open'), k, F.lit(".t.c")))
    )
    parsed = parse_quoted(identifier, F.lit(None).cast("struct<schema: string, table: string>"))
    return table(spark, sf, "orders").select(
        "o_orderkey", parsed["schema"].alias("schema_name"), parsed["table"].alias("table_name"),
        parsed["column"].alias("column_name"),
    )


@query(
    "lineage_table_normalize",
    """
    WITH i AS (SELECT o_orderkey, o_orderkey % 5 AS f, o_custkey AS k FROM orders)
    SELECT o_orderkey,
           CASE f WHEN 0 THEN 'src.da_ta.f' || k || '_old' WHEN 1 THEN 'main.t' || k
                  WHEN 2 THEN 'wh.t' || k WHEN 3 THEN 'file_sources.src_b_h' || k
                  ELSE '' END AS table_full_name
    FROM i""",
)
def q_table_normalize(spark, sf):
    """Quoted file, bare name, dotted name, csv call, missing name."""
    k, form = F.col("o_custkey"), F.col("o_orderkey") % 5
    name = (
        F.when(form == 0, F.concat(F.lit('"src/da.ta\\f'), k, F.lit('.old.TXT"')))
        .when(form == 1, F.concat(F.lit("t"), k))
        .when(form == 2, F.concat(F.lit("wh.t"), k))
        .when(form == 3, F.concat(F.lit("read_csv('/src/b\\h"), k, F.lit(".csv', header=False)")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", normalize_table(rewrite_csv_call(name)).alias("table_full_name")
    )


@query(
    "lineage_edges_extract",
    f"""
    WITH {_DOCS_SQL}
    SELECT file_name, script, tgt AS target_full, src AS source_full, col_pos, src_pos,
           transformation_type, transformation_logic, path, role,
           CASE WHEN has_join THEN {_JOIN_SQL} END AS join_info, notes FROM ed""",
)
def q_edges_extract(spark, sf):
    return derived(spark, sf).select(
        "file_name", "script", "target_full", "source_full", "col_pos", "src_pos",
        "transformation_type", "transformation_logic", F.array_join("path", ",").alias("path"),
        "role", "join_info", "notes",
    )


@query(
    "lineage_rejects",
    f"""
    WITH {_DOCS_SQL}
    SELECT file_name, script, target, 'prio' AS target_column, 1 AS src_pos,
           '1' AS source_identifier FROM doc""",
)
def q_lineage_rejects(spark, sf):
    return rejected_entries(source_entries(documents(spark, sf)))


_VERTEX_SQL = """
    m AS (
        SELECT 'Pipeline' AS label, pipeline AS key, pipeline AS name, NULL AS type FROM doc
        UNION SELECT 'Script', script, script, 'SQL' FROM doc
        UNION SELECT 'Schema', split_part(target, '.', 1), split_part(target, '.', 1), NULL FROM doc
        UNION SELECT 'Table', target, split_part(target, '.', 2), NULL FROM doc
        UNION SELECT 'Column', tgt, split_part(tgt, '.', 3), NULL FROM ed
        UNION SELECT 'Schema', sschema, sschema, NULL FROM ed
        UNION SELECT 'Table', sschema || '.' || stable, stable,
                     CASE WHEN ftable = stable THEN 'FILE' ELSE 'TABLE' END FROM ed
        UNION SELECT 'Column', src, scol, NULL FROM ed)"""


@query(
    "lineage_vertices",
    f"""
    WITH {_DOCS_SQL}, {_VERTEX_SQL} SELECT * FROM m""",
)
def q_vertices(spark, sf):
    return vertex_table(spark, sf)


@query(
    "lineage_vertex_properties",
    f"""
    WITH {_DOCS_SQL}, {_VERTEX_SQL},
    cat AS (
        SELECT 'Column' AS label, 'wh.c' || c_custkey || '.' || col AS key, col AS name,
               CASE col WHEN 'price' THEN 'double' ELSE 'timestamp' END AS type,
               CASE col WHEN 'price' THEN 'Primary Key: true' END AS description,
               'of ' || c_name AS comment
        FROM customer, (VALUES ('price'), ('loaded')) v(col)
        WHERE 'wh.c' || c_custkey IN (SELECT target FROM doc)),
    t AS (SELECT 'cust' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '.sql' AS key, c_custkey
          FROM customer)
    SELECT coalesce(m.label, cat.label) AS label, coalesce(m.key, cat.key) AS key,
           coalesce(m.name, cat.name) AS name, coalesce(cat.type, m.type) AS type,
           cat.description, cat.comment, 'sql/' || t.key AS path_to_sql,
           'SELECT ' || t.c_custkey AS sql_content
    FROM m FULL JOIN cat ON m.label = cat.label AND m.key = cat.key
         LEFT JOIN t ON m.label = 'Script' AND m.key = t.key""",
)
def q_vertex_properties(spark, sf):
    """A catalog of two columns per customer table and the text of every script."""
    customers = table(spark, sf, "customer")
    own = F.concat(F.lit("wh.c"), "c_custkey").alias("table_full_name")
    note = F.concat(F.lit("of "), "c_name").alias("comment")

    def column(name: str, kind: str, description):
        return customers.select(
            own, F.lit(name).alias("column"), F.lit(kind).alias("type"),
            F.lit(description).cast("string").alias("description"), note,
        )

    catalog = column("price", "double", "Primary Key: true").unionByName(
        column("loaded", "timestamp", None)
    )
    name = F.concat(F.lit("cust"), padded("c_custkey"), F.lit(".sql"))
    texts = customers.select(
        name.alias("name"), F.concat(F.lit("sql/"), name).alias("path"),
        F.concat(F.lit("SELECT "), "c_custkey").alias("content"),
    )
    columns = lg.enrich_columns(documents(spark, sf), catalog)
    return lg.vertex_properties(vertex_table(spark, sf), columns, texts)


@query(
    "lineage_edges_merge",
    f"""
    WITH {_DOCS_SQL}, {_MERGED_SQL}
    SELECT * EXCLUDE (has_join), CASE WHEN has_join THEN {_JOIN_SQL} END AS join_info FROM mg""",
)
def q_edges_merge(spark, sf):
    return merged(spark, sf).select(
        "target_column", "source_column", "transformation_type", "transformation_logic",
        F.array_join("path", ",").alias("path"), "role",
        "join_info", "notes",
    )


_EDGES_SQL = f"""
    WITH {_DOCS_SQL}, {_NEEDS_SQL}
    SELECT 'CONTAINS_SCRIPT' AS edge_type, pipeline AS src, script AS dst FROM doc
    UNION SELECT 'DEPENDS_ON', src, dst FROM needs
    UNION SELECT 'PRODUCES_OUTPUT_TABLE', script, target FROM doc
    UNION SELECT 'USES_INPUT_TABLE', script, 'wh.src_' || o_orderstatus FROM doc
    UNION SELECT 'IN_SCHEMA', target, split_part(target, '.', 1) FROM doc
    UNION SELECT 'IN_SCHEMA', fschema || '.' || ftable, fschema FROM doc WHERE ftable IS NOT NULL
    UNION SELECT 'IN_TABLE', tgt, target FROM ed
    UNION SELECT 'IN_SCHEMA', sschema || '.' || stable, sschema FROM ed
    UNION SELECT 'IN_TABLE', src, sschema || '.' || stable FROM ed
    UNION SELECT 'DERIVED_FROM', tgt, src FROM ed
    UNION SELECT 'READS_FROM', script, src FROM ed
    UNION SELECT 'GENERATES', script, tgt FROM ed"""


@query("lineage_graph_edges", _EDGES_SQL)
def q_graph_edges(spark, sf):
    return edge_table(spark, sf)


def grown_graph(spark, sf) -> StoredGraph:
    """The graph of two batches of documents whose file names interleave."""
    every = documents(spark, sf)
    early = F.col("target").startswith("wh.")
    folder = fresh_folder(spark, "graph")
    merge_documents(spark, folder, "B", every.where(~early), script_needs(spark, sf), buckets=16)
    return merge_documents(spark, folder, "A", every.where(early), pipeline_needs(spark, sf))


@query("graph_merge_increment", f"WITH {_DOCS_SQL}, {_VERTEX_SQL} SELECT * FROM m")
def q_graph_increment(spark, sf):
    """Vertices of a graph that took its documents in two batches."""
    return grown_graph(spark, sf).vertices()


@query("graph_edges_increment", _EDGES_SQL)
def q_graph_edges_increment(spark, sf):
    return grown_graph(spark, sf).edges()


@query(
    "script_io_columns",
    f"""
    WITH {_DOCS_SQL}
    SELECT script, 'READS_FROM' AS edge_type, src AS column FROM ed
    UNION SELECT script, 'GENERATES', tgt FROM ed""",
)
def q_script_io_columns(spark, sf):
    return io_columns(spark, sf)


@query(
    "script_io_tables",
    f"""
    WITH {_DOCS_SQL}
    SELECT script, 'PRODUCES_OUTPUT_TABLE' AS edge_type, target AS table_full_name,
           NULL AS alias_or_cte FROM doc GROUP BY ALL
    UNION ALL
    SELECT script, 'USES_INPUT_TABLE', 'wh.src_' || o_orderstatus,
           arg_max('a' || o_orderkey, file_name) FILTER (WHERE o_orderkey % 3 = 0)
    FROM doc GROUP BY ALL""",
)
def q_script_io_tables(spark, sf):
    return script_tables(documents(spark, sf))


@query(
    "graph_schema_triples",
    f"""
    WITH {_DOCS_SQL}, {_NEEDS_SQL}
    SELECT 'Pipeline' AS from_label, 'CONTAINS_SCRIPT' AS edge_type, 'Script' AS to_label FROM doc
    UNION SELECT 'Table', 'IN_SCHEMA', 'Schema' FROM doc
    UNION SELECT 'Script', 'PRODUCES_OUTPUT_TABLE', 'Table' FROM doc
    UNION SELECT 'Script', 'USES_INPUT_TABLE', 'Table' FROM doc
    UNION SELECT 'Column', 'IN_TABLE', 'Table' FROM ed
    UNION SELECT 'Column', 'DERIVED_FROM', 'Column' FROM ed
    UNION SELECT 'Script', 'READS_FROM', 'Column' FROM ed
    UNION SELECT 'Script', 'GENERATES', 'Column' FROM ed
    UNION SELECT label, 'DEPENDS_ON', label FROM needs""",
)
def q_schema_triples(spark, sf):
    return lg.schema_triples(edge_table(spark, sf), vertex_table(spark, sf))


@query(
    "script_dependency_edges",
    f"""
    WITH {_DOCS_SQL}, {_NEEDS_SQL} SELECT src, dst FROM needs WHERE label = 'Script'""",
)
def q_script_dependency_edges(spark, sf):
    """Scripts of customers need the script of the customer before."""
    return script_needs(spark, sf)


@query(
    "graph_key_check",
    """
    SELECT 'Part' AS label, p_name AS key, count(*) AS n FROM part GROUP BY ALL HAVING n > 1
    UNION ALL SELECT 'Order', CAST(l_orderkey AS VARCHAR), count(*) AS n FROM lineitem
    GROUP BY ALL HAVING n > 1""",
)
def q_key_check(spark, sf):
    """Part names, order keys and customer names as vertex keys; the last are unique."""

    def keyed(t: str, label: str, key: str):
        return table(spark, sf, t).select(
            F.lit(label).alias("label"), F.col(key).cast("string").alias("key")
        )

    rows = (
        keyed("part", "Part", "p_name")
        .unionByName(keyed("lineitem", "Order", "l_orderkey"))
        .unionByName(keyed("customer", "Customer", "c_name"))
    )
    return lg.duplicate_keys(rows)


@query(
    "edge_direction_audit",
    """
    SELECT l_returnflag AS f, l_linestatus AS s, l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_linenumber IN (3, 6) THEN 'invalid' WHEN l_linenumber IN (2, 7) THEN 'flip'
                ELSE 'ok' END AS verdict
    FROM lineitem""",
)
def q_edge_direction(spark, sf):
    """Lines as graph edges whose labels depend on the line number."""
    forms = [
        ("Table", "IN_SCHEMA", "Schema"),
        ("Schema", "IN_SCHEMA", "Table"),
        ("Script", "IN_SCHEMA", "Schema"),
        ("", "READS_FROM", "Column"),
        ("Column", "", "Column"),
        ("Pipeline", "", "Column"),
        ("Column", "GENERATES", ""),
    ]
    allowed = spark.createDataFrame(
        lg.EDGE_TRIPLES,
        "from_label string, edge_type string, to_label string",
    )
    pick = F.element_at(
        F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(allowed.columns, f)]) for f in forms]),
        F.col("l_linenumber"),
    )
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s"), "l_orderkey",
        "l_linenumber", "l_partkey", pick.alias("p"),
    )
    judged = edge_directions(rows.select("*", "p.*").drop("p"), allowed)
    return judged.drop("from_label", "edge_type", "to_label")


@query(
    "lineage_taxonomy_rollup",
    f"""
    WITH {_DOCS_SQL}, {_MERGED_SQL},
    c AS (SELECT regexp_replace(target_column, '\\.[^.]*$', '') AS table_full_name,
                 CASE WHEN role = 'join key' THEN 'INDIRECT' ELSE 'DIRECT' END AS lineage_class,
                 CASE WHEN role = 'join key' THEN 'Join' WHEN transformation_type = 'CAST'
                      THEN 'Transformation' ELSE 'Identity' END AS lineage_subclass FROM mg)
    SELECT *, count(*) AS n FROM c GROUP BY ALL""",
)
def q_taxonomy(spark, sf):
    return class_counts(merged(spark, sf))


@query(
    "lineage_audit_extract",
    f"""
    WITH {_DOCS_SQL}, {_MERGED_SQL}
    SELECT 'cust' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '.sql' AS script,
           'SELECT ' || c_custkey AS sql_content, NULL AS source_column, NULL AS target_column,
           NULL AS transformation_type, NULL AS transformation_logic
    FROM customer WHERE c_acctbal > 0
    UNION ALL
    SELECT DISTINCT g.script, NULL, mg.source_column, mg.target_column, mg.transformation_type,
           mg.transformation_logic
    FROM mg JOIN ed g ON g.tgt = mg.target_column
            JOIN ed r ON r.script = g.script AND r.src = mg.source_column
    WHERE mg.transformation_type <> 'DIRECT INPUT'""",
)
def q_audit_extract(spark, sf):
    texts = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.concat(F.lit("cust"), padded("c_custkey"), F.lit(".sql")).alias("name"),
        F.concat(F.lit("SELECT "), "c_custkey").alias("content"),
    )
    return script_extract(texts, io_columns(spark, sf), merged(spark, sf))


@query(
    "lineage_run_diff",
    f"""
    WITH {_DOCS_SQL}, {_MERGED_SQL},
    b AS (SELECT target_column, source_column,
                 CASE WHEN starts_with(target_column, 'main.') THEN lower(transformation_type)
                      ELSE transformation_type END AS t
          FROM mg WHERE source_column <> 'main.stage.total'
          UNION ALL SELECT target_column, 'new.src.col', 'CAST' FROM mg WHERE role = 'join key'),
    a AS (SELECT target_column, source_column, transformation_type AS t FROM mg)
    SELECT coalesce(a.target_column, b.target_column) AS target_column,
           coalesce(a.source_column, b.source_column) AS source_column,
           CASE WHEN a.target_column IS NULL THEN 'added' WHEN b.target_column IS NULL THEN 'removed'
                ELSE 'changed' END AS change
    FROM a FULL JOIN b ON a.target_column = b.target_column AND a.source_column = b.source_column
    WHERE a.target_column IS NULL OR b.target_column IS NULL OR a.t IS DISTINCT FROM b.t""",
)
def q_run_diff(spark, sf):
    """A second run that renames one source and changes some types."""
    before = merged(spark, sf)
    kind = F.col("transformation_type")
    after = before.withColumns(
        {
            "transformation_type": F.when(
                F.col("target_column").startswith("main."), F.lower(kind)
            ).otherwise(kind),
        }
    )
    renamed = after.where(F.col("role") == "join key").withColumns(
        {"source_column": F.lit("new.src.col"), "transformation_type": F.lit("CAST")}
    )
    after = after.where(F.col("role") != "join key").unionByName(renamed)
    return run_difference(before, after, ["transformation_type"])


_WALK_SQL = """
    ed AS (
        SELECT DISTINCT 'l' || l_orderkey || '.' || l_linenumber AS src, 'o' || l_orderkey AS dst
        FROM lineitem
        UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders
        UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
        UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation)"""


def walk_edges(spark, sf) -> DataFrame:
    """Lines derive from orders, orders from customers, and so on to regions."""

    def step(t: str, src, dst):
        return table(spark, sf, t).select(
            F.concat(*src).alias("src"), F.concat(*dst).alias("dst")
        )

    p = F.lit
    return (
        step("lineitem", (p("l"), "l_orderkey", p("."), "l_linenumber"), (p("o"), "l_orderkey"))
        .unionByName(step("orders", (p("o"), "o_orderkey"), (p("c"), "o_custkey")))
        .unionByName(step("customer", (p("c"), "c_custkey"), (p("n"), "c_nationkey")))
        .unionByName(step("nation", (p("n"), "n_nationkey"), (p("r"), "n_regionkey")))
    )


@query(
    "lineage_upstream_paths",
    f"""
    WITH RECURSIVE {_WALK_SQL},
    p AS (SELECT src AS start, src, dst, 1 AS depth, src || '>' || dst AS path FROM ed
          WHERE starts_with(src, 'l')
          UNION ALL
          SELECT p.start, ed.src, ed.dst, p.depth + 1, p.path || '>' || ed.dst
          FROM p JOIN ed ON ed.src = p.dst)
    SELECT * FROM p""",
)
def q_upstream_paths(spark, sf):
    edges = walk_edges(spark, sf)
    starts = edges.where(F.col("src").startswith("l")).select(F.col("src").alias("node"))
    paths = derivation_paths(edges, starts)
    return paths.withColumn("path", F.array_join("path", ">"))


_IMPACT_SQL = f"""
    WITH RECURSIVE {_WALK_SQL},
    p AS (SELECT dst AS start, src AS node, 1 AS depth FROM ed WHERE starts_with(dst, 'r')
          UNION ALL
          SELECT p.start, ed.src, p.depth + 1 FROM p JOIN ed ON ed.dst = p.node)
    SELECT * FROM p"""


def impact_walk(spark, sf) -> tuple[DataFrame, DataFrame]:
    flipped = walk_edges(spark, sf).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    regions = table(spark, sf, "region").select(
        F.concat(F.lit("r"), "r_regionkey").alias("node")
    )
    return flipped, regions


@query("lineage_downstream_impact", _IMPACT_SQL)
def q_downstream_impact(spark, sf):
    """Everything that goes unfilled when a region is missing."""
    return reachable(*impact_walk(spark, sf))


@query("lineage_impact_in_order", _IMPACT_SQL)
def q_impact_in_order(spark, sf):
    """The same, level by level of the graph."""
    return reachable_in_order(*impact_walk(spark, sf))


@query(
    "relational_paths",
    f"""
    WITH RECURSIVE
    named AS (SELECT c_custkey AS id, c_nationkey AS n,
                     r_name || '.' || n_name || '.' || c_name AS full_name
              FROM customer JOIN nation ON c_nationkey = n_nationkey
                   JOIN region ON n_regionkey = r_regionkey),
    ed AS (SELECT DISTINCT t.full_name AS src, s.full_name AS dst, t.n
           FROM orders JOIN named t ON t.id = o_custkey JOIN named s ON s.id = o_custkey // 2
           WHERE o_custkey <> o_custkey // 2),
    p AS (SELECT src AS start, src, dst, 1 AS depth, src || '>' || dst AS path FROM ed WHERE n = 7
          UNION ALL
          SELECT p.start, ed.src, ed.dst, p.depth + 1, p.path || '>' || ed.dst
          FROM p JOIN ed ON ed.src = p.dst)
    SELECT * FROM p""",
)
def q_relational_paths(spark, sf):
    """Regions as schemas, nations as tables, customers as columns.

    The column of an ordering customer derives from that of half its number;
    paths start at the columns of one table.
    """
    columns = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("column_id"), F.col("c_nationkey").alias("table_id"),
        F.col("c_name").alias("name"),
    )
    tables = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("table_id"), F.col("n_regionkey").alias("schema_id"),
        F.col("n_name").alias("name"),
    )
    schemas = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("schema_id"), F.col("r_name").alias("name")
    )
    links = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("to_column_id"),
        F.floor(F.col("o_custkey") / 2).alias("from_column_id"),
    ).where("to_column_id <> from_column_id").distinct()
    edges = relational_edges(links, columns, tables, schemas)
    starts = (
        columns.where("table_id = 7").withColumnRenamed("name", "_column")
        .join(tables.withColumnRenamed("name", "_table"), "table_id")
        .join(schemas, "schema_id")
        .select(F.concat_ws(".", "name", "_table", "_column").alias("node"))
    )
    paths = derivation_paths(edges, starts)
    return paths.withColumn("path", F.array_join("path", ">"))


@query(
    "lineage_catalog_enrich",
    """
    SELECT 'tpch.' || table_name AS table_full_name,
           'tpch.' || table_name || '.' || column_name AS column_full_name, column_name AS name,
           CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
                ELSE data_type END AS type,
           CASE WHEN column_name = 'o_orderkey' THEN 'Primary Key: true' END AS description,
           CASE WHEN table_name IN ('customer', 'orders')
                THEN column_name || ' of one ' || table_name END AS comment
    FROM information_schema.columns
    WHERE table_name IN ('customer', 'orders', 'lineitem', 'events')""",
)
def q_catalog_enrich(spark, sf):
    """One document per order names the tables; the session's catalog covers all tables."""
    picked = F.when(F.col("o_orderstatus") == "F", "tpch.orders").otherwise("tpch.customer")
    doc = F.to_json(
        F.struct(
            picked.alias("target_table"),
            F.array(
                F.struct(F.lit("TABLE").alias("type"), F.lit("tpch.lineitem").alias("name")),
                F.struct(F.lit("TABLE").alias("type"), F.lit("tpch.events").alias("name")),
                F.struct(F.lit("TABLE").alias("type"), F.lit("gone").alias("name")),
            ).alias("sources_summary"),
        )
    )
    texts = table(spark, sf, "orders").select(
        F.concat(padded("o_orderkey"), F.lit(".json")).alias("name"), doc.alias("content")
    )
    parsed, _ = parse_documents(texts)
    folder = fresh_folder(spark, "catalog")
    database = f"tpch_{folder[-32:]}"
    said = {
        t: {c: f"{c} of one {t}" for c in table(spark, sf, t).columns} for t in ("customer", "orders")
    }
    register_files(spark, database, folder, {t: f"{sf}/{t}.parquet" for t in TABLES}, said)
    known = {
        f"tpch.{name.split('.')[1]}": df for name, df in session_catalog(spark, database).items()
    }
    return lg.enrich_columns(parsed, catalog_of(spark, known, {"tpch.orders": ["o_orderkey"]}))


@query(
    "vector_topk",
    """
    WITH q AS (SELECT embedding AS e FROM embeddings ORDER BY vec_id LIMIT 1),
    s AS (SELECT vec_id, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]),
                 (SELECT CAST(e AS DOUBLE[]) FROM q)) AS score FROM embeddings)
    SELECT vec_id, 'label ' || label AS neighbour, round(score, 6) AS score
    FROM s ORDER BY s.score DESC, vec_id LIMIT 10""",
)
def q_vector_topk(spark, sf):
    """The ten vectors nearest to the first one, with their label vertex."""
    nodes = table(spark, sf, "embeddings")
    question = nodes.orderBy("vec_id").select("embedding").first()["embedding"]
    found = nearest(nodes, question, 10, "vec_id", "embedding")
    edges = nodes.select(
        F.col("vec_id").alias("src"), F.concat(F.lit("label "), "label").alias("dst")
    )
    return with_neighbours(found, edges, "vec_id").withColumn("score", F.round("score", 6))


_TOPK_SQL = """
    WITH s AS (
        SELECT q.vec_id AS question, v.vec_id AS node,
               round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]),
                     CAST(v.embedding AS DOUBLE[])), 6) AS score
        FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0)
    SELECT question, CAST(row_number() OVER (PARTITION BY question ORDER BY score DESC, node) AS INT) AS rank,
           node, score
    FROM s QUALIFY rank <= 10"""


def vector_questions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """All vectors, and as questions those whose id is divisible by 50."""
    nodes = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return nodes, nodes.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "question")


@query("vector_topk_many", _TOPK_SQL)
def q_vector_topk_many(spark, sf):
    """The ten vectors nearest to each vector whose id is divisible by 50."""
    nodes, questions = vector_questions(spark, sf)
    return nearest_many(nodes, questions, 10, "vec_id", "embedding")


@query("vector_topk_index")
def q_vector_topk_index(spark, sf):
    """The same by the index, with the share of the exact rows it found."""
    nodes, questions = vector_questions(spark, sf)
    index = build_index(nodes, "vec_id", "embedding")
    found = materialize(index.search(questions, 10, vector="embedding"), "found")
    exact = nearest_many(nodes, questions, 10, "vec_id", "embedding")
    return found.join(recall(found, exact), "question")


@query("vector_topk_bounded", _TOPK_SQL)
def q_vector_topk_bounded(spark, sf):
    """All of them by the index, with the lists its bounds leave open."""
    nodes, questions = vector_questions(spark, sf)
    return build_index(nodes, "vec_id", "embedding").search(
        questions, 10, exact=True, vector="embedding"
    )
