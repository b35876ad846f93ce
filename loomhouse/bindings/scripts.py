"""Script registry, pipeline mapping, dependencies, reviews and usage runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.bindings.registry import query, table
from loomhouse.lineage.closure import load_levels
from loomhouse.lineage.cycles import load_order
from loomhouse.lineage.documents import resolve_scripts, script_pipelines
from loomhouse.lineage.graph import attach_texts, dependency_edges, text_counts
from loomhouse.lineage.reviews import (
    issues,
    review_blocks,
    script_summary,
    usage_rows,
)
from loomhouse.operators.aggregates import usage_stats
from loomhouse.session import fresh_folder
from loomhouse.sources.files import read_whole_texts, write_folders


def padded(c: str):
    return F.lpad(F.col(c).cast("string"), 10, "0")


def mapping_texts(spark, sf):
    """Per customer a mapping of its nation's pipeline to its two scripts."""
    pipeline = F.concat(F.lit("load_"), "c_nationkey")
    scripts = F.array(
        F.concat(F.lit("cust"), "c_custkey", F.lit(".sql")),
        F.concat(F.lit("shared"), F.col("c_custkey") % 50, F.lit(".sql")),
    )
    return table(spark, sf, "customer").select(
        padded("c_custkey").alias("name"),
        F.to_json(F.create_map(pipeline, scripts)).alias("content"),
    )


_MAPPING_SQL = """
    m AS (SELECT 'cust' || c_custkey || '.sql' AS script, c_nationkey, c_custkey, 0 AS p
          FROM customer
          UNION ALL
          SELECT 'shared' || c_custkey % 50 || '.sql', c_nationkey, c_custkey, 1 FROM customer),
    s AS (SELECT script, 'load_' || arg_max(c_nationkey, c_custkey * 2 + p) AS pipeline,
                 min(c_custkey * 2 + p) AS position FROM m GROUP BY script)"""


@query("script_mapping_invert", f"WITH {_MAPPING_SQL} SELECT script, pipeline FROM s")
def q_mapping_invert(spark, sf):
    return script_pipelines(mapping_texts(spark, sf)).select("script", "pipeline")


@query(
    "script_name_resolve",
    f"""
    WITH {_MAPPING_SQL},
    st AS (SELECT o_orderkey,
                  CASE WHEN o_orderstatus = 'F' THEN 'cust' || o_custkey || '.sql'
                       WHEN o_orderstatus = 'O' THEN 'cust' || o_custkey || '_' || o_orderkey
                       WHEN o_orderpriority = '5-LOW' THEN 'other' || o_custkey
                       ELSE 'shared' || o_custkey || '.sql' END AS stem FROM orders),
    u AS (SELECT DISTINCT stem FROM st),
    hit AS (SELECT stem, s.*, CASE WHEN stem = script THEN 0 ELSE 1 END AS r
            FROM u JOIN s ON stem = script OR starts_with(stem, replace(script, '.sql', ''))),
    best AS (SELECT stem, arg_min(script, r * 1000000000 + position) AS script,
                    arg_min(pipeline, r * 1000000000 + position) AS pipeline
             FROM hit GROUP BY stem)
    SELECT o_orderkey, stem, script, pipeline FROM st JOIN best USING (stem)""",
)
def q_script_name_resolve(spark, sf):
    """Order-shaped file stems: exact names, prefixes, and unknown ones."""
    cust = F.concat(F.lit("cust"), "o_custkey")
    stem = (
        F.when(F.col("o_orderstatus") == "F", F.concat(cust, F.lit(".sql")))
        .when(F.col("o_orderstatus") == "O", F.concat(cust, F.lit("_"), "o_orderkey"))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("other"), "o_custkey"))
        .otherwise(F.concat(F.lit("shared"), "o_custkey", F.lit(".sql")))
    )
    stems = table(spark, sf, "orders").select("o_orderkey", stem.alias("stem"))
    return resolve_scripts(stems, script_pipelines(mapping_texts(spark, sf)))


def dependency_texts(spark, sf):
    """Orders need their customer and its nation, customers their nation, and so on."""
    orders = table(spark, sf, "orders").repartition("o_orderkey").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"),
    )

    def texts(df, key: str, prefix: str, *needs):
        name = F.concat(F.lit(prefix), key)
        return df.select(
            F.concat(F.lit(prefix), padded(key)).alias("name"),
            F.to_json(F.create_map(name, F.array(*needs))).alias("content"),
        )

    def node(prefix: str, key: str):
        return F.concat(F.lit(prefix), key)

    return (
        texts(orders, "o_orderkey", "o", node("c", "o_custkey"), node("n", "c_nationkey"), F.lit("absent"))
        .unionByName(texts(table(spark, sf, "customer"), "c_custkey", "c", node("n", "c_nationkey")))
        .unionByName(texts(table(spark, sf, "nation"), "n_nationkey", "n", node("r", "n_regionkey")))
    )


def pipeline_names(spark, sf):
    keys = {"orders": ("o", "o_orderkey"), "customer": ("c", "c_custkey"),
            "nation": ("n", "n_nationkey"), "region": ("r", "r_regionkey")}
    frames = [
        table(spark, sf, t).select(F.concat(F.lit(p), k).alias("pipeline"))
        for t, (p, k) in keys.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


_DEPS_SQL = """
    SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders
    UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
    UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation"""


@query(
    "dependency_edges",
    _DEPS_SQL
    + """
    UNION SELECT 'o' || o_orderkey, 'n' || c_nationkey
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def q_dependency_edges(spark, sf):
    return dependency_edges(dependency_texts(spark, sf), pipeline_names(spark, sf), "pipeline")


@query(
    "dependency_edges_last",
    """
    SELECT 'c' || c_custkey AS src, 'n' || c_nationkey AS dst FROM customer
    UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation""",
)
def q_dependency_edges_last(spark, sf):
    """As the graph loader does: the last prerequisite only (orders end in an unknown one)."""
    return dependency_edges(
        dependency_texts(spark, sf), pipeline_names(spark, sf), "pipeline", last_only=True
    )


@query(
    "load_order_levels",
    """
    SELECT 'o' || o_orderkey AS pipeline, 3 AS level FROM orders
    UNION ALL SELECT 'c' || c_custkey, 2 FROM customer
    UNION ALL SELECT 'n' || n_nationkey, 1 FROM nation
    UNION ALL SELECT 'r' || r_regionkey, 0 FROM region""",
)
def q_load_order_levels(spark, sf):
    names = pipeline_names(spark, sf)
    needs = dependency_edges(dependency_texts(spark, sf), names, "pipeline")
    return load_levels(needs, names, "pipeline").withColumnRenamed("node", "pipeline")


_RING_SQL = """
    needs AS (
        SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders
        UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
        UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
        UNION SELECT 'n' || n_nationkey, 'n' || (n_nationkey + 5) % 25 FROM nation WHERE n_nationkey % 5 = 1
        UNION SELECT 'r' || r_regionkey, 'r' || (r_regionkey + 1) % 3 FROM region WHERE r_regionkey < 3
        UNION SELECT 'r' || r_regionkey, 'r' || r_regionkey FROM region WHERE r_regionkey = 3),
    reach AS (SELECT src, dst FROM needs UNION SELECT r.src, n.dst FROM reach r JOIN needs n ON n.src = r.dst),
    on_ AS (SELECT a.src AS node, min(a.dst) AS cycle FROM reach a
            JOIN reach b ON b.src = a.dst AND b.dst = a.src GROUP BY a.src),
    stuck AS (SELECT DISTINCT src FROM reach WHERE dst IN (SELECT node FROM on_)
              UNION SELECT node FROM on_)"""


@query(
    "load_order_cycles",
    f"""
    WITH RECURSIVE {_RING_SQL},
    p AS (SELECT 'o' || o_orderkey AS pipeline, 3 AS depth FROM orders
          UNION ALL SELECT 'c' || c_custkey, 2 FROM customer
          UNION ALL SELECT 'n' || n_nationkey, 1 FROM nation
          UNION ALL SELECT 'r' || r_regionkey, 0 FROM region)
    SELECT pipeline, CASE WHEN s.src IS NULL THEN depth END AS level, cycle,
           s.src IS NOT NULL AND cycle IS NULL AS behind
    FROM p LEFT JOIN on_ ON node = pipeline LEFT JOIN stuck s ON s.src = pipeline""",
)
def q_load_order_cycles(spark, sf):
    """Orders need customers, these nations, these regions; some of these need each other."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")

    def pair(df, a, src, b, dst):
        return df.select(
            F.concat(F.lit(a), src).alias("src"), F.concat(F.lit(b), dst).alias("dst")
        )

    needs = [
        pair(orders, "o", F.col("o_orderkey"), "c", F.col("o_custkey")),
        pair(customer, "c", F.col("c_custkey"), "n", F.col("c_nationkey")),
        pair(nation, "n", F.col("n_nationkey"), "r", F.col("n_regionkey")),
        pair(nation.where("n_nationkey % 5 = 1"), "n", F.col("n_nationkey"), "n", (F.col("n_nationkey") + 5) % 25),
        pair(region.where("r_regionkey < 3"), "r", F.col("r_regionkey"), "r", (F.col("r_regionkey") + 1) % 3),
        pair(region.where("r_regionkey = 3"), "r", F.col("r_regionkey"), "r", F.col("r_regionkey")),
    ]
    edges = reduce(DataFrame.unionByName, needs)
    return load_order(edges, pipeline_names(spark, sf), "pipeline").withColumnRenamed(
        "node", "pipeline"
    )


def script_files(spark, sf):
    """Customer scripts of the positive balances, one file per script row."""
    return table(spark, sf, "customer").where("c_acctbal >= 0").select(
        F.concat(F.lit("cust"), "c_custkey", F.lit(".sql")).alias("name"),
        F.concat(F.lit("sql/"), "c_nationkey", F.lit("/cust"), "c_custkey", F.lit(".sql")).alias("path"),
        F.concat(F.lit("SELECT * FROM t\nWHERE k = "), "c_custkey").alias("content"),
    )


@query(
    "script_registry",
    f"""
    WITH {_MAPPING_SQL}
    SELECT script, pipeline,
           'sql/' || c_nationkey || '/cust' || c_custkey || '.sql' AS path_to_sql,
           'SELECT * FROM t' || chr(10) || 'WHERE k = ' || c_custkey AS sql_content
    FROM s LEFT JOIN customer ON script = 'cust' || c_custkey || '.sql' AND c_acctbal >= 0""",
)
def q_script_registry(spark, sf):
    scripts = script_pipelines(mapping_texts(spark, sf))
    return attach_texts(scripts.drop("position"), script_files(spark, sf))


@query(
    "script_text_counts",
    """
    SELECT count(*) FILTER (WHERE known) AS updated, count(*) FILTER (WHERE NOT known) AS not_found
    FROM (SELECT c_mktsegment <> 'BUILDING' AS known FROM customer WHERE c_acctbal >= 0)""",
)
def q_script_text_counts(spark, sf):
    """Script files whose customer has no script vertex count as not found."""
    scripts = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.concat(F.lit("cust"), "c_custkey", F.lit(".sql")).alias("script")
    )
    return text_counts(scripts, script_files(spark, sf))


@query(
    "script_files_read",
    """
    SELECT s_suppkey, 'SELECT * FROM t' || chr(10) || 'WHERE k = ' || s_suppkey AS content
    FROM supplier""",
)
def q_script_files_read(spark, sf):
    """Script files of the suppliers, a folder each, read back whole."""
    folder = fresh_folder(spark, "scripts")
    write_folders(
        table(spark, sf, "supplier").select(
            F.concat(F.lit("SELECT * FROM t\nWHERE k = "), "s_suppkey").alias("value"),
            F.col("s_suppkey").alias("k"),
        ),
        "k", folder,
    )
    texts = read_whole_texts(spark, folder, "*.txt")
    number = F.regexp_extract("path", r"k=(\d+)/", 1).cast("long")
    return texts.select(
        number.alias("s_suppkey"), F.regexp_replace("content", "\n$", "").alias("content")
    )


def review_texts(spark, sf):
    """A review text of three blocks per order; some blocks are not JSON."""
    cust = F.concat(F.lit("c"), "o_custkey", F.lit(".sql"))
    note = F.concat(F.lit("price {"), F.col("o_orderkey"), F.lit("} is off"))
    notes = F.when(F.col("o_orderstatus") == "F", F.array(note, F.lit("check"))).otherwise(
        F.array().cast("array<string>")
    )
    first = F.concat(
        F.lit('{\n "price": '), F.to_json(notes), F.lit(',\n "status": []\n}')
    )
    second = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit('{\n "x": [oops\n}')).otherwise(
        F.lit('{\n "x": ["a.b.sql is fine"],\n "y": null\n}')
    )
    return table(spark, sf, "orders").repartition("o_orderkey").select(
        padded("o_orderkey").alias("name"),
        F.concat(
            cust, F.lit(":\n"), first,
            F.col("o_orderpriority"), F.lit(".sql:\n"), second, F.lit("\n"),
            F.lit("last.sql: {}"),
        ).alias("content"),
    )


_BLOCKS_SQL = """
    b AS (SELECT 'c' || o_custkey || '.sql' AS script, 2 AS total,
                 CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS err,
                 CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS ok FROM orders
          UNION ALL
          SELECT o_orderpriority || '.sql', CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 2 END,
                 1, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END FROM orders
          UNION ALL SELECT 'last.sql', 0, 0, 0 FROM orders)"""


@query(
    "review_summary",
    f"""
    WITH {_BLOCKS_SQL}
    SELECT script, count(*) AS blocks, CAST(sum(total) AS BIGINT) AS total_columns,
           CAST(sum(err) AS BIGINT) AS error_count, CAST(sum(ok) AS BIGINT) AS ok_columns
    FROM b GROUP BY script
    UNION ALL
    SELECT NULL, count(*), CAST(sum(total) AS BIGINT), CAST(sum(total) - sum(ok) AS BIGINT),
           CAST(sum(ok) AS BIGINT) FROM b""",
)
def q_review_summary(spark, sf):
    return script_summary(review_blocks(review_texts(spark, sf)))


@query(
    "review_issues",
    """
    SELECT 'c' || o_custkey || '.sql' AS script, 'price' AS column,
           unnest(['price {' || o_orderkey || '} is off', 'check']) AS issue
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderpriority || '.sql', CASE WHEN o_orderpriority <> '1-URGENT' THEN 'x' END,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'JSON parse error'
                ELSE 'a.b.sql is fine' END FROM orders""",
)
def q_review_issues(spark, sf):
    return issues(review_blocks(review_texts(spark, sf)))


def usage_texts(spark, sf):
    """A usage run file of two prompts per document."""

    def prompt(file, asked, answered):
        return F.struct(
            F.struct(file.alias("sql_file_name")).alias("prompt_details"),
            F.struct(asked.alias("query_tokens_used"), answered.alias("answer_tokens_used")).alias("usage"),
        )

    key = F.col("doc_id")
    run = F.struct(
        F.col("lang").alias("template_name"),
        F.array(
            prompt(F.concat(F.lit("d"), key), F.col("n_chars"), key % 97),
            prompt(F.concat(F.lit("e"), key), key % 89, F.col("n_chars") % 50),
        ).alias("individual_prompts_metadata"),
    )
    return table(spark, sf, "documents").select(
        padded("doc_id").alias("name"), F.to_json(run).alias("content")
    )


def _usage_sql(group: str) -> str:
    measures = []
    for m in ("query_tokens", "answer_tokens"):
        measures.append(
            f"""min({m}) AS min_{m}, max({m}) AS max_{m}, round(avg({m}), 4) AS avg_{m},
            CAST(sum({m}) AS BIGINT) AS sum_{m},
            arg_min(file, {m} * 1000000000000 + doc_id * 2 + pos) AS file_at_min_{m},
            arg_min(file, -{m} * 1000000000000 + doc_id * 2 + pos) AS file_at_max_{m}"""
        )
    return f"""
    WITH u AS (SELECT doc_id, lang AS template_name, 0 AS pos, 'd' || doc_id AS file,
                      n_chars AS query_tokens, doc_id % 97 AS answer_tokens FROM documents
               UNION ALL
               SELECT doc_id, lang, 1, 'e' || doc_id, doc_id % 89, n_chars % 50 FROM documents)
    SELECT {group + ',' if group else ''} {', '.join(measures)} FROM u
    {'GROUP BY ' + group if group else ''}"""


def _usage(spark, sf, group: list[str]):
    measures = ["query_tokens", "answer_tokens"]
    stats = usage_stats(usage_rows(usage_texts(spark, sf)), group, measures, "file", ["name", "pos"])
    return stats.withColumns({f"avg_{m}": F.round(f"avg_{m}", 4) for m in measures})


@query("usage_stats", _usage_sql("template_name"))
def q_usage_stats(spark, sf):
    return _usage(spark, sf, ["template_name"])


@query("usage_stats_total", _usage_sql(""))
def q_usage_stats_total(spark, sf):
    return _usage(spark, sf, [])
