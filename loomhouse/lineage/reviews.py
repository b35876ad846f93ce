"""Review texts (``<script>.sql:`` followed by a JSON object) and usage runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text is cut where a script's name ends and its object begins.
_CUT = r"\.sql:(?=\s*\{)"
_USAGE = """
    template_name string, execution_number int,
    individual_prompts_metadata array<struct<
        prompt_details:struct<sql_file_name:string>,
        usage:struct<query_tokens_used:bigint,answer_tokens_used:bigint>>>
"""


def review_blocks(texts: DataFrame) -> DataFrame:
    """One row per block of every review text: ``script``, ``notes``, ``parsed``.

    ``notes`` maps a column to its issues; ``parsed`` is false for a block
    whose body is not JSON or has no end. A name starts on its line, or after
    the brace that ends the block before; a body ends with its last brace.
    """
    cuts = F.size("_parts") - 1
    blocks = (
        texts.select("name", F.split("content", _CUT).alias("_parts"))
        .where(cuts > 0)
        .select(
            "name",
            F.posexplode(
                F.arrays_zip(
                    F.slice("_parts", F.lit(1), cuts).alias("s"),
                    F.slice("_parts", F.lit(2), cuts).alias("b"),
                )
            ).alias("pos", "x"),
        )
    )
    line = F.substring_index("x.s", "\n", -1)
    script = F.concat(F.trim(F.substring_index(line, "}", -1)), F.lit(".sql"))
    open_ = F.substr("x.b", F.instr("x.b", "{"))
    body = F.left(open_, F.length(open_) - F.length(F.substring_index(open_, "}", -1)))
    wrapped = F.from_json(
        F.concat(F.lit('{"m":'), body, F.lit("}")),
        "m map<string,array<string>>, _corrupt string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    return blocks.select("name", "pos", script.alias("script"), wrapped.alias("w")).select(
        "name", "pos", "script", F.col("w.m").alias("notes"),
        (F.col("w._corrupt").isNull() & F.col("w.m").isNotNull()).alias("parsed"),
    )


def block_summary(blocks: DataFrame) -> DataFrame:
    """Columns reviewed, with and without issues, per block.

    A block that did not parse counts as one error and no column.
    """
    issues = F.size(F.map_filter("notes", lambda _, v: F.coalesce(F.size(v) > 0, F.lit(False))))
    total = F.size("notes")
    return blocks.select(
        "name", "pos", "script",
        F.when(F.col("parsed"), total).otherwise(0).cast("long").alias("total_columns"),
        F.when(F.col("parsed"), issues).otherwise(1).cast("long").alias("error_count"),
        F.when(F.col("parsed"), total - issues).otherwise(0).cast("long").alias("ok_columns"),
    )


def script_summary(blocks: DataFrame) -> DataFrame:
    """The block figures per script, plus a total row with a null script.

    The total counts issues as reviewed columns minus clean columns.
    """
    rows = block_summary(blocks)

    def sums(error):
        return [
            F.count(F.lit(1)).alias("blocks"),
            F.coalesce(F.sum("total_columns"), F.lit(0)).alias("total_columns"),
            F.coalesce(F.sum(error), F.lit(0)).alias("error_count"),
            F.coalesce(F.sum("ok_columns"), F.lit(0)).alias("ok_columns"),
        ]

    per_script = rows.groupBy("script").agg(*sums(F.col("error_count")))
    total = rows.agg(*sums(F.col("total_columns") - F.col("ok_columns")))
    return per_script.unionByName(
        total.withColumn("script", F.lit(None).cast("string"))
    )


def issues(blocks: DataFrame) -> DataFrame:
    """One row per issue: ``script``, ``column``, ``issue``.

    A block that did not parse gives one row without column.
    """
    bad = blocks.where(~F.col("parsed")).select(
        "script", F.lit(None).cast("string").alias("column"), F.lit("JSON parse error").alias("issue")
    )
    good = (
        blocks.where("parsed")
        .select("script", F.explode("notes").alias("column", "found"))
        .select("script", "column", F.explode("found").alias("issue"))
    )
    return good.unionByName(bad)


def usage_rows(texts: DataFrame) -> DataFrame:
    """One row per prompt of every usage run file."""
    return (
        texts.select("name", F.from_json("content", _USAGE).alias("r"))
        .select(
            "name", "r.template_name", F.posexplode("r.individual_prompts_metadata").alias("pos", "p")
        )
        .select(
            "name",
            "template_name",
            "pos",
            F.col("p.prompt_details.sql_file_name").alias("file"),
            F.col("p.usage.query_tokens_used").alias("query_tokens"),
            F.col("p.usage.answer_tokens_used").alias("answer_tokens"),
        )
    )
