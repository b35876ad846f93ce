"""Walks over derivation and dependency edges ``(src, dst)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.operators.skew import hot_keys, salted_join
from loomhouse.session import materialize


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def derivation_paths(edges: DataFrame, starts: DataFrame, node: str = "node") -> DataFrame:
    """Every path that leaves a start node along the edges.

    One row per path: ``start``, the last edge (``src``, ``dst``), ``depth``
    and ``path``, the nodes from the start to the end. A path never repeats an
    edge, so cycles end. Each level is written before the next is formed, so
    plans stay flat and a lost executor costs one level.
    """
    step = materialize(edges.select("src", "dst").distinct(), "edges")
    first = salted_join(
        step, starts.select(F.col(node).alias("src")).distinct(), ["src"], "left_semi"
    ).select(
        F.col("src").alias("start"), "src", "dst", F.lit(1).alias("depth"),
        F.array("src", "dst").alias("path"),
    )
    levels = []
    level = materialize(first, "paths")
    while not level.isEmpty():
        levels.append(level)
        tips = level.select(
            "start", F.col("dst").alias("src"), F.col("depth").alias("_depth"),
            F.col("path").alias("_path"),
        )
        grown = salted_join(tips, step, ["src"])
        # an edge can only repeat where its start was passed before
        passed = F.array_position("_path", F.col("src")) < F.size("_path")
        walked = passed & F.exists(
            F.arrays_zip(
                F.slice("_path", 1, F.size("_path") - 1).alias("a"),
                F.slice("_path", 2, F.size("_path") - 1).alias("b"),
            ),
            lambda e: (e["a"] == F.col("src")) & (e["b"] == F.col("dst")),
        )
        level = materialize(
            grown.where(~walked).select(
                "start", "src", "dst", (F.col("_depth") + 1).alias("depth"),
                F.concat("_path", F.array("dst")).alias("path"),
            ),
            "paths",
        )
    return _union_all(levels) if levels else level


def reachable(edges: DataFrame, starts: DataFrame, node: str = "node") -> DataFrame:
    """``(start, node, depth)``: nodes reached from each start, nearest depth.

    Keeps the set of reached pairs, so every pair is expanded once, also on
    cyclic graphs. The start itself is reported only if a cycle leads back.
    """
    step = materialize(edges.select("src", "dst").distinct(), "edges")
    hot = materialize(hot_keys(step, ["src"]), "hot-nodes")
    frontier = materialize(
        starts.select(F.col(node).alias("start"), F.col(node).alias("node")).distinct(),
        "frontier",
    )
    levels: list[DataFrame] = []
    depth = 0
    while True:
        depth += 1
        side = frontier.select("start", F.col("node").alias("src"))
        found = (
            salted_join(step, side, ["src"], spread_right=True, hot=hot)
            .select("start", F.col("dst").alias("node"))
            .distinct()
        )
        if levels:
            seen = _union_all([l.select("start", "node") for l in levels])
            found = found.join(seen, ["start", "node"], "left_anti")
        frontier = materialize(found.withColumn("depth", F.lit(depth)), "frontier")
        if frontier.isEmpty():
            return _union_all(levels) if levels else frontier
        levels.append(frontier)


def load_levels(edges: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """``(node, level)``: level 0 has no prerequisite, else longest path to one.

    ``edges`` point from a node to its prerequisite. Nodes on or behind a cycle
    can never load and get a null level. The edges are written once; each level
    lowers the number of missing prerequisites of the nodes still waiting.
    """
    needs = materialize(edges.select("src", "dst").distinct(), "needs")
    hot = materialize(hot_keys(needs, ["dst"]), "hot-prerequisites")
    counts = needs.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("missing"))
    waiting = materialize(
        nodes.select(F.col(node).alias("node")).distinct()
        .join(counts, "node", "left")
        .select("node", F.coalesce("missing", F.lit(0)).alias("missing")),
        "waiting",
    )
    levels: list[DataFrame] = []
    while True:
        ready = materialize(waiting.where("missing = 0").select("node"), "ready")
        if ready.isEmpty():
            stuck = waiting.select("node", F.lit(None).cast("int").alias("level"))
            return _union_all([*levels, stuck])
        levels.append(ready.withColumn("level", F.lit(len(levels))))
        met = (
            salted_join(needs, ready.select(F.col("node").alias("dst")), ["dst"], hot=hot)
            .groupBy(F.col("src").alias("node"))
            .agg(F.count(F.lit(1)).alias("met"))
        )
        waiting = materialize(
            waiting.where("missing > 0")
            .join(met, "node", "left")
            .select("node", (F.col("missing") - F.coalesce("met", F.lit(0))).alias("missing")),
            "waiting",
        )


def relational_edges(
    column_lineage: DataFrame, columns: DataFrame, tables: DataFrame, schemas: DataFrame
) -> DataFrame:
    """Derivation edges ``(src, dst)`` by full name from the relational model."""
    named = (
        columns.withColumnRenamed("name", "_column")
        .join(tables.withColumnRenamed("name", "_table"), "table_id")
        .join(schemas.withColumnRenamed("name", "_schema"), "schema_id")
        .select("column_id", F.concat_ws(".", "_schema", "_table", "_column").alias("full_name"))
    )
    target = named.select(
        F.col("column_id").alias("to_column_id"), F.col("full_name").alias("src")
    )
    source = named.select(
        F.col("column_id").alias("from_column_id"), F.col("full_name").alias("dst")
    )
    with_target = salted_join(column_lineage, target, ["to_column_id"])
    return salted_join(
        with_target, source, ["from_column_id"], profile=column_lineage
    ).select("src", "dst")
