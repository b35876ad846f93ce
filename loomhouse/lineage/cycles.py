"""Cycles of a dependency graph, named by their members, and walks in its order.

Strongly connected components without one node or path meeting in a task:
edges that cannot lie on a cycle are trimmed, the largest name is carried
forward until each node knows the largest that reaches it, and from every node
that kept its own name the nodes of that name are searched backwards. Those are
one component each; the rest goes on. Each step is an aggregate or an equi join
on stored tables, all components of a round are found side by side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.lineage.closure import load_levels
from loomhouse.operators.skew import hot_keys, salted_join
from loomhouse.session import fresh_folder, materialize
from loomhouse.sources.store import Store


class _Arcs:
    """Edges with the nodes that very many of them share, which joins spread."""

    def __init__(self, arcs: DataFrame):
        self.hot = {end: materialize(hot_keys(arcs, [end]), "hot-ends") for end in ("src", "dst")}

    def join(self, arcs: DataFrame, side: DataFrame, end: str, how: str = "inner") -> DataFrame:
        return salted_join(arcs, side, [end], how, hot=self.hot[end])

    def trimmed(self, arcs: DataFrame) -> DataFrame:
        """Without edges whose start nothing leads to or whose end leads nowhere."""
        while True:
            entered = arcs.select(F.col("dst").alias("src")).distinct()
            left = arcs.select(F.col("src").alias("dst")).distinct()
            kept = self.join(self.join(arcs, entered, "src", "left_semi"), left, "dst", "left_semi")
            kept = materialize(kept, "trimmed")
            if kept.count() == arcs.count():
                return kept
            arcs = kept

    def colored(self, arcs: DataFrame) -> DataFrame:
        """``(node, color)``: the largest node that reaches each node, itself included."""
        nodes = arcs.select(F.col("src").alias("node")).distinct()
        colors = materialize(nodes.withColumn("color", F.col("node")), "colors")
        while True:
            pushed = (
                self.join(arcs, colors.withColumnRenamed("node", "src"), "src")
                .groupBy(F.col("dst").alias("node"))
                .agg(F.max("color").alias("pushed"))
            )
            step = materialize(
                colors.join(pushed, "node", "left").select(
                    "node",
                    F.greatest("color", "pushed").alias("color"),
                    (F.col("pushed") > F.col("color")).alias("moved"),
                ),
                "colors",
            )
            colors = step.select("node", "color")
            if step.where("moved").isEmpty():
                return colors

    def components(self, inside: DataFrame, colors: DataFrame) -> DataFrame:
        """``(node, color)`` of the nodes that reach the node of their color.

        ``inside`` are the edges between nodes of one color.
        """
        level = materialize(colors.where("node = color"), "backward")
        levels = [level]
        while True:
            before = (
                self.join(inside, level.select(F.col("node").alias("dst")), "dst")
                .select(F.col("src").alias("node"), "color")
                .distinct()
            )
            seen = reduce(DataFrame.union, levels).select("node")
            level = materialize(before.join(seen, "node", "left_anti"), "backward")
            if level.isEmpty():
                return reduce(DataFrame.union, levels)
            levels.append(level)


def cycle_members(edges: DataFrame) -> DataFrame:
    """``(node, cycle)`` of every node of ``edges(src, dst)`` that lies on a cycle.

    ``cycle`` is the smallest node of its strongly connected component; an edge
    from a node to itself is a cycle. Edges with a null end are left out.
    """
    arcs = materialize(
        edges.select("src", "dst").where("src is not null and dst is not null").distinct(), "arcs"
    )
    found = [arcs.where("src = dst").select(F.col("src").alias("node"), F.col("src").alias("cycle"))]
    graph = _Arcs(arcs)
    live = graph.trimmed(arcs.where("src <> dst"))
    while not live.isEmpty():
        colors = graph.colored(live)
        ends = graph.join(live, colors.withColumnRenamed("node", "src"), "src")
        other = colors.select(F.col("node").alias("dst"), F.col("color").alias("other"))
        inside = materialize(
            graph.join(ends, other, "dst").where("color = other").select("src", "dst", "color"),
            "one-color",
        )
        members = materialize(graph.components(inside, colors), "members")
        names = members.groupBy("color").agg(
            F.min("node").alias("cycle"), F.count(F.lit(1)).alias("size")
        )
        several = salted_join(members, names.where("size > 1"), ["color"])
        found.append(several.select("node", "cycle"))
        gone = members.select("node")
        rest = graph.join(
            inside.select("src", "dst"), gone.withColumnRenamed("node", "src"), "src", "left_anti"
        )
        rest = graph.join(rest, gone.withColumnRenamed("node", "dst"), "dst", "left_anti")
        live = graph.trimmed(materialize(rest, "arcs"))
    # a node with an edge to itself may lie on a longer cycle, too
    return reduce(DataFrame.union, found).groupBy("node").agg(F.min("cycle").alias("cycle"))


def load_order(edges: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """``(node, level, cycle, behind)`` of every node.

    ``level`` as ``load_levels`` gives it; nodes that can never load are either
    on the cycle named ``cycle`` or ``behind`` one.
    """
    levels = load_levels(edges, nodes, node)
    return levels.join(cycle_members(edges), "node", "left").select(
        "node",
        "level",
        "cycle",
        (F.col("level").isNull() & F.col("cycle").isNull()).alias("behind"),
    )


def reachable_in_order(edges: DataFrame, starts: DataFrame, node: str = "node") -> DataFrame:
    """``(start, node, depth)``: nodes reached from each start, nearest depth.

    The rows of ``closure.reachable``, found in the order of the graph instead
    of by distance. With each cycle taken as one node, every node has a level
    above all it leads to. Pairs are written by the level of their node, highest
    level first: when a level's turn comes, all pairs of it are there, its
    shortest distances are one aggregate, and it is expanded once. So a level
    reads its own pairs and none of the earlier ones, and no pair is looked up
    among those seen before. Inside a cycle distances are relaxed among the
    pairs of its level until none gets shorter. The start itself is reported
    only if a cycle leads back.
    """
    spark = edges.sparkSession
    arcs = materialize(
        edges.select("src", "dst").where("src is not null and dst is not null").distinct(), "arcs"
    )
    hot = materialize(hot_keys(arcs, ["src"]), "hot-nodes")
    ends = arcs.select(F.col("src").alias("node")).union(arcs.select("dst")).distinct()
    whole = materialize(
        ends.join(cycle_members(arcs), "node", "left").select(
            "node", F.coalesce("cycle", "node").alias("whole"), F.col("cycle").isNotNull().alias("on_cycle")
        ),
        "condensed",
    )
    from_, to = (
        whole.select(F.col("node").alias(end), F.col("whole").alias(f"{end}_whole")) for end in ("src", "dst")
    )
    named = salted_join(salted_join(arcs, from_, ["src"]), to, ["dst"])
    named = materialize(named, "condensed-arcs")
    across = named.where("src_whole <> dst_whole")
    levels = load_levels(
        across.select(F.col("src_whole").alias("src"), F.col("dst_whole").alias("dst")),
        whole.select("whole").distinct(),
        "whole",
    ).withColumnRenamed("node", "dst_whole")
    step = materialize(
        salted_join(named, levels, ["dst_whole"]).select(
            "src", "dst", "level", (F.col("src_whole") == F.col("dst_whole")).alias("inner")
        ),
        "levelled-arcs",
    )
    start_rows = starts.select(F.col(node).alias("start")).where("start is not null").distinct()
    folder = fresh_folder(spark, "reached")
    store, parts = Store(spark, folder), 0

    def expand(pairs: DataFrame, arcs_: DataFrame) -> DataFrame:
        """Pairs ``(start, src, depth)`` one edge further."""
        return salted_join(arcs_, pairs, ["src"], spread_right=True, hot=hot).select(
            "start", F.col("dst").alias("node"), (F.col("depth") + 1).alias("depth"), "level"
        )

    def keep(candidates: DataFrame) -> None:
        nonlocal parts
        shortest = candidates.groupBy("start", "node", "level").agg(F.min("depth").alias("depth"))
        shortest.write.partitionBy("level").parquet(store.path(f"{parts:06d}"))
        parts += 1

    def held() -> dict[int, list[str]]:
        """The folders that hold pairs of each level."""
        out: dict[int, list[str]] = {}
        for k in range(parts):
            for name in store.names(f"{k:06d}"):
                if name.startswith("level="):
                    out.setdefault(int(name[6:]), []).append(store.path(f"{k:06d}/{name}"))
        return out

    first = start_rows.select("start", F.col("start").alias("src"), F.lit(0).alias("depth"))
    keep(expand(first, step))
    kind = step.schema["dst"].dataType.simpleString()
    schema = f"start {kind}, node {kind}, depth int"
    inner, outer = step.where("inner"), step.where("not inner")
    # numbers below the height of the graph
    rings = {r["level"] for r in inner.select("level").distinct().collect()}
    done: list[DataFrame] = []
    finished: set[int] = set()
    while True:
        waiting = held()
        left = [level for level in waiting if level not in finished]
        if not left:
            break
        level = max(left)
        finished.add(level)
        pairs = spark.read.schema(schema).parquet(*waiting[level])
        pairs = materialize(
            pairs.groupBy("start", "node").agg(F.min("depth").alias("depth")), "level-pairs"
        )
        moved = pairs
        while level in rings:
            near = expand(moved.withColumnRenamed("node", "src"), inner).select("start", "node", "depth")
            both = pairs.withColumn("old", F.lit(True)).unionByName(near.withColumn("old", F.lit(False)))
            step_ = materialize(
                both.groupBy("start", "node").agg(
                    F.min("depth").alias("depth"), F.min(F.when(F.col("old"), F.col("depth"))).alias("was")
                ),
                "level-pairs",
            )
            changed = step_.where("was is null or depth < was").select("start", "node", "depth")
            if changed.isEmpty():
                break
            pairs, moved = step_.select("start", "node", "depth"), changed
        done.append(pairs)
        keep(expand(pairs.withColumnRenamed("node", "src"), outer))
    if not done:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.union, done)
