"""Nearest vertices to a question vector, with their neighbours."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomhouse.operators.skew import salted_join


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def nearest(
    nodes: DataFrame, question: list[float], k: int, node: str = "node", vector: str = "vector"
) -> DataFrame:
    """The ``k`` nodes most similar to one question vector, by cosine.

    Scores are computed where the nodes are; each task keeps its best ``k``.
    Ties go to the smaller node.
    """
    asked = F.array(*[F.lit(float(x)) for x in question])
    v = F.col(vector)
    norms = F.sqrt(_dot(v, v)) * math.sqrt(sum(float(x) ** 2 for x in question))
    scored = nodes.select(node, (_dot(v, asked) / norms).alias("score"))
    return scored.orderBy(F.desc("score"), node).limit(k)


# Rows that meet in one task when many questions are asked.
NODE_BLOCK, QUESTION_BLOCK = 50_000, 500


def nearest_many(
    nodes: DataFrame,
    questions: DataFrame,
    k: int,
    node: str = "node",
    vector: str = "vector",
    question: str = "question",
) -> DataFrame:
    """``(question, rank, node, score)``: the ``k`` nodes nearest to each question.

    Exact: every block of questions meets every block of nodes in a task of its
    own, which keeps the best ``k`` of each question; the best of those are
    taken by a window. Scores are cosines rounded to six places, ties go to the
    smaller node. Rows with a null vector take no part, one of zeros scores 0.
    """
    few = nodes.count() // NODE_BLOCK + 1
    many = questions.count() // QUESTION_BLOCK + 1
    node_rows = nodes.where(F.col(vector).isNotNull()).select(
        F.col(node).alias("node"), F.col(vector).cast("array<double>").alias("vector"),
        F.pmod(F.xxhash64(node), F.lit(few)).alias("a"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))).alias("b"),
    )
    question_rows = questions.where(F.col(vector).isNotNull()).select(
        F.col(question).alias("question"), F.col(vector).cast("array<double>").alias("vector"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(few - 1).cast("long"))).alias("a"),
        F.pmod(F.xxhash64(question), F.lit(many)).alias("b"),
    )
    return ranked_best(node_rows, question_rows, ["a", "b"], k)


def unit(rows: pd.Series) -> np.ndarray:
    """Vectors of length one, as rows; a vector of zeros stays."""
    m = np.stack(rows.to_list()).astype(float)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def ranked_best(
    node_rows: DataFrame, question_rows: DataFrame, block: list[str], k: int
) -> DataFrame:
    """``(question, rank, node, score)``: the best ``k`` of the pairs that meet in a block."""
    kinds = {r.name: r.dataType.simpleString() for s in (node_rows, question_rows) for r in s.schema}
    schema = f"question {kinds['question']}, node {kinds['node']}, score double"

    def best(here: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(here) and len(asked):
            names = here["node"].to_numpy()
            scores = np.round(unit(asked["vector"]) @ unit(here["vector"]).T, 6) + 0.0
            for name, row in zip(asked["question"], scores):
                least = np.partition(row, -min(k, len(row)))[-min(k, len(row))]
                at = np.flatnonzero(row >= least)
                at = at[np.lexsort((names[at], -row[at]))][:k]
                found.append(pd.DataFrame({"question": name, "node": names[at], "score": row[at]}))
        if not found:
            return pd.DataFrame({"question": [], "node": [], "score": []})
        return pd.concat(found)

    per_block = (
        node_rows.groupBy(*block).cogroup(question_rows.groupBy(*block))
        .applyInPandas(best, schema)
    )
    order = Window.partitionBy("question").orderBy(F.desc("score"), "node")
    ranked = per_block.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("question", "rank", "node", "score")


def with_neighbours(found: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """The found nodes with everything one edge away from them."""
    side = found.withColumnRenamed(node, "src")
    out = salted_join(edges.select("src", F.col("dst").alias("neighbour")), side, ["src"])
    return out.withColumnRenamed("src", node)
