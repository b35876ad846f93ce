"""Nearest vectors for many questions by an inverted-list index.

Centroids are fitted by Lloyd rounds on a bounded sample; every row is then put
into the list of its nearest centroid, so the index covers all rows. A question
is compared with the rows of its nearest lists, exactly. What that misses is
measured against ``nearest_many``, or fetched: with the angle between a
centroid and the farthest row of its list, no row of a list can be nearer to a
question than a bound. ``search(exact=True)`` takes the lists whose bound reaches
the ``k``-th score of the first search, which gives the rows of all pairs.

Long lists are cut into blocks of rows and many questions of a list into blocks
of questions, so no task holds a whole list. Centroids are the only thing
broadcast: at most ``MOST_LISTS`` vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.lineage.retrieval import NODE_BLOCK, QUESTION_BLOCK, ranked_best, unit
from loomhouse.session import materialize

SAMPLE_ROWS, MOST_LISTS, ROUNDS = 20_000, 1_024, 8
# Scores are rounded to six places; angles get a margin above that.
_MARGIN = 1e-5


def fit_centroids(vectors: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors by Lloyd rounds; a list left empty takes the worst row."""
    rng = np.random.Generator(np.random.PCG64(seed))
    centroids = vectors[rng.choice(len(vectors), min(lists, len(vectors)), replace=False)]
    for _ in range(ROUNDS):
        scores = vectors @ centroids.T
        own, best = scores.argmax(1), scores.max(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, vectors)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centroids)) == 0)
        sums[empty] = vectors[np.argsort(best, kind="stable")[: len(empty)]]
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = sums / np.where(norm == 0, 1.0, norm)
    return centroids


@dataclass(frozen=True)
class VectorIndex:
    """Centroids, the rows ``(node, vector, list)`` and the reach of each list."""

    centroids: np.ndarray
    rows: DataFrame
    lists: DataFrame

    def _wanted(self, questions: DataFrame, choose) -> DataFrame:
        """``(question, vector, list)`` of the lists ``choose(rows, scores)`` marks per question."""
        held = questions.sparkSession.sparkContext.broadcast(self.centroids)

        def run(frames):
            for asked in frames:
                if not len(asked) or not len(held.value):
                    continue  # without lists there is nothing to find
                marked = choose(asked, unit(asked["vector"]) @ held.value.T)
                row, at = np.nonzero(marked)
                yield pd.DataFrame(
                    {
                        "question": asked["question"].to_numpy()[row],
                        "vector": asked["vector"].to_numpy()[row],
                        "list": at.astype(np.int32),
                    }
                )

        kind = questions.schema["question"].dataType.simpleString()
        return questions.mapInPandas(run, f"question {kind}, vector array<double>, list int")

    def _compared(self, wanted: DataFrame, k: int) -> DataFrame:
        """The best ``k`` of each question among the rows of its lists."""
        wanted = materialize(wanted, "questions-by-list")
        asked = wanted.groupBy("list").agg(F.count(F.lit(1)).alias("asked"))
        # one row per list, so their number is bounded
        blocks = self.lists.join(asked, "list").select(
            "list",
            F.ceil(F.col("rows") / NODE_BLOCK).alias("few"),
            F.ceil(F.col("asked") / QUESTION_BLOCK).alias("many"),
        )

        def all_of(n: str):
            return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

        nodes = self.rows.join(F.broadcast(blocks), "list").select(
            "list", "node", "vector", F.pmod(F.xxhash64("node"), "few").alias("a"), all_of("many").alias("b")
        )
        questions = wanted.join(F.broadcast(blocks), "list").select(
            "list", "question", "vector", all_of("few").alias("a"),
            F.pmod(F.xxhash64("question"), "many").alias("b"),
        )
        return ranked_best(nodes, questions, ["list", "a", "b"], k)

    def search(
        self,
        questions: DataFrame,
        k: int,
        probes: int = 8,
        exact: bool = False,
        vector: str = "vector",
        question: str = "question",
    ) -> DataFrame:
        """``(question, rank, node, score)`` from the ``probes`` nearest lists, as ``nearest_many``.

        With ``exact`` also from every other list that could hold a row as near
        as the ``k``-th found.
        """
        asked = questions.where(F.col(vector).isNotNull()).select(
            F.col(question).alias("question"), F.col(vector).cast("array<double>").alias("vector")
        )

        def nearest_lists(_, scores):
            most = min(probes, scores.shape[1])
            marked = np.zeros(scores.shape, bool)
            at = np.argpartition(-scores, most - 1, axis=1)[:, :most]
            np.put_along_axis(marked, at, True, axis=1)
            return marked

        found = self._compared(self._wanted(asked, nearest_lists), k)
        if not exact:
            return found
        found = materialize(found, "first-search")
        least = found.groupBy("question").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-2.0)).alias("least")
        )
        # at most MOST_LISTS numbers; a list without rows reaches nothing
        reach = np.full(len(self.centroids), -1.0)
        for r in self.lists.select("list", "reach").collect():
            reach[r["list"]] = r["reach"]

        def within_bound(rows, scores):
            nearest = np.arccos(np.clip(scores, -1, 1)) - reach[None, :]
            bound = np.cos(np.clip(nearest, 0, np.pi)) + _MARGIN
            return (bound >= rows["least"].to_numpy()[:, None]) & (reach >= 0)[None, :]

        return self._compared(
            self._wanted(asked.join(least, "question", "left").fillna({"least": -2.0}), within_bound), k
        )


def build_index(
    nodes: DataFrame,
    node: str = "node",
    vector: str = "vector",
    lists: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> VectorIndex:
    """The stored index of all rows with a vector.

    ``lists`` is by default the root of the number of rows, at most
    ``MOST_LISTS`` and one per 16 rows of the sample. About ``sample_rows`` rows are drawn by a hash
    of the node, for the centroids alone.
    """
    rows = nodes.where(F.col(vector).isNotNull()).select(
        F.col(node).alias("node"), F.col(vector).cast("array<double>").alias("vector")
    )
    total = rows.count()
    share = min(1.0, sample_rows / max(total, 1))
    drawn = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 40)) <= int(share * (1 << 40))
    # bounded by sample_rows, up to the spread of the draw
    sample = rows.where(drawn).select("vector").toPandas()["vector"]
    if len(sample):
        wanted = lists or int(np.sqrt(total)) + 1
        centroids = fit_centroids(unit(sample), max(1, min(wanted, MOST_LISTS, len(sample) // 16)), seed)
    else:
        centroids = np.zeros((0, 0))
    held = nodes.sparkSession.sparkContext.broadcast(centroids)

    def place(frames):
        for f in frames:
            if len(f):
                scores = unit(f["vector"]) @ held.value.T
                own = scores.argmax(1)
                angle = np.arccos(np.clip(scores[np.arange(len(own)), own], -1, 1))
                yield f.assign(list=own.astype(np.int32), angle=angle)

    kind = rows.schema["node"].dataType.simpleString()
    placed = materialize(
        rows.mapInPandas(place, f"node {kind}, vector array<double>, list int, angle double"),
        "vector-lists",
    )
    held_lists = placed.groupBy("list").agg(
        F.count(F.lit(1)).alias("rows"), F.max("angle").alias("reach")
    )
    return VectorIndex(centroids, placed.drop("angle"), materialize(held_lists, "list-sizes"))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``(question, recall)``: the share of the exact rows of each question that were found."""
    hits = exact.select("question", "node").join(
        found.select("question", "node", F.lit(1).alias("hit")), ["question", "node"], "left"
    )
    return hits.groupBy("question").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
