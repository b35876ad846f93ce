"""The vector index: recall, exact search by bounds, long lists."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomhouse.lineage import vector_index
from loomhouse.lineage.retrieval import nearest_many
from loomhouse.lineage.vector_index import build_index, fit_centroids, recall

SCHEMA = "node long, vector array<float>"


def frame(spark, vectors):
    return spark.createDataFrame(
        [(k, None if v is None else [float(x) for x in v]) for k, v in enumerate(vectors)], SCHEMA
    )


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 16))
    vectors = [centers[k % 12] + 0.35 * rng.normal(size=16) for k in range(900)]
    # a third of all rows is one vector; nulls and a vector of zeros
    vectors += [centers[0]] * 450 + [None, np.zeros(16), None]
    nodes = frame(spark, vectors).cache()
    return nodes, nodes.where("node % 50 = 0 OR vector IS NULL OR node = 1351").withColumnRenamed("node", "question")


def rows(df):
    return sorted((r.question, r.rank, r.node, r.score) for r in df.collect())


def test_every_row_is_in_one_list_and_recall_is_high(clustered):
    nodes, questions = clustered
    index = build_index(nodes)
    assert index.rows.count() == nodes.where("vector IS NOT NULL").count()
    assert index.lists.agg(F.sum("rows")).first()[0] == index.rows.count()
    found, exact = index.search(questions, 10), nearest_many(nodes, questions, 10)
    shares = recall(found, exact)
    assert shares.agg(F.avg("recall")).first()[0] >= 0.9
    assert shares.count() == exact.select("question").distinct().count()
    # scores are exact: what is found has the score it has among all pairs
    known = {(q, n): s for q, _, n, s in rows(exact)}
    assert all(known.get((q, n), s) == s for q, _, n, s in rows(found))


@pytest.mark.parametrize("probes", [1, 8])
def test_bounds_give_the_rows_of_all_pairs(clustered, probes, monkeypatch):
    monkeypatch.setattr(vector_index, "NODE_BLOCK", 60)
    monkeypatch.setattr(vector_index, "QUESTION_BLOCK", 7)
    nodes, questions = clustered
    index = build_index(nodes)
    assert rows(index.search(questions, 10, probes, exact=True)) == rows(nearest_many(nodes, questions, 10))


def test_random_vectors_without_any_structure(spark):
    rng = np.random.default_rng(2)
    nodes = frame(spark, rng.normal(size=(400, 8)))
    questions = nodes.where("node % 50 = 0").withColumnRenamed("node", "question")
    index = build_index(nodes, lists=15)
    assert rows(index.search(questions, 5, 2, exact=True)) == rows(nearest_many(nodes, questions, 5))


def test_few_rows_and_none(spark):
    nodes = frame(spark, [[1, 0], [0, 1], [-1, 0]])
    questions = nodes.withColumnRenamed("node", "question")
    assert rows(build_index(nodes).search(questions, 10, exact=True)) == rows(nearest_many(nodes, questions, 10))
    none = nodes.limit(0)
    assert build_index(none).search(questions, 3, exact=True).count() == 0
    assert build_index(nodes).search(questions.limit(0), 3).count() == 0


def test_centroids_are_unit_and_none_is_lost():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 6))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    c = fit_centroids(np.concatenate([v, np.repeat(v[:1], 300, 0)]), 20)
    assert c.shape == (20, 6) and np.allclose(np.linalg.norm(c, axis=1), 1)
