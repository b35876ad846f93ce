"""A graph that takes documents by batches is the graph of all documents."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loomhouse.lineage import graph as lg
from loomhouse.lineage.documents import (
    attach_scripts,
    derivations,
    parse_documents,
    script_pipelines,
    source_entries,
)
from loomhouse.lineage.increment import merge_documents
from tests.test_lineage import DOCS, MAPPING, _src

MORE = {
    "1_b.json": {
        "target_table": "main.T2",
        "sources_summary": [{"type": "TABLE", "name": "wh.T", "alias_or_cte": None}],
        "lineage": {
            "c1": {
                "sources": [_src("wh.T.c1", notes="b", transformation_type="CAST"), _src("S.k")],
                "transformation_type": "CAST",
            },
        },
    },
    "1_a_zz.json": {
        "target_table": "wh.T",
        "sources_summary": [],
        "lineage": {"c2": {"sources": [_src("S.k", transformation_type="LATE")], "notes": "z"}},
    },
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, json.dumps(v)) for k, v in {**DOCS, **MORE}.items()]
    parsed, _ = parse_documents(spark.createDataFrame(rows, "name string, content string"))
    mapping = spark.createDataFrame([("m", json.dumps(MAPPING))], "name string, content string")
    return attach_scripts(parsed, script_pipelines(mapping)).cache()


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("order", ["AB", "BA", "ABA"])
def test_batches_in_any_order_give_the_whole_graph(spark, docs, tmp_path, order):
    late = F.col("file_name").isin("1_a_v2.json", "1_b.json")
    parts = {"A": docs.where(~late), "B": docs.where(late)}
    needs = spark.createDataFrame([("p1", "p2")], "src string, dst string")
    for name in order:
        graph = merge_documents(spark, str(tmp_path / "g"), name, parts[name], needs, buckets=4)
    derived = derivations(source_entries(docs))
    assert rows(graph.vertices()) == rows(lg.vertices(docs, derived))
    assert rows(graph.derivations()) == rows(lg.merged_derivations(derived))
    assert rows(graph.edges()) == rows(lg.edges(docs, needs, derived=derived))
    assert graph.table("vertices").version == 2


def test_a_document_in_two_batches_changes_nothing(spark, docs, tmp_path):
    folder = str(tmp_path / "g")
    graph = merge_documents(spark, folder, "all", docs, buckets=4)
    before = [rows(f()) for f in (graph.vertices, graph.derivations, graph.edges)]
    graph = merge_documents(spark, folder, "again", docs.where("file_name = '1_b.json'"))
    assert [rows(f()) for f in (graph.vertices, graph.derivations, graph.edges)] == before


def test_a_batch_that_reached_one_table_reaches_the_others(spark, docs, tmp_path, monkeypatch):
    from loomhouse.sources.store import Store

    folder, publish = str(tmp_path / "g"), Store.publish

    def broken(self, name, text):
        if "/edges" in self.path() and not name.endswith("0000000000.json"):
            raise OSError("lost")
        publish(self, name, text)

    monkeypatch.setattr(Store, "publish", broken)
    with pytest.raises(OSError):
        merge_documents(spark, folder, "A", docs, buckets=4)
    monkeypatch.setattr(Store, "publish", publish)
    graph = merge_documents(spark, folder, "A", docs)
    assert rows(graph.edges()) == rows(lg.edges(docs))
    assert graph.table("vertices").version == graph.table("edges").version == 1
