"""Lineage documents, graph merge, walks, audits and reviews on small inputs."""

from __future__ import annotations

import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomhouse.lineage import graph as lg
from loomhouse.lineage.audit import classify, edge_directions, run_difference, script_extract
from loomhouse.lineage.closure import (
    derivation_paths,
    load_levels,
    reachable,
    relational_edges,
)
from loomhouse.lineage.documents import (
    attach_scripts,
    derivations,
    documented_tables,
    parse_documents,
    rejected_entries,
    resolve_scripts,
    script_pipelines,
    script_tables,
    source_entries,
)
from loomhouse.lineage.identifiers import (
    file_table,
    normalize_table,
    parse_column,
    parse_quoted,
    rewrite_csv_call,
)
from loomhouse.lineage import retrieval
from loomhouse.lineage.retrieval import nearest, nearest_many, with_neighbours
from loomhouse.lineage.reviews import issues, review_blocks, script_summary, usage_rows
from loomhouse.operators.aggregates import row_audit, usage_stats


def _src(identifier, **kw):
    return {"source_identifier": identifier, "path": ["p"], "role": "direct input", **kw}


DOCS = {
    "1_a.json": {
        "target_table": "wh.T",
        "sources_summary": [
            {"type": "FILE", "name": "", "alias_or_cte": None},
            {"type": "FILE", "name": "src/data/Batch1\\In.txt", "alias_or_cte": "f"},
            {"type": "FILE", "name": "other.txt", "alias_or_cte": "g"},
            {"type": "TABLE", "name": "S", "alias_or_cte": "first"},
            {"type": "TABLE", "name": "main.S", "alias_or_cte": "second"},
        ],
        "lineage": {
            "c1": {
                "sources": [_src("file.c1"), _src("wh.T.c1", transformation_type="RENAME")],
                "transformation_type": "DIRECT INPUT",
                "transformation_logic": "COPY from file x",
                "notes": "n1",
            },
            "c2": {"sources": [_src("S.k", join_info={"type": "INNER"}), _src(None), _src("1")]},
            "c3": {"sources": [], "transformation_type": "CONSTANT"},
        },
    },
    "1_a_v2.json": {
        "target_table": "wh.T",
        "sources_summary": [],
        "lineage": {
            "c2": {"sources": [_src("S.k", notes="later")], "transformation_type": "CAST"}
        },
    },
    "9_unknown.json": {"target_table": "wh.U", "sources_summary": [], "lineage": {}},
}
MAPPING = {"p1": ["1_a.sql", "1_b.sql"], "p2": ["1_b.sql"]}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, json.dumps(v, indent=1)) for k, v in DOCS.items()] + [("0_bad.json", '{"target_table": ')]
    texts = spark.createDataFrame(rows, "name string, content string")
    parsed, rejects = parse_documents(texts)
    assert [r["file_name"] for r in rejects.collect()] == ["0_bad.json"]
    mapping = spark.createDataFrame([("m", json.dumps(MAPPING))], "name string, content string")
    return attach_scripts(parsed, script_pipelines(mapping)).cache()


def test_last_pipeline_wins_for_a_script(spark):
    mapping = spark.createDataFrame([("m", json.dumps(MAPPING))], "name string, content string")
    rows = {r["script"]: r["pipeline"] for r in script_pipelines(mapping).collect()}
    assert rows == {"1_a.sql": "p1", "1_b.sql": "p2"}


def test_scripts_resolve_exactly_then_by_prefix(spark):
    mapping = spark.createDataFrame(
        [("m", json.dumps({"p": ["ab.sql", "a.sql", "abc.sql"]}))], "name string, content string"
    )
    stems = spark.createDataFrame([("a.sql",), ("abc.sql",), ("abcd",), ("zz",)], "stem string")
    got = {r["stem"]: r["script"] for r in resolve_scripts(stems, script_pipelines(mapping)).collect()}
    assert got == {"a.sql": "a.sql", "abc.sql": "abc.sql", "abcd": "ab.sql"}


def test_unknown_documents_are_left_out(docs):
    assert {(r["file_name"], r["script"]) for r in docs.collect()} == {
        ("1_a.json", "1_a.sql"),
        ("1_a_v2.json", "1_a.sql"),
    }


def test_derivations_and_fallbacks(docs):
    entries = source_entries(docs)
    rows = {
        (r["file_name"], r["target_full"], r["source_full"]): r for r in derivations(entries).collect()
    }
    copied = rows["1_a.json", "wh.T.c1", "src.data.Batch1.In.txt.c1"]
    assert copied["transformation_type"] == "FILE_LOAD" and copied["notes"] == "n1"
    assert rows["1_a.json", "wh.T.c1", "wh.T.c1"]["transformation_type"] == "RENAME"
    joined = rows["1_a.json", "wh.T.c2", "main.S.k"]
    assert json.loads(joined["join_info"]) == {"type": "INNER"}
    assert joined["transformation_type"] is None and joined["path"] == ["p"]
    assert len(rows) == 4
    bad = {r["source_identifier"] for r in rejected_entries(entries).collect()}
    assert bad == {None, "1"}


def test_vertices_first_mention_and_file_rule(docs):
    rows = {(r["label"], r["key"]): (r["name"], r["type"]) for r in lg.vertices(docs).collect()}
    assert rows["Table", "src.data.Batch1.In.txt"] == ("In.txt", "FILE")
    assert rows["Table", "wh.T"] == ("T", None)
    assert rows["Table", "main.S"] == ("S", "TABLE")
    assert rows["Script", "1_a.sql"] == ("1_a.sql", "SQL")
    assert ("Column", "wh.T.c3") in rows and ("Table", "other.txt") not in rows
    assert lg.duplicate_keys(lg.vertices(docs)).isEmpty()


def test_merge_keeps_the_last_value_present(docs):
    merged = {
        (r["target_column"], r["source_column"]): r
        for r in lg.merged_derivations(derivations(source_entries(docs))).collect()
    }
    row = merged["wh.T.c2", "main.S.k"]
    assert row["transformation_type"] == "CAST" and row["notes"] == "later"
    assert json.loads(row["join_info"]) == {"type": "INNER"}


def test_edges_and_schema_triples(docs):
    spark = docs.sparkSession
    needs = spark.createDataFrame([("p1", "p1"), ("1_a.sql", "1_a.sql")], "src string, dst string")
    edges = lg.edges(docs, needs)
    rows = {tuple(r) for r in edges.collect()}
    assert ("DEPENDS_ON", "p1", "p1") in rows
    assert ("USES_INPUT_TABLE", "1_a.sql", "main.S") in rows
    assert ("PRODUCES_OUTPUT_TABLE", "1_a.sql", "wh.T") in rows
    assert ("IN_TABLE", "wh.T.c3", "wh.T") in rows
    assert ("READS_FROM", "1_a.sql", "main.S.k") in rows
    assert ("IN_SCHEMA", "src.data.Batch1.In.txt", "src.data.Batch1") in rows
    triples = {tuple(r) for r in lg.schema_triples(edges, lg.vertices(docs)).collect()}
    assert triples == set(lg.EDGE_TRIPLES)


def test_script_tables_take_the_first_mention(docs):
    rows = {(r["edge_type"], r["table_full_name"]): r["alias_or_cte"] for r in script_tables(docs).collect()}
    assert rows == {("PRODUCES_OUTPUT_TABLE", "wh.T"): None, ("USES_INPUT_TABLE", "main.S"): "first"}


def test_documented_tables_and_enrichment(spark, docs):
    names = {r[0] for r in documented_tables(docs).collect()}
    assert {"wh.T", "main.S", "src/data/Batch1\\In.txt", "other.txt"} == names
    catalog = spark.createDataFrame(
        [("wh.T", "c1", 0, "int", None, "a"), ("wh.V", "c1", 0, "int", None, None)],
        "table_full_name string, column string, position int, type string, description string, comment string",
    )
    rows = lg.enrich_columns(docs, catalog).collect()
    assert [(r["column_full_name"], r["comment"]) for r in rows] == [("wh.T.c1", "a")]


def test_names(spark):
    def one(c):
        return spark.range(1).select(c.alias("v")).first()["v"]

    def norm(s):
        return one(normalize_table(rewrite_csv_call(F.lit(s).cast("string"))))

    assert norm("T") == "main.T" and norm("a.T") == "a.T" and norm(None) == ""
    assert norm('"d.x/e\\f.g.CSV"') == "d_x.e.f_g"
    assert norm('"f.dat"') == "file_sources.f" and norm('"f.json"') == '"f.json"'
    assert norm('".csv"') == '".csv"' and norm('"') == 'main."'
    assert norm("read_csv(x)") == "main.read_csv(x)"
    assert norm("read_csv('/src/Batch1\\HR.csv', delim=',')") == "file_sources.src_Batch1_HR"
    assert tuple(one(file_table(F.lit("a\\b/c.txt")))) == ("a.b", "c.txt")
    assert tuple(one(file_table(F.lit("c.txt")))) == ("file_root", "c.txt")
    assert one(file_table(F.lit(""))) is None
    none = F.lit(None).cast("struct<schema:string,table:string>")
    assert tuple(one(parse_column(F.lit("file.x"), none))) == ("main", "file", "x")
    assert tuple(one(parse_column(F.lit('"a.b.c.csv"'), none))) == ("a.b", "c", "file_content")
    assert one(parse_column(F.lit("1"), none)) is None


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_paths_on_a_cycle_end(spark):
    edges = _edges(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("a", "b")])
    starts = spark.createDataFrame([("a",)], "node string")
    paths = {"".join(r["path"]) for r in derivation_paths(edges, starts).collect()}
    assert paths == {"ab", "abc", "abd", "abca"}
    near = {(r["node"], r["depth"]) for r in reachable(edges, starts).collect()}
    assert near == {("b", 1), ("c", 2), ("d", 2), ("a", 3)}


def test_walks_without_edges(spark):
    starts = spark.createDataFrame([("z",)], "node string")
    assert derivation_paths(_edges(spark, [("a", "b")]), starts).isEmpty()
    assert reachable(_edges(spark, [("a", "b")]), starts).isEmpty()


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=10))
def test_reachable_is_the_repeated_one_hop_join(spark, pairs):
    named = [(str(a), str(b)) for a, b in pairs]
    starts = spark.createDataFrame([("0",), ("1",)], "node string")
    got = {(r["start"], r["node"]): r["depth"] for r in reachable(_edges(spark, named), starts).collect()}
    want = {}
    for s in "01":
        front, depth = {s}, 0
        while front:
            depth += 1
            front = {b for a, b in named if a in front} - {n for t, n in want if t == s}
            want.update({(s, n): depth for n in front})
    assert got == want


def test_load_levels_take_the_longest_path(spark):
    needs = _edges(spark, [("f", "t"), ("f", "c"), ("t", "s"), ("s", "c"), ("x", "y"), ("y", "x"), ("z", "x")])
    names = spark.createDataFrame([(n,) for n in "ftscxyz"], "node string")
    got = {r["node"]: r["level"] for r in load_levels(needs, names).collect()}
    assert got == {"c": 0, "s": 1, "t": 2, "f": 3, "x": None, "y": None, "z": None}


def test_dependencies_need_both_ends(spark):
    texts = spark.createDataFrame(
        [("1", json.dumps({"f": ["t", "c"], "t": ["gone"], "c": []}))], "name string, content string"
    )
    names = spark.createDataFrame([("f",), ("t",), ("c",)], "name string")
    every = {tuple(r) for r in lg.dependency_edges(texts, names, "name").collect()}
    last = {tuple(r) for r in lg.dependency_edges(texts, names, "name", last_only=True).collect()}
    assert every == {("f", "t"), ("f", "c")} and last == {("f", "c")}


def test_relational_model_gives_named_edges(spark):
    columns = spark.createDataFrame([(1, 10, "a"), (2, 11, "b")], "column_id int, table_id int, name string")
    tables = spark.createDataFrame([(10, 5, "T"), (11, 5, "U")], "table_id int, schema_id int, name string")
    schemas = spark.createDataFrame([(5, "wh")], "schema_id int, name string")
    links = spark.createDataFrame([(2, 1)], "from_column_id int, to_column_id int")
    got = relational_edges(links, columns, tables, schemas).collect()
    assert [tuple(r) for r in got] == [("wh.T.a", "wh.U.b")]


def test_extract_pairs_reads_and_writes_of_any_script(spark):
    derived = spark.createDataFrame(
        [("t", "s", "CAST", "x"), ("t", "u", "DIRECT INPUT", None), ("t", "w", None, None)],
        "target_column string, source_column string, transformation_type string, transformation_logic string",
    )
    io = spark.createDataFrame(
        [("1", "GENERATES", "t"), ("1", "READS_FROM", "s"), ("2", "GENERATES", "t"), ("3", "READS_FROM", "s")],
        "script string, edge_type string, column string",
    )
    texts = spark.createDataFrame([("1", "SELECT")], "name string, content string")
    rows = {tuple(r) for r in script_extract(texts, io, derived).collect()}
    assert rows == {("1", "SELECT", None, None, None, None), ("1", None, "s", "t", "CAST", "x")}


def test_edge_directions(spark):
    triples = spark.createDataFrame([("A", "r", "B")], "from_label string, edge_type string, to_label string")
    rows = spark.createDataFrame(
        [("A", "r", "B"), ("B", "r", "A"), ("A", "q", "B"), (None, "r", "A"), ("", "", "")],
        "from_label string, edge_type string, to_label string",
    )
    got = [r["verdict"] for r in edge_directions(rows, triples).collect()]
    assert sorted(got) == ["flip", "flip", "invalid", "ok", "ok"]


def test_classes_and_run_difference(spark):
    cols = "target_column string, source_column string, role string, transformation_type string"
    before = spark.createDataFrame([("t", "a", "join key", "CAST"), ("t", "b", None, None), ("t", "c", None, "X")], cols)
    got = {r["source_column"]: (r["lineage_class"], r["lineage_subclass"]) for r in classify(before).collect()}
    assert got == {"a": ("INDIRECT", "Join"), "b": ("DIRECT", "Transformation"), "c": ("DIRECT", "Transformation")}
    after = spark.createDataFrame([("t", "b", None, None), ("t", "c", None, "Y"), ("t", "d", None, None)], cols)
    diff = {r["source_column"]: r["change"] for r in run_difference(before, after, ["transformation_type"]).collect()}
    assert diff == {"a": "removed", "c": "changed", "d": "added"}


REVIEW = """a.sql:
{
  "x": [],
  "y": ["one } brace", "two"]
}b.sql:
{
  "z": [oops
}c.sql:
{}
"""


def test_review_text_may_name_a_script_inside_an_issue(spark):
    text = 'a.sql: {"x": ["see b.sql: } wrong"]}\n\nc d.sql:{"y": []} '
    texts = spark.createDataFrame(
        [("r", text), ("s", None), ("t", "no block"), ("u", "e.sql: {")], "name string, content string"
    )
    rows = {
        (r["name"], r["script"], r["parsed"], str(r["notes"])) for r in review_blocks(texts).collect()
    }
    assert rows == {
        ("r", "a.sql", True, "{'x': ['see b.sql: } wrong']}"),
        ("r", "c d.sql", True, "{'y': []}"),
        ("u", "e.sql", False, "None"),
    }


def test_review_blocks(spark):
    texts = spark.createDataFrame([("r", REVIEW)], "name string, content string")
    blocks = review_blocks(texts)
    rows = {
        r["script"]: (r["total_columns"], r["error_count"], r["ok_columns"])
        for r in script_summary(blocks).collect()
    }
    assert rows == {"a.sql": (2, 1, 1), "b.sql": (0, 1, 0), "c.sql": (0, 0, 0), None: (2, 1, 1)}
    found = {tuple(r) for r in issues(blocks).collect()}
    assert found == {("a.sql", "y", "one } brace"), ("a.sql", "y", "two"), ("b.sql", None, "JSON parse error")}


def test_usage_with_ties_and_empty(spark):
    run = {
        "template_name": "t",
        "individual_prompts_metadata": [
            {"prompt_details": {"sql_file_name": f}, "usage": {"query_tokens_used": q, "answer_tokens_used": a}}
            for f, q, a in (("one", 5, 1), ("two", 5, 9), ("three", 7, 9))
        ],
    }
    texts = spark.createDataFrame([("r", json.dumps(run))], "name string, content string")
    row = usage_stats(usage_rows(texts), [], ["query_tokens", "answer_tokens"], "file", ["name", "pos"]).first()
    assert (row["min_query_tokens"], row["file_at_min_query_tokens"]) == (5, "one")
    assert (row["max_answer_tokens"], row["file_at_max_answer_tokens"]) == (9, "two")
    none = usage_stats(usage_rows(texts.limit(0)), [], ["query_tokens"], "file", ["name", "pos"]).first()
    assert tuple(none) == (0, 0, 0.0, 0, "N/A", "N/A")


def test_empty_tables_are_listed(spark):
    got = row_audit({"a": spark.range(2), "b": spark.range(0)}, only_empty=True).collect()
    assert [r["table_name"] for r in got] == ["b"]


def test_nearest_and_neighbours(spark):
    nodes = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.1])], "node int, vector array<float>")
    found = nearest(nodes, [2.0, 0.0], 2)
    assert [r["node"] for r in found.collect()] == [1, 3]
    edges = spark.createDataFrame([(1, 9), (2, 9)], "src int, dst int")
    assert [(r["node"], r["neighbour"]) for r in with_neighbours(found, edges).collect()] == [(1, 9)]


def test_script_texts_are_attached(spark):
    scripts = spark.createDataFrame([("a.sql",), ("b.sql",)], "script string")
    texts = spark.createDataFrame([("a.sql", "/a", "x"), ("z.sql", "/z", "y")], "name string, path string, content string")
    rows = {r["script"]: r["sql_content"] for r in lg.attach_texts(scripts, texts).collect()}
    assert rows == {"a.sql": "x", "b.sql": None}
    assert tuple(lg.text_counts(scripts, texts).first()) == (1, 1)


@pytest.mark.parametrize("block", [50_000, 7])
def test_nearest_to_many_questions(spark, monkeypatch, block):
    monkeypatch.setattr(retrieval, "NODE_BLOCK", block)
    monkeypatch.setattr(retrieval, "QUESTION_BLOCK", block)
    vectors = [(i, [float(i % 5), float(i % 7), 1.0 - i % 2]) for i in range(40)]
    vectors += [(40, None), (41, [0.0, 0.0, 0.0])]
    nodes = spark.createDataFrame(vectors, "node int, vector array<float>")
    asked = nodes.withColumnRenamed("node", "question")
    got = {}
    for r in nearest_many(nodes, asked, 3).collect():
        got.setdefault(r["question"], {})[r["rank"]] = (r["node"], r["score"])

    def cosine(a, b):
        norms = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return round(sum(x * y for x, y in zip(a, b)) / norms, 6) if norms else 0.0

    known = [(i, v) for i, v in vectors if v]
    assert set(got) == {i for i, _ in known}
    for q, v in known:
        best = sorted(((-cosine(v, w), i) for i, w in known))[:3]
        assert got[q] == {k + 1: (i, -s + 0.0) for k, (s, i) in enumerate(best)}


def test_properties_of_vertices(spark):
    vertex_rows = spark.createDataFrame(
        [("Column", "a.t.c", "c", None), ("Script", "s.sql", "s.sql", "SQL")],
        "label string, key string, name string, type string",
    )
    columns = spark.createDataFrame(
        [("a.t", "a.t.c", "c", "int", "key", None), ("a.t", "a.t.d", "d", "date", None, "day")],
        "table_full_name string, column_full_name string, name string, type string, "
        "description string, comment string",
    )
    texts = spark.createDataFrame(
        [("s.sql", "x/s.sql", "SELECT 1"), ("lost.sql", "x/lost.sql", "SELECT 2")],
        "name string, path string, content string",
    )
    found = lg.vertex_properties(vertex_rows, columns, texts)
    assert {tuple(r) for r in found.collect()} == {
        ("Column", "a.t.c", "c", "int", "key", None, None, None),
        ("Column", "a.t.d", "d", "date", None, "day", None, None),
        ("Script", "s.sql", "s.sql", "SQL", None, None, "x/s.sql", "SELECT 1"),
    }
    assert lg.vertex_properties(vertex_rows.limit(0), columns.limit(0), texts).isEmpty()


def test_quoted_and_four_part_names(spark):
    cases = {
        '"my.schema".t.c': ("my.schema", "t", "c"),
        "db.s.t.c": ("db.s", "t", "c"),
        '"a""b"."c.d"': ("main", 'a"b', "c.d"),
        '"d"."s.x"."t"."c"': ("d.s.x", "t", "c"),
        "s.t.c": ("s", "t", "c"),
        "t.c": ("main", "t", "c"),
        "file.c": ("dir", "f.csv", "c"),
        '"a.b.f.csv"': ("a.b", "f", "file_content"),
        '"open.t.c': None,
        'a."b': None,
        '"x"y.t.c': None,
        "a..c.d": None,
        "a.b.c.d.e": None,
        "constant": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "i string")
    file = F.struct(F.lit("dir").alias("schema"), F.lit("f.csv").alias("table"))
    got = {r["i"]: r["p"] and tuple(r["p"]) for r in df.select("i", parse_quoted(F.col("i"), file).alias("p")).collect()}
    assert got == cases
