"""Readers with rejects, audited writes and cycles in the load order."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomhouse.lineage.closure import reachable
from loomhouse.lineage.cycles import cycle_members, load_order, reachable_in_order
from loomhouse.operators import skew
from loomhouse.operators.audited import AuditFailed, Checks, write_audited
from loomhouse.sources.files import read_delimited, read_with_rejects

FIELDS = T.StructType(
    [
        T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
        T.StructField("c", T.DateType()), T.StructField("d", T.DoubleType()),
    ]
)
LINES = [
    "1|x|2020-01-01|1.5", "two|y|2020-01-02|2", "", "3|z|never|bad", "4|short", "5|a|2020-01-05|5|more",
    "  ", "||2020-02-30|", "8|||", '9|"quoted | bar"|2020-01-09|9',
]


def test_rows_and_rejects_of_one_scan(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(LINES) + "\n")
    rows, rejects = read_with_rejects(spark, str(tmp_path), FIELDS)
    plain = read_delimited(spark, str(tmp_path), FIELDS)
    got = sorted((tuple(r) for r in rows.collect()), key=repr)
    assert (9, "quoted | bar", dt.date(2020, 1, 9), 9.0) in got
    assert got == sorted((tuple(r) for r in plain.collect()), key=repr)
    bad = {r["line"]: (r["reason"], r["record"]) for r in rejects.collect()}
    assert bad == {
        2: ("a: two", LINES[1]),
        4: ("c: never, d: bad", LINES[3]),
        5: ("2 fields instead of 4", LINES[4]),
        6: ("5 fields instead of 4", LINES[5]),
        8: ("c: 2020-02-30", LINES[7]),
    }


def test_line_numbers_hold_in_files_of_many_blocks(spark, tmp_path):
    for name, every in (("a.txt", 7), ("b.txt", 11)):
        lines = [f"{'x' if k % every == 0 else k}|{'t' * (k % 50)}|2020-01-01|1" for k in range(1, 4001)]
        (tmp_path / name).write_text("\n\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        _, rejects = read_with_rejects(spark, str(tmp_path), FIELDS)
        got = {(r["file"][-5:], r["line"]) for r in rejects.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {("a.txt", 2 * k - 1) for k in range(7, 4001, 7)} | {("b.txt", 2 * k - 1) for k in range(11, 4001, 11)}


@pytest.fixture
def some(spark):
    return spark.range(100).select(
        "id", F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"), (F.col("id") % 50).alias("g")
    )


def test_an_audited_write_is_published_with_its_metrics(spark, some, tmp_path):
    checks = Checks(("id",), ("id",), (("small", "g < 50"),), 1)
    found = write_audited(some, str(tmp_path), "t", checks)
    assert (found["rows"], found["null_v"], found["most_copies"], found["broken_small"]) == (100, 10, 1, 0)
    assert abs(found["distinct"] - 100) < 10
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["id", "v", "g"]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


@pytest.mark.parametrize(
    ("checks", "said"),
    [
        (Checks(not_null=("v",)), "10 nulls in v"),
        (Checks(unique=("g",)), "2 rows of one key"),
        (Checks(rules=(("low", "v < 50"),)), "rows break low"),
        (Checks(least_rows=101), "100 rows instead of 101"),
    ],
)
def test_a_write_that_breaks_a_check_is_not_published(spark, some, tmp_path, checks, said):
    with pytest.raises(AuditFailed, match=said):
        write_audited(some, str(tmp_path), "t", checks)
    assert not (tmp_path / "t").exists()


def test_the_audit_reads_its_input_once(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "in"))
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.read.parquet(str(tmp_path / "in")).mapInArrow(counted, "id long")
    write_audited(df, str(tmp_path / "out"), "t", Checks(("id",), ("id",)))
    assert runs.value == 1000


def brute_cycles(arcs):
    reach = {n: set() for a in arcs for n in a}
    for n in reach:
        todo = [n]
        while todo:
            for a, b in arcs:
                if a == todo[-1] and b not in reach[n]:
                    reach[n].add(b)
                    todo.insert(0, b)
            todo.pop()
    return {n: min(m for m in reach[n] if n in reach[m]) for n in reach if n in reach[n]}, reach


@pytest.mark.parametrize("salted", [False, True])
def test_members_of_cycles_and_what_is_behind(spark, salted, monkeypatch):
    if salted:
        found = skew.hot_keys
        monkeypatch.setattr(skew, "hot_keys", lambda df, on, _=0: found(df, on, 2))
    rng = random.Random(5)
    # a ring of six, two rings that touch one way, a loop on a ring, chains before and behind
    arcs = {(f"a{k}", f"a{(k + 1) % 6}") for k in range(6)}
    arcs |= {("b0", "b1"), ("b1", "b0"), ("b1", "c0"), ("c0", "c1"), ("c1", "c0"), ("c1", "c1")}
    arcs |= {("x1", "a0"), ("x2", "x1"), ("b0", "y1"), ("y1", "y2"), ("z", "z")}
    names = [f"r{k}" for k in range(14)]
    arcs |= {(rng.choice(names), rng.choice(names)) for _ in range(22)}
    edges = spark.createDataFrame(sorted(arcs) + [(None, "a0"), ("y2", None)], "src string, dst string")
    want, reach = brute_cycles(arcs)
    assert {r["node"]: r["cycle"] for r in cycle_members(edges).collect()} == want
    nodes = spark.createDataFrame([(n,) for n in [*reach, "alone"]], "node string")
    got = {r["node"]: r for r in load_order(edges.dropna(), nodes).collect()}
    for n, r in reach.items():
        stuck = n in want or any(m in want for m in r)
        assert (got[n]["level"] is None) == stuck
        assert got[n]["cycle"] == want.get(n) and got[n]["behind"] == (stuck and n not in want)
    assert got["alone"]["level"] == 0


def test_no_edges_and_no_cycles(spark):
    none = spark.createDataFrame([], "src string, dst string")
    assert cycle_members(none).count() == 0
    chain = spark.createDataFrame([(f"{k}", f"{k + 1}") for k in range(9)], "src string, dst string")
    assert cycle_members(chain).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_walks_in_level_order_reach_what_plain_walks_reach(spark, seed):
    rng = random.Random(seed)
    names = [f"n{k}" for k in range(18)]
    arcs = [(rng.choice(names), rng.choice(names)) for _ in range(26)]
    arcs += [(f"t{k}", f"t{k + 1}") for k in range(6)] + [("t0", "t4"), ("t6", names[0]), (names[3], "t2")]
    edges = spark.createDataFrame(arcs, "src string, dst string")
    starts = spark.createDataFrame([("t0",), (names[0],), (names[1],), ("nowhere",), ("t0",)], "node string")
    got = sorted((r["start"], r["node"], r["depth"]) for r in reachable_in_order(edges, starts).collect())
    assert got == sorted((r["start"], r["node"], r["depth"]) for r in reachable(edges, starts).collect())
    assert reachable_in_order(edges, starts.where("node = 'nowhere'")).count() == 0
