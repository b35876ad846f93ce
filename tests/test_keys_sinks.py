from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomhouse.operators import skew
from loomhouse.operators.joins import either_key_lookup, match_people, role_lookup
from loomhouse.operators.keys import (
    assign_dense_ids,
    composite_hash_key,
    composite_key,
    date_key,
    next_dense_start,
)
from loomhouse.operators.sinks import conform, save, upsert
from loomhouse.schemas import STAGING, WAREHOUSE, comments_by_table, struct
from loomhouse.session import fresh_folder
from loomhouse.sources.files import read_column_comments


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_dense_ids_are_exactly_one_to_n(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("hot"))
    got = assign_dense_ids(df, ["hot", "v"], "sk", partitions=partitions)
    rows = got.orderBy("v").collect()
    assert [r["sk"] for r in rows] == list(range(1, 1001))


def test_dense_ids_on_no_rows(spark):
    assert assign_dense_ids(spark.range(0), ["id"], "sk").count() == 0


def test_append_starts_two_above_the_highest(spark):
    empty = spark.createDataFrame([], "sk bigint")
    rows = spark.range(3)
    ids = assign_dense_ids(rows, ["id"], "sk", next_dense_start(empty, "sk")).collect()
    assert sorted(r["sk"] for r in ids) == [2, 3, 4]


def test_date_keys(spark):
    r = spark.sql("SELECT DATE'2020-03-04' AS d, 12L AS a, 9999999999999L AS b").select(
        date_key("d").alias("k"), composite_key("d", "a").alias("c"),
        composite_key("d", "a", "b", overflow="null").alias("big"), composite_hash_key("d", "a", "b").alias("h"),
    ).first()
    assert (r["k"], r["c"], r["big"]) == (20200304, 2020030412, None)
    assert r["h"] is not None


def test_composite_key_never_vanishes(spark):
    ids = spark.sql("SELECT DATE'2020-03-04' AS d, 123456789L AS a, 1234L AS b, 99L AS c")
    with pytest.raises(Exception, match="exceeds 64 bits"):
        ids.select(composite_key("d", "a", "b")).collect()
    assert ids.select(composite_key("d", "a", "c").alias("k")).first()["k"] == 2020030412345678999
    assert ids.select(composite_key(F.lit(None).cast("date"), "a").alias("k")).first()["k"] is None


def test_upsert_keeps_first_batch_and_is_idempotent(spark):
    cols = "k int, v string, recordbatchid int, batchid int"
    old = spark.createDataFrame([(1, "a", 1, 1), (2, "b", 1, 1)], cols)
    new = spark.createDataFrame(
        [(2, "mid", 2, 2), (2, None, 3, 3), (3, "c", 2, 2)], cols
    )
    once = upsert(old, new, ["k"], ["batchid"], ["recordbatchid"])
    want = [(1, "a", 1, 1), (2, None, 3, 1), (3, "c", 2, 2)]
    assert sorted(tuple(r) for r in once.collect()) == want
    twice = upsert(once, new, ["k"], ["batchid"], ["recordbatchid"])
    assert sorted(tuple(r) for r in twice.collect()) == want


def test_conform_is_positional_with_comments(spark):
    target = struct("id int, flag boolean, d date", {"flag": "a flag"})
    df = spark.sql("SELECT 5L AS a, 'Y' AS b, '2020-01-02' AS c")
    out = conform(df, target)
    assert tuple(out.first()) == (5, True, dt.date(2020, 1, 2))
    assert out.schema["flag"].metadata == {"comment": "a flag"}
    with pytest.raises(ValueError):
        conform(df.drop("a"), target)


def test_conform_checks_not_null(spark):
    target = struct("a bigint not null, b string")
    rows = spark.createDataFrame([(1, "x"), (None, None)], "a int, b string")
    with pytest.raises(Exception, match="a must not be null"):
        conform(rows, target).collect()
    kept = conform(rows, target, enforce=False).collect()
    assert {tuple(r) for r in kept} == {(1, "x"), (None, None)}
    assert conform(rows.where("a = 1"), target).count() == 1


def test_all_schemas_parse():
    for ddl in (*WAREHOUSE.values(), *STAGING.values()):
        assert len(struct(ddl)) > 1
    assert struct(STAGING["ProspectIncremental"])["income"].dataType.simpleString() == "string"


def test_comments_are_read_from_scripts(spark):
    folder = fresh_folder(spark, "comments")
    spark.createDataFrame(
        [("COMMENT ON COLUMN wh.T.a IS 'First; name';\nCOMMENT ON COLUMN wh.T.b IS 'It''s b.';",)], "v string"
    ).coalesce(1).write.text(folder)
    got = comments_by_table(read_column_comments(spark, folder, "*.txt"))
    assert got == {"wh.T": {"a": "First; name", "b": "It's b."}}


def test_append_to_a_table(spark):
    folder = fresh_folder(spark, "table")
    save(spark.range(3), folder)
    save(spark.range(2), folder)
    assert spark.read.parquet(folder).count() == 5


def test_people_match_blank_rules(spark):
    names = "last string, addr string"
    left = spark.createDataFrame([("a", ""), ("b", None), ("c", "x")], names)
    right = spark.createDataFrame([("A", None), ("B", ""), ("C", "X")], names).withColumn(
        "hit", F.lit(True)
    )

    def hits(strict):
        rows = match_people(left, right, ["last"], ["addr"], strict, ["hit"]).collect()
        return {r["last"] for r in rows if r["hit"]}

    assert hits(strict=True) == {"c"}
    assert hits(strict=False) == {"a", "b", "c"}


@pytest.mark.parametrize("small", [False, True])
def test_one_lookup_in_two_roles(spark, small, monkeypatch):
    monkeypatch.setattr(skew, "broadcast_sized", lambda _: small)
    df = spark.createDataFrame([("x", "y"), ("y", "gone")], "a string, b string")
    codes = spark.createDataFrame([("x", 1), ("y", 2)], "id string, n int")
    got = role_lookup(df, codes, "id", {"a": "a_", "b": "b_"}, ["n"]).collect()
    assert [(r["a"], r["a_n"], r["b_n"]) for r in got] == [("x", 1, 2)]


def test_either_key_has_no_cartesian_plan(spark):
    fact = spark.createDataFrame(
        [("1", None, dt.date(2020, 1, 1)), (None, "y", dt.date(2020, 1, 1))], "i string, n string, day date"
    )
    dim = spark.createDataFrame(
        [(1, "x", dt.date(2019, 1, 1), dt.date(2021, 1, 1)), (2, "y", dt.date(2020, 1, 1), dt.date(2020, 1, 2))],
        "id long, name string, effectivedate date, enddate date",
    )
    out = either_key_lookup(fact, dim, "i", "n", "id", "name", "day")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert sorted(r["id"] for r in out.collect()) == [1, 2]


def test_dense_ids_split_an_order_key_that_most_rows_share(spark, monkeypatch):
    from loomhouse.operators import keys

    stored = {}
    write = keys.materialize
    monkeypatch.setattr(keys, "materialize", lambda df, name: stored.setdefault(name, write(df, name)))
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 6, 7).otherwise(F.col("id") % 1000).alias("k"),
        F.when(F.col("id") % 10 < 3, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )
    numbered = keys.assign_dense_ids(df, ["k"], "sk", partitions=8)
    sizes = [r["count"] for r in stored["dense-ids"].groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 2 * 20_000 / 8 and sum(sizes) == 20_000
    rows = numbered.orderBy("sk").collect()
    assert [r["sk"] for r in rows] == list(range(1, 20_001))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)
