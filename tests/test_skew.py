"""Salted joins give the rows of a plain join, also when forced to salt."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomhouse.operators import intervals, skew
from loomhouse.operators.intervals import overlap_join, point_lookup

FORCE = {"rows_per_task": 20}


@pytest.fixture(autouse=True)
def counted(monkeypatch):
    """The sides of these tests are small; treat them as beyond a broadcast."""
    monkeypatch.setattr(skew, "broadcast_sized", lambda _: False)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    """A left side whose first key holds a third of the rows, some keys null."""
    left = spark.range(900).select(
        F.when(F.col("id") < 300, 1).when(F.col("id") % 10 == 0, None)
        .otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return left, right.unionByName(right.where("k < 3").withColumn("w", F.lit(-1).cast("long")))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_equals_plain(sides, how):
    left, right = sides
    assert _rows(skew.salted_join(left, right, ["k"], how, **FORCE)) == _rows(
        left.join(right, ["k"], how)
    )


def test_residual_condition(sides):
    left, right = sides
    got = skew.salted_join(left, right, ["k"], "left", extra=F.col("w") > F.col("v"), **FORCE)
    plain = left.join(
        right.withColumnRenamed("k", "rk"), (F.col("k") == F.col("rk")) & (F.col("w") > F.col("v")), "left"
    ).drop("rk")
    assert _rows(got.select("k", "v", "w")) == _rows(plain.select("k", "v", "w"))


def test_hot_keys_are_found_and_bounded(sides):
    left, _ = sides
    hot = {r["k"]: r["_salts"] for r in skew.hot_keys(left, ["k"], 100).collect()}
    assert hot == {1: 4}


def test_hot_key_is_spread_over_tasks(spark, sides):
    left, right = sides
    joined = skew.salted_join(left, right.dropDuplicates(["k"]), ["k"], **FORCE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        parts = (
            joined.where("k = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(parts) > 3
    assert sum(r["count"] for r in parts) == 312


def test_small_right_side_is_broadcast_without_counting(sides, monkeypatch):
    left, right = sides
    monkeypatch.undo()
    monkeypatch.setattr(skew, "hot_keys", None)
    joined = skew.salted_join(left, right, ["k"], "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
    assert _rows(joined) == _rows(left.join(right, ["k"], "left"))


def test_without_hot_keys_the_join_is_a_plain_one(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = skew.salted_join(left, right, ["k"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Join") == 1 and "_salt" not in plan


def test_left_rows_without_key_are_spread(spark, sides):
    left = sides[0].withColumn("k", F.lit(None).cast("long"))
    joined = skew.salted_join(left, sides[1], ["k"], "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(parts) == 8 and sum(r["count"] for r in parts) == 900


def test_hot_keys_of_both_sides(spark, sides):
    left, _ = sides
    right = spark.range(200).select((F.col("id") % 2).alias("k"), F.col("id").alias("w"))
    both = skew.salted_join(left, right, ["k"], spread_right=True, **FORCE)
    assert _rows(both) == _rows(left.join(right, ["k"]))
    with pytest.raises(ValueError):
        skew.salted_join(left, right, ["k"], "left", spread_right=True)


def test_stray_dates_and_empty_facts_do_not_multiply_the_dimension(spark):
    dim = _intervals(spark, 40, 1, "d")
    days = spark.sql("SELECT 0L AS k, DATE'9999-12-30' AS day UNION ALL SELECT 0L, DATE'2020-02-01'")
    for fact in (days, days.where("k = 1")):
        found = point_lookup(fact, dim, ["k"], "day")
        plain = fact.join(dim, ["k"]).where("day >= effectivedate AND day < enddate")
        assert found.count() == plain.count()
        seen = intervals._slices(fact.select(intervals._slice(F.col("day"), 366).alias("s")))
        sliced = intervals._with_slices(dim, "effectivedate", "enddate", seen, 366)
        assert sliced.count() <= 2 * dim.count()


def _intervals(spark, n, seed, name):
    return spark.range(n).select(
        F.when(F.col("id") < n // 3, 0).otherwise(F.col("id") % 7).alias("k"),
        F.col("id").alias(name),
        F.expr(f"date_add(DATE'2020-01-01', int(abs(xxhash64(id, {seed})) % 900))").alias("effectivedate"),
    ).withColumn(
        "enddate",
        F.expr(
            f"CASE WHEN {name} % 5 = 0 THEN DATE'9999-12-31' "
            f"ELSE date_add(effectivedate, int({name} % 41)) END"
        ),
    )


@pytest.mark.parametrize("slice_days", [7, 366])
@pytest.mark.parametrize("force", [{}, FORCE])
def test_point_lookup_is_the_range_join(spark, slice_days, force):
    dim = _intervals(spark, 120, 1, "d")
    fact = spark.range(400).select(
        F.when(F.col("id") < 150, 0).otherwise(F.col("id") % 9).alias("k"),
        F.col("id").alias("f"),
        F.expr("date_add(DATE'2020-01-01', int(abs(xxhash64(id, 5)) % 1000))").alias("day"),
    )
    got = point_lookup(
        fact, dim, ["k"], "day", slice_days=slice_days,
        rows_per_task=force.get("rows_per_task", skew.ROWS_PER_TASK),
    )
    plain = fact.alias("f").join(
        dim.alias("d"),
        F.expr("f.k = d.k AND f.day >= d.effectivedate AND f.day < d.enddate"),
    ).select("f.k", "f.f", "f.day", "d.d")
    assert _rows(got.select("k", "f", "day", "d")) == _rows(plain)


@pytest.mark.parametrize("slice_days", [7, 366])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlap_join_is_the_interval_join(spark, slice_days, how):
    a, b = _intervals(spark, 120, 1, "a"), _intervals(spark, 90, 2, "b")
    got = overlap_join(a, b, ["k"], how, slice_days=slice_days)
    a.createOrReplaceTempView("ta")
    b.createOrReplaceTempView("tb")
    plain = spark.sql(
        f"""
        SELECT ta.k, a, b, greatest(ta.effectivedate, tb.effectivedate) AS effectivedate,
               least(ta.enddate, tb.enddate) AS enddate
        FROM ta {how} JOIN tb ON ta.k = tb.k AND tb.enddate > ta.effectivedate
             AND tb.effectivedate < ta.enddate
        WHERE ta.effectivedate < ta.enddate"""
    )
    assert _rows(got.select("k", "a", "b", "effectivedate", "enddate")) == _rows(plain)


def test_overlap_without_partners_keeps_left(spark):
    a = _intervals(spark, 10, 1, "a").where("effectivedate < enddate")
    none = _intervals(spark, 10, 2, "b").where("k = 99")
    got = overlap_join(a, none, ["k"], "left")
    assert got.where("b IS NULL").count() == got.count() == a.count()
