"""Bucketed tables and histories that take batches: equal to one build, safe to repeat."""

from __future__ import annotations

import datetime as dt
import random
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F


from loomhouse.operators.bucketed import BucketedTable, upsert_bucketed
from loomhouse.operators.history import History, apply_changes, current_versions
from loomhouse.operators.sinks import upsert
from loomhouse.operators.versions import scd2_build
from loomhouse.sources.store import AlreadyThere, Store

ROOT = Path(__file__).resolve().parents[1]
SCHEMA = "k long, v string, n int, first int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(folder) -> set[str]:
    return {str(p.relative_to(folder)) for p in Path(folder).glob("data/**/*.parquet")}


def named(table) -> set[str]:
    """Data files the newest manifest stands for."""
    root = Path(table.store.path().removeprefix("file:"))
    return {
        str(p.relative_to(root))
        for f in table.manifest["buckets"].values()
        for p in (root / f).glob("*.parquet")
    }


def batch_of(spark, keys, value, n):
    return spark.createDataFrame([(k, f"{value}{k}", n, n) for k in keys], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    made = BucketedTable.create(
        spark, str(tmp_path / "t"), batch_of(spark, [], "", 0).schema, ["k"], 16
    )
    return upsert_bucketed(made, "one", batch_of(spark, range(200), "a", 1), ["first"], ["n"])


def test_upsert_equals_the_full_rewrite(spark, table):
    old = batch_of(spark, range(200), "a", 1)
    new = batch_of(spark, range(150, 260), "b", 2).unionByName(batch_of(spark, [150], "c", 3))
    after = upsert_bucketed(table, "two", new, ["first"], ["n"])
    assert rows(after.rows()) == rows(upsert(old, new, ["k"], ["first"], ["n"]))
    assert after.version == table.version + 1 == 2


def test_buckets_without_a_change_keep_their_files(spark, table, tmp_path):
    before = dict(table.manifest["buckets"])
    after = upsert_bucketed(table, "two", batch_of(spark, [7], "b", 2), ["first"], ["n"])
    changed = {b for b, f in after.manifest["buckets"].items() if before[b] != f}
    assert len(before) == 16 and len(changed) == 1
    assert len(named(table) & named(after)) == len(named(table)) - 1
    # only the bucket of the key was read
    again = after.rows([int(next(iter(changed)))])
    assert again.where("k = 7").first().v == "b7" and again.count() < 40
    assert upsert_bucketed(after, "none", batch_of(spark, [], "", 0), ["first"], ["n"]).version == 3


def test_a_batch_sent_again_writes_nothing(spark, table, tmp_path):
    new = batch_of(spark, range(50), "b", 2)
    after = upsert_bucketed(table, "two", new, ["first"], ["n"])
    held = files(tmp_path / "t")
    again = upsert_bucketed(after, "two", new, ["first"], ["n"])
    assert again.version == after.version and files(tmp_path / "t") == held


def test_a_batch_that_fails_before_the_rename_leaves_the_table(spark, table, tmp_path, monkeypatch):
    new, before = batch_of(spark, range(100, 300), "b", 2), rows(table.rows())
    publish = Store.publish

    def broken(self, *_):
        raise OSError("lost")

    monkeypatch.setattr(Store, "publish", broken)
    with pytest.raises(OSError):
        upsert_bucketed(table, "two", new, ["first"], ["n"])
    monkeypatch.setattr(Store, "publish", publish)
    now = BucketedTable(spark, table.store.path())
    assert now.version == table.version and rows(now.rows()) == before
    after = upsert_bucketed(now, "two", new, ["first"], ["n"])
    assert after.rows().count() == after.rows().select("k").distinct().count() == 300
    assert named(after) < files(tmp_path / "t")


def test_of_two_writers_the_second_is_refused(spark, table):
    other = BucketedTable(spark, table.store.path())
    upsert_bucketed(table, "two", batch_of(spark, [1], "b", 2), ["first"], ["n"])
    with pytest.raises(AlreadyThere):
        upsert_bucketed(other, "three", batch_of(spark, [2], "c", 2), ["first"], ["n"])
    with pytest.raises(FileNotFoundError):
        BucketedTable(spark, table.store.path() + "-none")


def test_a_task_that_fails_and_runs_again_writes_nothing_twice(tmp_path):
    code = f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from loomhouse.operators.bucketed import BucketedTable, upsert_bucketed

        spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")

        def once(batches):
            for b in batches:
                yield b
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("executor lost")

        rows = spark.range(300).selectExpr("id as k", "concat('b', id) as v", "2 as n", "2 as first")
        table = BucketedTable.create(spark, {str(tmp_path / "t")!r}, rows.schema, ["k"], 8)
        flaky = rows.mapInArrow(once, rows.schema)
        done = upsert_bucketed(table, "one", flaky, ["first"], ["n"])
        done = upsert_bucketed(done, "two", flaky.where("k < 100"), ["first"], ["n"])
        found = done.rows()
        print("ROWS", found.count(), found.select("k").distinct().count(), done.version)
    """
    run = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=300
    )
    assert "ROWS 300 300 2" in run.stdout, run.stderr[-2000:]


def changes_of(spark, seed):
    rng = random.Random(seed)
    start = dt.datetime(2020, 1, 1)
    made = [
        (
            rng.choice([1, 1, 1, *range(20)]),
            rng.choice([None] + [start + dt.timedelta(hours=rng.randrange(24 * 40))] * 9),
            i,
            rng.choice([None, "x", "y", "z"]),
            rng.choice([None, 1, 2]),
        )
        for i in range(300)
    ]
    return spark.createDataFrame(made, "k long, ts timestamp, o int, a string, b int")


@pytest.mark.parametrize("fill", [None, "first", "forward"])
@pytest.mark.parametrize("seed", [1, 2])
def test_batches_give_the_rows_of_one_build(spark, tmp_path, fill, seed):
    changes = changes_of(spark, seed).cache()
    how = History(["k"], "ts", ["o"], ["a", "b"], fill, ["a"])
    want = scd2_build(changes, ["k"], "ts", ["o"], ["a", "b"], fill, ["a"])
    # three batches that overlap in time, in an order that is not theirs
    part = F.pmod(F.xxhash64("o", F.lit(seed)), F.lit(3))
    folder = str(tmp_path / "h")
    for k in (2, 0, 1, 0):
        done = apply_changes(spark, folder, how, f"batch-{k}", changes.where(part == k), buckets=8)
    got = current_versions(done, how)
    assert got.columns == want.columns
    assert rows(got) == rows(want) and done.version == 3


def test_a_small_batch_leaves_other_buckets_and_closes_the_open_version(spark, tmp_path):
    how = History(["k"], "ts", ["o"], ["a"])
    make = lambda r: spark.createDataFrame(r, "k long, ts timestamp, o int, a string")
    day = lambda d: dt.datetime(2020, 1, d, 5)
    folder = str(tmp_path / "h")
    first = apply_changes(spark, folder, how, "1", make([(k, day(1), k, "old") for k in range(100)]), 8)
    after = apply_changes(spark, folder, how, "2", make([(3, day(9), 1, "new")]))
    assert len(named(first) - named(after)) == 1 and len(named(first) & named(after)) == len(named(first)) - 1
    got = rows(current_versions(after, how).where("k = 3"))
    end = dt.date(9999, 12, 31)
    assert got == [
        (3, "new", dt.date(2020, 1, 9), end, True),
        (3, "old", dt.date(2020, 1, 1), dt.date(2020, 1, 9), False),
    ]
    assert current_versions(after, how).where("iscurrent").count() == 100


def test_an_empty_first_batch_makes_an_empty_history(spark, tmp_path):
    how = History(["k"], "ts", ["o"], ["a", "b"])
    none = changes_of(spark, 1).limit(0)
    assert current_versions(apply_changes(spark, str(tmp_path / "h"), how, "1", none), how).count() == 0


def test_store_names_and_texts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.names() == []
    store.publish("a.json", "é")
    assert store.read_text("a.json") == "é" and "a.json" in store.names()
    with pytest.raises(AlreadyThere):
        store.publish("a.json", "other")
    assert store.read_text("a.json") == "é"
