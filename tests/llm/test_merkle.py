"""The manifest against a plain one, and what it stores."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomhouse.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text) -> str:
    i, _, lang, source, n = row
    values = [None if v is None else str(v) for v in (i, source, lang, n, text)]
    return H(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def tree(leaves: list[str]) -> tuple[str, list[list[str]]]:
    """The top and all levels below it."""
    levels = []
    while len(leaves) > 1:
        levels.append(leaves)
        leaves = [H(*leaves[i : i + 3]) for i in range(0, len(leaves), 3)]
    return leaves[0], levels


def path(levels, i):
    """Siblings before and behind, level by level."""
    out = []
    for level in levels:
        first = i - i % 3
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return out


def brute(rows, found):
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row, leaf_of(row, row[1])))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        made[name] = tree([leaf for _, leaf in groups[name]])
    root, top = tree([made[n][0] for n in names]) if names else (None, [])
    out = []
    for k, name in enumerate(names):
        subroot, levels = made[name]
        for i, (row, leaf) in enumerate(groups[name]):
            proof = path(levels, i) + path(top, k)
            h = leaf_of(row, found(row))
            for before, behind in proof:
                h = H(before, h, behind)
            out.append((row[0], leaf, subroot, root, H(*[b + a for b, a in proof]), h, h == root))
    return sorted(out, key=repr)


def rows_of(n: int, sources: list, seed: int):
    rng = random.Random(seed)
    words = ["ä", "b\nc", "d", "\n", ""]
    return [
        (
            rng.choice([None, *range(3 * n)]) if rng.random() < 0.1 else i,
            rng.choice([None, " ".join(rng.choices(words, k=rng.randrange(6)))]),
            rng.choice([None, "en", "fr"]),
            rng.choice(sources),
            rng.choice([None, 7]),
        )
        for i in range(n)
    ]


def manifest_of(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    tampered = F.when(F.col("id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.document_manifest(df, tampered).collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 81, 82, 400])
def test_manifest_equals_the_plain_one(spark, n):
    # one source holds most rows, and one is null
    rows = rows_of(n, ["hot"] * 8 + [None, "", "a", "é", "z"], n)
    rows += rows[:1] * 2
    found = lambda r: r[1].replace("\n", "") if r[1] and r[0] is not None and r[0] % 2 == 0 else r[1]
    assert manifest_of(spark, rows) == brute(rows, found)


def test_many_sources_make_a_deep_top_tree(spark):
    rows = rows_of(300, [f"s{i}" for i in range(120)], 5)
    found = lambda r: r[1].replace("\n", "") if r[1] and r[0] is not None and r[0] % 2 == 0 else r[1]
    assert manifest_of(spark, rows) == brute(rows, found)


def test_empty_table_and_clashing_columns(spark):
    assert manifest_of(spark, []) == []
    rows = rows_of(30, ["a", "b"], 3)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "pos", "n", "hash", "above", "_at", "_part", "id", "group", "f0", "other"):
        df = df.withColumn(name, F.lit("mine"))
    got = sorted((tuple(r) for r in merkle.document_manifest(df).collect()), key=repr)
    assert got == brute(rows, lambda r: r[1])
    assert all(r[-1] for r in got)


def test_very_long_text(spark):
    rows = [(1, "x\n" * 1_500_000, "en", "a", 1), (2, "y", "en", "a", 1)]
    got = manifest_of(spark, rows)
    assert got == brute(rows, lambda r: r[1].replace("\n", "") if r[0] == 2 else r[1])


def test_only_every_fourth_level_is_stored(spark):
    leaves = spark.range(1000).select(
        F.lit("t").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("hash")
    )
    groups, roots = merkle.manifest(leaves, ["id"], ["id"])
    # seven levels above 1,000 leaves: 0, 4 and the top are kept
    assert [g.count() for g in groups] == [1000, 13, 1]
    assert [r.count() for r in roots] == [1]


def test_positions_do_not_depend_on_partitions(spark):
    leaves = spark.range(500).select(
        F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("tree"),
        (F.col("id") * 7919 % 500).alias("id"),
        F.lit("h").alias("hash"),
    )
    want = sorted(tuple(r) for r in merkle.placed(leaves, ["id"], 1).select("tree", "id", "pos", "n").collect())
    got = sorted(tuple(r) for r in merkle.placed(leaves, ["id"], 13).select("tree", "id", "pos", "n").collect())
    assert got == want
    assert [r[2] for r in want if r[0] == "hot"] == list(range(300))
