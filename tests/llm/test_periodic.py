"""Runs found in the grammar against all periods tried by hand."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomhouse.llm import periodic

LEAST = periodic.LEAST


def brute_runs(w: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    n, best = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            b = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - b >= max(least, 3 * q):
                best.setdefault((b, i + q), q)
    return sorted((b, e - b, q) for (b, e), q in best.items())


def fibonacci(n: int) -> list[int]:
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def random_text(rng: random.Random) -> list[int]:
    out = []
    for _ in range(rng.randrange(1, 7)):
        base = [rng.randrange(rng.choice([1, 2, 3, 9, 400])) for _ in range(rng.randrange(1, 14))]
        kind = rng.random()
        if kind < 0.5:
            out += base * rng.randrange(1, 14) + base[: rng.randrange(len(base))]
        elif kind < 0.7:
            inner = base * 4
            out += (inner + [rng.randrange(50)]) * rng.randrange(1, 5)
        else:
            out += [rng.randrange(300) for _ in range(rng.randrange(40))]
    return out


def found_runs(w, least=LEAST):
    return [tuple(r) for r in periodic.runs_of(np.array(w, np.int64), least).tolist()]


def test_runs_equal_brute_force_on_random_texts():
    rng = random.Random(4)
    some = 0
    for _ in range(600):
        w = random_text(rng)
        got = found_runs(w)
        assert got == brute_runs(w), w
        some += bool(got)
    assert some > 200


@pytest.mark.parametrize("least", [6, 12, 24, 50])
def test_other_least_lengths(least):
    rng = random.Random(least)
    for _ in range(150):
        w = random_text(rng)
        assert found_runs(w, least) == brute_runs(w, least), w


@pytest.mark.parametrize(
    "w",
    [
        [], [1], [1] * 23, [1] * 24, [1] * 25, [1, 2] * 40, fibonacci(400),
        ([1, 2, 3] * 9 + [4]) * 5, list(range(50)) * 3, list(range(50)) * 2,
        [7] * 30 + [8] + [7] * 30 + [9] + [7] * 61,
    ],
    ids=range(11),
)
def test_special_words(w):
    assert found_runs(w) == brute_runs(w)


def expanded(symbols, rules, first):
    out = []
    for s in symbols:
        out += [s] if s < first else expanded(rules[s - first], rules, first)
    return out


def test_grammar_derives_the_text_and_leaves_no_pair_twice():
    rng = random.Random(2)
    for _ in range(200):
        w = random_text(rng)
        first = max(w, default=0) + 1
        rules, start = periodic.repair(w, first)
        assert expanded(start, rules, first) == w
        seen, taken = {}, -1
        for i, pair in enumerate(zip(start, start[1:], strict=False)):
            if i == taken:
                continue  # inside the pair before it
            assert pair not in seen
            seen[pair], taken = i, i + 1 if pair[0] == pair[1] else -1
        assert len(set(rules)) == len(rules)


def test_the_most_frequent_pair_comes_first():
    rules, start = periodic.repair([1, 2, 5, 3, 4, 1, 2, 6, 3, 4, 1, 2], 10)
    assert rules == [(1, 2), (3, 4)] or rules[0] == (1, 2)
    assert expanded(start, rules, 10) == [1, 2, 5, 3, 4, 1, 2, 6, 3, 4, 1, 2]


def test_a_long_repeated_passage_gives_a_flat_grammar():
    passage = list(range(1000))
    rules, _ = periodic.repair(passage + [5000] + passage, 6000)
    depth = {}
    for k, (a, b) in enumerate(rules):
        depth[6000 + k] = 1 + max(depth.get(a, 0), depth.get(b, 0))
    assert max(depth.values()) < 15


def collapsed(words, runs):
    gone = {i for b, n, q in runs for i in range(b + q, b + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows_of_a_table(spark):
    rng = random.Random(9)
    texts = [" \n".join(f"w{x}" for x in random_text(rng)) for _ in range(60)]
    texts += [None, "", " \t\n", "ab\xa0cd " * 30, "go " * 40_000, texts[0]]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name in ("id", "runs", "collapsed", "n_words"):
        df = df.withColumn(name, F.lit("mine"))
    got = sorted(
        ((r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(df).collect()),
        key=repr,
    )
    want = []
    for i, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = [(0, 40_000, 1)] if t == "go " * 40_000 else brute_runs(words)
        want.append((i, len(words), runs, collapsed(words, runs)))
    assert got == sorted(want, key=repr)
    assert periodic.periodic_runs(df.limit(0)).count() == 0


def test_reordered_words(spark):
    df = spark.createDataFrame(
        [(1, " ".join(map(str, range(100)))), (2, "a b")], "doc_id long, text string"
    )
    take = lambda i, n: np.arange(n) % 10 if i == 1 else None
    got = {r.id: r for r in periodic.periodic_runs(df, reordered=take).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 100, 10)]
    assert got[1].collapsed == " ".join(map(str, range(10))) and got[2].collapsed == "a b"
