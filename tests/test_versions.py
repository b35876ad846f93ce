"""Version building: contiguous, one per day, filled as asked."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loomhouse.operators.aggregates import daily_total, running_total, watch_periods
from loomhouse.operators.versions import scd2_build

SCHEMA = "k int, ts timestamp_ntz, n int, a string, b string"
D = dt.datetime


def _build(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = scd2_build(df, ["k"], "ts", ["n"], ["a", "b"], **kw)
    return [tuple(r) for r in out.orderBy("k", "effectivedate").collect()]


OPEN = dt.date(9999, 12, 31)


def test_same_day_versions_collapse_to_the_last(spark):
    rows = [
        (1, D(2020, 1, 1, 8), 1, "x", None),
        (1, D(2020, 1, 1, 9), 2, "y", "p"),
        (1, D(2020, 1, 3), 3, None, None),
        (2, D(2020, 1, 2), 4, "z", None),
        (3, None, 5, "never", None),
    ]
    assert _build(spark, rows) == [
        (1, "y", "p", dt.date(2020, 1, 1), dt.date(2020, 1, 3), False),
        (1, None, None, dt.date(2020, 1, 3), OPEN, True),
        (2, "z", None, dt.date(2020, 1, 2), OPEN, True),
    ]


def test_fill_first_takes_the_first_change_nulls_included(spark):
    rows = [
        (1, D(2020, 1, 1, 8), 1, "x", None),
        (1, D(2020, 1, 1, 9), 2, "y", "p"),
        (1, D(2020, 1, 3), 3, None, None),
    ]
    got = _build(spark, rows, fill="first", filled=["a", "b"])
    # the first change of the key was replaced on its own day, and still fills
    assert [r[1:3] for r in got] == [("y", "p"), ("x", None)]


def test_fill_forward_takes_the_last_known(spark):
    rows = [
        (1, D(2020, 1, 1), 1, "x", "p"),
        (1, D(2020, 1, 2, 1), 2, "y", None),
        (1, D(2020, 1, 2, 2), 3, None, None),
        (1, D(2020, 1, 5), 4, None, "q"),
    ]
    got = _build(spark, rows, fill="forward")
    assert [r[1:3] for r in got] == [("x", "p"), ("y", "p"), ("y", "q")]


changes = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 400), st.integers(0, 23)), max_size=40
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(changes)
def test_versions_never_overlap_and_are_contiguous(spark, rows):
    data = [
        (k, D(2020, 1, 1) + dt.timedelta(days=d, hours=h), i, str(i), None)
        for i, (k, d, h) in enumerate(rows)
    ]
    by_key: dict[int, list] = {}
    for r in _build(spark, data):
        by_key.setdefault(r[0], []).append(r)
    assert set(by_key) == {k for k, _, _ in rows}
    for k, versions in by_key.items():
        assert [v[4] for v in versions[:-1]] == [v[3] for v in versions[1:]]
        assert versions[-1][4] == OPEN and [v[5] for v in versions].count(True) == 1
        assert len(versions) == len({d for kk, d, _ in rows if kk == k})


def test_the_window_never_sees_raw_changes(spark):
    """Changes are aggregated per key and day before they meet by key."""
    df = spark.createDataFrame([(1, D(2020, 1, 1), 1, "x", None)], SCHEMA)
    plan = scd2_build(df, ["k"], "ts", ["n"], ["a"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("partial_max_by")


def test_running_balance(spark):
    cash = spark.createDataFrame(
        [(1, D(2020, 1, 1, 3), 5.0), (1, D(2020, 1, 1, 4), 2.5), (1, D(2020, 1, 4), -1.0)],
        "k int, ts timestamp_ntz, amt double",
    )
    daily = daily_total(cash, ["k"], "ts", "amt", "total")
    got = daily.select("datevalue", running_total(["k"], "datevalue", "total").alias("cash"))
    assert sorted(r["cash"] for r in got.collect()) == [6.5, 7.5]


@pytest.mark.parametrize("paired, rows", [(False, 2), (True, 1)])
def test_watch_removal(spark, paired, rows):
    events = spark.createDataFrame(
        [(1, D(2020, 1, 1), "ACTV"), (1, D(2020, 2, 1), "CNCL")],
        "k int, ts timestamp_ntz, act string",
    )
    got = watch_periods(events, ["k"], "ts", "act", "CNCL", paired).collect()
    assert len(got) == rows
    full = [r for r in got if r["dateplaced"] and r["dateremoved"]]
    if paired:
        assert full[0]["dateplaced"] == dt.date(2020, 1, 1)
    else:
        # a removal row carries its own day as placement, never the real one
        assert full[0]["dateplaced"] == full[0]["dateremoved"]
