"""Every registered query agrees with its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from loomhouse.operators import skew
from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES, ORACLES) is None


@pytest.mark.parametrize(
    "name",
    [
        "scd2_point_lookup", "account_customer_overlap", "security_company_overlap",
        "financial_either_key", "cash_running_balance", "prospect_match",
        "prospect_match_strict", "script_name_resolve", "script_registry",
        "edge_direction_audit", "lineage_audit_extract", "lineage_upstream_paths",
        "lineage_downstream_impact", "load_order_levels", "account_dim", "trade_dim",
        "watches_fact", "financial_fact", "customer_dim", "holdings_fact",
    ],
)
def test_query_agrees_when_every_join_is_salted(spark, con, name, monkeypatch):
    found = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda df, on, _: found(df, on, 20))
    monkeypatch.setattr(skew, "broadcast_sized", lambda _: False)
    assert compare(spark, con, SF, name, QUERIES, ORACLES) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "account_version", "sk_dateid", "cash"]
    assert df.count() > 0
