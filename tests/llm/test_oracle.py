"""Queries of the text operators agree with their SQL on the smallest tables."""

import pytest

from loomhouse.llm.queries import ORACLES, QUERIES
from tests.compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, oracle_connection(SF), SF, name, QUERIES, ORACLES) is None
