"""Registration of queries and shared helpers of the bindings."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomhouse.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and the SQL that gives the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            _STORED.clear()
            return fn(spark, sf)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(c: str) -> Column:
    """A column as text, named as before."""
    return F.col(c).cast("string").alias(c)


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def stamp(c: str) -> Column:
    """A zone-free timestamp as text up to the second."""
    return F.substring(F.col(c).cast("string"), 1, 19).alias(c)


def sql_case(column: str, codes: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items())
    return f"CASE {column} {arms} END"


def sql_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Tables written by the query that runs: a table is built once and read by all
# that stand on it. The next query starts anew.
_STORED: dict[tuple[str, str], DataFrame] = {}


def stored(
    spark,
    sf: str,
    name: str,
    build: Callable[[], DataFrame],
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    key = (sf, name)
    if key not in _STORED:
        _STORED[key] = materialize(build(), name, partition_by)
    return _STORED[key]
