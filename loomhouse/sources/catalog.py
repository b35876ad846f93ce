"""Column catalog of a set of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATALOG_SCHEMA = (
    "table_full_name string, column string, position int, type string, "
    "description string, comment string"
)


def catalog_of(
    spark: SparkSession, tables: dict[str, DataFrame], primary_keys: dict[str, list[str]] | None = None
) -> DataFrame:
    """One row per column: type, primary-key text and comment.

    Reads schemas only, no data. ``description`` is ``Primary Key: true`` for
    key columns and null otherwise.
    """
    keys = primary_keys or {}
    rows = [
        (
            name,
            f.name,
            position,
            f.dataType.simpleString(),
            "Primary Key: true" if f.name in keys.get(name, ()) else None,
            f.metadata.get("comment"),
        )
        for name, df in tables.items()
        for position, f in enumerate(df.schema)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def session_catalog(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The tables of a session database, keyed by ``database.table``."""
    return {
        f"{database}.{t.name}": spark.table(f"{database}.{t.name}")
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    }


def with_comments(schema: T.StructType, comments: dict[str, str]) -> T.StructType:
    """The schema with column comments as the catalog keeps them."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                f.dataType,
                f.nullable,
                f.metadata | ({"comment": comments[f.name]} if f.name in comments else {}),
            )
            for f in schema
        ]
    )


def register_files(
    spark: SparkSession,
    database: str,
    folder: str,
    files: dict[str, str],
    comments: dict[str, dict[str, str]],
) -> None:
    """A database in ``folder`` whose tables are parquet files that stay where they are.

    Column comments go into the catalog with the schema; no data are copied.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{folder}'")
    for name, path in files.items():
        schema = with_comments(spark.read.parquet(path).schema, comments.get(name, {}))
        spark.catalog.createTable(f"`{database}`.`{name}`", path=path, source="parquet", schema=schema)
