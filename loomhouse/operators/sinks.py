"""Writing into fixed schemas: positional conform and keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(
    df: DataFrame, schema: T.StructType, by_name: bool = False, enforce: bool = True
) -> DataFrame:
    """Rename (by position, unless ``by_name``) and cast to a target schema.

    Column comments of the schema are carried as metadata. A null in a column
    that the schema declares NOT NULL raises an error; ``enforce=False`` lets it
    pass.
    """
    if not by_name and len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns for a target of {len(schema)}")
    sources = schema.names if by_name else df.columns

    def value(source: str, f: T.StructField):
        cast = F.col(f"`{source}`").cast(f.dataType)
        if enforce and not f.nullable:
            missing = F.raise_error(F.lit(f"{f.name} must not be null")).cast(f.dataType)
            cast = F.coalesce(cast, missing)
        return cast.alias(f.name, metadata=f.metadata)

    return df.select(*[value(s, f) for s, f in zip(sources, schema)])


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key along ``order`` (map-side combined)."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    keep: list[str],
    order: list[str],
) -> DataFrame:
    """``target`` after merging ``updates`` on ``keys``, as a new frame.

    Existing rows take every column from the update except ``keep``, which
    stay as first loaded; unknown keys are appended. Several updates of one
    key are reduced to the last along ``order``. Write the result to a new
    location and swap: it reads the old target.
    """
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*rest).alias("_old"))
    new = last_per_key(updates, keys, order).select(*keys, F.struct(*rest).alias("_new"))

    def pick(c: str):
        newer, older = F.col("_new")[c], F.col("_old")[c]
        if c in keep:
            value = F.when(F.col("_old").isNotNull(), older).otherwise(newer)
        else:
            value = F.when(F.col("_new").isNotNull(), newer).otherwise(older)
        return value.alias(c)

    merged = old.join(new, keys, "full_outer")
    return merged.select(*keys, *[pick(c) for c in rest]).select(*target.columns)


def save(df: DataFrame, folder: str, mode: str = "append", partition_by: tuple = ()) -> None:
    """Append to (or replace) a parquet table."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
