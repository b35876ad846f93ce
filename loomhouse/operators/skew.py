"""Equi joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomhouse.session import materialize

# A key above this many rows is spread over several tasks.
ROWS_PER_TASK = 2_000_000
# More hot keys than this are joined by a shuffle instead of a broadcast.
BROADCAST_KEYS = 500_000
# Tasks over which left rows without a key are spread.
NULL_SALTS = 4096


def broadcast_sized(df: DataFrame) -> bool:
    """Whether Spark estimates ``df`` below its broadcast threshold.

    The same estimate decides when Spark plans the join, so such a side is
    broadcast and no task holds all rows of a key.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def hot_keys(df: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than a task should hold, and their salt count."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > rows_per_task).select(
        *on, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_salts")
    )


def _sized(hot: DataFrame) -> DataFrame | None:
    """The list of hot keys, to be broadcast where its size allows; None if empty."""
    n = hot.count()
    if not n:
        return None
    return F.broadcast(hot) if n <= BROADCAST_KEYS else hot


def _row_hash(df: DataFrame, spread: list[str] | None) -> Column:
    hashed = spread or [c for c, t in df.dtypes if "map<" not in t]
    return F.xxhash64(*[F.col(f"`{c}`") for c in hashed])


def _no_key(on: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in on])


def _salted(
    df: DataFrame, hot: DataFrame | None, on: list[str], name: str, spread: list[str] | None
) -> DataFrame:
    """Rows of hot keys dealt over the salts of their key, by a hash of the row.

    A hash, not a row number: a task that runs again gives the same salts. Rows
    without a key are dealt over many salts; they match nothing.
    """
    if hot is not None:
        df = df.join(hot, on, "left")
    salts = F.coalesce("_salts", F.lit(1)) if hot is not None else F.lit(1)
    salts = F.when(_no_key(on), NULL_SALTS).otherwise(salts)
    salt = F.when(salts > 1, F.pmod(_row_hash(df.drop("_salts"), spread), salts)).otherwise(0)
    return df.withColumn(name, salt.cast("int")).drop("_salts")


def _repeated(df: DataFrame, hot: DataFrame | None, on: list[str], name: str) -> DataFrame:
    """Rows of hot keys once for each salt of their key."""
    if hot is None:
        return df.withColumn(name, F.lit(0))
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    return df.join(hot, on, "left").withColumn(name, salts).drop("_salts")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    extra: Column | None = None,
    profile: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    spread: list[str] | None = None,
    spread_right: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join whose left side may be dominated by a few keys.

    Where Spark broadcasts the right side, nothing is counted or salted. Else
    the hot keys of the left side are counted and stored once; without any, the
    join is a plain one. Left rows of a hot key are spread by a hash of the row
    (of the ``spread`` columns, if given) over as many salts as the key needs;
    the matching right rows are repeated once per salt. ``spread_right`` does
    the same for hot keys of the right side of an inner join.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``; ``extra``
    is a residual condition over the two sides. ``profile`` is a cheaper frame
    with the key distribution of ``left`` (its base table, say); ``hot`` are its
    hot keys where they are known, as ``hot_keys`` gives them. Rows with a null
    key match nothing; a left or anti join that keeps them spreads them.
    """
    if spread_right and how != "inner":
        raise ValueError("only an inner join can spread both sides")
    if hot is None:
        if broadcast_sized(right):
            return _join(left, right, on, how, extra)
        sized = profile if profile is not None else left
        hot = materialize(hot_keys(sized.where(~_no_key(on)), on, rows_per_task), "hot-keys")
    hot = _sized(hot)
    hot_right = None
    if spread_right:
        found = hot_keys(right.where(~_no_key(on)), on, rows_per_task)
        hot_right = _sized(materialize(found, "hot-keys"))
    keeps_null = how in ("left", "left_anti") and any(left.schema[c].nullable for c in on)
    if hot is None and hot_right is None and not keeps_null:
        return _join(left, right, on, how, extra)
    keys = [*on, "_salt"]
    salted = _salted(left, hot, on, "_salt", spread)
    other = _repeated(right, hot, on, "_salt")
    if hot_right is not None:
        salted = _repeated(salted, hot_right, on, "_right_salt")
        other = _salted(other, hot_right, on, "_right_salt", right.columns)
        keys.append("_right_salt")
    return _join(salted, other, keys, how, extra).drop("_salt", "_right_salt")


def _join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, extra: Column | None
) -> DataFrame:
    if extra is None:
        return left.join(right, keys, how)
    marked = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r_{k}") for k in keys])
    return left.join(marked, same & extra, how).drop(*[f"_r_{k}" for k in keys])
