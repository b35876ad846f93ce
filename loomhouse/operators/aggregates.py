"""Totals, balances, watch periods, usage statistics and table audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_total(df: DataFrame, keys: list[str], ts: str, amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` per key and calendar day (column ``datevalue``)."""
    return df.groupBy(*keys, F.to_date(ts).alias("datevalue")).agg(F.sum(amount).alias(name))


def running_total(keys: list[str], day: str, amount: str) -> Column:
    """Balance up to and including ``day``; equal days share one balance.

    Meant for daily totals, where a key has at most one row per calendar day.
    """
    return F.sum(amount).over(Window.partitionBy(*keys).orderBy(day))


def watch_periods(
    df: DataFrame, keys: list[str], ts: str, action: str, cancel: str, paired: bool = False
) -> DataFrame:
    """Placement and removal days of watches.

    As loaded by the warehouse, the removal day is part of the grouping, so a
    removal never shares a row with its placement; ``paired`` instead gives one
    row per key with the first placement and the last removal.
    """
    cancelled = F.col(action) == F.lit(cancel)
    if paired:
        return df.groupBy(*keys).agg(
            F.to_date(F.min(F.when(~cancelled, F.col(ts)))).alias("dateplaced"),
            F.to_date(F.max(F.when(cancelled, F.col(ts)))).alias("dateremoved"),
        )
    removed = F.when(cancelled, F.to_date(ts)).alias("dateremoved")
    return df.groupBy(*keys, removed).agg(F.to_date(F.min(ts)).alias("dateplaced"))


def usage_stats(
    df: DataFrame, group: list[str], measures: list[str], name: str, order: list[str]
) -> DataFrame:
    """min/max/avg/sum of each measure and the name at its min and max.

    The first row along ``order`` wins a tie. Without any row the numbers are 0
    and the names ``N/A`` (global form, ``group=[]``).
    """
    aggs = []
    for m in measures:
        present = F.col(m).isNotNull()
        low = F.when(present, F.struct(F.col(m), *order))
        high = F.when(present, F.struct(-F.col(m), *order))
        aggs += [
            F.coalesce(F.min(m), F.lit(0)).alias(f"min_{m}"),
            F.coalesce(F.max(m), F.lit(0)).alias(f"max_{m}"),
            F.coalesce(F.avg(m), F.lit(0.0)).alias(f"avg_{m}"),
            F.coalesce(F.sum(m), F.lit(0)).alias(f"sum_{m}"),
            F.coalesce(F.min_by(name, low), F.lit("N/A")).alias(f"{name}_at_min_{m}"),
            F.coalesce(F.min_by(name, high), F.lit("N/A")).alias(f"{name}_at_max_{m}"),
        ]
    return df.groupBy(*group).agg(*aggs)


def row_audit(tables: dict[str, DataFrame], only_empty: bool = False) -> DataFrame:
    """Row count per table in one job; optionally only the empty tables."""
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), "n_rows"
            )
            for name, df in tables.items()
        ],
    )
    return counts.where("n_rows = 0") if only_empty else counts
