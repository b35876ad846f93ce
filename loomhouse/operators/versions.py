"""Type-2 history: from change rows to non-overlapping validity intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def scd2_build(
    changes: DataFrame,
    keys: list[str],
    ts: str,
    order: list[str],
    attrs: list[str],
    fill: str | None = None,
    filled: list[str] | None = None,
) -> DataFrame:
    """Validity intervals per key, one version per day.

    A version starts on the day of its change and ends on the day of the next
    change; versions replaced on the day they started are dropped, so only the
    last change of a day survives. ``ts`` plus ``order`` must order the changes
    of a key totally.

    ``fill`` replaces nulls in ``filled`` (default: all ``attrs``):
    ``"first"`` takes the value of the key's first change, ``"forward"`` the
    last non-null value seen up to the version.

    The day's last change is picked by an aggregate, with a map-side combine,
    before anything is grouped by key; the window then sees at most one row
    per key and calendar day however many changes a key has.
    """
    filled = filled if filled is not None else attrs
    position = F.struct(ts, *order)
    aggs = [F.max_by(F.struct(*attrs), position).alias("_last")]
    if fill == "first":
        aggs.append(F.min_by(F.struct(*filled), position).alias("_first"))
    if fill == "forward":
        aggs += [
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), position)).alias(f"_seen_{c}")
            for c in filled
        ]
    days = (
        changes.where(F.col(ts).isNotNull())
        .withColumn("effectivedate", F.to_date(ts))
        .groupBy(*keys, "effectivedate")
        .agg(*aggs)
    )
    w = Window.partitionBy(*keys).orderBy("effectivedate")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def value(c: str):
        own = F.col("_last")[c]
        if c not in filled or fill is None:
            return own.alias(c)
        if fill == "first":
            return F.coalesce(own, F.first(F.col("_first")[c]).over(so_far)).alias(c)
        return F.last(F.col(f"_seen_{c}"), ignorenulls=True).over(so_far).alias(c)

    following = F.lead("effectivedate").over(w)
    return days.select(
        *keys,
        *[value(c) for c in attrs],
        "effectivedate",
        F.coalesce(following, F.lit(OPEN_END).cast("date")).alias("enddate"),
        following.isNull().alias("iscurrent"),
    ).where(F.col("effectivedate") < F.col("enddate"))
