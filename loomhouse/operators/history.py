"""Type-2 history that takes change batches one after another.

What a build needs of all changes of a key and day is an aggregate that
combines: the last change with its position, for fills also the first change
and the last values seen. The table keeps these beside the versions, one row per
key and day. A batch is aggregated likewise, combined with the stored days of
the buckets it touches, and their versions are drawn anew: the open version of
a touched key is closed, new ones follow, and a change that arrives late is put
in where it belongs. The result is that of one build over all changes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomhouse.operators.bucketed import BucketedTable
from loomhouse.operators.versions import OPEN_END


@dataclass(frozen=True)
class History:
    """How versions are made of changes; see ``scd2_build`` for the parameters."""

    keys: list[str]
    ts: str
    order: list[str]
    attrs: list[str]
    fill: str | None = None
    filled: list[str] | None = None

    @property
    def _filled(self) -> list[str]:
        return self.attrs if self.filled is None else self.filled

    def _pairs(self) -> list[tuple[str, str, str]]:
        """Value column, its position column, and which position wins."""
        pairs = [("_last", "_last_at", "max")]
        if self.fill == "first":
            pairs.append(("_first", "_first_at", "min"))
        if self.fill == "forward":
            pairs += [(f"_seen_{c}", f"_seen_at_{c}", "max") for c in self._filled]
        return pairs

    @property
    def state(self) -> list[str]:
        """Columns of the days that combine."""
        return [*self.keys, "effectivedate", *[c for v, at, _ in self._pairs() for c in (v, at)]]

    def days(self, changes: DataFrame) -> DataFrame:
        """One row per key and day of ``changes``; those without time are left out."""
        position = F.struct(self.ts, *self.order)
        values = {"_last": F.struct(*self.attrs), "_first": F.struct(*self._filled)}
        rows = changes.where(F.col(self.ts).isNotNull()).select(
            *self.keys,
            F.to_date(self.ts).alias("effectivedate"),
            *[
                c
                for value, at, _ in self._pairs()
                for c in (
                    values.get(value, F.col(value.removeprefix("_seen_"))).alias(value),
                    (
                        position
                        if value in values
                        else F.when(F.col(value.removeprefix("_seen_")).isNotNull(), position)
                    ).alias(at),
                )
            ],
        )
        return self.combined(rows)

    def combined(self, days: DataFrame) -> DataFrame:
        """Days that repeat a key and day as one, with a map-side combine."""
        best = {"max": (F.max_by, F.max), "min": (F.min_by, F.min)}
        aggs = []
        for value, at, which in self._pairs():
            by, of = best[which]
            aggs += [by(F.col(value), F.col(at)).alias(value), of(F.col(at)).alias(at)]
        return days.groupBy(*self.keys, "effectivedate").agg(*aggs)

    def versions(self, days: DataFrame) -> DataFrame:
        """The days with the attributes of their version, its end and whether it is open.

        A key has one row per calendar day at most, however many changes it has.
        """
        w = Window.partitionBy(*self.keys).orderBy("effectivedate")
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

        def value(c: str):
            own = F.col("_last")[c]
            if c in self._filled and self.fill == "first":
                own = F.coalesce(own, F.first(F.col("_first")[c]).over(so_far))
            elif c in self._filled and self.fill == "forward":
                own = F.last(F.col(f"_seen_{c}"), ignorenulls=True).over(so_far)
            return own.alias(c)

        following = F.lead("effectivedate").over(w)
        return days.select(
            *self.state,
            *[value(c) for c in self.attrs],
            F.coalesce(following, F.lit(OPEN_END).cast("date")).alias("enddate"),
            following.isNull().alias("iscurrent"),
        )


def apply_changes(
    spark: SparkSession,
    folder: str,
    history: History,
    batch: str,
    changes: DataFrame,
    buckets: int = 64,
) -> BucketedTable:
    """The versioned table in ``folder`` after ``batch``; made by the first batch.

    Batches may come in any order and overlap in time. A batch applied before
    changes nothing. Only buckets with a key of the batch are rewritten.
    """
    days = history.days(changes)
    if BucketedTable.exists(spark, folder):
        table = BucketedTable(spark, folder)
    else:
        schema = history.versions(days).schema
        table = BucketedTable.create(spark, folder, schema, history.keys, buckets)

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.select(*history.state).unionByName(new)
        return history.versions(history.combined(both))

    return table.apply(batch, days, merge)


def current_versions(table: BucketedTable, history: History) -> DataFrame:
    """The validity intervals, as ``scd2_build`` gives them."""
    return (
        table.rows()
        .where(F.col("effectivedate") < F.col("enddate"))
        .select(*history.keys, *history.attrs, "effectivedate", "enddate", "iscurrent")
    )
