"""Writes that are checked while they run and published only if the checks hold.

Counts, nulls and distinct keys are observed on the rows as they are written, so
the audit costs no second scan. The rows go to a folder of their own, which is
renamed into place when all checks hold; else nothing is published.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from loomhouse.sources.store import Store


class AuditFailed(RuntimeError):
    """What a write was refused for."""


@dataclass(frozen=True)
class Checks:
    """``not_null`` columns, ``unique`` keys, and named ``rules``, SQL that holds for every row.

    At most ``copies`` rows may share the ``unique`` keys; ``least_rows`` guards
    against an input that came empty.
    """

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    rules: tuple[tuple[str, str], ...] = ()
    least_rows: int = 0
    copies: int = 1


def write_audited(df: DataFrame, folder: str, name: str, checks: Checks) -> dict[str, int]:
    """Writes ``df`` as parquet to ``folder/name`` and returns what was observed.

    The metrics are ``rows``, ``null_<column>`` of every column, ``distinct``
    (a sketch, of the unique keys), ``most_copies`` of a key and ``broken_<rule>``.
    Copies are counted where the rows are, after a shuffle by the keys; equal
    keys meet in one task, which is what a unique key must not have many of.
    """
    seen = df
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in df.columns
    ]
    metrics += [F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(f"broken_{n}") for n, rule in checks.rules]
    if checks.unique:
        keys = [F.col(f"`{c}`") for c in checks.unique]
        seen = seen.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        metrics += [
            F.coalesce(F.max("_copies"), F.lit(0)).alias("most_copies"),
            F.approx_count_distinct(F.struct(*keys)).alias("distinct"),
        ]
    observed = Observation(f"audit-{uuid.uuid4().hex}")
    rows = seen.observe(observed, *metrics).select(*[F.col(f"`{c}`") for c in df.columns])
    store = Store(df.sparkSession, folder)
    staged = f"staged/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(store.path(staged))
    found = dict(observed.get)
    wrong = [f"{found[f'null_{c}']} nulls in {c}" for c in checks.not_null if found[f"null_{c}"]]
    wrong += [f"{found[f'broken_{n}']} rows break {n}" for n, _ in checks.rules if found[f"broken_{n}"]]
    if checks.unique and found["most_copies"] > checks.copies:
        wrong.append(f"{found['most_copies']} rows of one key ({', '.join(checks.unique)})")
    if found["rows"] < checks.least_rows:
        wrong.append(f"{found['rows']} rows instead of {checks.least_rows} or more")
    if wrong:
        raise AuditFailed(f"{name}: " + "; ".join(wrong))
    store.move(staged, name)
    return found
