"""Connected components of a link table, by least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.operators.skew import ROWS_PER_TASK, hot_keys, salted_join
from loomhouse.session import materialize


def components(links: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``id``, ``label`` (least id reachable) of every id in ``links(a, b)``.

    Each round takes the least label among the neighbours and then the label
    of the label, so the number of rounds grows with the logarithm of the
    longest path. Labels are written each round; the only thing the driver
    sees is whether a label changed. An id with more than ``rows_per_task``
    links, and a label that so many ids share, is spread over several tasks. An
    empty link table gives an empty result.
    """
    both = materialize(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(),
        "links",
    )
    labels = materialize(
        both.groupBy(F.col("a").alias("id")).agg(
            F.least(F.min("b"), F.col("a")).alias("label")
        ),
        "labels",
    )
    hubs = materialize(hot_keys(both, ["b"], rows_per_task), "hubs")
    while True:
        near = (
            salted_join(both, labels.withColumnRenamed("id", "b"), ["b"], hot=hubs)
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        seen = materialize(
            labels.join(near, labels["id"] == near["a"]).select(
                "id", "label", F.least("label", "near").alias("low")
            ),
            "near-labels",
        )
        far = labels.select(F.col("id").alias("low"), F.col("label").alias("far"))
        step = materialize(
            salted_join(seen, far, ["low"], rows_per_task=rows_per_task).select(
                "id", F.col("far").alias("label"), (F.col("far") < F.col("label")).alias("moved")
            ),
            "labels",
        )
        labels = step.select("id", "label")
        if step.where("moved").isEmpty():
            return labels
