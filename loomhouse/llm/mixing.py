"""Mixing sources to target weights over a tree of domains, languages, sources.

A token budget goes down the tree by the weights of the children. A child that
holds less than its share gives what it lacks to its siblings; only what a
whole node cannot use goes to the siblings of that node. Each leaf then reads
its documents in seeded epochs, each epoch in its own keyed order, and takes
the prefix that fills its budget.

The order of an epoch is the order of a keyed hash. The prefix is found by
sums over hash buckets and a running sum inside the one bucket where the budget
ends, so no task sorts a whole leaf. What remains is one cutoff per leaf, and
selecting is a comparison on the way through the documents: texts are not
shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomhouse.llm.quality import n_words
from loomhouse.session import materialize

# Rows of a leaf that meet in one task while its cutoff is looked for.
BUCKET_ROWS = 20_000
_KEY_BITS = 60


def weight_of(levels: list[str], weights: dict[str, int], default: int = 1) -> Column:
    """Weight of the node named by the path of ``levels``, e.g. ``web/en``."""
    path = F.concat_ws("/", *levels)
    arms = F.lit(default)
    for name, weight in weights.items():
        arms = F.when(path == name, F.lit(weight)).otherwise(arms)
    return arms.cast("long")


def order_key(seed: int, epoch: Column, id_col: Column) -> Column:
    """Place of a document in an epoch: 60 bits of a keyed md5."""
    keyed = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), id_col.cast("string"))
    return F.conv(F.substring(F.md5(keyed), 1, _KEY_BITS // 4), 16, 10).cast("long")


def share_out(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """``budget`` of each child from the ``total`` of its parent.

    ``nodes`` has the parent columns, the child column, ``weight``, ``cap`` and
    ``total``. Children are taken in the order of cap per weight: as long as a
    child's cap is below its share of what is left, it gets its cap and the
    rest is shared by those behind it. Shares are rounded along the order so
    that they add up to the total exactly.
    """
    family = Window.partitionBy(*parent)
    order = family.orderBy(F.col("cap") / F.col("weight"), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(0, Window.unboundedFollowing)
    ranked = (
        nodes.withColumn("_left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("_behind", F.sum("weight").over(behind))
        .withColumn(
            "_full",
            F.col("cap").cast("decimal(38,0)") * F.col("_behind")
            <= F.col("_left").cast("decimal(38,0)") * F.col("weight"),
        )
    )
    # Everything from the first child that is not full on shares one rest.
    open_ = ranked.withColumn("_rest", F.max(F.when(~F.col("_full"), F.col("_left"))).over(family)).withColumn(
        "_open", F.max(F.when(~F.col("_full"), F.col("_behind"))).over(family)
    )
    upto = F.col("_open") - F.col("_behind") + F.col("weight")

    def part(weight: Column) -> Column:
        return F.floor(F.col("_rest").cast("decimal(28,0)") * weight / F.col("_open")).cast("long")

    return open_.withColumn(
        "budget",
        F.when(F.col("_full"), F.col("cap")).otherwise(part(upto) - part(upto - F.col("weight"))),
    ).drop("_left", "_behind", "_full", "_rest", "_open")


def leaf_budgets(
    leaves: DataFrame,
    levels: list[str],
    weights: dict[str, int],
    share: tuple[int, int],
    epochs: int,
) -> DataFrame:
    """``budget`` of every leaf; ``leaves`` has the levels and ``tokens``.

    The budget of the root is ``share[0] / share[1]`` of all tokens. A leaf can
    give its tokens ``epochs`` times.
    """
    capped = leaves.withColumn("cap", F.col("tokens") * epochs)
    total = capped.agg(
        F.least(
            F.floor(F.sum("tokens") * share[0] / share[1]).cast("long"), F.sum("cap")
        ).alias("total")
    )
    above = total.withColumn("_root", F.lit(0))
    parent = ["_root"]
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        nodes = (
            capped.withColumn("_root", F.lit(0))
            .groupBy("_root", *path)
            .agg(F.sum("cap").alias("cap"))
            .withColumn("weight", weight_of(path, weights))
            .join(above, parent)
        )
        above = share_out(nodes.where("weight > 0 and cap > 0"), parent, level).select(
            "_root", *path, F.col("budget").alias("total")
        )
        parent = ["_root", *path]
    return leaves.join(above, levels).withColumnRenamed("total", "budget").drop("_root")


def mixing_plan(
    docs: DataFrame,
    id_col: str,
    levels: dict[str, Column],
    tokens: Column,
    weights: dict[str, int],
    share: tuple[int, int] = (1, 1),
    epochs: int = 2,
    seed: int = 11,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per leaf: levels, ``budget``, ``full`` epochs, ``cut_key``, ``cut_id``.

    Of epoch ``full`` the documents up to ``(cut_key, cut_id)`` are taken.
    """
    names = list(levels)
    counted = materialize(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            *[_named(c).alias(n) for n, c in levels.items()],
            tokens.alias("tokens"),
        ).where("tokens > 0"),
        "mix-tokens",
    )
    leaves = counted.groupBy(*names).agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    plan = materialize(
        leaf_budgets(leaves, names, weights, share, epochs)
        .withColumn("full", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens"))
        .withColumn("buckets", F.ceil(F.col("rows") / bucket_rows).cast("long")),
        "mix-plan",
    )
    keyed = (
        counted.join(plan.select(*names, "full", "rest", "buckets").where("rest > 0"), names)
        .withColumn("key", order_key(seed, F.col("full"), F.col("id")))
        .withColumn(
            "bucket",
            F.shiftright(F.col("key"), 30) * F.col("buckets") / F.lit(1 << (_KEY_BITS - 30)),
        )
        .withColumn("bucket", F.floor("bucket").cast("long"))
        .select(*names, "bucket", "rest", "key", "id", "tokens")
    )
    by_bucket = keyed.groupBy(*names, "bucket", "rest").agg(F.sum("tokens").alias("sum"))
    so_far = Window.partitionBy(*names).orderBy("bucket")
    ending = (
        by_bucket.withColumn("end", F.sum("sum").over(so_far))
        .where((F.col("end") >= F.col("rest")) & (F.col("end") - F.col("sum") < F.col("rest")))
        .select(*names, "bucket", (F.col("end") - F.col("sum")).alias("start"))
    )
    inside = keyed.join(ending, [*names, "bucket"])
    running = (
        Window.partitionBy(*names, "bucket").orderBy("key", "id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cut = (
        inside.withColumn("at", F.col("start") + F.coalesce(F.sum("tokens").over(running), F.lit(0)))
        .where(F.col("at") < F.col("rest"))
        .groupBy(*names)
        .agg(F.max(F.struct("key", "id")).alias("cut"))
    )
    return materialize(
        plan.join(cut, names, "left").select(
            *names,
            "budget",
            "full",
            F.col("cut.key").alias("cut_key"),
            F.col("cut.id").alias("cut_id"),
        ),
        "mix-cuts",
    )


def _named(level: Column) -> Column:
    return F.coalesce(level.cast("string"), F.lit(""))


def mixed(
    docs: DataFrame,
    plan: DataFrame,
    id_col: str,
    levels: dict[str, Column],
    tokens: Column,
    seed: int = 11,
) -> DataFrame:
    """Rows of ``docs`` once per epoch that takes them, as structs ``row`` and ``mix``.

    ``row`` has the columns of ``docs``, whatever their names; ``mix`` holds
    ``epoch``, ``tokens``, ``budget`` and the levels. A document is taken whole;
    the one at the end of the budget is the last.
    """
    names = list(levels)
    side = plan.select(
        *[F.col(n).alias(f"_in_{n}") for n in names], "budget", "full", "cut_key", "cut_id"
    )
    # nodes without weight have no budget and no row in the plan
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").alias("_id"),
        tokens.alias("_tokens"),
        *[_named(c).alias(f"_at_{n}") for n, c in levels.items()],
    )
    same = reduce(lambda a, b: a & b, [F.col(f"_at_{n}") == F.col(f"_in_{n}") for n in names])
    key = order_key(seed, F.col("full"), F.col("_id"))
    place = F.struct(key.alias("key"), F.col("_id").cast("long").alias("id"))
    cut = F.struct(F.col("cut_key").alias("key"), F.col("cut_id").cast("long").alias("id"))
    within = F.col("cut_key").isNotNull() & (place <= cut)
    last = F.col("full") + F.when(within, 1).otherwise(0)
    return (
        rows.where("_tokens > 0")
        .join(side, same)
        .withColumn("_last", last)
        .where("_last > 0")
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_last") - 1)))
        .select(
            "row",
            F.struct(
                F.col("_epoch").alias("epoch"),
                F.col("_tokens").alias("tokens"),
                "budget",
                *[F.col(f"_in_{n}").alias(n) for n in names],
            ).alias("mix"),
        )
    )


def mix_documents(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, int],
    id_col: str = "doc_id",
    text_col: str = "text",
    share: tuple[int, int] = (1, 1),
    epochs: int = 2,
    seed: int = 11,
) -> DataFrame:
    """Plan and select in one call; tokens are the words of ``text_col``.

    Null levels count as an empty name. Texts without words hold no tokens and
    are never taken. Rows that repeat an id lie at the same place of an epoch
    and are taken together; rows with a null id likewise. A weight of zero
    takes nothing from a node. An empty table gives an empty result. Ids are
    whole numbers.
    """
    tokens = F.coalesce(n_words(F.col(f"`{text_col}`")), F.lit(0)).cast("long")
    plan = mixing_plan(docs, id_col, levels, tokens, weights, share, epochs, seed)
    return mixed(docs, plan, id_col, levels, tokens, seed)
