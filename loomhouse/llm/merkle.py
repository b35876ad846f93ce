"""Merkle manifest of a table: trees of hashes, few stored levels, proofs.

Every row is a leaf; the leaves of a group make one tree, the tops of all groups
one more. A parent is the hash of up to ``FANOUT`` neighbours.

Checkpoint and recompute: only every ``EVERY``-th level is stored. A stored node
stands for an aligned subtree of at most ``FANOUT ** EVERY`` nodes of the stored
level below. Building hashes each such subtree in one row and keeps its top;
proof extraction takes a subtree's stored nodes again, makes the levels between
anew, emits for each node its siblings, and drops them. Proofs are put together
from the top down, one row per subtree, so a leaf's proof is complete when its
subtree is opened and is never shuffled.

Positions come from a range partition and sort by group and order, with the
sizes of the partitions before. A group of any size is therefore cut into
ranges and subtrees; only group tops and partition counts are treated as one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomhouse.llm.common import picked
from loomhouse.operators.skew import ROWS_PER_TASK
from loomhouse.session import materialize

FANOUT, EVERY = 3, 4
_SPAN = FANOUT**EVERY
# Powers of the fan-out that a 64-bit number of leaves can reach.
_POWERS = [FANOUT**k for k in range(40)]


def joined_hash(*parts: Column) -> Column:
    """Hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes in front, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return joined_hash(*[field(f) for f in fields])


def tree_name(group: Column) -> Column:
    """A name that is never null and sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def _levels(n: Column) -> Column:
    """Levels above ``n`` leaves; none above a single one."""
    return F.size(F.filter(F.array(*[F.lit(p) for p in _POWERS]), lambda p: p < n))


def _up(nodes: Column) -> Column:
    """The parents of neighbouring nodes."""
    last = F.ceil(F.size(nodes) / FANOUT).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.sha2(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), ""), 256),
    )


def _times(steps: Column, start: Column, step) -> Column:
    return F.aggregate(F.array_repeat(F.lit(0), steps), start, lambda acc, _: step(acc))


def placed(rows: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """Rows with ``pos``, their place in their ``tree`` from 0, and its size ``n``.

    ``tree`` is never null. Nulls of ``order`` come first; rows that agree in
    all of it are equal leaves, so their mutual order does not show.
    """
    rows = materialize(rows, "leaves")
    conf = rows.sparkSession.conf
    parts = partitions or max(
        int(conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS_PER_TASK + 1
    )
    by = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    sorted_ = materialize(
        rows.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33)),
        "sorted-leaves",
    )
    held = sorted_.groupBy("tree", "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(tree).alias("n"),
    )
    return (
        sorted_.join(offsets, ["tree", "_part"])
        .withColumn("pos", F.col("_at") + F.col("_shift"))
        .drop("_at", "_part", "_shift")
    )


def _subtrees(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """One row per aligned subtree: its nodes in order."""
    node = F.struct("pos", "hash", *carried)
    return (
        nodes.where(F.col("above") > 0)
        .groupBy("tree", "n", "above", F.expr(f"pos div {_SPAN}").alias("block"))
        .agg(F.array_sort(F.collect_list(node)).alias("nodes"))
        .withColumn("hashes", F.col("nodes.hash"))
        .withColumn("steps", F.least("above", F.lit(EVERY)))
    )


def stored_levels(leaves: DataFrame, name: str = "merkle") -> list[DataFrame]:
    """Every ``EVERY``-th level of the trees of ``leaves(tree, pos, n, hash, ...)``.

    Each has ``tree``, ``n``, ``pos``, ``hash`` and ``above``, the number of
    levels above it; a node with none above is the top of its tree. The first
    level keeps the other columns of ``leaves``.
    """
    levels = [materialize(leaves.withColumn("above", _levels(F.col("n"))), f"{name}-0")]
    # one number: the height of the highest tree
    height = levels[0].agg(F.coalesce(F.max("above"), F.lit(0))).first()[0]
    for base in range(0, height, EVERY):
        top = _times(F.col("steps"), F.col("hashes"), _up)[0]
        above = _subtrees(levels[-1], []).select(
            "tree",
            "n",
            F.col("block").alias("pos"),
            top.alias("hash"),
            (F.col("above") - F.col("steps")).alias("above"),
        )
        levels.append(materialize(above, f"{name}-{base + EVERY}"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """``tree`` and ``hash`` of the top of each tree."""
    done = [level.where("above = 0").select("tree", "hash") for level in levels]
    return reduce(DataFrame.union, done)


def _sibling_lists() -> Column:
    """For each node of a subtree, its siblings level by level."""
    made = _times(
        F.col("steps") - 1,
        F.array(F.col("hashes")),
        lambda acc: F.concat(acc, F.array(_up(F.element_at(acc, -1)))),
    )
    powers = F.array(*[F.lit(p) for p in _POWERS[: EVERY + 1]])

    def siblings(level: Column, t: Column, i: Column) -> Column:
        own = F.floor(i / F.element_at(powers, t + 1)).cast("int")
        first = own - own % FANOUT
        return F.struct(
            F.array_join(F.slice(level, first + 1, own - first), "").alias("before"),
            F.array_join(F.slice(level, own + 2, first + FANOUT - 1 - own), "").alias("behind"),
        )

    def of_all(levels: Column) -> Column:
        return F.transform(
            F.col("nodes"),
            lambda _, i: F.transform(levels, lambda level, t: siblings(level, t, i)),
        )

    return F.transform(F.array(made), of_all)[0]


def proofs(levels: list[DataFrame], ends: DataFrame, carried: list[str]) -> DataFrame:
    """``carried`` columns, ``hash``, ``top``, ``end`` and ``proof`` of every leaf.

    A proof has one entry per level, from the leaf upwards: the joined hashes
    of the siblings ``before`` and ``behind``. ``ends(tree, top, proof, end)``
    is what follows above the top of each tree.
    """
    beyond = None
    for depth, level in reversed(list(enumerate(levels))):
        also = carried if depth == 0 else []
        kept = ["tree", "pos", "hash", *also]
        out = (
            level.where("above = 0").select(*kept).join(ends, "tree")
        )
        if beyond is not None:
            parents = beyond.select(
                "tree", F.col("pos").alias("block"), "top", "end", F.col("proof").alias("_rest")
            )
            opened = (
                _subtrees(level, also)
                .withColumn("_own", _sibling_lists())
                .join(parents, ["tree", "block"])
                .select(
                    "tree", "top", "end", "_rest",
                    F.explode(F.arrays_zip("nodes", "_own")).alias("_node"),
                )
                .select(
                    "tree",
                    *[F.col(f"_node.nodes.{c}").alias(c) for c in ("pos", "hash", *also)],
                    "top",
                    F.concat("_node._own", "_rest").alias("proof"),
                    "end",
                )
            )
            out = out.select(opened.columns).union(opened)
        beyond = out
    return beyond.select(*carried, "hash", "top", "end", "proof")


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        proof, start, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["behind"]), 256)
    )


def proof_hash(proof: Column) -> Column:
    """Hash of all siblings of a proof, level by level, left to right."""
    return F.sha2(
        F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["behind"])), ""), 256
    )


def manifest(leaves: DataFrame, order: list[str], carried: list[str]) -> tuple[list, list]:
    """Stored levels of the group trees and of the tree over their tops.

    ``leaves`` has ``tree`` (see ``tree_name``), ``hash``, the columns of
    ``order`` and those ``carried`` along.
    """
    groups = stored_levels(placed(leaves, [*order, "hash"]).select("tree", "n", "pos", "hash", *carried))
    over = placed(
        tops(groups).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash"), ["name"]
    )
    return groups, stored_levels(over.select("tree", "n", "pos", "hash", "name"), "merkle-top")


def leaf_proofs(groups: list[DataFrame], roots: list[DataFrame], carried: list[str]) -> DataFrame:
    """``carried``, ``leaf``, ``subroot``, ``root`` and ``proof`` of every row."""
    nothing = F.array().cast("array<struct<before: string, behind: string>>")
    root = tops(roots).select("tree", F.col("hash").alias("top"), nothing.alias("proof"))
    over = proofs(roots, root.withColumn("end", F.col("top")), ["name"])
    ends = over.select(
        F.col("name").alias("tree"), F.col("hash").alias("top"), "proof", F.col("top").alias("end")
    )
    return proofs(groups, ends, carried).select(
        *carried,
        F.col("hash").alias("leaf"),
        F.col("top").alias("subroot"),
        F.col("end").alias("root"),
        "proof",
    )


def document_manifest(
    docs: DataFrame,
    tampered: Column | None = None,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: tuple[str, ...] = ("lang", "n_chars"),
    text_col: str = "text",
) -> DataFrame:
    """``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf is the hash of id, group, ``fields`` and text. ``tampered`` is an
    expression over ``id`` and ``text``, the text as it is found at verification
    (default: the same); the root is then folded from the leaf of that text and
    the stored siblings. Null values count as ``-``, a null group is a tree of
    its own and the first, null ids come first in their tree, rows that repeat
    an id stand side by side in the order of their leaves. An empty table gives
    no rows. Other columns of ``docs`` are not read.
    """
    names = {f"f{i}": f for i, f in enumerate(fields)}
    rows = picked(docs, id=id_col, group=group_col, text=text_col, **names)
    own = [F.col("id"), F.col("group"), *[F.col(f) for f in names]]
    found = F.col("text") if tampered is None else tampered
    changed = ~found.eqNullSafe(F.col("text"))
    leaves = rows.select(
        "id",
        tree_name(F.col("group")).alias("tree"),
        leaf(*own, F.col("text")).alias("hash"),
        F.when(changed, leaf(*own, found)).alias("other"),
    )
    groups, roots = manifest(leaves, ["id"], ["id", "other"])
    out = leaf_proofs(groups, roots, ["id", "other"])
    reached = out.withColumn(
        "folded_root", folded(F.coalesce("other", "leaf"), F.col("proof"))
    )
    return reached.select(
        "id",
        "leaf",
        "subroot",
        "root",
        proof_hash(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
