"""Exact duplicates by content hash, with the bytes compared.

Texts are grouped by a 128-bit hash together with the text itself, so rows of
one group are equal byte by byte and texts that only share a hash stay apart.
The grouping combines rows before the shuffle: a text with any number of
copies costs one row per task. Only ids and hashes are joined back, and the
rows of a text with very many copies are spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomhouse.llm.common import picked
from loomhouse.operators.skew import ROWS_PER_TASK, salted_join
from loomhouse.session import materialize


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``id``, ``keep_id``, ``group_size``, ``kept``, ``sha256`` of every row.

    ``keep`` is ``smallest`` or ``largest``: which id of equal texts stays.
    Texts are compared unchanged, null counts as empty. Null ids are never the
    id that stays; in a group of null ids alone ``keep_id`` is null and all its
    rows are kept. Rows that repeat id and text are counted one by one and
    share their verdict. Other columns of ``docs`` are not read.
    """
    stays = {"smallest": F.min, "largest": F.max}[keep]("id")
    rows = picked(docs, id=id_col, text=text_col).select(
        "id", F.coalesce("text", F.lit("")).alias("text")
    )
    equal = materialize(
        rows.select("id", "text", _hash(F.col("text")).alias("hash"))
        .groupBy("hash", "text")
        .agg(stays.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", "keep_id", "group_size", F.sha2("text", 256).alias("sha256")),
        "equal-texts",
    )
    hot = equal.where(F.col("group_size") > rows_per_task).select(
        "hash", "sha256", F.ceil(F.col("group_size") / rows_per_task).cast("int").alias("_salts")
    )
    # Texts that share a hash are told apart by their SHA-256.
    hashed = rows.select(
        "id", _hash(F.col("text")).alias("hash"), F.sha2("text", 256).alias("sha256")
    )
    return salted_join(hashed, equal, ["hash", "sha256"], hot=hot, spread=["id"]).select(
        "id",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "sha256",
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One whole row of ``docs`` for each text, its columns unchanged.

    The row with the smallest (largest) id stays. Null ids stay only where a
    text has no other; of rows that agree in the id, the one whose other columns
    have the smaller hash. Other columns may have any type. Null and empty text
    are equal; the row that stays keeps its own.
    """
    id_ = F.col(f"`{id_col}`")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    row = F.struct(
        F.struct(*rest).alias("_row"), F.col(f"`{text_col}`").isNull().alias("_null")
    )
    # maps have no order; written as JSON they have a hash
    plain = [F.col(f"`{c}`") for c, t in docs.dtypes if c != text_col and "map<" not in t]
    maps = [F.to_json(F.col(f"`{c}`")) for c, t in docs.dtypes if "map<" in t]
    tie = F.xxhash64(*plain, *maps, F.col(f"`{text_col}`").isNull())
    if keep == "smallest":
        best = F.min_by(row, F.struct(id_.isNull(), id_, tie))
    else:
        best = F.max_by(row, F.struct(id_.isNotNull(), id_, tie))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    kept = docs.groupBy(_hash(text).alias("_hash"), text.alias("_text")).agg(best.alias("_best"))
    return kept.select(
        *[
            F.when(~F.col("_best._null"), F.col("_text")).alias(c)
            if c == text_col
            else F.col(f"_best._row.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
