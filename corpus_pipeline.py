"""Training-text pipeline over the documents of a folder.

Stages run in the order of ``STAGES``. Each takes ``(spark, docs, sf_dir)``,
works on all its predecessor kept and returns a DataFrame that is written as
Parquet and read again; all but the last return the columns of ``documents``.
Stages read documents only through ``docs``, so any table with the columns
``doc_id, text, lang, source, n_chars`` can be given; more columns are carried
along. Null and empty texts fail the quality rules, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomhouse.llm.exact import drop_copies
from loomhouse.llm.mixing import mix_documents
from loomhouse.llm.neardup import drop_near_copies
from loomhouse.llm.pieces import encode_pieces
from loomhouse.llm.quality import quality_filter
from loomhouse.llm.queries import (
    MIX_EPOCHS,
    MIX_SEED,
    MIX_SHARE,
    MIX_WEIGHTS,
    mix_levels,
    piece_model,
)
from loomhouse.session import materialize

SHINGLE = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    return quality_filter(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id.

    Shingles are ``SHINGLE`` words long. Rows that repeat an id are judged one
    by one, each by its own text.
    """
    return drop_near_copies(docs, shingle=SHINGLE)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the seeded epochs that fill the budgets; repeated ones recur."""
    taken = mix_documents(
        docs, mix_levels(), MIX_WEIGHTS, share=MIX_SHARE, epochs=MIX_EPOCHS, seed=MIX_SEED
    )
    return taken.select("row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and the ids of its text, with seeded merge-dropout of each epoch's own."""
    encoded = encode_pieces(docs, piece_model(), copies=True)
    return encoded.select(F.col("id").alias("doc_id"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("min-max near-dedup", near_copies),
    ("source mix", source_mix),
    ("merge-dropout pieces", pieces),
]

# SQL cannot express the last stage; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
