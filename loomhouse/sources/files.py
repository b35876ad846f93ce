"""Readers for delimited, fixed-width and whole-text files."""

from __future__ import annotations

import re
import uuid
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomhouse.session import materialize
from loomhouse.sources.store import place

# Fixed value: names of the quarterly wire files (audit files do not match).
FINWIRE_NAME = r"^FINWIRE\d{4}Q\d$"


def read_delimited(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = "|"
) -> DataFrame:
    """Header-less delimited file read by position into a typed schema.

    A field that does not parse becomes null (tolerant reading).
    """
    return spark.read.csv(path, schema=schema, sep=sep, header=False, mode="PERMISSIVE")


def read_with_rejects(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = "|"
) -> tuple[DataFrame, DataFrame]:
    """The typed rows of header-less files, and what of them did not fit.

    The lines are read and parsed once and stored. A line with a field that does
    not parse or with too few or too many fields is in both: as a row with nulls,
    as ``read_delimited`` gives it, and as a reject ``(file, line, reason,
    record)``. ``line`` counts from 1, blank lines included; blank lines are no
    rows and no rejects.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    stored = materialize(
        spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            F.when(F.trim("value") != "", F.from_csv("value", whole.toDDL(), options)).alias("row"),
        ),
        "lines",
    )
    rows = stored.where("row is not null").select(*[F.col("row")[n].alias(n) for n in schema.names])
    blocks = stored.groupBy("file", "block").agg(F.min("at").alias("least"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select(
        "file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least") + 1).alias("shift")
    )
    record = F.col("row._corrupt")
    fields = F.split(record, re.escape(sep))
    wrong = [
        F.when(
            F.col("row")[n].isNull() & (F.trim(F.get(fields, F.lit(i))) != ""),
            F.concat(F.lit(f"{n}: "), F.get(fields, F.lit(i))),
        )
        for i, n in enumerate(schema.names)
    ]
    expected = len(schema)
    reason = F.when(
        F.size(fields) != expected, F.concat(F.size(fields), F.lit(f" fields instead of {expected}"))
    ).otherwise(F.concat_ws(", ", *wrong))
    rejects = (
        stored.where(record.isNotNull())
        .join(shifts, ["file", "block"])
        .select("file", (F.col("at") + F.col("shift")).alias("line"), reason.alias("reason"), record.alias("record"))
    )
    return rows, rejects


def file_stem() -> Column:
    """File name of the scanned row without its extension."""
    return F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")


def parent_folder() -> Column:
    return F.element_at(F.split("_metadata.file_path", "/"), -2)


def batch_number(folder: Column) -> Column:
    """All digits of a folder name as a number: ``Batch12`` gives 12."""
    return F.regexp_replace(folder, "[^0-9]", "").try_cast("int")


def read_batch_dates(spark: SparkSession, path: str) -> DataFrame:
    """One date per batch folder, with the batch number from the folder name."""
    dates = spark.read.schema("batchdate date").csv(path, recursiveFileLookup=True)
    return dates.select("batchdate", batch_number(parent_folder()).alias("batchid"))


def read_wire_lines(spark: SparkSession, path: str, case_sensitive: bool = True) -> DataFrame:
    """Lines of all quarterly wire files below ``path``, in one scan.

    A file belongs when its stem has the quarterly name, or when it is a part
    file in a folder of that name (a file written in parts).
    """
    pattern = FINWIRE_NAME if case_sensitive else "(?i)" + FINWIRE_NAME
    lines = spark.read.text(path, recursiveFileLookup=True)
    part = parent_folder().rlike(pattern) & file_stem().startswith("part-")
    quarterly = file_stem().rlike(pattern) | part
    return lines.where(quarterly).select(F.col("value").alias("line"))


def split_wire_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """``(rectype, recdate, value)`` per line.

    ``FIN`` records are split into ``FIN_COMPANYID`` and ``FIN_NAME`` by
    whether the company field holds a number.
    """
    text = F.col(line)
    kind = F.substring(text, 16, 3)
    company = F.trim(F.substring(text, 187, 60))
    rectype = F.when(
        kind == "FIN",
        F.when(company.try_cast("bigint").isNotNull(), "FIN_COMPANYID").otherwise("FIN_NAME"),
    ).otherwise(kind)
    return lines.select(
        rectype.alias("rectype"),
        F.try_to_date(F.substring(text, 1, 8), "yyyyMMdd").alias("recdate"),
        text.substr(F.lit(19), F.length(text)).alias("value"),
    )


# Folders that one task writes.
FOLDERS_PER_TASK = 10_000


def write_folders(df: DataFrame, key: str, folder: str) -> None:
    """Text files of the rows ``(value, key)``, in a folder ``key=...`` for each key.

    Gives what ``write.partitionBy(key).text(folder)`` gives where one task holds a
    key: its values as lines in the order of the input, an empty line for null. That
    starts several processes for every file on a local disk and moves all folders one
    by one at the end; here tasks write and rename their files themselves.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, df.count() // FOLDERS_PER_TASK + 1)
    name = F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))

    def run(batches):
        system, base = place(folder)
        rows = chain.from_iterable(
            zip(b["below"].to_pylist(), b["value"].to_pylist(), strict=True) for b in batches
        )
        for below, group in groupby(rows, itemgetter(0)):
            system.create_dir(f"{base}/{below}")
            draft = f"{base}/{below}/.{uuid.uuid4().hex}"
            with system.open_output_stream(draft) as out:
                for _, value in group:
                    out.write(f"{value or ''}\n".encode())
            system.move(draft, f"{base}/{below}/part-0.txt")
            yield pa.RecordBatch.from_pydict({"below": [below]})

    system, base = place(folder)
    system.create_dir(base, recursive=True)
    (
        df.select(F.concat(F.lit(f"{key}="), name).alias("below"), "value", F.monotonically_increasing_id().alias("at"))
        .repartition(tasks, "below")
        .sortWithinPartitions("below", "at")
        .mapInArrow(run, "below string")
        .count()
    )


_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_whole_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per file below ``path``: name, path and whole content.

    Spark lists many folders by as many tasks, up to 10,000; here by a few for each core.
    """
    before = spark.conf.get(_LISTERS)
    spark.conf.set(_LISTERS, min(int(before), 8 * spark.sparkContext.defaultParallelism))
    try:
        texts = spark.read.text(
            path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern
        )
    finally:
        spark.conf.set(_LISTERS, before)
    return texts.select(
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("content"),
    )


def read_column_comments(spark: SparkSession, path: str, pattern: str = "*.comment") -> DataFrame:
    """``(table_full_name, column, comment)`` from comment scripts."""
    statement = r"(?is)COMMENT\s+ON\s+COLUMN\s+(\S+)\.(\w+)\s+IS\s+'((?:[^']|'')*)'"
    parts = [
        F.regexp_extract_all("content", F.lit(statement), F.lit(group)) for group in (1, 2, 3)
    ]
    found = F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("t", "c", "m"))])
    return (
        read_whole_texts(spark, path, pattern)
        .select(F.explode(found).alias("f"))
        .select(
            F.col("f.t").alias("table_full_name"),
            F.col("f.c").alias("column"),
            F.regexp_replace("f.m", "''", "'").alias("comment"),
        )
    )
