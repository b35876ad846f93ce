"""Column identifiers and table names as written in lineage documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCHEMA = "main"
# Endings of the data files that stand for a table.
FILE_ENDINGS = ("csv", "txt", "dat")


def _slashes(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def _join_parts(parts: Column, first: int, drop_last: int) -> Column:
    return F.array_join(F.slice(parts, F.lit(first), F.size(parts) - drop_last), ".")


def rewrite_csv_call(name: Column) -> Column:
    """``read_csv('dir/file.csv'...)`` becomes ``"dir.file.csv"``; others stay."""
    call = F.substring_index(name, "read_csv(", -1)
    # The argument between its quotes, of either kind.
    quoted = F.split_part(F.translate(call, '"', "'"), F.lit("'"), F.lit(2))
    is_csv = name.contains("read_csv(") & F.left(call, F.lit(1)).isin("'", '"') & quoted.endswith(".csv")
    path = F.when(is_csv, F.left(quoted, F.length(quoted) - 4)).otherwise("")
    dotted = F.replace(F.regexp_replace(_slashes(path), "^/+", ""), F.lit("/"), F.lit("."))
    return F.when(path != "", F.concat(F.lit('"'), dotted, F.lit('.csv"'))).otherwise(name)


def normalize_table(name: Column) -> Column:
    """``schema.table`` form of a table name.

    A quoted data file turns its folders into the schema and its name into the
    table; a dotted name stays; a bare name goes to the default schema.
    """
    low = F.lower(name)
    stem = F.lit("")
    for ending in FILE_ENDINGS:
        close = f'.{ending}"'
        bare = F.substr(name, F.lit(2), F.length(name) - (len(close) + 1))
        stem = F.when(low.startswith('"') & low.endswith(close), bare).otherwise(stem)
    path = _slashes(stem)
    parts = F.transform(F.split(path, "/"), lambda p: F.replace(p, F.lit("."), F.lit("_")))
    folder = F.when(F.size(parts) > 1, _join_parts(parts, 1, 1)).otherwise("file_sources")
    file = F.element_at(parts, -1)
    return (
        F.when(F.coalesce(name, F.lit("")) == "", F.lit(""))
        .when(path != "", F.concat_ws(".", folder, file))
        .when(F.contains(name, F.lit(".")), name)
        .otherwise(F.concat(F.lit(DEFAULT_SCHEMA + "."), name))
    )


def split_table(full_name: Column) -> tuple[Column, Column]:
    """Schema and table: the parts before and after the first dot."""
    return (
        F.regexp_extract(full_name, r"^([^.]*)\.(.*)$", 1),
        F.regexp_extract(full_name, r"^([^.]*)\.(.*)$", 2),
    )


def file_table(path: Column) -> Column:
    """Struct ``(schema, table)`` of a file path; null for an empty path.

    The folders joined by dots are the schema (``file_root`` without folder).
    """
    norm = _slashes(path)
    folder = F.regexp_extract(norm, r"^(.*)/[^/]*$", 1)
    schema = (
        F.when(~F.contains(norm, F.lit("/")), F.lit("file_root"))
        .when(folder == "", F.lit("."))
        .otherwise(F.replace(folder, F.lit("/"), F.lit(".")))
    )
    table = F.regexp_extract(norm, r"([^/]*)$", 1)
    return F.when(
        F.coalesce(path, F.lit("")) != "", F.struct(schema.alias("schema"), table.alias("table"))
    )


def parse_column(identifier: Column, file: Column) -> Column:
    """Struct ``(schema, table, column)`` of a source identifier.

    ``file`` is the document's file source as ``(schema, table)`` or null; it
    replaces the ``file`` placeholder. Null when the identifier has no
    recognised form.
    """
    parts = F.split(identifier, r"\.")
    count = F.size(parts)

    def piece(i: int) -> Column:
        return F.get(parts, F.lit(i))

    def triple(schema: Column, table: Column, column: Column) -> Column:
        return F.struct(schema.alias("schema"), table.alias("table"), column.alias("column"))

    inner = F.split(F.regexp_replace(identifier, '^"+|"+$', ""), r"\.")
    return (
        F.when(F.coalesce(identifier, F.lit("")) == "", F.lit(None))
        .when(
            identifier.startswith("file.") & (count == 2) & file.isNotNull(),
            triple(file["schema"], file["table"], piece(1)),
        )
        .when(count == 3, triple(piece(0), piece(1), piece(2)))
        .when(count == 2, triple(F.lit(DEFAULT_SCHEMA), piece(0), piece(1)))
        .when(
            identifier.startswith('"') & identifier.endswith('.csv"') & (F.size(inner) > 2),
            triple(_join_parts(inner, 1, 2), F.get(inner, F.size(inner) - 2), F.lit("file_content")),
        )
    )


def identifier_parts(identifier: Column) -> Column:
    """The parts of a dotted name; null where a quote is left open or a part is missing.

    Dots inside double quotes belong to their part, doubled quotes are one.
    """
    part = r'"(?:[^"]++|"")*+"|[^".]++'
    found = F.regexp_extract_all(identifier, F.lit(part), F.lit(0))

    def bare(p: Column) -> Column:
        inner = F.substr(p, F.lit(2), F.length(p) - 2)
        return F.when(p.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(p)

    whole = identifier.rlike(rf"^(?:{part})(?:\.(?:{part}))*+$")
    return F.when(whole, F.transform(found, bare))


def parse_quoted(identifier: Column, file: Column) -> Column:
    """``parse_column`` for names with quoted parts or with a database in front, too.

    Database and schema of four parts are joined by a dot. A name with an open
    quote has no recognised form. A data file in quotes and all other forms are
    read as before.
    """
    parts = identifier_parts(identifier)
    count = F.size(parts)

    def piece(i: int) -> Column:
        return F.get(parts, F.lit(i))

    schema = (
        F.when(count == 2, F.lit(DEFAULT_SCHEMA))
        .when(count == 3, piece(0))
        .otherwise(F.concat_ws(".", piece(0), piece(1)))
    )
    table, column = F.element_at(parts, -2), F.element_at(parts, -1)
    named = F.struct(schema.alias("schema"), table.alias("table"), column.alias("column"))
    quoted = F.contains(identifier, F.lit('"')) & count.isin(2, 3, 4)
    open_ = F.contains(identifier, F.lit('"')) & parts.isNull()
    return (
        F.when(open_, F.lit(None))
        .when(quoted | (count == 4), named)
        .otherwise(parse_column(identifier, file))
    )
