"""Chat formatting from an event log.

A conversation is a log of events on its messages:

=============  ==============================================================
``start``      opens the message with a role and a first text
``delta``      appends text
``edit``       replaces the text so far
``regenerate`` replaces the text so far and drops what the conversation had
               after the message until then
=============  ==============================================================

The log is partitioned by conversation and sorted by sequence number; folding
gives the final messages, which a template renders as ``<s>role\\ntext</s>``.
Control strings inside texts are quoted: a backslash is put behind their first
character, one more where there are some already, so taking one away gives the
text back.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: control strings of common chat templates
CONTROL = [
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>",
]
OPEN, CLOSE = "<s>", "</s>"

_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)


def quote(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_TAILS})", r"$1\\$2$3")


def unquote(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_TAILS})", r"$1$2$3")


def quote_role(role: Column) -> Column:
    """A role is one line: backslashes and line ends are written out too."""
    return quote(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unquote_role(role: Column) -> Column:
    parts = F.split(unquote(role), r"\\\\")
    return F.array_join(
        F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\"
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv, message, role, text)`` of an event log.

    ``events`` has ``conv``, ``message`` (its place), ``seq``, ``kind``,
    ``role`` and ``text``. Null texts are empty; the role is the last one
    given. A message whose events were all dropped is gone. Events of equal
    ``seq`` are taken in the order of kind and text. Null conversations are one
    conversation; a null place comes first.
    """
    log = Window.partitionBy("conv")
    earlier = log.orderBy("message").rangeBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("conv", "message")
    cleared = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)
    reset = F.max(F.when(F.col("kind") != "delta", F.col("seq"))).over(own)
    alive = events.withColumn("_cleared", cleared).where(
        F.col("_cleared").isNull() | (F.col("seq") > F.col("_cleared"))
    )
    live = alive.withColumn("_reset", reset)
    said = F.when(
        F.col("_reset").isNull() | (F.col("seq") >= F.col("_reset")),
        F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text")),
    )
    return live.groupBy("conv", "message").agg(
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role")))["role"].alias("role"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(said)), lambda e: e["text"]
            ),
            "",
        ).alias("text"),
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv``, ``formatted`` and ``loss``: spans of the texts to learn.

    A span ``(start, chars)`` counts code points of ``formatted`` and covers
    the quoted text of a message of ``loss_role`` and nothing else.
    """
    head = F.concat(F.lit(OPEN), quote_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turns = messages.select(
        "conv", "message", "role", head.alias("head"), quote(F.col("text")).alias("body")
    ).withColumn("turn", F.concat("head", "body", F.lit(CLOSE)))
    before = (
        Window.partitionBy("conv").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = turns.withColumn(
        "start",
        F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.length("head"),
    )
    span = F.when(
        (F.col("role") == loss_role) & (F.length("body") > 0),
        F.struct(F.col("start"), F.length("body").cast("long").alias("chars")),
    )
    return placed.groupBy("conv").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("message", "turn"))), lambda m: m["turn"]
            ),
            "",
        ).alias("formatted"),
        F.array_sort(F.collect_list(span)).alias("loss"),
    )


def turns_of(formatted: Column) -> Column:
    """Roles and texts read back from a formatted conversation."""
    inner = F.substring(
        formatted,
        F.lit(len(OPEN) + 1),
        F.length(formatted) - len(OPEN) - len(CLOSE),
    )
    return F.transform(
        F.split(inner, re.escape(CLOSE + OPEN)),
        lambda t: F.struct(
            unquote_role(F.substring_index(t, "\n", 1)).alias("role"),
            unquote(F.substring(t, F.instr(t, F.lit("\n")) + 1, F.length(t))).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, read from their spans."""
    return F.array_join(
        F.transform(
            loss,
            lambda s: unquote(
                F.substring(formatted, (s["start"] + 1).cast("int"), s["chars"].cast("int"))
            ),
        ),
        "",
    )


def as_events(rows: DataFrame, chars: int = 400) -> DataFrame:
    """The event log of a finished conversation table, as a chat service writes it.

    ``rows`` has ``conv``, ``turn``, ``role`` and ``text``. Each row is a
    ``start`` and the ``delta`` pieces of its text. Rows of one turn are told
    apart by role and text, and repeated rows stay messages of their own.
    """
    place = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text"))
    text = F.coalesce("text", F.lit(""))
    pieces = F.ceil(F.length("text") / F.lit(chars)).cast("int")
    log = rows.select("conv", place.cast("long").alias("message"), "role", text.alias("text")).select(
        "conv", "message", "role", "text", F.explode(F.sequence(F.lit(0), pieces)).alias("piece")
    )
    return log.select(
        "conv",
        "message",
        (F.shiftleft("message", 32) + F.col("piece")).alias("seq"),
        F.when(F.col("piece") == 0, "start").otherwise("delta").alias("kind"),
        F.when(F.col("piece") == 0, F.coalesce("role", F.lit(""))).alias("role"),
        F.when(F.col("piece") == 0, "").otherwise(
            F.substring(F.col("text"), (F.col("piece") - 1) * chars + 1, F.lit(chars))
        ).alias("text"),
    )


def format_conversations(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Fold the log and render it; one row per conversation that has a message."""
    return render(fold(events), loss_role)
