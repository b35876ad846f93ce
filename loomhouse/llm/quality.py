"""Quality rules as a short-circuit cascade.

Rules are column expressions that are true where a text fails. A sample gives
each rule's rejection rate and its time, and the rules are tried in falling
order of rejection per cost: a text is read by the next rule only if the ones
before it let it pass. The order changes the work, never the verdict.

Words are cut once per text. Windows of words are compared by 64-bit hashes; only
where a hash comes back are the words themselves compared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomhouse.llm.common import WORD, picked
from loomhouse.session import materialize


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_chars(text: Column) -> Column:
    return (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")


def n_letter_words(text: Column) -> Column:
    """Words with a letter: from its first letter on, a word is taken as a whole."""
    return F.regexp_count(text, F.lit(r"\p{L}[^\x20\x09-\x0D]*+")).cast("long")


def full_lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def line_counts(text: Column) -> Column:
    """``lines`` with a word, and ``again``, those that equal an earlier one."""
    return let(
        full_lines(text),
        lambda x: F.struct(
            F.size(x).cast("long").alias("lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again"),
        ),
    )


def n_repeat_words(w: Column, width: int = 3) -> Column:
    """Of the words ``w``, those in a window of ``width`` that occurs twice or more.

    Where a hash of a window comes back, hashes are sorted with their places and
    neighbours compared word by word, so the work stays near linear in the
    words. Windows of one hash that differ are told apart but for three of them
    in alternation.
    """

    def windows(h: Column) -> Column:
        places = F.when(
            F.size(h) >= width, F.sequence(F.lit(0), F.size(h) - width)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))

    def equal(w: Column, a: Column, b: Column) -> Column:
        same = [F.get(w, a["at"] + k) == F.get(w, b["at"] + k) for k in range(width)]
        return reduce(lambda x, y: x & y, [a["h"] == b["h"], *same])

    def marked(w: Column, found: Column) -> Column:
        placed = F.array_sort(F.transform(found, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        pairs = let(
            placed,
            lambda s: F.filter(
                F.zip_with(
                    s,
                    F.slice(s, 2, F.size(s)),
                    lambda a, b: F.when(equal(w, a, b), F.array(a["at"], b["at"])),
                ),
                lambda x: x.isNotNull(),
            ),
        )
        covered = F.transform(
            F.array_distinct(F.flatten(pairs)), lambda at: F.sequence(at, at + (width - 1))
        )
        return F.size(F.array_distinct(F.flatten(covered)))

    def repeated(w: Column, found: Column) -> Column:
        apart = F.size(F.array_distinct(found)) == F.size(found)
        return F.when(apart, 0).otherwise(marked(w, found))

    # each step is bound once; an expression inside a lambda would run per element
    return let(
        w,
        lambda w: let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: let(windows(h), lambda x: repeated(w, x)),
        ),
    ).cast("long")


def measured(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``,
    ``n_dup_lines`` and ``n_repeat_words`` of the text."""
    text = F.col(text_col)
    cut = rows.withColumn("_words", words(text)).withColumn("_lines", line_counts(text))
    return cut.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": word_chars(text),
            "n_symbols": n_symbols(text),
            "n_lines": F.col("_lines.lines"),
            "n_dup_lines": F.col("_lines.again"),
            "n_repeat_words": n_repeat_words(F.col("_words")),
        }
    ).drop("_words", "_lines")


def base_failed(n: Column, repeated: Column) -> Column:
    return (n < 50) | (100 * repeated > 50 * n)


@dataclass(frozen=True)
class Rule:
    """A name and an expression over the text that is true where it fails."""

    name: str
    fails: Column


def text_rules(text: Column, found: DataFrame | None = None) -> list[Rule]:
    """The rules of the query and the pipeline. Thresholds are per cent.

    Too few words; more than half of the words repeated in windows; mean word
    length outside 2 to 15; more symbols than a tenth of the words; more than
    half of the lines repeated; fewer than half of the words with a letter.
    The measures are those of ``found`` where given (see ``measured``), else
    each rule takes its own from the text.
    """
    if found is not None:
        n, chars, symbols = found["n_words"], found["word_chars"], found["n_symbols"]
        repeated = found["n_repeat_words"]
        many_lines = 100 * found["n_dup_lines"] > 50 * found["n_lines"]
    else:
        n, chars, symbols = n_words(text), word_chars(text), n_symbols(text)
        repeated = n_repeat_words(words(text))
        many_lines = let(line_counts(text), lambda x: 100 * x["again"] > 50 * x["lines"])
    return [
        Rule("few_words", n < 50),
        Rule("repeated_words", 100 * repeated > 50 * n),
        Rule("word_length", ~chars.between(2 * n, 15 * n)),
        Rule("symbols", 100 * symbols > 10 * n),
        Rule("repeated_lines", many_lines),
        Rule("few_letters", 100 * n_letter_words(text) < 50 * n),
    ]


def cascade_order(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by rejected texts per second over the rows of ``sample``.

    One job runs all rules; the time of each is taken inside the tasks, around
    every single evaluation, so reading and scheduling do not count. Rules of
    equal gain keep their order in the list.
    """

    def now() -> Column:
        return F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")

    # a struct is filled from left to right
    timed = sample.select(
        *[
            F.struct(now().alias("from"), rule.fails.alias("fails"), now().alias("to")).alias(rule.name)
            for rule in rules
        ]
    )
    sums = []
    for rule in rules:
        tried = F.col(rule.name)
        sums.append(F.sum(tried["fails"].cast("long")).alias(f"{rule.name}_failed"))
        sums.append(F.sum(tried["to"] - tried["from"]).alias(f"{rule.name}_nanos"))
    found = timed.agg(*sums).first()
    gain = {
        r.name: (found[f"{r.name}_failed"] or 0) / max(found[f"{r.name}_nanos"] or 0, 1)
        for r in rules
    }
    return sorted(rules, key=lambda r: -gain[r.name])


def drawn(texts: DataFrame, rows: int = 2_000, seed: int = 7) -> DataFrame:
    """About ``rows`` rows by a seeded draw, stored; used for the order alone."""
    share = min(1.0, rows / max(texts.count(), 1))
    return materialize(texts.sample(share, seed).coalesce(8), "quality-sample")


def failed_rule(rules: list[Rule]) -> Column:
    """Name of the first rule in order that a text fails, else null."""
    arms = F
    for rule in rules:
        arms = arms.when(rule.fails, F.lit(rule.name))
    return arms.otherwise(F.lit(None).cast("string"))


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass all rules, unchanged.

    Each rule measures the text when its turn comes. A null text counts as empty
    and fails. An empty table stays empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sample = drawn(docs.select(text.alias("text")))
    ordered = cascade_order(sample, text_rules(F.col("text")))
    by_name = {r.name: r for r in text_rules(text)}
    return docs.where(failed_rule([by_name[r.name] for r in ordered]).isNull())


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base measures, ``base_failed`` and ``kept`` of every row.

    The measures are part of the result; the rules of the cascade judge by them
    and read the text only for what is not among them. Null and empty texts have
    zero measures and are not kept; a null id is carried along; repeated rows
    are judged one by one. Other columns of ``docs`` are not read.
    """
    rows = picked(docs, id=id_col, text=text_col).select(
        "id", F.coalesce("text", F.lit("")).alias("text")
    )
    sample = materialize(measured(drawn(rows.select("text"))), "quality-measures")
    ordered = cascade_order(sample, text_rules(F.col("text"), sample))
    found = measured(rows)
    by_name = {r.name: r for r in text_rules(F.col("text"), found)}
    return found.select(
        "id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
        failed_rule([by_name[r.name] for r in ordered]).isNull().alias("kept"),
    )


def any_failed(rules: list[Rule]) -> Column:
    """All rules without short circuit, for tests."""
    return reduce(lambda a, b: a | b, [r.fails for r in rules])
