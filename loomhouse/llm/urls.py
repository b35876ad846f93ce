"""URL filter: site rules first, then a list of canonical URLs.

The list becomes a blocked Bloom filter: each URL sets eight bits inside one
512-bit block, and blocks are joined to the pages by a broadcast of bounded
size. Only pages that hit all bits of their block go on to the exact join with
the list, which removes the false positives. A list too long for the bound
gives more false positives and the same verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomhouse.llm.common import picked
from loomhouse.session import materialize

_WORDS = 8  # 64-bit words of a block, one bit set in each
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 16  # 4 MB of filter


@dataclass(frozen=True)
class SiteRule:
    """``verdict`` for a host with its subdomains and a prefix of the path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# fixed values: rules of the query
RULES = [
    SiteRule("allow", "org", "/"),
    SiteRule("block", "example.org", "/es/"),
    SiteRule("block", "example.org", "/en/1"),
    SiteRule("allow", "com", "/fr/"),
    SiteRule("block", "com", "/de/"),
]


def _lower(c: Column) -> Column:
    """A-Z alone in lower case."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _behind_scheme(url: Column) -> Column:
    return F.when(
        F.instr(url, F.lit("://")) > 0,
        F.substring(url, F.instr(url, F.lit("://")) + 3, F.length(url)),
    ).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end."""
    return _lower(F.regexp_extract(_behind_scheme(url), r"(?s)^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(_behind_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without ``.html`` and last slash."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.concat(bare, F.regexp_replace(F.regexp_replace(path, r"\.html$", ""), r"/$", ""))


def rule_for(rules: list[SiteRule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct; ties go to the first in text order."""
    fits = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        on_host = (host == r.host) | F.endswith(host, F.lit(f".{r.host}"))
        found = F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))
        fits = F.when(on_host & F.startswith(path, F.lit(r.path)), found).otherwise(fits)
    return fits


def _block(hash_: Column, blocks: int) -> Column:
    return F.pmod(hash_, F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit in each word of the block, six bits of a second hash for each."""
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    return [
        F.call_function(
            "shiftleft", one, F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        )
        for k in range(_WORDS)
    ]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block`` and its words ``w0..w7``, at most ``blocks`` rows."""
    marked = keys.select(
        _block(F.xxhash64(key), blocks).alias("block"),
        *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(key)))],
    )
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)])


def blocks_for(n: int) -> int:
    """Blocks for ``n`` keys, a power of two within the bound."""
    need = max(1, n * BITS_PER_URL // (64 * _WORDS))
    return min(MAX_BLOCKS, 1 << (need - 1).bit_length())


def possible_hits(rows: DataFrame, key: str, filter_: DataFrame, blocks: int) -> Column:
    """``rows`` with ``_maybe``: whether ``key`` may be in the filter."""
    hit = reduce(
        lambda a, b: a & b,
        [F.col(f"_w{i}").bitwiseAND(b) == b for i, b in enumerate(_bits(F.col(key)))],
    )
    side = filter_.select(
        F.col("block").alias("_block"), *[F.col(f"w{i}").alias(f"_w{i}") for i in range(_WORDS)]
    )
    # at most MAX_BLOCKS rows of 68 bytes
    return (
        rows.join(F.broadcast(side), _block(F.xxhash64(key), blocks) == F.col("_block"), "left")
        .withColumn("_maybe", F.coalesce(hit, F.lit(False)))
        .select(*rows.columns, "_maybe")
    )


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[SiteRule],
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict`` of every row of ``pages``.

    The verdict is the longest rule's, else ``block`` where the canonical URL
    is that of a listed one, else ``allow``. Null URLs and URLs without ``://``
    have an empty host and path, meet no rule and are never listed. Repeated
    rows are judged one by one; repeated list entries count once. Other columns
    are not read.
    """
    parts = picked(pages, id=id_col, url=url_col).select(
        "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    parts = parts.select(
        "id",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path")],
    ).withColumn("canon", canonical(F.col("host"), F.col("path")))
    entries = picked(listed, url=listed_col).select(
        canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("canon")
    )
    entries = materialize(entries.where("canon <> ''").distinct(), "listed-urls")
    blocks = blocks_for(entries.count())
    filter_ = materialize(bloom_filter(entries, "canon", blocks).coalesce(1), "url-bloom")
    ruled = parts.withColumn("_rule", rule_for(rules, F.col("host"), F.col("path")))
    tested = possible_hits(ruled, "canon", filter_, blocks)
    # A rule decides alone, so only pages without one ask the list.
    asks = F.col("_maybe") & F.col("_rule").isNull() & (F.col("canon") != "")
    confirmed = tested.where(asks).join(entries.withColumn("_listed", F.lit(True)), "canon", "left")
    passed = tested.where(~asks).withColumn("_listed", F.lit(None).cast("boolean"))
    verdict = F.coalesce(
        F.col("_rule.verdict"), F.when(F.col("_listed"), "block").otherwise("allow")
    )
    return (
        confirmed.select(*passed.columns)
        .union(passed)
        .select("id", "host", "path", F.col("_rule.text").alias("rule"), verdict.alias("verdict"))
    )
