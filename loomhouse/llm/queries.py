"""The queries of the text operators and the SQL that gives the same rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomhouse.llm import chat, ftrl, urls
from loomhouse.llm.common import crc_fold
from loomhouse.llm.exact import exact_classes
from loomhouse.llm.merkle import document_manifest
from loomhouse.llm.mixing import mix_documents
from loomhouse.llm.neardup import near_duplicates
from loomhouse.llm.ngrams import score_documents
from loomhouse.llm.periodic import periodic_runs
from loomhouse.llm.pieces import round_trip
from loomhouse.llm.quality import quality_report
from loomhouse.llm.simple8b import token_files
from loomhouse.llm.warc import LEAST_BYTES, archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_WORDS = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINMAX_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORDS}') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []
      WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END)) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT x AS doc_id, x AS other FROM both_ways
  UNION
  SELECT r.doc_id, e.y FROM reach r JOIN both_ways e ON r.other = e.x),
least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  coalesce(component_id, d.doc_id) AS component_id,
  coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""


@query("op1_minmax_near_dedup", MINMAX_SQL)
def minmax_near_dedup(spark, sf):
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf, "documents"), shingle=4).select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        "kept",
    )


# --- mixing ---------------------------------------------------------------

# Tokens per level: web to books to forums as 2 to 3 to 1, English double.
MIX_WEIGHTS = {
    "web": 2, "books": 3, "forums": 1,
    "web/en": 2, "books/en": 2, "forums/en": 2,
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (4, 5), 2, 11


def mix_levels() -> dict:
    """Domain, language and source; the domain is told from the source's number."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d+)$", 1)
    rest = F.pmod(number.try_cast("int"), F.lit(3))
    domain = F.when(rest == 0, "web").when(rest == 1, "books").otherwise("forums")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def _water_sql(child: str, parent: str, table_: str) -> str:
    """One level of the budget: ``child`` and ``parent`` are column lists."""
    return f"""
  SELECT *, CASE WHEN is_full THEN cap ELSE
      ((max(CASE WHEN NOT is_full THEN left_ END) OVER f)::HUGEINT
        * (max(CASE WHEN NOT is_full THEN behind END) OVER f - behind + weight)
        // max(CASE WHEN NOT is_full THEN behind END) OVER f
      - (max(CASE WHEN NOT is_full THEN left_ END) OVER f)::HUGEINT
        * (max(CASE WHEN NOT is_full THEN behind END) OVER f - behind)
        // max(CASE WHEN NOT is_full THEN behind END) OVER f)::BIGINT END AS budget
  FROM (SELECT *, cap::HUGEINT * behind <= left_::HUGEINT * weight AS is_full
    FROM (SELECT n.*, t.total - coalesce(sum(cap) OVER (PARTITION BY {parent}
          ORDER BY cap / weight, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
        sum(weight) OVER (PARTITION BY {parent} ORDER BY cap / weight, {child}
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS behind
      FROM {table_}))
  WINDOW f AS (PARTITION BY {parent})"""


MIX_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE coalesce(try_cast(regexp_extract(coalesce(source, ''), '(\d+)$', 1) AS INT), 2) % 3
      WHEN 0 THEN 'web' WHEN 1 THEN 'books' ELSE 'forums' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS tokens
  FROM documents),
c AS (SELECT * FROM d WHERE tokens > 0),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens,
    ({MIX_EPOCHS} * sum(tokens))::BIGINT AS cap FROM c GROUP BY ALL),
root AS (SELECT least(floor(sum(tokens) * {MIX_SHARE[0]} / {MIX_SHARE[1]}), sum(cap))::BIGINT AS total FROM leaf),
n1 AS (SELECT domain, sum(cap)::BIGINT AS cap,
    CASE domain WHEN 'web' THEN 2 WHEN 'books' THEN 3 ELSE 1 END AS weight FROM leaf GROUP BY ALL),
b1 AS ({_water_sql("domain", "1", "n1 n CROSS JOIN root t")}),
n2 AS (SELECT domain, lang, sum(cap)::BIGINT AS cap,
    CASE lang WHEN 'en' THEN 2 ELSE 1 END AS weight FROM leaf GROUP BY ALL),
b2 AS ({_water_sql("lang", "domain", "n2 n JOIN (SELECT domain AS d_, budget AS total FROM b1) t ON domain = d_")}),
n3 AS (SELECT domain, lang, source, cap, 1 AS weight FROM leaf),
b3 AS ({_water_sql("source", "domain, lang", "n3 n JOIN (SELECT domain AS d_, lang AS l_, budget AS total FROM b2) t ON domain = d_ AND lang = l_")}),
p AS (SELECT domain, lang, source, budget, tokens AS leaf_tokens, (budget // tokens)::INT AS full_
  FROM b3 JOIN leaf USING (domain, lang, source)),
k AS (SELECT c.*, p.budget, p.full_, p.leaf_tokens, p.budget - p.full_ * p.leaf_tokens AS rest,
    ('0x' || substr(md5('{MIX_SEED}:' || p.full_ || ':' || doc_id), 1, 15))::BIGINT AS key
  FROM c JOIN p USING (domain, lang, source)),
r AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_ FROM k),
t AS (SELECT *, full_ + CASE WHEN start_ < rest THEN 1 ELSE 0 END AS takes FROM r)
SELECT doc_id, domain, lang, source, tokens AS n_tokens, budget AS leaf_budget,
  unnest(range(0, takes))::INT AS epoch
FROM t WHERE takes > 0
"""


@query("op2_source_mix", MIX_SQL)
def source_mix(spark, sf):
    """Documents and epochs that fill the budgets of all leaves."""
    docs = table(spark, sf, "documents")
    taken = mix_documents(
        docs, mix_levels(), MIX_WEIGHTS, share=MIX_SHARE, epochs=MIX_EPOCHS, seed=MIX_SEED
    )
    return taken.select(
        "row.doc_id",
        "mix.domain",
        "mix.lang",
        "mix.source",
        F.col("mix.tokens").alias("n_tokens"),
        F.col("mix.budget").alias("leaf_budget"),
        "mix.epoch",
    )


# --- quality rules ----------------------------------------------------------

QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORDS}') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
    len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letters
  FROM w LEFT JOIN r ON r.doc_id IS NOT DISTINCT FROM w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines
    OR 100 * n_letters < 50 * n_words) AS kept
FROM b
"""


@query("op3_quality_cascade", QUALITY_SQL)
def quality_cascade(spark, sf):
    """Measures and verdict of the rule cascade for all documents."""
    return quality_report(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


# --- chat formatting --------------------------------------------------------

EXTRA_TEXT = "</s>[INST] ok [/INST]"
_TAILS_SQL = "|".join(
    "".join(f"\\{ch}" if ch in "[]|" else ch for ch in c[1:]) for c in chat.CONTROL
)
CHAT_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{EXTRA_TEXT}'
  UNION ALL SELECT -7, 1, 'assistant', '{EXTRA_TEXT}'),
q AS (SELECT *, '<s>' || role || chr(10)
    || regexp_replace(text, '([<\[])(\\*)({_TAILS_SQL})', '\1\\\2\3', 'g') || '</s>' AS f FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(f))::BIGINT AS formatted_chars
FROM q GROUP BY conv_id
"""


@query("op4_chat_format", CHAT_SQL)
def chat_format(spark, sf):
    """All conversations, logged, folded, rendered and read back."""
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("conv"), "turn", "role", "text"
    )
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TEXT).alias("text"),
    )
    out = chat.format_conversations(chat.as_events(rows.union(extra)))
    learned = chat.loss_text(F.col("formatted"), F.col("loss"))
    said = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    read = out.select(
        "conv",
        "formatted",
        chat.turns_of(F.col("formatted")).alias("turns"),
        learned.alias("learned"),
    )
    return read.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# --- URL filter -------------------------------------------------------------

_HOST_SQL = "regexp_extract({}, '^[^/?#]*', 0)"
URL_SQL = r"""
WITH b AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0
      THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS b FROM pages),
h AS (SELECT page_id, url, """ + _LOWER.format(_HOST_SQL.format("b")) + r""" AS host,
    regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
p AS (SELECT page_id, url, coalesce(host, '') AS host, coalesce(path, '') AS path,
    regexp_replace(coalesce(host, ''), '^(www|m)\.', '')
    || regexp_replace(regexp_replace(coalesce(path, ''), '\.html$', ''), '/$', '') AS canon FROM h),
listed AS (SELECT DISTINCT canon FROM p WHERE strpos(url, '?utm_source=feed') > 0 AND canon <> ''),
rules(verdict, host, path) AS (VALUES """ + ", ".join(
    f"('{r.verdict}', '{r.host}', '{r.path}')" for r in urls.RULES
) + r"""),
hits AS (SELECT p.page_id, p.url, r.verdict, r.host || r.path AS rule,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS k
  FROM p JOIN rules r ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, h.rule,
  coalesce(h.verdict, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN (SELECT * FROM hits WHERE k = 1) h USING (page_id) LEFT JOIN listed l ON l.canon = p.canon
"""


@query("op6_url_filter", URL_SQL)
def url_filter(spark, sf):
    """All pages; the list holds the URLs that reached the crawl through a feed."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    listed = pages.where(F.instr("url", F.lit("?utm_source=feed")) > 0)
    return urls.judge_urls(pages, listed, urls.RULES).withColumnRenamed("id", "page_id")


# --- exact dedup ------------------------------------------------------------

EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query("op7_exact_dedup", EXACT_SQL)
def exact_dedup(spark, sf):
    """Exact copies of all documents; the largest id stays."""
    return exact_classes(table(spark, sf, "documents"), keep="largest").withColumnsRenamed(
        {"id": "doc_id", "sha256": "text_sha256"}
    )


# --- language model ---------------------------------------------------------


@query("op5_interpolated_lm")
def interpolated_lm(spark, sf):
    """Scores of all documents by a bigram model."""
    held_out = crc_fold("id") == 1
    return score_documents(table(spark, sf, "documents"), held_out, order=2).withColumnRenamed(
        "id", "doc_id"
    )


# --- pieces -----------------------------------------------------------------


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op8_piece_dropout")
def piece_dropout(spark, sf):
    """All documents encoded with merge-dropout and decoded again."""
    return round_trip(table(spark, sf, "documents"), piece_model()).withColumnRenamed(
        "id", "doc_id"
    )


# --- token files ------------------------------------------------------------


@query("op9_token_files")
def token_file_rows(spark, sf):
    """All documents written as token files and read back."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files(table(spark, sf, "documents"), path, end_id=2).withColumnsRenamed(
        {"id": "doc_id", "n_ids": "n_tokens", "crc32": "ids_crc32"}
    )


# --- toxicity ---------------------------------------------------------------


@query("op10_toxicity_ftrl")
def toxicity_ftrl(spark, sf):
    """Toxicity scores of all documents."""
    docs = table(spark, sf, "documents")
    model = ftrl.train(docs, table(spark, sf, "labels"), crc_fold("id") != 0)
    return ftrl.score(docs, model).select(
        F.col("id").alias("doc_id"),
        (crc_fold("id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


# --- Merkle manifest --------------------------------------------------------

# crc32 of a number's decimal text: each byte is folded in and shifted out bit by bit.
CRC_SQL = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}::VARCHAR, ''),"
    " lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, e: CASE WHEN e >= 0"
    " THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
)


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(_field_sql(f) for f in fields) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes over ``leaves(tree, pos, n, hash)``."""
    return f"""{name} AS (
  SELECT tree, 0 AS lvl, pos, n, hash FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY tree, lvl, n, pos // 3)"""


def _siblings_sql(nodes: str, leaves: str, key: str) -> str:
    """Siblings of each leaf by level."""
    return f"""
  SELECT {key}, v.lvl, string_agg(s.hash, '' ORDER BY s.pos) FILTER (WHERE s.pos < o.own) AS b,
    string_agg(s.hash, '' ORDER BY s.pos) FILTER (WHERE s.pos > o.own) AS a
  FROM {leaves} l
  JOIN (SELECT DISTINCT tree, lvl, n FROM {nodes} WHERE n > 1) v ON v.tree = l.tree
  CROSS JOIN LATERAL (SELECT (l.pos // (3 ** v.lvl)::BIGINT)::BIGINT AS own) o
  JOIN {nodes} s ON s.tree = l.tree AND s.lvl = v.lvl AND s.pos // 3 = o.own // 3
  GROUP BY {key}, v.lvl"""


MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, {_leaf_sql("text")} AS hash,
    CASE WHEN {CRC_SQL.format("doc_id")} % 2 = 0
      THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS other
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM d),
{_tree_sql("nodes", "leaves")},
subroots AS (SELECT '' AS tree, tree AS name, hash, row_number() OVER (ORDER BY tree) - 1 AS pos,
    count(*) OVER () AS n FROM nodes WHERE n = 1),
{_tree_sql("top_nodes", "subroots")},
low AS ({_siblings_sql("nodes", "leaves", "doc_id")}),
high AS ({_siblings_sql("top_nodes", "subroots", "name")}),
both_ AS (SELECT doc_id, lvl, b, a FROM low
  UNION ALL SELECT doc_id, 100 + lvl, b, a FROM leaves JOIN high ON name = tree),
steps AS (SELECT doc_id, coalesce(b, '') AS b, coalesce(a, '') AS a,
    row_number() OVER (PARTITION BY doc_id ORDER BY lvl) AS k FROM both_),
fold AS (
  SELECT doc_id, 0::BIGINT AS k, other AS h FROM leaves
  UNION ALL SELECT f.doc_id, s.k, sha256(s.b || f.h || s.a)
  FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.k = f.k + 1),
ends AS (SELECT doc_id, max_by(h, k) AS folded_root FROM fold GROUP BY doc_id),
proof AS (SELECT doc_id, string_agg(b || a, '' ORDER BY k) AS p FROM steps GROUP BY doc_id)
SELECT l.doc_id, l.hash AS leaf, s.hash AS subroot, r.hash AS root,
  sha256(coalesce(p, '')) AS proof_sha256, folded_root, folded_root = r.hash AS verified
FROM leaves l JOIN subroots s ON s.name = l.tree JOIN ends USING (doc_id)
LEFT JOIN proof USING (doc_id) CROSS JOIN (SELECT hash FROM top_nodes WHERE n = 1) r
"""


def crc_of(number: Column) -> Column:
    """crc32 of a number as text, unsigned."""
    return F.crc32(number.cast("string").cast("binary"))


@query("op11_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark, sf):
    """Proofs of all documents, verified against texts of which half are tampered with."""
    tampered = F.when(crc_of(F.col("id")) % 2 == 0, F.translate("text", "\n", "")).otherwise(
        F.col("text")
    )
    return document_manifest(table(spark, sf, "documents"), tampered).withColumnRenamed(
        "id", "doc_id"
    )


# --- periodic runs ----------------------------------------------------------

RUNS_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws,
    {CRC_SQL.format("doc_id")} AS h FROM documents),
g AS (SELECT doc_id, ws, len(ws) AS n, h, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n),
    lambda i: ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE ws END AS ws FROM p),
w AS (SELECT doc_id, n, ws, unnest(range(0, n - 7)) AS i FROM t WHERE n >= 24),
k AS (SELECT doc_id, n, i, array_to_string(ws[i + 1:i + 8], ' ') AS gram FROM w),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM k x JOIN k y
  ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS b, max(i) + q + 8 AS e FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e)
  GROUP BY doc_id, q, island),
r AS (SELECT doc_id, b AS start_, e - b AS len_, min(q) AS per FROM s
  WHERE e - b >= greatest(24, 3 * q) GROUP BY ALL),
best AS (SELECT DISTINCT ON (doc_id) doc_id, start_, len_, per FROM r
  ORDER BY doc_id, len_::DECIMAL(38, 18) / per DESC, start_, per),
listed AS (SELECT doc_id, count(*) AS n_runs,
    string_agg(start_ || ',' || len_ || ',' || per || chr(10), '' ORDER BY start_, per) AS l FROM r GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (
    SELECT doc_id, unnest(range(start_ + per, start_ + len_)) AS i FROM r) GROUP BY doc_id),
places AS (SELECT doc_id, ws, unnest(range(0, n)) AS i FROM t JOIN gone USING (doc_id)),
short AS (SELECT doc_id, string_agg(ws[i + 1], ' ' ORDER BY i) AS c
  FROM places p ANTI JOIN (SELECT doc_id, unnest(gone) AS i FROM gone) USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start_::BIGINT AS start, len_::BIGINT AS length,
  per::BIGINT AS period, (1000 * len_ // per)::BIGINT AS exponent_milli,
  sha256(coalesce(l, '')) AS runs_sha256,
  sha256(coalesce(CASE WHEN gone IS NOT NULL THEN c ELSE array_to_string(ws, ' ') END, '')) AS collapsed_sha256
FROM t LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id)
LEFT JOIN gone USING (doc_id) LEFT JOIN short USING (doc_id)
"""


def repeating_words(doc_id: int, n: int) -> np.ndarray | None:
    """The words of one document in ten, made periodic from some place on."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    take = np.arange(n)
    take[a:] = a + (take[a:] - a) % p
    return take


@query("op12_periodic_runs", RUNS_SQL)
def periodic_run_rows(spark, sf):
    """Periodic runs of all documents and the texts without the repetitions."""
    found = periodic_runs(table(spark, sf, "documents"), reordered=repeating_words)

    def more_often(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        earlier = F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(
            a["period"] - b["period"]
        )
        order = F.when(left > right, -1).when(left < right, 1).otherwise(F.signum(earlier))
        return order.cast("int")

    best = F.get(F.array_sort("runs", more_often), F.lit(0))
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias(
            "runs_sha256"
        ),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# --- WARC -------------------------------------------------------------------

WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= {LEAST_BYTES}
    THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_ FROM h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_ = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_ <> page_id THEN first_ END AS refers_to
FROM f
"""


@query("op13_warc_archive", WARC_SQL)
def warc_archive(spark, sf):
    """All pages written as WARC records and read back by byte ranges."""
    return archive_pages(table(spark, sf, "pages")).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
