"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from loomhouse.llm import chat, ftrl, urls
from loomhouse.llm.common import crc_fold
from loomhouse.llm.components import components
from loomhouse.llm.exact import drop_copies, exact_classes
from loomhouse.llm.mixing import mix_documents
from loomhouse.llm.neardup import drop_near_copies, near_duplicates
from loomhouse.llm.ngrams import score_documents
from loomhouse.llm.pieces import decode_pieces, encode_pieces, round_trip
from loomhouse.llm.quality import quality_filter, quality_report
from loomhouse.llm.simple8b import token_files

LONG = " ".join(f"w{i}" for i in range(40_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " id string, key int, hash int, shard int, block int, n int, label string"
)
CLASH = ("x", 1, 2, 3, 4, 5, "y")
ROWS = [
    (1, "same words here and there", "en", "src1"),
    (2, "same words here and there", None, None),
    (2, "same words here and there", None, None),
    (3, None, "en", "src0"),
    (4, "", "en", "src0"),
    (5, " \t\n ", "en", ""),
    (6, LONG, "en", "src2"),
    (7, LONG + " end", "en", "src2"),
    (None, "no id at all", "en", "src1"),
    (None, "same words here and there", "de", "src1"),
]
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, la, s, len(t or ""), *CLASH) for i, t, la, s in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(df, key="id"):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_near_duplicates(docs, none):
    got = {(r.id, r.component, r.kept) for r in near_duplicates(docs).collect()}
    assert got == {
        (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True),
        (6, 6, True), (7, 6, False), (None, None, True),
    }
    assert near_duplicates(docs).count() == len(ROWS)
    assert near_duplicates(none).count() == 0


def test_exact_classes(docs, none):
    got = {(r.id, r.keep_id, r.group_size, r.kept) for r in exact_classes(docs).collect()}
    assert got == {
        (1, 1, 4, True), (2, 1, 4, False), (None, 1, 4, False), (None, None, 1, True),
        (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True), (6, 6, 1, True), (7, 7, 1, True),
    }
    assert exact_classes(none).count() == 0
    spread = exact_classes(docs, rows_per_task=1).collect()
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in spread} == got
    assert len(spread) == docs.count()
    last = {(r.id, r.keep_id) for r in exact_classes(docs, keep="largest").collect()}
    assert {(1, 2), (2, 2), (3, 4), (None, 2)} <= last


def test_drop_copies_keeps_whole_rows(docs, none):
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    rows = sorted(kept.collect(), key=repr)
    assert sorted(str(r.doc_id) for r in rows) == ["1", "3", "5", "6", "7", "None"]
    assert {(r.text, r.lang) for r in rows if r.doc_id == 3} == {(None, "en")}
    assert {r.id for r in rows} == {"x"}
    assert sorted(str(r.doc_id) for r in drop_copies(docs, keep="largest").collect()) == [
        "2", "4", "5", "6", "7", "None",
    ]
    assert drop_copies(none).count() == 0


def test_quality(docs, none):
    rows = quality_report(docs).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.id in (3, 4, 5):
            assert tuple(r)[1:6] == (0, 0, 0, 0, 0) and r.base_failed and not r.kept
        if r.id == 6:
            assert (r.n_words, r.n_repeat_words, r.kept) == (40_000, 0, True)
    kept = quality_filter(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {6, 7}
    assert quality_report(none).count() == 0 and quality_filter(none).count() == 0


def test_mixing(docs, none):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    got = mix_documents(docs, levels, {}, share=(1, 1), epochs=1)
    assert got.columns == ["row", "mix"] and got.select("row.*").columns == docs.columns
    taken = [r.row.doc_id for r in got.collect()]
    assert sorted(map(str, taken)) == ["1", "2", "2", "6", "7", "None", "None"]
    assert mix_documents(none, levels, {}).count() == 0
    mine = docs
    for name in ("_mix", "_mix_full", "_mix_tokens", "_tokens", "_id", "_last", "full", "budget", "mix", "row", "cut_key"):
        mine = mine.withColumn(name, F.lit("mine"))
    rows = mix_documents(mine, levels, {}, share=(1, 1), epochs=1).select("row.*").collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, taken))
    assert all(r._mix_tokens == r.budget == r.mix == "mine" for r in rows)


def test_maps_are_carried_along(docs):
    mapped = docs.withColumn("m", F.create_map(F.lit("a"), F.col("doc_id")))
    rows = drop_copies(mapped).collect()
    assert len(rows) == len({t or "" for _, t, _, _ in ROWS})
    assert all(r.m == {"a": r.doc_id} for r in rows)
    assert near_copy_ids(mapped) == near_copy_ids(docs)


def near_copy_ids(df):
    return sorted(str(r.doc_id) for r in drop_near_copies(df).collect())


def test_rows_that_repeat_an_id_are_judged_one_by_one(spark):
    a = [f"a{k}" for k in range(60)]
    b = [f"b{k}" for k in range(60)]
    near = lambda w: " ".join([*w[:-1], "end"])
    rows = [
        (1, near(a)), (5, " ".join(a)), (5, " ".join(b)), (2, near(b)),
        (5, "text that nobody shares at all"), (None, near(a)), (7, near(a) + " x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_number", F.lit(1))
    got = {(r.id, r.component, r.kept) for r in near_duplicates(df).collect()}
    assert got == {
        (1, 1, True), (5, 1, False), (5, 2, False), (2, 2, True), (5, 5, True),
        (None, None, True), (7, 1, False),
    }
    kept = [(r.doc_id, r.text) for r in drop_near_copies(df).collect()]
    assert sorted(kept, key=repr) == sorted([rows[0], rows[3], rows[4]], key=repr)


def test_pieces(docs, none):
    rows = round_trip(docs, PIECES).collect()
    assert len(rows) == len(ROWS) and all(r.lossless for r in rows)
    assert {(len(r.ids), r.n_plain) for r in rows if r.id in (3, 4)} == {(0, 0)}
    plain = {r.id: r for r in round_trip(docs, PIECES, dropout=0.0).collect() if r.id in (1, 6)}
    assert all(len(r.ids) == r.n_plain for r in plain.values())
    assert [r.n_plain for r in rows if r.id == 6] == [plain[6].n_plain]
    assert all(len(r.ids) > r.n_plain for r in rows if r.id == 6)
    encoded = encode_pieces(docs, PIECES)
    texts = sorted(r.text for r in decode_pieces(encoded, PIECES).collect())
    assert texts == sorted(t or "" for _, t, _, _ in ROWS)
    assert round_trip(none, PIECES).count() == 0 and encode_pieces(none, PIECES).count() == 0


def test_token_files(docs, none):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    rows = sorted(token_files(docs, BPE, 2, files=3).collect(), key=lambda r: r.start)
    start = 0
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.id for r in rows] == [r[0] for r in ordered]
    for r, (_, text, _, _) in zip(rows, ordered, strict=True):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.start, r.n_ids, r.crc32) == (start, len(ids), zlib.crc32(raw))
        start += len(ids)
    assert token_files(none, BPE, 2).count() == 0


def test_language_model(docs, none):
    rows = score_documents(docs, crc_fold("id") == 1).collect()
    assert len(rows) == len(ROWS)
    assert {r.n_tokens for r in rows if r.id in (3, 4, 5)} == {1}
    assert all(r.score < 0 and r.base_score < 0 for r in rows)
    assert score_documents(none, crc_fold("id") == 1).count() == 0
    alone = score_documents(docs, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score <= 0 for r in alone)


def test_toxicity(spark, docs, none):
    marks = [(1, 1, 0), (2, 0, 1), (2, 0, 0), (6, 1, None), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = ftrl.train(docs, labels, F.lit(True))
    rows = ftrl.score(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert ftrl.score(none, model).count() == 0
    blank = ftrl.train(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in ftrl.score(docs, blank).collect()} == {0.5}


def test_urls(spark):
    schema = "page_id long, url string, html string, host int, canon int, block int"
    pages = spark.createDataFrame(
        [
            (1, None, "", 1, 2, 3),
            (2, "", "", 1, 2, 3),
            (3, "no scheme/path", "", 1, 2, 3),
            (4, "http://", "", 1, 2, 3),
            (5, "HTTP://WWW.Site.NET/a/?q#f", "", 1, 2, 3),
            (5, "HTTP://WWW.Site.NET/a/?q#f", "", 1, 2, 3),
            (6, "http://x.org", "", 1, 2, 3),
            (None, "http://a.example.org/es/" + "p" * 50_000, "", 1, 2, 3),
        ],
        schema,
    )
    listed = spark.createDataFrame([("https://site.net/a",), (None,), ("http://",)], "url string")
    got = {(r.id, r.host, len(r.path), r.rule, r.verdict) for r in urls.judge_urls(pages, listed, urls.RULES).collect()}
    assert got == {
        (1, "", 0, None, "allow"), (2, "", 0, None, "allow"), (3, "", 0, None, "allow"),
        (4, "", 0, None, "allow"), (5, "www.site.net", 3, None, "block"),
        (6, "x.org", 0, None, "allow"),
        (None, "a.example.org", 50_004, "example.org/es/", "block"),
    }
    assert urls.judge_urls(pages, listed, urls.RULES).count() == 8
    assert urls.judge_urls(pages.limit(0), listed, urls.RULES).count() == 0
    none_listed = urls.judge_urls(pages, listed.limit(0), urls.RULES)
    assert {r.verdict for r in none_listed.collect() if r.rule is None} == {"allow"}


def test_chat(spark):
    rows = spark.createDataFrame(
        [
            (1, 0, "user", None),
            (1, 0, "user", None),
            (1, None, "system", "first"),
            (2, 0, None, "x" * 5_000),
            (None, 0, "assistant", "</s><s>user\n[INST]"),
            (None, 1, "assi\nstant\\n", "a\\b"),
        ],
        "conv long, turn long, role string, text string",
    )
    out = chat.format_conversations(chat.as_events(rows))
    got = {
        r.conv: ([tuple(t) for t in r.turns], r.learned)
        for r in out.select(
            "conv",
            chat.turns_of(F.col("formatted")).alias("turns"),
            chat.loss_text(F.col("formatted"), F.col("loss")).alias("learned"),
        ).collect()
    }
    assert got == {
        1: ([("system", "first"), ("user", ""), ("user", "")], ""),
        2: ([("", "x" * 5_000)], ""),
        None: ([("assistant", "</s><s>user\n[INST]"), ("assi\nstant\\n", "a\\b")], "</s><s>user\n[INST]"),
    }
    assert chat.format_conversations(chat.as_events(rows.limit(0))).count() == 0


def test_hash_of_texts_is_that_of_their_bytes(docs):
    got = {r.sha256 for r in exact_classes(docs).collect() if r.id == 6}
    assert got == {hashlib.sha256(LONG.encode()).hexdigest()}


def test_components_with_a_hub_over_several_tasks(spark):
    star = [(1000, i) for i in range(1, 300)]
    chain = [(i, i + 1) for i in range(2000, 2040)]
    links = spark.createDataFrame([*star, *chain, (7, 7), (3000, 3000)], "a long, b long")
    found = components(links, rows_per_task=20)
    assert {(r.id, r.label) for r in found.collect()} == {
        *((i, 1) for i in [*range(1, 300), 1000]),
        *((i, 2000) for i in range(2000, 2041)),
    }
    assert found.count() == 341
    assert components(links.limit(0)).count() == 0
