"""Operators against brute force, exact round trips and held-out accuracy."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomhouse.llm import chat, ftrl, neardup, ngrams, simple8b
from loomhouse.llm.mixing import mix_documents
from loomhouse.llm.pieces import Encoder, load
from loomhouse.llm.quality import (
    any_failed,
    cascade_order,
    failed_rule,
    n_repeat_words,
    text_rules,
    words,
)
from loomhouse.llm.simple8b import (
    BpeEncoder,
    FileWriter,
    pack,
    read_block,
    read_table,
    unpack,
)
from loomhouse.llm.urls import bloom_filter, possible_hits
from loomhouse.session import fresh_folder, materialize

SCHEMA = "doc_id long, text string"


# --- near duplicates --------------------------------------------------------


def families(seed=3, groups=12, copies=14):
    """Documents whose copies differ in a few words, near the threshold."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.randrange(6, 120))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10_000)}"
            rows.append((len(rows), " ".join(words)))
    shared = " ".join(f"p{k}" for k in range(60))
    rows += [(len(rows) + k, f"{shared} " + " ".join(f"u{rng.random()}" for _ in range(80))) for k in range(40)]
    rng.shuffle(rows)
    return rows


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = text.encode().lower().split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    low = {i: i for i in sets}
    changed = True
    pairs = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in pairs:
            least = min(low[a], low[b])
            changed |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    return low, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("chunked", [False, True])
def test_components_equal_brute_force(spark, monkeypatch, chunked):
    if chunked:  # every bucket and group in several tasks
        monkeypatch.setattr(neardup, "BUCKET_ROWS", 4)
        monkeypatch.setattr(neardup, "GROUP_SHINGLES", 200)
    rows = families()
    low, sizes = brute_components(rows)
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.id: r.component for r in got} == low
    assert {r.id: r.n_shingles for r in got} == sizes
    assert len(set(low.values())) < len(low)


def test_links_of_a_large_group_grow_with_its_members(spark):
    rng, rows = random.Random(8), []
    base = [f"w{k}" for k in range(150)]
    for i in range(600):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(150)] = f"n{rng.randrange(100_000)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "id long, text string")
    signed = materialize(
        docs.mapInArrow(lambda b: neardup._signatures(b, 4), neardup._SIGNATURE), "signed"
    )
    links = [(r.a, r.b) for r in neardup._similar(signed).collect()]
    assert len(links) < 1.5 * len(rows) and all(a < b for a, b in links)
    low = list(range(len(rows)))
    for a, b in sorted(links, key=lambda x: x[::-1]):  # united by the larger end
        old, least = max(low[a], low[b]), min(low[a], low[b])
        low = [least if x == old else x for x in low]
    assert set(low) == {0}


def test_min_max_halves_the_hashing():
    flat, sizes = neardup.shingles([b"a b c d e f g h", b"a b c d e f g x"], neardup.WordHash())
    out = neardup.min_max(flat, np.cumsum(sizes) - sizes)
    assert out.shape == (2 * neardup.PERMUTATIONS, 2)
    assert (out[: neardup.PERMUTATIONS] < out[neardup.PERMUTATIONS :]).all()


# --- quality ----------------------------------------------------------------


def brute_repeat(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_repeated_words_and_order_of_rules(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.doc_id: r.n for r in df.select("doc_id", n_repeat_words(words(F.col("text"))).alias("n")).collect()}
    assert got == {i: brute_repeat(t.split()) for i, t in enumerate(texts)}
    rules = text_rules(F.col("text"))
    ordered = cascade_order(df, rules)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    both = df.select(failed_rule(ordered).isNotNull().alias("a"), any_failed(rules).alias("b"))
    assert both.where("a <> b").count() == 0


# --- mixing -----------------------------------------------------------------


def brute_budgets(tree, total):
    """Budgets of a tree of (weight, cap) leaves and (weight, children) nodes."""

    def cap(node):
        return node if isinstance(node, int) else sum(cap(c) for _, c in node.values())

    def fill(node, budget, path, out):
        if isinstance(node, int):
            out[path] = budget
            return
        left, open_ = budget, dict(node)
        share = {}
        while open_:
            weight = sum(w for w, _ in open_.values())
            full = [k for k, (w, c) in open_.items() if cap(c) * weight <= left * w]
            if not full:
                share.update({k: left * w / weight for k, (w, _) in open_.items()})
                break
            for k in full:
                share[k] = cap(open_.pop(k)[1])
            left = budget - sum(share.values())
        for k, (_, c) in node.items():
            fill(c, share[k], (*path, k), out)

    out = {}
    fill(tree, total, (), out)
    return out


def test_budgets_and_epochs(spark):
    sizes = {("en", "a"): 50, ("en", "b"): 4, ("de", "a"): 9, ("de", "c"): 3}
    rows = [
        (1000 * k + i, " ".join(["w"] * 10), la, s)
        for k, ((la, s), n) in enumerate(sizes.items())
        for i in range(n)
    ]
    docs = spark.createDataFrame(rows, SCHEMA + ", lang string, source string")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    weights = {"en": 1, "de": 1, "en/b": 3}
    got = mix_documents(docs, levels, weights, share=(4, 5), epochs=2).collect()
    tree = {
        "en": (1, {"a": (1, 1000), "b": (3, 80)}),
        "de": (1, {"a": (1, 180), "c": (1, 60)}),
    }
    want = brute_budgets(tree, 528)
    taken = {}
    for r in got:
        key = (r.row.lang, r.row.source)
        taken[key] = taken.get(key, 0) + r.mix.tokens
        assert abs(r.mix.budget - want[key]) < 1
    # a prefix ends with the document that fills the budget
    assert all(0 <= taken[k] - b < 10 for k, b in want.items())
    epochs = {(r.row.doc_id, r.mix.epoch) for r in got}
    assert len(epochs) == len(got) and {e for _, e in epochs} == {0, 1}
    again = mix_documents(docs, levels, weights, share=(4, 5), epochs=2).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_cutoff_inside_a_bucket_equals_one_sort(spark):
    docs = spark.range(500).selectExpr("id as doc_id", "repeat('w ', int(id % 7) + 1) as text", "'x' as lang")
    levels = {"lang": F.col("lang")}
    from loomhouse.llm import mixing

    tokens = mixing.n_words(F.col("text"))
    whole, split = (
        mixing.mixing_plan(docs, "doc_id", levels, tokens, {}, (1, 3), 1, 11, rows).first()
        for rows in (10**9, 20)
    )
    assert whole == split and whole.cut_key is not None


# --- chat -------------------------------------------------------------------


def test_events_fold(spark):
    log = [
        (1, 0, 1, "start", "user", "hi"), (1, 1, 2, "start", "assistant", ""),
        (1, 1, 3, "delta", None, "Hel"), (1, 1, 4, "delta", None, "lo"),
        (1, 2, 5, "start", "user", "gone"), (1, 2, 6, "delta", None, " too"),
        (1, 1, 7, "regenerate", None, "Good"), (1, 1, 8, "delta", None, " day"),
        (1, 2, 9, "start", "user", "next"), (1, 0, 10, "edit", None, "hey"),
        (1, 0, 11, "delta", None, " you"),
    ]
    events = spark.createDataFrame(
        log, "conv long, message long, seq long, kind string, role string, text string"
    )
    got = [tuple(r)[1:] for r in chat.fold(events).orderBy("message").collect()]
    assert got == [(0, "user", "hey you"), (1, "assistant", "Good day"), (2, "user", "next")]


def test_quoting_is_reversible(spark):
    rng = random.Random(1)
    bits = [*chat.CONTROL, "\\", "<", "[", "s>", "INST]", "/s>", "$1", "\n", "a", ""]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.quote(F.col("t")).alias("q"), chat.unquote(chat.quote(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u and not any(c in r.q for c in chat.CONTROL) for r in rows)


# --- URL list ---------------------------------------------------------------


def test_bloom_filter_has_no_false_negative(spark):
    keys = spark.range(2_000).selectExpr("concat('k', id) as canon")
    for blocks in (1, 64):
        seen = possible_hits(keys, "canon", bloom_filter(keys, "canon", blocks), blocks)
        assert seen.where("not _maybe").count() == 0
    others = spark.range(20_000).selectExpr("concat('o', id) as canon")
    hits = possible_hits(others, "canon", bloom_filter(keys, "canon", 64), 64)
    assert hits.where("_maybe").count() < 400


# --- token files ------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_256), st.integers(0, 2**64 - 1)), max_size=300))
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    assert (unpack(pack(v)) == v).all()


def test_simple8b_is_dense_and_blocks_stand_alone():
    assert len(pack(np.zeros(60, np.uint64))) == 1
    assert len(pack(np.full(8, 2**60, np.uint64))) == 16
    ids = [np.arange(n, dtype=np.uint32) for n in (3, 1, 500)]
    out = io.BytesIO()
    writer = FileWriter(out)
    writer.add(np.concatenate(ids[:2]), [5, None], np.array([3, 4]))
    writer.add(ids[2], [9], np.array([500]))
    writer.close()
    raw = out.getvalue()
    table = read_table(out, len(raw))
    assert table[:, 1:].tolist() == [[0, 0], [4, 2], [504, 3]]
    cuts = table[:, 0].tolist()
    read = [read_block(memoryview(raw)[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    assert [(n, e.tolist()) for _, n, e in read] == [([5, None], [3, 4]), ([9], [500])]
    assert (read[1][0] == ids[2]).all()


def test_words_apart_give_the_ids_of_the_whole_text():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = BpeEncoder(path, limit=50), Tokenizer.from_file(path)
    texts = [
        "", " ", "a  b \n c", " it's  \t x y", "\x1c b \x85 c  ", "é" * 200,
        "<|endoftext|> x", "x <|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c <|endoftext|>",
        "<|endoftext|>", "a <|endoftext|", "we'll see 123 456!? ...", "　wide  　 space",
        "word. word, Word; wörd! naïve? ÿ. ı. don't x' 'y \"quoted\" (in) a_b c__ d² Ⅷ. e\u0301. f-g h/i",
        "end.\nNext line. \nThird", "a" * 200 + ". " + "b" * 200, *["w%d end" % i for i in range(90)],
    ]
    want = [p.ids for p in plain.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [i.tolist() for i in encoder.encode(texts)] == want
    assert encoder.encode(["x"], b"\x02\0\0\0")[0].tolist() == [*want[0], *plain.encode("x").ids, 2]


def test_ids_of_random_texts_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = BpeEncoder(path, limit=300), Tokenizer.from_file(path)
    rng = random.Random(6)
    parts = [*"abcXYZéßøŁ", *".,;:!?'\"()-_/#", *"0189²", *" \n\t\u00a0\u2003\x1c", "中", "ع", "\u0301", "\U0001f600", "'s", "'ll", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, [3] * 10 + [1] * (len(parts) - 10), k=rng.randrange(80))).replace("Z", " ") for _ in range(3000)]
    want = [p.ids for p in plain.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in encoder.encode(texts)] == want


def test_one_file_of_many_blocks_is_read_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(simple8b, "BLOCK_IDS", 40)
    monkeypatch.setattr(simple8b, "BLOCKS_AT_ONCE", 3)
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    path = public_tokenizers.path("byte_bpe_50k.json")
    one, many = (
        sorted(map(tuple, simple8b.token_files(docs, path, 2, files=n).collect())) for n in (1, 7)
    )
    assert one == many and len(one) == 300


def test_files_follow_from_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(simple8b, "FILE_BYTES", 100)
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('x', 10) as text")
    written = simple8b.write_tokens(
        docs, public_tokenizers.path("byte_bpe_50k.json"), fresh_folder(spark, "t"), 2
    )
    assert written.rdd.getNumPartitions() == 41 and written.count() > 30


# --- pieces -----------------------------------------------------------------


def test_pieces_equal_the_library_and_vary_without_loss():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, pieces = sentencepiece.SentencePieceProcessor(model_file=path), load(path)
    texts = ["the quick brown foxes", "  a  b ", "\n\tx\r\n", "中文 \U0001f600 é", "a" * 90, "<s></s><0x41>"] * 3
    plain = Encoder(pieces, 0.0, 1).encode(texts, [1] * len(texts))
    assert [p.tolist() for p in plain] == library.encode(texts)
    varied = Encoder(pieces, 0.3, 1)
    found = varied.encode(texts, list(range(len(texts))))
    assert [pieces.decode(i.tolist()) for i in found] == texts
    assert [library.decode(i.tolist()) for i in found] == texts
    assert any(len(a) != len(b) for a, b in zip(plain, found, strict=True))
    again = Encoder(pieces, 0.3, 1).encode(texts, list(range(len(texts))))
    assert all((a == b).all() for a, b in zip(found, again, strict=True))
    marked = "▁a ▁"
    assert pieces.decode(varied.encode([marked], [0])[0].tolist()) == marked


# --- language model ---------------------------------------------------------


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(ngrams, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(ngrams, "SHARD_BYTES", 3_000)
    rng = random.Random(2)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(rng.randrange(40))) for _ in range(120)]
    rows = list(enumerate(texts))
    got = ngrams.score_documents(
        spark.createDataFrame(rows, SCHEMA), F.col("id") % 5 == 1, order=order
    ).collect()
    seqs = {i: [*t.split(), "</>"] for i, t in rows}
    counts, docs = {}, 0

    def gram(s, k, n):
        return tuple((["<>"] * n + s)[n + k - n + 1 : n + k + 1])

    for i, s in seqs.items():
        if i % 5 != 1:
            docs += 1
            for n in range(order):
                counts[("<>",) * (n + 1)] = counts.get(("<>",) * (n + 1), 0) + 1
                for k in range(len(s)):
                    g = gram(s, k, n + 1)
                    counts[g] = counts.get(g, 0) + 1
    train = sum(len(s) for i, s in seqs.items() if i % 5 != 1)
    types = len({w for i, s in seqs.items() if i % 5 != 1 for w in s})

    def estimates(s, out):
        c = [np.array([counts.get(gram(s, k, n + 1), 0) for k in range(len(s))]) for n in range(order)]
        return ngrams._estimates(c, docs, train, types, out)

    cells = {}
    for i, s in seqs.items():
        if i % 5 != 1:
            p, bucket = estimates(s, 1)
            for k in range(len(s)):
                cell = tuple(
                    int(np.round(-ngrams._GRID * np.log2(x))) if x > 0 else -1 for x in p[1:, k]
                )
                cells[int(bucket[k]), cell] = cells.get((int(bucket[k]), cell), 0) + 1
    weights = ngrams.learn_weights([(*k, n) for k, n in cells.items()], types, order)
    assert len(got) == len(rows)
    for r in got:
        s = seqs[r.id]
        known = [counts.get((w,), 0) for w in s]
        base = sum(np.log10((c + 0.5) / (train + 0.5 * (types + 1))) for c in known)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(s), sum(c > 0 for c in known), train)
        assert r.base_score == pytest.approx(base)
        assert r.score == pytest.approx(_total(ngrams, estimates(s, 0), weights))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 1.1 * sum(r.base_score for r in held)


def _total(ngrams, found, weights):
    p, bucket = found
    w = weights[bucket].T
    if len(p) > 2:
        w = np.where((bucket == 0) & (np.arange(len(p)) > 1)[:, None], 0.0, w)
        w = w / w.sum(0)
    return np.log10((w * p).sum(0)).sum()


# --- toxicity ---------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(9)
    rows = []
    for i in range(800):
        toxic = int(rng.random() < 0.3)
        words = [f"w{rng.randrange(300)}" for _ in range(40)]
        if toxic:
            words[rng.randrange(40)] = rng.choice(["Trash!", "idiot", "(scum)"])
        rows.append((i, " ".join(words), toxic))
    df = spark.createDataFrame(rows, SCHEMA + ", toxic int")
    learn = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) != 0
    model = ftrl.train(df, df, learn)
    assert len(model.place) < 400
    score = {r.id: r.score for r in ftrl.score(df, model).collect()}
    held = [(score[i], t) for i, _, t in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((s >= 0.5) == bool(t) for s, t in held) / len(held) > 0.95


# --- work of the encoders -----------------------------------------------------


def test_new_words_of_letters_are_merged_together(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, calls, merged = BpeEncoder(path), [], BpeEncoder._merged
    monkeypatch.setattr(BpeEncoder, "_merged", lambda self, w: calls.append(w) or merged(self, w))
    texts = ["Ab cde, fgé. hij cde " + "x" * 80 + " k\u00fcl", None, "Ab  cde (fgé) " + "x" * 80 + "!", ""]
    got = encoder.encode(texts)
    assert len(calls) == 1
    plain = encoder.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    assert [g.tolist() for g in got] == [f.ids for f in plain]
    assert [g.tolist() for g in encoder.encode(texts)] == [f.ids for f in plain]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
def test_words_start_where_a_plain_walk_starts_them(n):
    behind = np.minimum(np.arange(n) + np.random.default_rng(n).choice([1, 2, 7, 60], n), n)
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at = behind[at]
    assert simple8b._followed(behind.astype(np.int32)).tolist() == starts


class Asked(dict):
    """Counts the look-ups of its keys."""

    n = 0

    def get(self, key, other=None):
        self.n += 1
        return super().get(key, other)

    def __contains__(self, key):
        self.n += 1
        return super().__contains__(key)

    def __getitem__(self, key):
        self.n += 1
        return super().__getitem__(key)


def test_a_known_chunk_is_looked_up_once():
    from loomhouse.llm.queries import piece_model

    encoder, text = Encoder(load(piece_model()), 0.1, 17), "some words and some more words"
    first = encoder.encode([text], [4])[0].tolist()
    encoder.plain = Asked(encoder.plain)
    assert encoder.encode([text], [4])[0].tolist() == first
    assert encoder.plain.n == 4
    few = Encoder(load(piece_model()), 0.1, 17, limit=3)  # what is known is carried over
    for words in (text, "more and others", text, "y" * 70 + " some " + "y" * 70, text):
        whole = Encoder(load(piece_model()), 0.1, 17).encode([words], [4])[0].tolist()
        assert few.encode([words], [4])[0].tolist() == whole


def test_a_known_word_is_looked_up_once_in_a_batch():
    encoder = BpeEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["some words, and some words. and 12 ", None, "some and <|endoftext|> some", "words, 12\u00a0x"] * 30
    encoder.known = Asked()
    got = encoder.encode(texts, b"\x02\0\0\0")
    plain = encoder.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    assert [g.tolist() for g in got] == [[*f.ids, 2] for f in plain]
    encoder.known.n = 0
    assert [g.tolist() for g in encoder.encode(texts)] == [f.ids for f in plain]
    assert encoder.known.n <= 15 < sum(len((t or "").split()) for t in texts)


def test_parts_are_those_of_a_slice_with_texts_that_end_in_a_space():
    encoder = BpeEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x ", "y", " ", " ", ".a", "b", ".", None, "", "  ", "\u3000 \u3000a", "c ", "d. 'e's, f_g. \x1c h"]
    flat, ends = encoder.encode_flat(pa.array(["z ", *texts, " z"]).slice(1, len(texts)))
    plain = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [g.tolist() for g in np.split(flat, ends[:-1])] == plain
    none, at = encoder.encode_flat(pa.array([None, ""], pa.string()), b"\x02\0\0\0")
    assert (none.tolist(), at.tolist()) == ([2, 2], [1, 2])
    assert encoder.encode([]) == []
