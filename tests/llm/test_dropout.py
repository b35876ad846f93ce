"""Merge-dropout draws for every occurrence of a word."""

import sys
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from loomhouse.llm import pieces
from loomhouse.llm.pieces import Encoder, _chunks, encode_pieces, load

PATH = public_tokenizers.path("piece_bpe_32k.model")


def cuts(encoder, text, doc, epoch=0):
    """Ids of each chunk of ``text``, segmented one by one."""
    chunks = _chunks(text)
    keys = encoder._keys([doc], [epoch], np.array([len(chunks)]))
    return [encoder.pieces.segment(c, int(k), encoder.below) for c, k in zip(chunks, keys, strict=True)]


@pytest.mark.parametrize("word", ["the", "house", "international"])
def test_a_word_has_as_many_forms_as_its_occurrences_draw(word):
    encoder = Encoder(load(PATH), 0.1, 17)
    chunk, n, docs = "▁" + word, 400, 10
    _, steps = encoder.pieces.plain_all([chunk])[0]
    keys = encoder._keys(list(range(docs)), [0] * docs, np.full(docs, n))
    skips = encoder._differs([chunk], [steps], np.zeros(n * docs, np.int64), keys)
    # every merge is skipped in a tenth of the occurrences, whatever the word
    share = 1 - 0.9 ** (len(steps) // 8)
    assert abs(skips.mean() - share) < 4 * np.sqrt(share * (1 - share) / (n * docs))
    found = Counter(c for d in range(docs) for c in cuts(encoder, " ".join([word] * n), d))
    assert len(found) > 2 and found.most_common(1)[0][0] == encoder.pieces.segment(chunk, 0, 0)
    got = encoder.encode([" ".join([word] * n)] * docs, list(range(docs)))
    assert len({g.tobytes() for g in got}) == docs


def test_remembered_merges_give_the_ids_of_one_by_one():
    encoder = Encoder(load(PATH), 0.3, 5, limit=20)
    texts = ["the quick brown foxes jump", "  a  b ", "中文 \U0001f600 é ▁x", "a" * 90 + " b", None, "", "over the lazy dogs the"] * 4
    docs = [*range(len(texts) - 1), None]
    for epoch in (0, 1):
        got = encoder.encode(texts, docs, [epoch] * len(texts))
        for text, doc, ids in zip(texts, docs, got, strict=True):
            assert ids.tobytes() == (b"".join(cuts(encoder, text, doc, epoch)) if text else b"")


FULL = 1 << 64


def mixed(h: int, value: int) -> int:
    out = (h ^ value) * 0x9E3779B97F4A7C15 % FULL
    return out ^ (out >> 29)


def brute_ids(model, score, word, key, limit):
    """Of all neighbours that make a piece and are not skipped, the best and leftmost merge."""
    rank = {p: r for r, p in enumerate(sorted(score, key=lambda p: -score[p]))}
    parts = [(i, ch) for i, ch in enumerate(word)]
    while True:
        open_ = []
        for k in range(len(parts) - 1):
            place, joined = parts[k][0], parts[k][1] + parts[k + 1][1]
            if joined in rank and mixed(mixed(key, place), rank[joined]) >> 32 >= limit:
                open_.append((rank[joined], place, k))
        if not open_:
            break
        k = min(open_)[2]
        parts[k : k + 2] = [(parts[k][0], parts[k][1] + parts[k + 1][1])]
    out = []
    for _, p in parts:
        out += [model.piece_to_id(p)] if p in score else [model.piece_to_id(f"<0x{b:02X}>") for b in p.encode()]
    return out


def test_ids_equal_a_scan_over_all_neighbours():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    score = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    }
    texts = ["the quick brown foxes are international", "straightforwardly  naïve 中文 é", "a" * 60, "1234567 x"]
    encoder = Encoder(load(PATH), 0.3, 21)
    got = encoder.encode(texts, [5, 6, 7, None], [0, 1, 2, 3])
    for text, doc, epoch, ids in zip(texts, [5, 6, 7, 0], [0, 1, 2, 3], got, strict=True):
        start = mixed(mixed(mixed(0, 21), doc), epoch)
        want = []
        for place, chunk in enumerate(_chunks(text)):
            want += brute_ids(model, score, chunk, mixed(start, place), encoder.below)
        assert ids.tolist() == want


def test_copies_of_a_row_differ_by_epoch(spark):
    text = " ".join(["international house of the quick brown foxes"] * 9)
    rows = [(1, text)] * 3 + [(2, text), (None, text), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.id, tuple(r.ids)) for r in encode_pieces(docs, PATH, copies=True).collect()]
    encoder = Encoder(load(PATH), 0.1, 17)
    want = [(1, 0), (1, 1), (1, 2), (2, 0), (None, 0)]
    ids = encoder.encode([text] * 5, [d for d, _ in want], [e for _, e in want])
    assert Counter(got) == Counter(
        [*((d, tuple(i.tolist())) for (d, _), i in zip(want, ids, strict=True)), (3, ()), (3, ())]
    )
    assert len({i for _, i in got}) == 6


def test_chunks_cut_from_bytes_are_those_of_the_pattern():
    texts = ["a b", None, "", " ", "  a  b ", "a\tb\n c", "é 中 文  \U0001f600", "▁x ▁ y", "b ", " b", "a" * 90 + " b"]
    for some in (pa.array(texts), pa.array(["z  ", *texts, "z"]).slice(1, len(texts)), pa.array([None, ""], pa.string())):
        spaced, which, sizes = pieces._cut(some)
        found = iter(pieces._marked(spaced[k]) for k in which)
        want = [_chunks(t) if t else [] for t in some.to_pylist()]
        assert [[next(found) for _ in range(n)] for n in sizes] == want
        assert next(found, None) is None and len(set(spaced)) == len(spaced)


def test_python_calls_do_not_grow_with_the_occurrences():
    def calls(text):
        encoder, seen = Encoder(load(PATH), 0.3, 5), []
        sys.setprofile(lambda frame, event, arg: seen.append(1) if event in ("call", "c_call") else None)
        try:
            encoder.encode([text], [1])
        finally:
            sys.setprofile(None)
        return len(seen)

    words = "the quick brown foxes are over lazy international dogs \U0001f600 "
    calls(words)
    assert calls(words * 550) - calls(words * 50) < 1_500


def test_remembered_chunks_take_little_memory():
    limit = 30_000
    letters = np.random.default_rng(3).integers(97, 123, (5, limit // 2, 7), np.uint8)
    texts = [" ".join(2 * words.view("S7").ravel().astype(str).tolist()) for words in letters]
    encoder = Encoder(load(PATH), 0.1, 17, limit)
    encoder.encode(["warm up"], [0])
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for text in texts:
        encoder.encode([text], [1])
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert limit // 2 <= len(encoder.plain) <= limit and held < 300 * limit
    # words that come once in a batch are not remembered
    n = len(encoder.plain)
    encoder.encode(["these words come just once"], [1])
    assert len(encoder.plain) == n
    # a text without spaces is not kept
    encoder.encode(["x" * 300_000 + " a" * 3], [1])
    assert pa.total_allocated_bytes() - before < 300 * limit
    assert all(len(c) <= 64 for c in encoder.plain) and len(encoder.forms[0]) == len(encoder.plain)
