"""The pipeline against plain stages: shingles of five words, a draw per epoch."""

from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from loomhouse.llm import neardup
from loomhouse.llm.pieces import Encoder, load
from loomhouse.llm.queries import MIX_SQL, QUALITY_SQL
from tests.compare import oracle_connection
from tests.llm.test_methods import families

SF = "/root/testdata/sf0.001"


def brute_low(rows, size):
    """Smallest id reachable over links of similarity 0.8 on ``size`` words."""
    sets = {}
    for i, text in rows:
        w = text.encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    pairs = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    low, before = {i: i for i in sets}, None
    while low != before:
        before = dict(low)
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return low


@pytest.mark.parametrize("chunked", [False, True])
def test_five_words_equal_brute_force(spark, monkeypatch, chunked):
    if chunked:  # every bucket and group in several tasks
        monkeypatch.setattr(neardup, "BUCKET_ROWS", 4)
        monkeypatch.setattr(neardup, "GROUP_SHINGLES", 200)
    rows = families()
    low = brute_low(rows, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component for r in neardup.near_duplicates(docs, shingle=5).collect()}
    assert got == low != brute_low(rows, 4)
    kept = corpus_pipeline.near_copies(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, least in low.items() if i == least)


def test_run_equals_plain_stages_by_the_rules(spark):
    con = oracle_connection(SF)
    con.execute("CREATE TABLE d AS SELECT * FROM documents")
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents AS SELECT * FROM d")
    con.execute(f"DELETE FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({QUALITY_SQL}) WHERE kept)")
    con.execute("DELETE FROM documents WHERE doc_id NOT IN (SELECT min(doc_id) FROM documents GROUP BY text)")
    low = brute_low(con.execute("SELECT doc_id, text FROM documents").fetchall(), 5)
    gone = [i for i, least in low.items() if i != least]
    con.execute(f"DELETE FROM documents WHERE doc_id IN ({', '.join(map(str, gone)) or -1})")
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    taken = con.execute(f"SELECT doc_id, epoch FROM ({MIX_SQL})").fetchall()
    encoder = Encoder(load(public_tokenizers.path("piece_bpe_32k.model")), 0.1, 17)
    want = Counter((i, tuple(encoder.encode([texts[i]], [i], [e])[0].tolist())) for i, e in taken)
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and len(taken) > len({i for i, _ in taken})
