"""Language-model scores by deleted interpolation of n-gram estimates.

The probability of a word is a mixture of maximum-likelihood estimates of all
orders and a uniform one. The mixture weights depend on how often the context
was seen (buckets of powers of two) and are learned by expectation-maximisation
on held-out counts: every training token is scored with itself taken out of the
counts, so all of the training text serves as held-out text of the rest.

Counting and looking up go together. Documents are dealt into blocks by hash.
A block sends each distinct n-gram once, as a sorted 64-bit key, to the shard
of the key; a shard adds up the counts of all blocks and answers each with the
totals of its keys. So a frequent n-gram costs one entry per block and no task
holds more than a shard or a block. Nothing is pruned or capped: every n-gram
of the training text counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomhouse.llm.common import WordHash, hashed_words, mix, picked
from loomhouse.session import materialize

END, BEGIN = np.uint64(1), np.uint64(2)  # hashes of the end and the begin mark
BUCKETS = 24
# Bytes of text in a block and n-gram entries in a shard, on average.
BLOCK_BYTES = 4_000_000
SHARD_BYTES = 8_000_000


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each followed by the end mark."""
    words, counts = hashed_words([(t or "").encode() for t in texts], WordHash())
    return np.insert(words, np.cumsum(counts), END), counts + 1


def _grams(tokens: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """Key of the n-gram that ends at each token, for each order from 1.

    In front of a text stand begin marks.
    """
    starts = np.cumsum(counts) - counts
    place = np.arange(len(tokens)) - np.repeat(starts, counts)
    keys, out = mix(tokens, 0), []
    out.append(keys)
    for k in range(1, order):
        back = np.full(len(tokens), BEGIN, np.uint64)
        inside = place >= k
        back[inside] = tokens[np.flatnonzero(inside) - k]
        keys = mix(keys, back)
        out.append(keys)
    return out


def _begin_keys(order: int) -> list[int]:
    """Keys of the contexts made of begin marks alone, for orders from 1."""
    out, key = [], mix(np.array([BEGIN]), 0)
    for _ in range(order - 1):
        out.append(int(key[0]))
        key = mix(key, BEGIN)
    return out


def _delta(keys: np.ndarray) -> bytes:
    """Sorted keys as byte planes of their differences, highest byte first."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = steps.astype(">u8").view(np.uint8).reshape(-1, 8).T
    used = int(np.argmax(planes.any(1))) if planes.any() else 7
    return bytes([used]) + np.ascontiguousarray(planes[used:]).tobytes()


def _undelta(raw: bytes) -> np.ndarray:
    used = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(8 - used, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, used:] = planes.T
    return np.cumsum(full.view(">u8").ravel().astype(np.uint64), dtype=np.uint64)


def _small(numbers: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, lowest byte first."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = 8 - int(np.argmax(planes[::-1].any(1))) if planes.any() else 1
    return bytes([used]) + np.ascontiguousarray(planes[:used]).tobytes()


def _unsmall(raw: bytes) -> np.ndarray:
    used = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(used, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :used] = planes.T
    return full.view("<u8").ravel().astype(np.int64)


def _block_keys(rows: pd.DataFrame, order: int):
    tokens, counts = _tokens(rows["text"].tolist())
    grams = _grams(tokens, counts, order)
    learned = np.repeat(~rows["held_out"].to_numpy(bool), counts)
    return tokens, counts, grams, learned


def _ask(order: int, shards: int):
    """A block's distinct keys with their training counts, by shard and order."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        block = rows["block"].iloc[0]
        _, counts, grams, learned = _block_keys(rows, order)
        trained = int((~rows["held_out"]).sum())
        out = []
        for n, keys in enumerate(grams, 1):
            found, at = np.unique(keys, return_inverse=True)
            seen = np.bincount(at, weights=learned, minlength=len(found)).astype(np.int64)
            shard = _shard_of(found, shards)
            edges = np.searchsorted(shard, np.arange(shards + 1))
            for s in range(shards):
                lo, hi = edges[s], edges[s + 1]
                if lo < hi:
                    out.append((s, n, block, _delta(found[lo:hi]), _small(seen[lo:hi])))
        # documents are the count of the begin mark
        out.append((0, 0, block, b"", _small(np.array([trained]))))
        return pd.DataFrame(out, columns=["shard", "n", "block", "keys", "counts"])

    return run


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the top bits, so that sorted keys have sorted shards."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Totals of a shard's keys for each block that asked; totals of the shard."""
    n = int(rows["n"].iloc[0])
    if n == 0:
        total = sum(int(_unsmall(c)[0]) for c in rows["counts"])
        return pd.DataFrame(
            {"shard": [0], "n": [0], "block": [None], "counts": [b""], "tokens": [total], "types": [0]}
        )
    asked = [_undelta(k) for k in rows["keys"]]
    keys, at = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(
        at, weights=np.concatenate([_unsmall(c) for c in rows["counts"]]), minlength=len(keys)
    ).astype(np.int64)
    ends = np.cumsum([len(a) for a in asked])
    answers = [_small(part) for part in np.split(total[at], ends[:-1])]
    return pd.DataFrame(
        {
            "shard": [*rows["shard"], int(rows["shard"].iloc[0])],
            "n": [*rows["n"], n],
            "block": [*rows["block"], None],
            "counts": [*answers, b""],
            "tokens": [*[0] * len(rows), int(total.sum())],
            "types": [*[0] * len(rows), int((total > 0).sum())],
        }
    )


def _read_answers(order: int, shards: int):
    """A block's documents with the counts of the n-grams at their tokens."""

    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        _, counts, grams, _ = _block_keys(docs, order)
        told = {(r.n, r.shard): r.counts for r in answers.itertuples()}
        ends = np.cumsum(counts)
        columns = {}
        for n, keys in enumerate(grams, 1):
            found, at = np.unique(keys, return_inverse=True)
            present = np.unique(_shard_of(found, shards))
            total = np.concatenate(
                [np.empty(0, np.int64), *[_unsmall(told[n, int(s)]) for s in present]]
            )[at]
            columns[f"c{n}"] = [_small(c) for c in np.split(total, ends[:-1])]
        return pd.DataFrame(
            {"id": docs["id"], "held_out": docs["held_out"], "counts": list(zip(*columns.values()))}
        )

    return run


def _estimates(c: list[np.ndarray], docs: int, total: int, types: int, out: int):
    """Estimates by order from 0 and bucket of each token of a text.

    ``c`` are the counts of the n-grams ending at each token; ``out`` is what
    the text's own token takes from every count: 1 while learning, else 0. The
    context of a token is the n-gram that ends one token before it.
    """
    size = len(c[0])
    p = [np.full(size, 1.0 / (types + 1)), (c[0] - out) / max(total - out, 1)]
    seen = np.zeros(size, np.int64)
    for n in range(1, len(c)):
        context = np.concatenate([[docs], c[n - 1][:-1]]) - out
        p.append(np.where(context > 0, (c[n] - out) / np.maximum(context, 1), 0.0))
        if n == 1:
            seen = context
    buckets = np.minimum(np.frexp(np.maximum(seen, 0).astype(float))[1], BUCKETS - 1)
    return np.stack(p), buckets


_GRID = 4  # cells per factor of two


def _cells(totals):
    """Training tokens by bucket and by cell of their estimates."""
    docs, total, types = totals

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            held = batch["held_out"].to_pylist()
            keys, weights = [], []
            for raw, out in zip(batch["counts"].to_pylist(), held, strict=True):
                if out:
                    continue
                p, bucket = _estimates([_unsmall(r) for r in raw], docs, total, types, 1)
                cell = np.full(p[1:].shape, -1, np.int64)
                some = p[1:] > 0
                cell[some] = np.round(-_GRID * np.log2(p[1:][some])).astype(np.int64)
                keys.append(np.vstack([bucket, cell]))
            if not keys:
                continue
            cells, weights = np.unique(np.concatenate(keys, 1), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cells[0]),
                    pa.array(cells[1:].T.tolist(), pa.list_(pa.int64())),
                    pa.array(weights),
                ],
                names=["bucket", "cell", "tokens"],
            )

    return run


def learn_weights(cells: list, types: int, order: int, rounds: int = 50) -> np.ndarray:
    """Mixture weights by bucket and order from 0, by EM on cells of tokens.

    A bucket without tokens takes the weights of all tokens together. The
    uniform estimate keeps at least 1e-6, so no text has probability zero.
    """

    def fit(rows) -> np.ndarray:
        p = np.array([[1.0 / (types + 1), *[2.0 ** (-c / _GRID) if c >= 0 else 0.0 for c in r[1]]] for r in rows])
        n = np.array([r[2] for r in rows], float)
        w = np.full(order + 1, 1.0 / (order + 1))
        for _ in range(rounds):
            part = w * p
            part /= part.sum(1, keepdims=True)
            w = (n[:, None] * part).sum(0) / n.sum()
        w = np.maximum(w, [1e-6, *[0.0] * order])
        return w / w.sum()

    every = fit(cells) if cells else np.eye(order + 1)[0]
    by_bucket = {b: [r for r in cells if r[0] == b] for b in {r[0] for r in cells}}
    return np.stack([fit(by_bucket[b]) if b in by_bucket else every for b in range(BUCKETS)])


def _scores(totals, weights: np.ndarray):
    docs, total, types = totals

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for raw in batch["counts"].to_pylist():
                c = [_unsmall(r) for r in raw]
                p, bucket = _estimates(c, docs, total, types, 0)
                w = weights[bucket].T
                if len(p) > 2:  # an unseen context says nothing: its weight goes down
                    unseen = bucket == 0
                    w = np.where(unseen & (np.arange(len(p)) > 1)[:, None], 0.0, w)
                    w = w / w.sum(0)
                base = np.log10((c[0] + 0.5) / (total + 0.5 * (types + 1)))
                rows.append(
                    (len(c[0]), int((c[0] > 0).sum()), base.sum(), np.log10((w * p).sum(0)).sum())
                )
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["held_out"],
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array([total] * batch.num_rows, pa.int64()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(columns[3], pa.float64()),
                ],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score_documents(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 2,
) -> DataFrame:
    """Score of every row, learning from those that are not ``held_out``.

    ``held_out`` is an expression over ``id``; a null one counts as false.
    Null and empty texts are the end mark alone. Ids are whole numbers, null
    ids are carried along, repeated rows count as often as they occur. Without
    training rows all estimates but the uniform one are zero. Other columns of
    ``docs`` are not read.

    ``base_score`` is the add-half unigram score, ``score`` the log10
    probability under the interpolated model of ``order``.
    """
    spark = docs.sparkSession
    rows = picked(docs, id=id_col, text=text_col).select(
        "id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    weight = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = 1 + int(weight) // BLOCK_BYTES
    shards = 1 + int(weight) * order // SHARD_BYTES
    dealt = rows.withColumn(
        "block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")
    )
    asked = dealt.groupBy("block").applyInPandas(
        _ask(order, shards), "shard int, n int, block int, keys binary, counts binary"
    )
    answers = materialize(
        asked.groupBy("shard", "n").applyInPandas(
            _answer, "shard int, n int, block int, counts binary, tokens long, types long"
        ),
        "lm-answers",
    )
    total = {
        r["n"]: (r["tokens"], r["types"])
        for r in answers.where("block is null")
        .groupBy("n")
        .agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"))
        .collect()
    }
    totals = (total.get(0, (0, 0))[0], *total.get(1, (0, 0)))
    told = answers.where("block is not null").select("shard", "n", "block", "counts")
    counted = materialize(
        dealt.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInPandas(
            _read_answers(order, shards), "id long, held_out boolean, counts array<binary>"
        ),
        "lm-counts",
    )
    cells = (
        counted.mapInArrow(_cells(totals), "bucket long, cell array<long>, tokens long")
        .groupBy("bucket", "cell")
        .agg(F.sum("tokens").alias("tokens"))
    )
    # cells are bounded by the grid: buckets times 4 per factor of two and order
    weights = learn_weights([tuple(r) for r in cells.collect()], totals[2], order)
    return counted.mapInArrow(
        _scores(totals, weights),
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double",
    )
