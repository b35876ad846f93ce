"""Toxicity by FTRL-proximal logistic regression on hashed n-grams.

Features of a text are its distinct words, word pairs and skip pairs (one word
left out), hashed to 2^20 places. Words lose the punctuation around them.
FTRL-proximal keeps a sum of gradients and of their squares per feature, so
each coordinate has its own learning rate, and its L1 term leaves most weights
at zero: the model is the list of the others.

FTRL is an online method: one learner goes through the rows one after another.
It reads a bounded sample of the labelled rows (``sample_rows``), whose features
are made in parallel. Scoring reads all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomhouse.llm.common import (
    WordHash,
    as_bytes,
    hashed_words,
    mix,
    picked,
    small_batches,
)
from loomhouse.session import materialize

BITS = 20
PUNCTUATION = b".,;:!?\"'()[]{}"
BIAS = 0  # place of the constant feature


@dataclass(frozen=True)
class Ftrl:
    """Rates and penalties; ``l1`` sets how many weights stay zero."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.1
    epochs: int = 6
    sample_rows: int = 12_000


def features(
    texts: list[bytes | None], known: WordHash
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct features of each text, and their number."""
    words, counts = hashed_words(texts, known)
    owner = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
    kinds, owners = [words], [owner]
    for gap in (1, 2):
        same = owner[gap:] == owner[:-gap]
        kinds.append(mix(mix(words[:-gap], gap), words[gap:])[same])
        owners.append(owner[gap:][same])
    place = (np.concatenate(kinds) >> np.uint64(64 - BITS)).astype(np.int64)
    place[place == BIAS] = 1
    found = np.unique((np.concatenate(owners) << BITS) | place)
    sizes = np.bincount(found >> BITS, minlength=len(counts))
    return (found & ((1 << BITS) - 1)).astype(np.int32), sizes


def _feature_rows(batches):
    known = WordHash(PUNCTUATION)
    for batch in small_batches(batches, "text", 2_000_000):
        flat, sizes = features(as_bytes(batch["text"]), known)
        ends = np.cumsum(sizes)
        places = [flat[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["label"], pa.array(places, pa.binary())],
            names=["id", "label", "places"],
        )


def _weights(z: np.ndarray, n: np.ndarray, p: Ftrl) -> np.ndarray:
    shrunk = np.sign(z) * p.l1 - z
    return np.where(
        np.abs(z) <= p.l1, 0.0, shrunk / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)
    )


def _chance(margin):
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))


def _learn(p: Ftrl):
    """All epochs over the sample, each in an order of its own."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        rows = rows.sort_values("id", kind="stable")
        labels, places = rows["label"].to_numpy(), rows["places"].tolist()
        for epoch in range(p.epochs):
            for k in np.random.Generator(np.random.PCG64(epoch)).permutation(len(rows)):
                at = np.append(np.frombuffer(places[k], np.int32), BIAS)
                w = _weights(z[at], n[at], p)
                g = _chance(w.sum()) - labels[k]
                root = np.sqrt(n[at])
                z[at] += g - (np.sqrt(n[at] + g * g) - root) / p.alpha * w
                n[at] += g * g
        w = _weights(z, n, p)
        used = np.flatnonzero(w)
        return pd.DataFrame({"place": used, "weight": w[used]})

    return run


@dataclass(frozen=True)
class Model:
    """Places and weights that are not zero; at most 2^20 of them."""

    place: np.ndarray
    weight: np.ndarray


def train(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    params: Ftrl = Ftrl(),
) -> Model:
    """Fit on labelled rows for which ``may_learn`` (over ``id``) holds.

    An id labelled several times counts as toxic if one label says so; null
    labels and ids are left out. Without labelled rows all weights are zero.
    """
    marks = (
        picked(labels, id=id_col, label=label_col)
        .where("id is not null and label is not null")
        .where(may_learn)
        .groupBy("id")
        .agg(F.max("label").cast("double").alias("label"))
    )
    marks = materialize(marks, "toxic-labels")
    share = min(1.0, params.sample_rows / max(marks.count(), 1))
    # drawn among 2^40, so that a small share of very many rows is not none
    drawn = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 40)) < int(share * (1 << 40))
    # about sample_rows rows of 20 bytes
    rows = picked(docs, id=id_col, text=text_col).join(F.broadcast(marks.where(drawn)), "id")
    placed = materialize(
        rows.mapInArrow(_feature_rows, "id long, label double, places binary"), "toxic-sample"
    )
    # places are bounded by 2^20, so is what the driver gets
    model = (
        placed.withColumn("learner", F.lit(0))
        .groupBy("learner")
        .applyInPandas(_learn(params), "place long, weight double")
        .toPandas()
    )
    return Model(model["place"].to_numpy(), model["weight"].to_numpy())


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id`` and ``score`` of every row; null and empty texts get the bias alone.

    Ids are whole numbers, null ids are carried along, repeated rows are scored
    one by one. Other columns of ``docs`` are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.place, model.weight))

    def run(batches):
        weights = np.zeros(1 << BITS)
        place, weight = held.value
        weights[place] = weight
        known = WordHash(PUNCTUATION)
        for batch in small_batches(batches, "text", 2_000_000):
            flat, sizes = features(as_bytes(batch["text"]), known)
            sums = np.append(0.0, np.cumsum(weights[flat]))
            ends = np.cumsum(sizes)
            value = _chance(sums[ends] - sums[ends - sizes] + weights[BIAS])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(value)], names=["id", "score"]
            )

    return picked(docs, id=id_col, text=text_col).mapInArrow(run, "id long, score double")
