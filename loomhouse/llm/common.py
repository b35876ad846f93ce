"""Helpers shared by the text operators.

Words are runs of ``[^\\x20\\x09-\\x0D]``; ``bytes.split()`` cuts at exactly
these six characters and ``bytes.lower()`` changes A-Z alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
NOT_WORD = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_MUL = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def mix(h: np.ndarray, value: np.ndarray | int) -> np.ndarray:
    """Fold ``value`` into the 64-bit hashes ``h``."""
    out = np.multiply(h ^ np.asarray(value, np.uint64), _MUL)
    return out ^ (out >> _SHIFT)


class WordHash(dict):
    """Hash of a word, remembered; emptied when ``limit`` words are held."""

    def __init__(self, strip: bytes = b"", seed: int = 0, limit: int = 200_000):
        self.strip, self.seed, self.limit = strip, seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        bare = word.strip(self.strip) or word if self.strip else word
        h = self[word] = xxhash.xxh64_intdigest(bare, self.seed)
        return h


def hashed_words(
    texts: Iterable[bytes | None], known: WordHash
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words per text."""
    split = [(t or b"").lower().split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter(
        map(known.__getitem__, chain.from_iterable(split)), np.uint64, counts.sum()
    )
    return flat, counts


def small_batches(
    batches: Iterable[pa.RecordBatch], column: str, most: int = 6_000_000
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` has at most ``most`` bytes in each part.

    One text above the bound is a part of its own.
    """
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch[column]), 0)
        part = np.cumsum(size.to_numpy(zero_copy_only=False)) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if hi > lo:
                yield batch.slice(int(lo), int(hi - lo))


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of spans one after another."""
    out = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    out += np.arange(len(out))
    return out


def distinct_parts(starts: np.ndarray, data: pa.Buffer) -> tuple[list[str], np.ndarray]:
    """The distinct texts between neighbouring ``starts`` of ``data``, and the number of each part."""
    parts = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), data)
    coded = parts.dictionary_encode()
    texts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return texts, coded.indices.to_numpy().astype(np.int64)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def crc_fold(id_col: str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in columns.items()])
