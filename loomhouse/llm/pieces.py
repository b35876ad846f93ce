"""SentencePiece segmentation with seeded merge-dropout.

The vocabulary and its merge order come from a model file; the merging is done
here, because each candidate merge has to be skipped or taken by a keyed hash.
Candidates wait in an agenda, best piece first and leftmost among equals. A
candidate that comes up is skipped when the hash of (seed, document, epoch,
chunk's place in the document, place, piece) falls below the dropout rate.
Without dropout the ids are those of the library.

Merges never cross the start of a word, because no piece of the vocabulary has
a space mark behind another character; chunks are therefore segmented alone.
Remembered is only how a chunk merges without dropout. As long as none of these
merges is skipped, an occurrence merges in the same way; all other occurrences
are segmented one by one. Every occurrence draws for itself, and every run
gives the same ids.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomhouse.llm.common import distinct_parts, mix, picked, small_batches, spans
from loomhouse.session import materialize

MARK = "▁"
_MASK = (1 << 64) - 1
# A lone surrogate: no text holds one, so it can stand for a text's own space mark.
_STAND_IN = "\ud800"
_SHORT, _ROWS, _NONE = 40, 6_000, 1 << 30
# Occurrences whose merges are drawn at once.
_DRAWS = 50_000
_TABLE, _SPREAD = 20, np.uint64(0x9E3779B97F4A7C15)
_CHUNK = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")


def skipped(key, place, rank, limit: int):
    """Whether the merge at ``place`` to the piece of ``rank`` is dropped."""
    return (mix(mix(key, place), rank) >> np.uint64(32)) < np.uint64(limit)


class _Parts(dict):
    """Numbers of pieces and characters; those without a piece come behind."""

    def __init__(self, ids: dict[str, int], size: int):
        super().__init__(ids)
        self.size, self.names = size, []

    def __missing__(self, char: str) -> int:
        number = self[char] = self.size + len(self.names)
        self.names.append(char)
        return number


class _Written(dict):
    """Ids of a final part: its piece, else its bytes.

    A space mark of the text itself would decode to a space; it is written in
    bytes.
    """

    def __init__(self, ids: dict[str, int], byte: dict[int, int]):
        super().__init__((p, (i,)) for p, i in ids.items())
        self.byte = byte

    def __missing__(self, part: str) -> tuple[int, ...]:
        raw = MARK if part == _STAND_IN else part
        return tuple(self.byte[b] for b in raw.encode())


class Pieces:
    """Ids, scores and byte pieces of a model file."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        plain = [
            i for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.id = {self.text[i]: i for i in plain}
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        if len(self.byte) != 256:
            raise ValueError("the model has no byte pieces, so it cannot encode every text")
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("the model has pieces across words")
        best_first = sorted(plain, key=lambda i: -model.get_score(i))
        self.rank = {self.text[i]: r for r, i in enumerate(best_first)}
        self.by_rank = np.array(best_first)
        self.size = size
        self.part = _Parts(self.id, size)
        # the number of a character by its code point, -1 where none is given yet
        self.code = np.full(0x110000, -1, np.int32)
        self.written = _Written(self.id, self.byte)
        self._hash_pairs()
        raw = [
            bytes([self.value[i]]) if i in self.value else t.replace(MARK, " ").encode()
            for i, t in enumerate(self.text)
        ]
        self.raw_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_sizes = np.fromiter(map(len, raw), np.int64, size)
        self.raw_starts = np.cumsum(self.raw_sizes) - self.raw_sizes

    def _hash_pairs(self) -> None:
        """Open-addressed table of all pairs of parts that make a piece."""
        made = {}
        for piece, rank in self.rank.items():
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                if (a in self.id or cut == 1) and (b in self.id or cut == len(piece) - 1):
                    made[(self.part[a] << 32) | self.part[b]] = rank
        keys = np.array(list(made), np.int64)
        slots = (keys.view(np.uint64) * _SPREAD) >> np.uint64(64 - _TABLE)
        self.table_key = np.full((1 << _TABLE) + 64, -1, np.int64)
        self.table_rank = np.full((1 << _TABLE) + 64, _NONE, np.int32)
        self.steps = 1
        for key, slot in zip(keys.tolist(), slots.tolist(), strict=True):
            step = 0
            while self.table_key[slot + step] != -1:
                step += 1
            self.table_key[slot + step], self.table_rank[slot + step] = key, made[key]
            self.steps = max(self.steps, step + 1)

    def segment(self, chunk: str, key: int, limit: int) -> bytes:
        """Ids of one chunk, as 32-bit bytes; a merge whose hash is below ``limit`` is skipped."""
        parts = list(chunk)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, str]] = []

        def propose(left: int) -> None:
            right = after[left]
            if right < n:
                joined = parts[left] + parts[right]
                best = self.rank.get(joined)
                if best is not None:
                    heapq.heappush(agenda, (best, left, joined))

        for i in range(n - 1):
            propose(i)
        while agenda:
            best, left, joined = heapq.heappop(agenda)
            right = after[left]
            if not parts[left] or right >= n or parts[left] + parts[right] != joined:
                continue
            if limit and skipped(np.uint64(key), np.uint64(left), np.uint64(best), limit):
                continue
            parts[left], parts[right] = joined, ""
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            propose(left)
            if before[left] >= 0:
                propose(before[left])
        ids = chain.from_iterable(map(self.written.__getitem__, filter(None, parts)))
        return np.fromiter(ids, "<i4").tobytes()

    def plain_all(
        self, chunks: list[str], joined: str | None = None
    ) -> list[tuple[bytes, bytes]]:
        """Ids of chunks without dropout, and their merges as 64-bit place and rank.

        The merges are in no order; those of a chunk above ``_SHORT`` are not listed.
        ``joined``: the chunks one after another, if those given have plain spaces.
        """
        ids, steps = self.plain_arrays(chunks, "".join(chunks) if joined is None else joined)
        return list(zip(ids.to_pylist(), steps.to_pylist(), strict=True))

    def plain_arrays(
        self, chunks: list[str], joined: str
    ) -> tuple[pa.LargeBinaryArray, pa.LargeBinaryArray]:
        """``plain_all`` in two arrays, without an object per chunk."""
        merges, every = [], np.arange(len(chunks))
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        flat, starts, counts = self.segment_all(
            joined, lengths, every, np.zeros(len(chunks), np.uint64), 0, merges
        )
        rows = np.concatenate([np.empty(0, np.int64), *[r for r, _ in merges]])
        done = np.concatenate([np.empty(0, np.int64), *[m for _, m in merges]])
        steps = done[np.argsort(rows)].astype("<u8")
        return (
            _as_binary(flat[spans(starts, counts)].astype("<i4"), counts),
            _as_binary(steps, np.bincount(rows, minlength=len(chunks))),
        )

    def segment_all(
        self,
        joined: str,
        lengths: np.ndarray,
        which: np.ndarray,
        keys: np.ndarray,
        limit: int,
        steps: list[tuple[np.ndarray, np.ndarray]] | None = None,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``segment`` of chunks by number, the agendas of equally long ones side by side.

        ``joined`` has all chunks one after another. Returns the ids of those in
        ``which``, and where those of each begin and how many they are. To ``steps``
        are added the merges of those up to ``_SHORT``, with their places in ``which``.
        """
        firsts, numbers = np.cumsum(lengths) - lengths, self._numbers(joined)
        starts, counts = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
        out, at = [np.empty(0, np.int32)], 0
        # lengths in 16 bits are sorted by their digits
        sizes = np.minimum(lengths[which], _SHORT + 1).astype(np.uint16)
        order = np.argsort(sizes, kind="stable")
        short = int(np.searchsorted(sizes[order], _SHORT, "right"))
        for lo in range(0, short, _ROWS):
            rows = order[lo : min(lo + _ROWS, short)]
            merges = None if steps is None else []
            names = which[rows]
            ids, n = self._merge(numbers, firsts[names], lengths[names], keys[rows], limit, merges)
            starts[rows], counts[rows] = at + np.cumsum(n) - n, n
            out.append(ids)
            at += len(ids)
            if steps is not None:
                steps += [(rows[r], done) for r, done in merges]
        for r in order[short:].tolist():
            first = firsts[which[r]]
            chunk = joined[first : first + lengths[which[r]]]
            ids = np.frombuffer(self.segment(chunk, int(keys[r]), limit), "<i4")
            starts[r], counts[r] = at, len(ids)
            out.append(ids)
            at += len(ids)
        return np.concatenate(out), starts, counts

    def _merge(self, numbers, firsts, lengths, keys, limit, merges=None):
        """Ids of chunks that begin at ``firsts`` of ``numbers``, and how many each has."""
        n, width = len(firsts), int(lengths.max())
        # a column without a part ends each row on both sides
        wide = width + 1
        column = np.arange(wide, dtype=np.int32)
        inside = column < lengths[:, None]
        part = np.full(n * wide, -1, np.int32)
        part[inside.ravel()] = numbers[(firsts[:, None] + column)[inside]]
        rank = np.full(n * wide, _NONE, np.int32)
        pairs = np.flatnonzero(part[1:] >= 0)
        pairs = pairs[part[pairs] >= 0]
        rank[pairs] = self._pair(part[pairs], part[pairs + 1])
        place = np.arange(n * wide, dtype=np.int32)
        after, before = place + 1, place - 1
        before[::wide] = place[width::wide]
        by_row = rank.reshape(n, wide)
        rows = np.arange(n)
        while len(rows):
            at = (by_row if len(rows) == n else by_row.take(rows, 0)).argmin(1)
            p = rows * wide + at
            best = rank.take(p)
            going = best < _NONE
            if not going.all():
                rows, at, p, best = rows[going], at[going], p[going], best[going]
            r = rows
            if limit:
                drop = skipped(keys.take(rows), at.astype(np.uint64), best.astype(np.uint64), limit)
                rank[p[drop]] = _NONE
                take = ~drop
                r, at, p, best = rows[take], at[take], p[take], best[take]
            if merges is not None:
                merges.append((r, (at << 32) | best))
            made = self.by_rank.take(best)
            j = after.take(p)
            k, h = after.take(j), before.take(p)
            part[p], part[j], rank[j] = made, -1, _NONE
            after[p], before[k] = k, p
            found = self._pair(
                np.concatenate([made, part.take(h)]), np.concatenate([part.take(k), made])
            )
            rank[p], rank[h] = found[: len(p)], found[len(p) :]
        kept = part >= 0
        flat, counts = part[kept], kept.reshape(n, wide).sum(1)
        return self._in_bytes(flat, counts) if (flat >= self.size).any() else (flat, counts)

    def _numbers(self, text: str) -> np.ndarray:
        """Part number of each character."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        found = self.code[points]
        if (found < 0).any():
            for point in np.unique(points[found < 0]).tolist():
                self.code[point] = self.part[chr(point)]
            found = self.code[points]
        return found

    def _in_bytes(self, flat: np.ndarray, counts: np.ndarray):
        """Ids and counts of rows of parts of which some are characters without a piece."""
        odd = flat >= self.size
        names, named = np.unique(flat[odd], return_inverse=True)
        raw = [self.written[self.part.names[p - self.size]] for p in names.tolist()]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        times = np.ones(len(flat), np.int64)
        times[odd] = sizes[named]
        out = np.repeat(flat, times)
        source = np.fromiter(chain.from_iterable(raw), np.int32)
        out[np.repeat(odd, times)] = source[spans((np.cumsum(sizes) - sizes)[named], sizes[named])]
        behind = np.append(0, np.cumsum(times))
        ends = np.cumsum(counts)
        return out, behind[ends] - behind[ends - counts]

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that two parts make, ``_NONE`` where there is none."""
        key = (left.astype(np.int64) << 32) | right
        slot = ((key.view(np.uint64) * _SPREAD) >> np.uint64(64 - _TABLE)).astype(np.int64)
        there = self.table_key[slot]
        same = there == key
        out = np.where(same, self.table_rank[slot], np.int32(_NONE))
        # on from a slot that another pair holds
        at = np.flatnonzero(~same & (there != -1))
        key, slot = key[at], slot[at]
        for step in range(1, self.steps):
            if not len(at):
                break
            there = self.table_key[slot + step]
            hit = there == key
            out[at[hit]] = self.table_rank[slot[hit] + step]
            on = ~hit & (there != -1)
            at, key, slot = at[on], key[on], slot[on]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``: space marks to spaces, without the first space."""
        return self.decode_all(np.asarray(ids, np.int64), np.array([len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids one after another, which end at ``ends``."""
        sizes = self.raw_sizes[ids]
        last = np.cumsum(sizes)
        # the place of each byte among the bytes of all pieces
        place = np.repeat(self.raw_starts[ids] - (last - sizes), sizes) + np.arange(sizes.sum())
        raw = self.raw_bytes[place].tobytes()
        cuts = np.append(0, last)[np.append(0, ends)].tolist()
        return [
            raw[lo:hi].decode(errors="replace").removeprefix(" ")
            for lo, hi in zip(cuts, cuts[1:], strict=False)
        ]


@lru_cache(2)
def load(model_path: str) -> Pieces:
    return Pieces(model_path)


def _as_binary(flat: np.ndarray, counts: np.ndarray) -> pa.LargeBinaryArray:
    """Rows of ``counts`` numbers each, as bytes."""
    ends = np.append(0, np.cumsum(counts)) * flat.itemsize
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(flat)]
    return pa.Array.from_buffers(pa.large_binary(), len(counts), buffers)


def _as_numbers(rows: pa.LargeBinaryArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows one after another, and how many each row has."""
    ends = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset :][: len(rows) + 1]
    flat = np.frombuffer(rows.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(kind)
    return flat, np.diff(ends) // flat.itemsize


def _chunks(text: str) -> list[str]:
    return _CHUNK.findall(MARK + _marked(text))


def _marked(text: str) -> str:
    return text.replace(MARK, _STAND_IN).replace(" ", MARK)


def _cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``_chunks`` of texts: the distinct ones with plain spaces, their numbers in order, chunks per text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    full = pc.greater(pc.binary_length(texts), 0)
    sizes = np.zeros(len(texts), np.int64)
    space, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    spaced = pc.binary_join_element_wise(space, texts.filter(full), none)
    if not len(spaced):
        return [], np.empty(0, np.int64), sizes
    ends = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset :][: len(spaced) + 1]
    raw = np.frombuffer(spaced.buffers()[2], np.uint8)[: ends[-1]]
    # a chunk starts with the first of some spaces
    first = raw == ord(" ")
    first[1:] &= raw[:-1] != ord(" ")
    first[ends[:-1]] = True
    starts = np.append(np.flatnonzero(first[ends[0] :]) + ends[0], ends[-1])
    sizes[full.to_numpy(zero_copy_only=False)] = np.diff(np.searchsorted(starts, ends))
    return *distinct_parts(starts, spaced.buffers()[2]), sizes


class Encoder:
    """Segments texts; the dropout-free merges of ``limit`` chunks, or of a batch's, are remembered.

    ``plain`` numbers the remembered chunks; their ids and merges lie in two arrays.
    A chunk is remembered when it comes twice in a batch; most that come once are rare.
    """

    def __init__(self, pieces: Pieces, dropout: float, seed: int, limit: int = 400_000):
        self.pieces, self.seed, self.limit = pieces, seed, limit
        self.below = int(dropout * (1 << 32))
        self.plain: dict[str, int] = {}
        self.forms = [pa.array([], pa.large_binary())] * 2

    def encode(
        self,
        texts: list[str | None],
        docs: list[int | None],
        epochs: list[int | None] | None = None,
    ) -> list[np.ndarray]:
        """Ids of each text; ``docs``, ``epochs`` and the places of chunks key the dropout."""
        return self.encode_counted(texts, docs, epochs)[0]

    def encode_counted(
        self,
        texts: list[str | None],
        docs: list[int | None],
        epochs: list[int | None] | None = None,
    ) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of each text, and how many it has without dropout."""
        ids, ends, plain = self.encode_flat(pa.array(texts, pa.string()), docs, epochs)
        return np.split(ids, ends[:-1]) if len(ends) else [], plain

    def encode_flat(
        self, texts: pa.Array, docs: list[int | None], epochs: list[int | None] | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts one after another, their ends, and how many each has without dropout."""
        spaced, which, sizes = _cut(texts)
        ids, steps = self._plain(spaced, np.bincount(which, minlength=len(spaced)))
        source, plain = _as_numbers(ids, "<i4")
        starts, counts = (np.cumsum(plain) - plain)[which], plain[which]
        ends = np.cumsum(sizes)
        so_far = np.append(0, np.cumsum(counts))
        n_plain = so_far[ends] - so_far[ends - sizes]
        if self.below:
            keys = self._keys(docs, epochs or [0] * len(docs), sizes)
            other = np.flatnonzero(self._differs(spaced, steps, which, keys))
            lengths = np.fromiter(map(len, spaced), np.int64, len(spaced))
            cut, at, n = self.pieces.segment_all(
                _marked("".join(spaced)), lengths, which[other], keys[other], self.below
            )
            starts[other], counts[other] = at + len(source), n
            source = np.concatenate([source, cut])
            so_far = np.append(0, np.cumsum(counts))
        return source[spans(starts, counts)], so_far[ends], n_plain

    def _plain(self, chunks: list[str], times: np.ndarray) -> list[pa.LargeBinaryArray]:
        """Ids and merges of distinct chunks without dropout; ``times``: how often each occurs."""
        at = np.fromiter(map(self.plain.get, chunks, repeat(-1)), np.int64, len(chunks))
        new, first = np.flatnonzero(at < 0), len(self.plain)
        left = [chunks[k] for k in new.tolist()]
        at[new] = first + np.arange(len(left))
        made = self.pieces.plain_arrays(left, _marked("".join(left)))
        forms = [pa.concat_arrays(both) for both in zip(self.forms, made, strict=True)]
        found = [f.take(pa.array(at)) for f in forms]
        again = times > 1
        if first + np.count_nonzero(again[new]) > self.limit:
            # those of this batch are carried over
            again[at < first] = True
            self.plain, first, left, forms, new = {}, 0, chunks, found, slice(None)
        keep = again[new] & (np.fromiter(map(len, left), np.int64, len(left)) <= 64)
        every = pa.array(np.append(np.ones(first, bool), keep))
        left, forms = list(compress(left, keep.tolist())), [f.filter(every) for f in forms]
        self.plain.update(zip(left, range(first, first + len(left)), strict=True))
        self.forms = forms
        return found

    def _keys(self, docs, epochs, sizes: np.ndarray) -> np.ndarray:
        """Key of each occurrence from seed, document, epoch and place in the document."""
        doc = np.array([(d or 0) & _MASK for d in docs], np.uint64)
        epoch = np.array([(e or 0) & _MASK for e in epochs], np.uint64)
        text = mix(mix(mix(np.zeros(len(doc), np.uint64), self.seed & _MASK), doc), epoch)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return mix(np.repeat(text, sizes), place)

    def _differs(self, chunks, steps, which: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether an occurrence skips any of the merges its chunk has without dropout."""
        merges, counts = _as_numbers(pa.array(steps, pa.large_binary()), "<u8")
        starts = np.cumsum(counts) - counts
        out = (np.fromiter(map(len, chunks), np.int64, len(chunks)) > _SHORT)[which]
        for lo in range(0, len(which), _DRAWS):
            part = which[lo : lo + _DRAWS]
            n = counts[part]
            row = np.repeat(np.arange(lo, lo + len(part)), n)
            first = np.repeat(starts[part] - (np.cumsum(n) - n), n)
            merge = merges[first + np.arange(len(row))]
            drop = skipped(keys[row], merge >> np.uint64(32), merge & np.uint64(0xFFFFFFFF), self.below)
            out[row[drop]] = True
        return out


@lru_cache(2)
def encoder_for(model_path: str, dropout: float, seed: int) -> Encoder:
    """The encoder of a worker process, so that its tasks share what it remembers."""
    return Encoder(load(model_path), dropout, seed)


def encode_pieces(
    docs: DataFrame,
    model_path: str,
    dropout: float = 0.1,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    copies: bool = False,
    counted: bool = False,
) -> DataFrame:
    """``id`` and ``ids`` of every row of ``docs``.

    ``model_path`` has to exist on every executor. Null and empty texts have no
    ids; a null id counts as 0 for the dropout; repeated rows are encoded
    alike, or with ``copies`` under an epoch of their own, from 0 on. With
    ``counted`` also ``n_plain``, the number of ids without dropout, and
    ``text_hash``, by which a decoded text is told to be the same. Other
    columns of ``docs`` are not read.
    """
    rows = picked(docs, id=id_col, text=text_col)
    if copies:
        numbered = rows.groupBy("id", "text").agg(F.count(F.lit(1)).alias("n"))
        rows = numbered.select(
            "id", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("epoch")
        )
    else:
        rows = rows.withColumn("epoch", F.lit(0).cast("long"))
    if counted:
        rows = rows.withColumn("text_hash", text_hash(F.col("text")))

    def run(batches):
        encoder = encoder_for(model_path, dropout, seed)
        for batch in small_batches(batches, "text", 2_000_000):
            names, epochs = batch["id"].to_pylist(), batch["epoch"].to_pylist()
            ids, ends, plain = encoder.encode_flat(batch["text"], names, epochs)
            found = {
                "id": batch["id"],
                "ids": pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids)),
            }
            if counted:
                found |= {"n_plain": pa.array(plain), "text_hash": batch["text_hash"]}
            yield pa.RecordBatch.from_pydict(found)

    schema = "id long, ids array<int>" + ", n_plain long, text_hash string" * counted
    return rows.mapInArrow(run, schema)


def text_hash(text: Column) -> Column:
    """128 bits of a text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def decode_pieces(encoded: DataFrame, model_path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id`` and ``text`` from ``id`` and ``ids``, and the columns to ``keep``.

    Null ids decode to an empty text.
    """
    kept = ["id", *keep]

    def run(batches):
        pieces = load(model_path)
        for batch in batches:
            # about 4 bytes of text per id
            for part in _slices(batch, "ids", 500_000):
                ids = part["ids"]
                sizes = pc.fill_null(pc.list_value_length(ids), 0)
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                texts = pieces.decode_all(flat, np.cumsum(sizes.to_numpy(zero_copy_only=False)))
                columns = [part[c] for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.string())], names=[*kept, "text"]
                )

    rows = encoded.select(*dict.fromkeys([*kept, "ids"]))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return rows.mapInArrow(run, f"{schema}, text string")


def _slices(batch: pa.RecordBatch, column: str, most: int):
    """Parts of a batch with about ``most`` list entries; one long list is a part of its own."""
    sizes = pc.fill_null(pc.list_value_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // most
    cuts = (np.flatnonzero(np.diff(part)) + 1).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def round_trip(
    docs: DataFrame,
    model_path: str,
    dropout: float = 0.1,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id``, ``ids``, ``n_plain``, ``lossless``.

    The ids are stored and the stored table is decoded. ``n_plain`` is the
    number of ids without dropout; ``lossless`` tells whether the decoded text
    is that of the row.
    """
    encoded = encode_pieces(docs, model_path, dropout, seed, id_col, text_col, counted=True)
    stored = materialize(encoded, "pieces")
    decoded = decode_pieces(stored, model_path, ("n_plain", "text_hash", "ids"))
    same = text_hash(F.col("text")) == F.col("text_hash")
    return decoded.select("id", "ids", "n_plain", same.alias("lossless"))
