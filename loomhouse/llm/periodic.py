"""Periodic runs of words, found in the grammar of a text.

A run is a stretch of words with a smallest period ``q``: words ``q`` apart are
equal, the stretch has at least ``least`` words and at least three periods, and
no neighbouring word continues it.

1. Re-Pair: the most frequent pair of neighbouring symbols becomes a
   nonterminal, until no pair occurs twice. Pairs of equal frequency wait in
   line, so a long copy is halved, not eaten from one end. The remaining start
   sequence is split into a balanced tree.
2. A run lies in a lowest node of that derivation, where it crosses the border
   between the two parts. Each nonterminal is searched once, at its first place:
   a run that crosses a border has a window of ``least / 3`` words that begins or
   ends there and comes back one period further. The pairs of such windows are
   extended to both sides inside the node by ranks of windows of 1, 2, 4 ... words.
3. What a nonterminal holds is carried to all places where it is derived.
4. Pieces inside a longer stretch of the same period are parts of it and go;
   of periods with equal stretches the smallest stays.

A text in which no such window comes back has no run; its grammar would have no
border to search. This is told for all texts of a batch at once, so only the
others are compressed. Memory is that of a batch, or of one long text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomhouse.llm.common import as_bytes, mix, picked, small_batches

LEAST, TIMES = 24, 3


def repair(words: list[int], first: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Rules of the nonterminals ``first``, ``first + 1``, ..., and the start sequence."""
    n = len(words)
    held = list(words)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, pair in enumerate(zip(words, words[1:], strict=False)):
        places[pair].append(i)
    waiting: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for pair, at in places.items():
        if len(at) > 1:
            waiting[len(at)].append(pair)

    def still(pair: tuple[int, int]) -> list[int]:
        """Places where the pair stands now, none inside another."""
        left, right = pair
        out, taken = [], -1
        for p in places[pair]:
            q = after[p]
            if p != taken and held[p] == left and q < n and held[q] == right:
                out.append(p)
                taken = q
        return out

    rules: list[tuple[int, int]] = []
    for count in range(max(waiting, default=1), 1, -1):
        line = waiting.get(count, [])
        for pair in line:  # grows while it is read
            at = still(pair)
            if len(at) < count:
                if len(at) > 1:
                    places[pair] = at
                    waiting[len(at)].append(pair)
                continue
            new = first + len(rules)
            rules.append(pair)
            fresh: dict[tuple[int, int], list[int]] = defaultdict(list)
            for p in at:
                q = after[p]
                held[p], held[q] = new, -1
                behind = after[p] = after[q]
                if behind < n:
                    before[behind] = p
                    fresh[new, held[behind]].append(p)
                if before[p] >= 0:
                    fresh[held[before[p]], new].append(before[p])
            for made, found in fresh.items():
                if len(found) > 1:
                    places[made] = found
                    (line if len(found) == count else waiting[len(found)]).append(made)
    return rules, [s for s in held if s >= 0]


def _halves(starts: list[int], least: int) -> list[tuple[int, int, int]]:
    """Begin, border and end of the nodes of a balanced tree over a start sequence."""
    out, todo = [], [(0, len(starts) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a > 1 and starts[b] - starts[a] >= least:
            k = (a + b) // 2
            out.append((starts[a], starts[k], starts[b]))
            todo += [(a, k), (k, b)]
    return out


class _Ranks:
    """Numbers of the windows of 1, 2, 4, ... words of a text; equal windows agree."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
        while True:
            last, half = self.ranks[-1], 1 << (len(self.ranks) - 1)
            if len(last) <= half:
                break
            most = int(last.max()) + 1
            if most == len(last):
                break  # all apart already
            self.ranks.append(
                np.unique(last[:-half] * most + last[half:], return_inverse=True)[1].astype(np.int64)
            )

    def extended(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words before and from ``i`` and ``j`` on, ``i < j``."""
        back, on = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, width = self.ranks[k], 1 << k
            a, b = i + on, j + on
            fits = b < len(rank)
            fits[fits] = rank[a[fits]] == rank[b[fits]]
            on[fits] += width
            a, b = i - back - width, j - back - width
            fits = a >= 0
            fits[fits] = rank[a[fits]] == rank[b[fits]]
            back[fits] += width
        return back, on


def _crossing(ranks: _Ranks, nodes: np.ndarray, least: int, level: int):
    """Stretches across the borders of ``nodes``: node, begin, end and period."""
    window, width = ranks.ranks[level], 1 << level
    span = ranks.n + 1
    order = np.argsort(window, kind="stable")
    sorted_ = window[order] * span + order
    found = []
    for shift in (0, width):
        lo, at, hi = nodes[:, 0], nodes[:, 1] - shift, nodes[:, 2]
        inside = np.flatnonzero((at >= lo) & (at + width <= hi))
        key = window[at[inside]] * span
        left = np.searchsorted(sorted_, key + lo[inside])
        right = np.searchsorted(sorted_, key + hi[inside] - width, "right")
        many = right - left
        node = np.repeat(inside, many)
        begin = np.repeat(left - (np.cumsum(many) - many), many)
        other = order[begin + np.arange(len(node))]
        here = at[node]
        near = (other != here) & (TIMES * np.abs(other - here) <= hi[node] - lo[node])
        found.append((node[near], np.minimum(other, here)[near], np.maximum(other, here)[near]))
    node, i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    back, on = ranks.extended(i, j)
    begin = i - np.minimum(back, i - nodes[node, 0])
    end = j + np.minimum(on, nodes[node, 2] - j)
    period = j - i
    long = end - begin >= np.maximum(least, TIMES * period)
    return node[long], begin[long], end[long], period[long]


def _smallest(*columns: np.ndarray) -> np.ndarray:
    """Rows with the smallest last column among those that agree in the others."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns[:-1]:
        new[1:] |= c[order][1:] != c[order][:-1]
    return order[new]


def runs_of(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """``start``, ``length``, ``period`` of all runs of a text, by start, then period."""
    none = np.empty((0, 3), np.int64)
    level = (least // TIMES).bit_length() - 1
    ranks = _Ranks(words)
    if len(words) < least or len(ranks.ranks) <= level:
        return none
    first = len(ranks.ranks[0])
    rules, start = repair(ranks.ranks[0].tolist(), first)
    size = [1] * first
    for left, right in rules:
        size.append(size[left] + size[right])
    cuts = np.cumsum([0, *(size[s] for s in start)]).tolist()
    places: dict[int, list[int]] = defaultdict(list)
    for s, at in zip(start, cuts, strict=False):
        if size[s] >= least:
            places[s].append(at)
    owners, nodes = [], []
    for new in range(first + len(rules) - 1, first - 1, -1):
        if size[new] < least:
            continue
        left, right = rules[new - first]
        for part, shift in ((left, 0), (right, size[left])):
            if size[part] >= least:
                places[part] += [p + shift for p in places[new]]
        lo = places[new][0]
        owners.append(new)
        nodes.append((lo, lo + size[left], lo + size[new]))
    nodes += _halves(cuts, least)
    if not nodes:
        return none
    nodes = np.array(nodes, np.int64)
    node, begin, end, period = _crossing(ranks, nodes, least, level)
    chosen = _smallest(node, begin, end, period)
    node, begin, end, period = node[chosen], begin[chosen], end[chosen], period[chosen]
    # what a nonterminal holds, at all its places; a node of the tree has one
    where = [
        np.array(places[owners[k]]) - nodes[k, 0] if k < len(owners) else np.zeros(1, np.int64)
        for k in node.tolist()
    ]
    many = np.fromiter(map(len, where), np.int64, len(where))
    shift = np.concatenate([np.empty(0, np.int64), *where])
    begin, end = np.repeat(begin, many) + shift, np.repeat(end, many) + shift
    period = np.repeat(period, many)
    chosen = _smallest(begin, end, period)
    begin, end, period = begin[chosen], end[chosen], period[chosen]
    order = np.lexsort((-end, begin, period))
    reach = period[order] * (len(words) + 1) + end[order]
    whole = np.ones(len(order), bool)
    whole[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    kept = order[whole]
    kept = kept[np.lexsort((period[kept], begin[kept]))]
    return np.stack([begin, end - begin, period], 1)[kept]


def _recurring(words: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Whether a window of ``width`` words comes back in its text, for each text."""
    text = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
    starts = np.flatnonzero(left >= width)
    h = mix(text[starts].astype(np.uint64), 7)
    for k in range(width):
        h = mix(h, words[starts + k])
    order = np.argsort(h)
    again = np.flatnonzero(h[order][1:] == h[order][:-1])
    out = np.zeros(len(counts), bool)
    out[text[starts[order[again]]]] = True
    return out


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    reordered: Callable[[int, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """``id``, ``n_words``, ``runs`` and ``collapsed`` of every row of ``docs``.

    ``runs`` has start, length and period in words, by start and period.
    ``collapsed`` is the text without the repetitions: of each run the first
    period stays, kept words are joined by one space. ``reordered`` may give,
    for an id and a number of words, the word to take for each place. Null and
    empty texts and texts of white space have no words and no runs; a null id
    is carried along and not given to ``reordered``; repeated rows are judged
    one by one. Words are compared exactly. Other columns are not read.
    """
    width = 1 << ((least // TIMES).bit_length() - 1)

    def run(batches):
        for batch in small_batches(batches, "text", 2_000_000):
            ids = batch["id"].to_pylist()
            texts = [(t or b"").split() for t in as_bytes(batch["text"])]
            if reordered is not None:
                for k, (i, words) in enumerate(zip(ids, texts, strict=True)):
                    take = reordered(i, len(words)) if i is not None and words else None
                    if take is not None:
                        texts[k] = list(map(words.__getitem__, take.tolist()))
            number = {w: k for k, w in enumerate(set(chain.from_iterable(texts)))}
            counts = np.fromiter(map(len, texts), np.int64, len(texts))
            flat = np.fromiter(
                map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(counts.sum())
            )
            recurs = _recurring(flat.astype(np.uint64), counts, width)
            ends = np.cumsum(counts)
            runs, kept = [], []
            for k, words in enumerate(texts):
                found = runs_of(flat[ends[k] - counts[k] : ends[k]], least) if recurs[k] else ()
                if len(found):
                    stays = np.ones(len(words), bool)
                    for begin, length, period in found.tolist():
                        stays[begin + period : begin + length] = False
                    words = [words[x] for x in np.flatnonzero(stays).tolist()]
                runs.append(found)
                kept.append(b" ".join(words))
            sizes = np.cumsum([0, *map(len, runs)])
            rows = np.concatenate([np.empty((0, 3), np.int64), *[r for r in runs if len(r)]])
            spans = pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in rows.T], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), spans),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["id", "n_words", "runs", "collapsed"],
            )

    schema = (
        "id long, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    return picked(docs, id=id_col, text=text_col).mapInArrow(run, schema)
