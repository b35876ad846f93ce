"""Token ids in files of Simple-8b words.

A 64-bit word has a 4-bit selector on top and up to 60 bits of values: 60 ids
of one bit, 30 of two, and so on to one of sixty. Selector 0 is the escape:
the next word holds one plain 64-bit value. Words are grouped in blocks; a
block keeps the position of each document and of each run of words, so any
block is decoded alone, all words of one selector at a time.

A file is one range of document ids: a header, blocks, the table of blocks and
a footer. How many files there are follows from the bytes of the texts. Tasks
write block by block to the shared folder under a name of their own and move the
file into place. The reader takes the tables first and deals ranges of blocks
over tasks, so neither side ever holds a file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomhouse.llm.common import distinct_parts, picked, small_batches, spans
from loomhouse.session import fresh_folder

# fixed values: ids per word and bits per id by selector, 0 is the escape
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8BTOK01"
BLOCK_IDS = 1 << 16
# Bytes of text per file, and blocks that one read takes.
FILE_BYTES = 1 << 29
BLOCKS_AT_ONCE = 32

_FOUR = np.uint64(60)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value, 1 for zero."""
    high = (values >> np.uint64(32)).astype(np.uint32)
    # doubles hold 32-bit numbers exactly
    out = np.frexp(values.astype(np.uint32).astype(np.float64))[1].astype(np.int8)
    if high.any():
        above = np.frexp(high.astype(np.float64))[1].astype(np.int8)
        out = np.where(high > 0, above + np.int8(32), out)
    return np.maximum(out, np.int8(1))


def _followed(behind: np.ndarray) -> np.ndarray:
    """The places from 0 on, each ``behind`` the one before, as long as there are any.

    Doubled steps lead from place to place 64 at a time; those between follow from them.
    """
    n = len(behind)
    steps = [np.append(behind, np.int32(n))]
    for _ in range(6):
        steps.append(steps[-1][steps[-1]])
    far, at, places = steps.pop().tolist(), 0, []
    while at < n:
        places.append(at)
        at = far[at]
    places = np.array(places, np.int32)
    for step in reversed(steps):
        places = np.stack([places, step[places]], 1).ravel()
    return places[places < n].astype(np.int64)


def pack(values: np.ndarray) -> np.ndarray:
    """Simple-8b words of unsigned 64-bit values.

    The best selector of every position is found for all positions at once
    from sliding maxima of the widths; then the positions where words start
    are followed from the first to the last.
    """
    n = len(values)
    if not n:
        return np.empty(0, np.uint64)
    values = values.astype(np.uint64)
    widths = _widths(values)
    best = np.where(widths <= 60, np.int8(len(COUNTS) - 1), np.int8(0))
    span, high = 1, widths
    for s in range(len(COUNTS) - 2, 0, -1):
        count = int(COUNTS[s])
        if count > n:
            break
        # widest of `count` values from each position on
        while span < count:
            step = min(span, count - span)
            high = np.maximum(high[: len(high) - step], high[step:])
            span += step
        fits = high <= BITS[s]
        if not fits.any():
            break
        best[: len(fits)][fits] = s
    starts = _followed(np.minimum(np.arange(n) + COUNTS[best], n).astype(np.int32))
    chosen = best[starts].astype(np.int64)
    words = chosen.astype(np.uint64) << _FOUR
    for s in range(1, len(COUNTS)):
        here = np.flatnonzero(chosen == s)
        for k in range(int(COUNTS[s]) if len(here) else 0):
            words[here] |= values[starts[here] + k] << np.uint64(k * int(BITS[s]))
    escaped = np.flatnonzero(chosen == 0)
    return np.insert(words, escaped + 1, values[starts[escaped]]) if len(escaped) else words


def unpack(words: np.ndarray) -> np.ndarray:
    """The values of Simple-8b words."""
    selectors = (words >> _FOUR).astype(np.int64)
    plain = np.zeros(len(words), bool)
    if (selectors == 0).any():
        # a word behind an escape is a value, whatever its top bits say
        at = 0
        zeros = np.flatnonzero(selectors == 0).tolist()
        for z in zeros:
            if z >= at:
                plain[z + 1] = True
                at = z + 2
    counts = np.where(plain, 1, np.where(selectors == 0, 0, COUNTS[selectors % len(COUNTS)]))
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    begins = ends - counts
    out[begins[plain]] = words[plain]
    for s in range(1, len(COUNTS)):
        here = np.flatnonzero((selectors == s) & ~plain)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s]) if len(here) else 0):
            out[begins[here] + k] = (words[here] >> np.uint64(k * int(BITS[s]))) & mask
    return out


def write_block(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> bytes:
    """A block: its counts, the documents with their ends, the words."""
    words = pack(ids)
    null = np.array([d is None for d in doc_ids], np.uint8)
    named = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join(
        [
            struct.pack("<QQQ", len(ids), len(named), len(words)),
            named.tobytes(),
            null.tobytes(),
            ends.astype("<u8").tobytes(),
            words.astype("<u8").tobytes(),
        ]
    )


def read_block(raw: memoryview) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """Ids, document ids and the end of each document in the block."""
    n, docs, words = struct.unpack_from("<QQQ", raw)
    at = 24
    named = np.frombuffer(raw, "<i8", docs, at).tolist()
    null = np.frombuffer(raw, np.uint8, docs, at := at + 8 * docs).tolist()
    ends = np.frombuffer(raw, "<u8", docs, at := at + docs).astype(np.int64)
    ids = unpack(np.frombuffer(raw, "<u8", words, at + 8 * docs))
    if len(ids) != n:
        raise ValueError("block is damaged")
    return ids, [None if x else d for d, x in zip(named, null, strict=True)], ends


class FileWriter:
    """Writes header, blocks, table and footer to an open file.

    The table has a row per block and one behind the last: its offset, the ids
    and the documents before it.
    """

    def __init__(self, out):
        self.out, self.at, self.ids, self.docs = out, len(MAGIC), 0, 0
        self.table: list[tuple[int, int, int]] = []
        out.write(MAGIC)

    def add(self, ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> None:
        self.table.append((self.at, self.ids, self.docs))
        raw = write_block(ids, doc_ids, ends)
        self.out.write(raw)
        self.at += len(raw)
        self.ids += len(ids)
        self.docs += len(doc_ids)

    def close(self) -> None:
        rows = np.array([*self.table, (self.at, self.ids, self.docs)], "<u8")
        self.out.write(rows.tobytes())
        self.out.write(struct.pack("<QQ", self.ids, len(self.table)) + MAGIC)


def read_table(file, size: int) -> np.ndarray:
    """The table of blocks of an open file of ``size`` bytes."""
    file.seek(0)
    head = file.read(len(MAGIC))
    file.seek(size - 24)
    foot = file.read(24)
    if head != MAGIC or foot[-8:] != MAGIC:
        raise ValueError("not a token file")
    _, count = struct.unpack_from("<QQ", foot)
    file.seek(size - 24 - 24 * (count + 1))
    return np.frombuffer(file.read(24 * (count + 1)), "<u8").reshape(-1, 3).astype(np.int64)


# Token ids of texts.

# A space in front of a character that is not white space always starts a
# token of the byte-level pattern, and so does a sign behind a letter; texts can
# be cut there. A byte by which white space outside of ASCII may begin is left alone.
_LETTER, _SIGN, _BLANK = (np.zeros(256, bool) for _ in range(3))
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN[[b for b in range(33, 127) if not (chr(b).isalnum() or chr(b) in "'_")]] = True
_BLANK[[*range(33), 0xC2, 0xE1, 0xE2, 0xE3]] = True
# Latin letters and what follows them, each of which is one token of the pattern.
_LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([^\w\s']*)")


def _byte_chars() -> dict[int, str]:
    """The characters that stand for bytes in byte-level pieces, by byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class BpeEncoder:
    """Ids of the tokenizers library, with frequent words remembered.

    Texts are cut where a space precedes a word and where a sign follows a letter;
    the parts of a batch are told apart and counted over their bytes. Words of
    letters go to the library's merges directly, others through all of it. A text
    that holds a special token is encoded as a whole.
    """

    def __init__(self, path: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.words = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # words apart never hold a special token; a row of them must not form one
        self.words.encode_special_tokens = True
        # they are remembered here; the model's own cache only costs time
        self.words.model._resize_cache(0)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit
        # bytes of each id: a character of a byte-level piece stands for one byte
        self.lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for piece, i in self.tokenizer.get_vocab().items():
            self.lengths[i] = len(piece)
        self.chars = _byte_chars()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str | None], end: bytes = b"") -> list[np.ndarray]:
        """Ids of each text, ``end`` behind them."""
        ids, ends = self.encode_flat(pa.array(texts, pa.string()), end)
        return np.split(ids, ends[:-1]) if len(ends) else []

    def encode_flat(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, ``end`` behind each, and where those of each end."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.zeros(len(texts), bool)
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(whole)
        parts, which, sizes = _cut(texts)
        known = self._known(parts)
        if len(whole):
            # a text with a special token is one part of its own
            kept = np.ones(len(sizes), bool)
            kept[whole] = False
            which = which[np.repeat(kept, sizes)]
            sizes[whole] = 0
            at = np.cumsum(sizes)[whole]
            which = np.insert(which, at, len(known) + np.arange(len(whole)))
            sizes[whole] = 1
            known += self._each(texts.take(whole).to_pylist())
        if end:
            which = np.insert(which, np.cumsum(sizes), len(known))
            sizes = sizes + 1
            known.append(end)
        counts = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = (np.cumsum(counts) - counts)[which]
        counts = counts[which]
        flat = np.frombuffer(b"".join(known), "<u4")[spans(starts, counts)]
        return flat, np.append(0, np.cumsum(counts))[np.cumsum(sizes)]

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, from those remembered or made now."""
        found = list(map(self.known.get, parts))
        missing = [i for i, f in enumerate(found) if f is None]
        if missing:
            new = [parts[i] for i in missing]
            if len(self.known) + len(new) > self.limit:
                self.known, self.older = {}, self.known
            for i, part, ids in zip(missing, new, self._look_up(new), strict=True):
                found[i] = ids
                if len(part) <= 64:
                    self.known[part] = ids
        return found

    def _look_up(self, new: list[str]) -> list[bytes]:
        """Ids of distinct parts that are not known."""
        ids = list(map(self.older.get, new)) if self.older else [None] * len(new)
        letters, tailed, bare, rest = [], [], [], []
        for i, part in enumerate(new):
            if ids[i] is not None:
                continue
            word = part[1:]
            if part[:1] != " " or not word or word[0].isspace():
                bare.append(i)
            elif word.isascii() and word.isalpha():
                letters.append(i)
            elif (found := _LETTERS.fullmatch(word)) is None:
                rest.append(i)
            else:
                tailed.append((i, *found.groups()))
        merged = self._merged([new[i][1:] for i in letters] + [base for _, base, _ in tailed])
        for i, made in zip(letters, merged, strict=False):
            ids[i] = made
        for (i, _, tail), made in zip(tailed, merged[len(letters) :], strict=True):
            ids[i] = made + self._tail(tail) if tail else made
        for i, made in zip(rest, self._apart([new[i][1:] for i in rest]), strict=True):
            ids[i] = made
        found = self.words.encode_batch_fast([new[i] for i in bare], add_special_tokens=False)
        for i, made in zip(bare, found, strict=True):
            ids[i] = np.array(made.ids, "<u4").tobytes()
        return ids

    def _merged(self, letters: list[str]) -> list[bytes]:
        """Ids of words of letters behind a space."""
        tokenize = self.words.model.tokenize
        space, flat, ends = self.chars[32], [], []
        for word in letters:
            if not word.isascii():  # letters of ASCII stand for themselves
                word = word.encode().decode("latin-1").translate(self.chars)
            flat += [token.id for token in tokenize(space + word)]
            ends.append(4 * len(flat))
        ids = np.array(flat, "<u4").tobytes()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {"": b""}
            self.tails[tail] = self._ids([tail]).tobytes()
        return self.tails[tail]

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def _ids(self, texts: list[str]) -> np.ndarray:
        found = self.words.encode_batch_fast(texts, add_special_tokens=False)
        return np.fromiter(chain.from_iterable(f.ids for f in found), "<u4")

    def _apart(self, words: list[str], at_once: int = 2_000) -> list[bytes]:
        """Ids of words behind a space: encoded in a row, told apart by their bytes."""
        rows = [
            " " + " ".join(words[i : i + at_once]) for i in range(0, len(words), at_once)
        ]
        ids = self._ids(rows)
        ends = np.cumsum(self.lengths[ids])
        sizes = np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words))
        cuts = (np.searchsorted(ends, np.cumsum(sizes)) + 1) * 4
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist(), strict=False)]


def _cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct parts of texts, their numbers in order, and how many parts each text has."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    if not len(texts) or ends[0] == ends[-1]:
        return [], np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    first = np.zeros(len(raw), bool)
    first[:-1] = (raw[:-1] == ord(" ")) & ~_BLANK[raw[1:]]
    first[1:] |= _LETTER[raw[:-1]] & _SIGN[raw[1:]]
    cuts = ends - ends[0]
    # the end of a text is no place in front of a word
    last = cuts[1:][np.diff(cuts) > 0] - 1
    first[last[raw[last] == ord(" ")]] = False
    first[cuts[:-1][np.diff(cuts) > 0]] = True
    starts = np.append(np.flatnonzero(first), len(raw))
    sizes = np.diff(np.searchsorted(starts, cuts))
    return *distinct_parts(starts + ends[0], texts.buffers()[2]), sizes


@lru_cache(1)
def encoder_for(path: str) -> BpeEncoder:
    """The encoder of a worker process, so that its tasks share what it remembers."""
    return BpeEncoder(path)


def _place(uri: str):
    """File system and path of a folder name as Spark writes it."""
    return fs.FileSystem.from_uri(uri if "://" in uri else re.sub(r"^(file:)?/+", "file:///", uri))


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: int | None = None,
) -> DataFrame:
    """Writes the ids of all texts in ascending id order; ``file``, ``n_ids``.

    The folder is one that all executors reach, ``tokenizer_path`` a file that
    each of them has. Each range of ids becomes one file named by its place:
    ``files`` of them, or one per ``FILE_BYTES`` bytes of text and at least the
    shuffle partitions. A task that runs again writes the same file again. Null
    ids come first, null and empty texts are the end id alone, repeated rows
    stay, equal ids are in the order of their texts. The result is what was
    written; files appear when it is computed.
    """
    rows = picked(docs, id=id_col, text=text_col)
    if files is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        files = max(least, size // FILE_BYTES + 1)
    end = struct.pack("<I", end_id)

    def run(batches):
        system, base = _place(folder)
        part = TaskContext.get().partitionId()
        encoder = encoder_for(tokenizer_path)
        out = writer = draft = None
        ids, names, held = [], [], 0

        def add() -> None:
            writer.add(np.concatenate(ids), names, np.cumsum([len(i) for i in ids]))

        for batch in small_batches(batches, "text", 6_000_000):
            if out is None:
                system.create_dir(base, recursive=True)
                draft = f"{base}/.{part:06d}-{uuid.uuid4().hex}"
                out = system.open_output_stream(draft)
                writer = FileWriter(out)
            flat, ends = encoder.encode_flat(batch["text"], end)
            found = np.split(flat, ends[:-1])
            for name, i in zip(batch["id"].to_pylist(), found, strict=True):
                ids.append(i)
                names.append(name)
                held += len(i)
                if held >= BLOCK_IDS:
                    add()
                    ids, names, held = [], [], 0
        if out is not None:
            if names:
                add()
            writer.close()
            out.close()
            system.move(draft, f"{base}/{part:06d}.s8b")
            yield pa.RecordBatch.from_pydict({"file": [part], "n_ids": [writer.ids]})

    return (
        rows.repartitionByRange(files, F.col("id").asc_nulls_first())
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
        .mapInArrow(run, "file long, n_ids long")
    )


_RANGE = "path string, file long, cuts array<long>, start long, place long"


def _block_ranges(batches):
    """Ranges of blocks of files: their cuts, and the ids and documents before them."""
    for batch in batches:
        for path, size in zip(batch["path"].to_pylist(), batch["length"].to_pylist(), strict=True):
            system, place = _place(path)
            with system.open_input_file(place) as file:
                table = read_table(file, size)
            firsts = range(0, len(table) - 1, BLOCKS_AT_ONCE)
            number = int(re.search(r"(\d+)\.s8b$", path)[1])
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "path": path,
                        "file": number,
                        "cuts": table[k : k + BLOCKS_AT_ONCE + 1, 0].tolist(),
                        "start": int(table[k, 1]),
                        "place": int(table[k, 2]),
                    }
                    for k in firsts
                ],
                schema=pa.schema(
                    [("path", pa.string()), ("file", pa.int64()), ("cuts", pa.list_(pa.int64())),
                     ("start", pa.int64()), ("place", pa.int64())]
                ),
            )


def read_tokens(spark, folder: str) -> DataFrame:
    """``file``, ``place``, ``id``, ``start``, ``n_ids``, ``crc32`` of each document.

    ``start`` counts from the begin of the file. A task reads block by block.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.s8b")
        .load(folder)
        .select("path", "length")
    )
    ranges = files.mapInArrow(_block_ranges, _RANGE)
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(ranges.count(), most))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, at = _place(row["path"])
                start, place, cuts = row["start"], row["place"], row["cuts"]
                with system.open_input_file(at) as file:
                    for lo, hi in zip(cuts, cuts[1:], strict=False):
                        file.seek(lo)
                        ids, names, ends = read_block(memoryview(file.read(hi - lo)))
                        begins = np.concatenate([[0], ends[:-1]])
                        plain = memoryview(ids.astype("<u4")).cast("B")
                        yield pa.RecordBatch.from_pydict(
                            {
                                "file": [row["file"]] * len(names),
                                "place": list(range(place, place + len(names))),
                                "id": pa.array(names, pa.int64()),
                                "start": start + begins,
                                "n_ids": ends - begins,
                                "crc32": [
                                    zlib.crc32(plain[4 * b : 4 * e])
                                    for b, e in zip(begins.tolist(), ends.tolist(), strict=True)
                                ],
                            }
                        )
                        start += len(ids)
                        place += len(names)

    return ranges.repartition(tasks, "path", "start").mapInArrow(
        run, "file long, place long, id long, start long, n_ids long, crc32 long"
    )


def token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: int | None = None,
) -> DataFrame:
    """Writes the files, reads them back: ``id``, ``start``, ``n_ids``, ``crc32``.

    ``start`` is the number of ids of all documents before it. Only one number
    per file is summed up in one task. Nulls, ties and repeated rows as in
    ``write_tokens``; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "tokens")
    system, base = _place(folder)
    system.create_dir(base, recursive=True)
    sizes = spark.createDataFrame(
        write_tokens(docs, tokenizer_path, folder, end_id, id_col, text_col, files).toArrow()
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    return (
        read_tokens(spark, folder)
        .join(F.broadcast(offsets), "file")
        .select("id", (F.col("start") + F.col("offset")).alias("start"), "n_ids", "crc32")
    )
