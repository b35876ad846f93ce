"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct word shingles. One pass over the texts
hashes every shingle under each permutation once and keeps both the least and
the greatest value, so 224 permutations give 448 signature values: 64 bands of
seven. Two documents of similarity 0.8 share no band with probability 3e-7.

From bands to components, without ever listing the pairs of a group:

1. Equal shingle sets are one class, found by a 128-bit hash of the set; only
   its number and the text of its smallest id go on.
2. Members of a band bucket are compared by a sketch (low bytes of 128
   signature values). A bucket gives a spanning forest of the pairs whose
   sketches agree in 76 places or more (six deviations below 0.8), so at most
   one link per member. This drops documents that share only a passage. The
   links of all buckets are drawn in to one or a few per member.
3. Connected sketches make a candidate group. Inside it the full shingle sets
   are compared: a visited document is compared with all documents that no
   visited one has reached yet, and a spanning forest of the confirmed links
   is kept. Nothing is capped.
4. Confirmed links give the components.

Buckets and candidate groups above a weight bound are cut into chunks, and
every two chunks meet in one task, so no task holds an unbounded group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomhouse.llm.common import (
    WordHash,
    as_bytes,
    hashed_words,
    mix,
    picked,
    small_batches,
)
from loomhouse.llm.components import components
from loomhouse.operators.skew import ROWS_PER_TASK, salted_join
from loomhouse.session import fresh_folder, materialize

SHINGLE = 4
BANDS, ROWS = 64, 7
PERMUTATIONS = BANDS * ROWS // 2
SKETCH, SKETCH_LEAST = 128, 76
# Sketches and shingles that meet in one task at most, for groups in chunks.
BUCKET_ROWS = 20_000
GROUP_SHINGLES = 2_000_000
# Bytes of text signed at once, and of a row group when rows are numbered.
BATCH_BYTES, ROW_GROUP_BYTES = 1_000_000, 8 << 20

_SIGNATURE = "id long, n long, h1 long, h2 long, bands array<long>, sketch binary"
_NAMES = ["id", "n", "h1", "h2", "bands", "sketch"]


def shingles(
    texts: list[bytes | None], known: WordHash, size: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their number.

    A text of fewer words is one shingle, a text without words has none.
    """
    words, counts = hashed_words(texts, known)
    sets, start = [], 0
    for n in counts.tolist():
        w = words[start : start + n]
        start += n
        m = max(1, n - size + 1) if n else 0
        h = np.full(m, min(n, size), np.uint64)
        for k in range(min(n, size)):
            h = mix(h, w[k : k + m])
        sets.append(np.unique(h))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate([np.empty(0, np.uint64), *sets]), sizes


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20_240_229))
    draw = rng.integers(0, 1 << 63, (2, PERMUTATIONS)).astype(np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def min_max(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least values, then greatest values, of each permutation by document."""
    mul, add = _permutations()
    out = np.empty((2 * PERMUTATIONS, len(starts)), np.uint32)
    for k in range(PERMUTATIONS):
        h = (((flat ^ add[k]) * mul[k]) >> np.uint64(32)).astype(np.uint32)
        out[k] = np.minimum.reduceat(h, starts)
        out[PERMUTATIONS + k] = np.maximum.reduceat(h, starts)
    return out


def _signatures(batches, size: int):
    known = WordHash()
    for batch in small_batches(batches, "text", BATCH_BYTES):
        flat, sizes = shingles(as_bytes(batch["text"]), known, size)
        full = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[full]
        if len(starts):
            yield _signed(batch["id"].filter(pa.array(full)), flat, starts, sizes[full])
        empty = int((~full).sum())
        if empty:
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].filter(pa.array(~full)),
                    *[pa.array(np.zeros(empty, np.int64))] * 3,
                    pa.array([[]] * empty, pa.list_(pa.int64())),
                    pa.array([b""] * empty, pa.binary()),
                ],
                names=_NAMES,
            )


def _set_hashes(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set; no set is empty."""
    return (
        np.add.reduceat(mix(flat, 1), starts).view(np.int64),
        np.bitwise_xor.reduceat(mix(flat, 2), starts).view(np.int64),
    )


def _signed(ids, flat, starts, sizes) -> pa.RecordBatch:
    values = min_max(flat, starts)
    keys = np.empty((len(ids), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(ids), b, np.uint64)
        for r in range(ROWS):
            h = mix(h, values[b * ROWS + r])
        keys[:, b] = h
    half = SKETCH // 2
    sketch = np.concatenate(
        [values[:half], values[PERMUTATIONS : PERMUTATIONS + half]]
    ).astype(np.uint8)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(sizes),
            *map(pa.array, _set_hashes(flat, starts)),
            pa.ListArray.from_arrays(
                np.arange(0, keys.size + 1, BANDS, dtype=np.int32),
                keys.view(np.int64).ravel(),
            ),
            pa.array([s.tobytes() for s in np.ascontiguousarray(sketch.T)], pa.binary()),
        ],
        names=_NAMES,
    )


def meet(df: DataFrame, group: str, chunks: DataFrame) -> DataFrame:
    """Rows with the tasks ``(group, i, j)`` in which they meet the others.

    ``chunks(group, chunks)`` says into how many chunks a group is cut. A group
    of one chunk is one task; else each pair of chunks is one.
    """
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: k != F.col("_own"))
    tasks = F.when(
        F.col("chunks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    ).otherwise(
        F.transform(
            others,
            lambda k: F.struct(
                F.least(k, F.col("_own")).alias("i"), F.greatest(k, F.col("_own")).alias("j")
            ),
        )
    )
    return (
        df.join(chunks, group)
        .withColumn("_own", own)
        .withColumn("_task", F.explode(tasks))
        .select(*df.columns, "_task.i", "_task.j")
    )


def _agreeing(ids: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the sketches that agree in enough places, from the first of each component."""
    links, rest, queue = [], np.arange(len(ids)), []
    while len(rest):
        if not queue:
            root, rest = rest[0], rest[1:]
            queue = [root]
            continue
        x = queue.pop()
        near = (sketches[rest] == sketches[x]).sum(1) >= SKETCH_LEAST
        links += [(ids[root], ids[y]) for y in rest[near]]
        queue += rest[near].tolist()
        rest = rest[~near]
    return links


def _bucket_links(batches):
    """Links inside the buckets of a partition that is sorted by bucket and id; ``a < b``."""
    held: list[pa.RecordBatch] = []

    def links(table: pa.Table) -> pa.RecordBatch:
        ids = table["id"].to_numpy()
        sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8)
        sketches = sketches.reshape(-1, SKETCH)
        starts = np.flatnonzero(_new_task(table))
        sizes = np.diff([*starts, len(ids)])
        first = np.repeat(starts, sizes)
        near = (sketches == sketches[first]).sum(1) >= SKETCH_LEAST
        near[starts] = False
        apart = np.flatnonzero(np.add.reduceat(near, starts, dtype=np.int64) < sizes - 1)
        apart = apart[sizes[apart] > 2]
        done = near & ~np.repeat(np.isin(np.arange(len(starts)), apart), sizes)
        a, b = [ids[first[done]]], [ids[done]]
        for g in apart:
            span = slice(starts[g], starts[g] + sizes[g])
            if more := _agreeing(ids[span], sketches[span]):
                more = np.array(more, np.int64)
                a.append(more[:, 0])
                b.append(more[:, 1])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(np.flatnonzero(_new_task(batch))[-1])
        held.append(batch)
        table = pa.Table.from_batches(held)
        cut = table.num_rows - batch.num_rows + last
        if cut and _same_task(table, cut):
            continue  # the whole batch belongs to the task before it
        if cut:
            yield links(table.slice(0, cut).combine_chunks())
        held = table.slice(cut).to_batches()
    if held:
        yield links(pa.Table.from_batches(held).combine_chunks())


def _task_columns(table) -> list[np.ndarray]:
    return [np.asarray(table[c]) for c in ("key", "i", "j")]


def _new_task(table) -> np.ndarray:
    """True at the first row of each task."""
    out = np.zeros(table.num_rows, bool)
    out[:1] = True
    for c in _task_columns(table):
        out[1:] |= c[1:] != c[:-1]
    return out


def _same_task(table, row: int) -> bool:
    return all(table[c][row] == table[c][row - 1] for c in ("key", "i", "j"))


def confirmed_links(
    flat: np.ndarray, sizes: np.ndarray, percent: int = 80
) -> list[tuple[int, int]]:
    """Spanning forest of the documents with ``100*common >= percent*union``.

    ``flat`` holds the sets one after another. Every document is compared with
    all documents not reached before it, among those whose size allows a link.
    """
    _, dense = np.unique(flat, return_inverse=True)
    ends = np.cumsum(sizes)
    sets = [dense[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    mark = np.zeros(len(flat), np.uint8)
    rest = np.argsort(sizes, kind="stable")
    lengths, offsets, joined = _layout(sets, sizes, rest)
    links, queue = [], []
    while len(rest):
        if not queue:
            queue = [int(rest[0])]
            rest, lengths, offsets = rest[1:], lengths[1:], offsets[1:]
            continue
        x = queue.pop()
        size = int(sizes[x])
        lo = np.searchsorted(100 * lengths, percent * size)
        hi = np.searchsorted(percent * lengths, 100 * size, "right")
        if lo >= hi:
            continue
        mark[sets[x]] = 1
        end = offsets[hi - 1] + lengths[hi - 1]
        seen = mark[joined[offsets[lo] : end]]
        common = np.add.reduceat(seen, offsets[lo:hi] - offsets[lo], dtype=np.int64)
        mark[sets[x]] = 0
        union = size + lengths[lo:hi] - common
        near = np.zeros(len(rest), bool)
        near[lo:hi] = 100 * common >= percent * union
        if near.any():
            links += [(x, int(y)) for y in rest[near]]
            queue += rest[near].tolist()
            rest = rest[~near]
            lengths, offsets, joined = _layout(sets, sizes, rest)
    return links


def _layout(sets, sizes, rest):
    lengths = sizes[rest]
    joined = np.concatenate([np.empty(0, np.int64), *[sets[r] for r in rest]])
    return lengths, np.cumsum(lengths) - lengths, joined


def _group_links(table: pa.Table, size: int) -> pa.Table:
    """Links between the classes of a task; a text that is not its class's is left out."""
    flat, sizes = shingles(as_bytes(table["text"].combine_chunks()), WordHash(), size)
    starts = np.cumsum(sizes) - sizes
    ids = table["id"].to_numpy()
    h1, h2 = _set_hashes(flat, starts)
    own = (h1 == table["h1"].to_numpy()) & (h2 == table["h2"].to_numpy())
    _, first = np.unique(np.where(own, ids, -1), return_index=True)
    rows = first[own[first]]
    if len(rows) < len(ids):
        parts = [flat[starts[r] : starts[r] + sizes[r]] for r in rows.tolist()]
        flat, sizes, ids = np.concatenate([flat[:0], *parts]), sizes[rows], ids[rows]
    found = np.array(confirmed_links(flat, sizes), np.int64).reshape(-1, 2)
    return pa.table({"a": ids[found[:, 0]], "b": ids[found[:, 1]]})


def _chunks(weights: DataFrame, group: str, most: int) -> DataFrame:
    """``(group, chunks)``: one chunk up to ``most``, else chunks of half of it."""
    return weights.select(
        group,
        F.when(F.col("weight") <= most, 1)
        .otherwise(F.ceil(F.col("weight") * 2 / most))
        .cast("int")
        .alias("chunks"),
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``id``, ``n_shingles``, ``component``, ``kept`` of every row of ``docs``.

    ``shingle`` is the number of words of a shingle.
    ``component`` is the smallest id reachable over links of similarity 0.8 or
    more; the row whose id it is, is kept. Null and empty texts and texts of
    white space have no shingles and are linked with nothing. Rows with a null
    id are linked with nothing either; they are kept and their component is
    null. What is linked are shingle sets, not ids: rows that repeat an id are
    judged one by one, each by its own text; those that repeat the smallest id
    of their component are all kept. Other columns of ``docs`` are not read.
    Shingles are compared by 64-bit hashes.
    """

    def sign(batches):
        return _signatures(batches, shingle)

    def link(table: pa.Table) -> pa.Table:
        return _group_links(table, shingle)

    rows = picked(docs, id=id_col, text=text_col)
    signed = materialize(rows.mapInArrow(sign, _SIGNATURE), "minmax")
    judged = F.col("id").isNotNull() & (F.col("n") > 0)
    # a class is known by a number of its own; stored, so it keeps it
    classes = materialize(
        signed.where(judged)
        .groupBy("h1", "h2")
        .agg(F.min("id").alias("least"), *[F.first(c).alias(c) for c in ("n", "bands", "sketch")])
        .withColumn("id", F.monotonically_increasing_id()),
        "minmax-classes",
    )
    groups = components(_similar(classes)).join(classes.select("id", "n", "h1", "h2", "least"), "id")
    groups = materialize(groups, "minmax-groups")
    weights = groups.groupBy("label").agg(F.sum("n").alias("weight"))
    # a shuffle at every size: groups grow with the documents
    texts = rows.withColumnRenamed("id", "least").hint("merge")
    links = (
        meet(groups, "label", _chunks(weights, "label", GROUP_SHINGLES))
        .join(texts, "least")
        .groupBy("label", "i", "j")
        .applyInArrow(link, "a long, b long")
    )
    linked = materialize(
        components(links).join(classes.select("id", "least"), "id"), "minmax-linked"
    )
    named = linked.groupBy("label").agg(F.min("least").alias("component"))
    hubs = linked.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).where(
        F.col("rows") > ROWS_PER_TASK
    )
    hubs = hubs.select("label", F.ceil(F.col("rows") / ROWS_PER_TASK).cast("int").alias("_salts"))
    of_class = salted_join(linked, named, ["label"], hot=hubs).select("id", "component")
    by_set = (
        classes.select("h1", "h2", "id", "least")
        .join(of_class, "id", "left")
        .select("h1", "h2", F.coalesce("component", "least").alias("component"))
    )
    found = signed.where(judged).select("id", "n", "h1", "h2").join(by_set, ["h1", "h2"])
    alone = signed.where(~judged).select("id", "n", F.col("id").alias("component"))
    return (
        found.select("id", "n", "component")
        .union(alone)
        .select(
            "id",
            F.col("n").alias("n_shingles"),
            "component",
            F.col("id").eqNullSafe(F.col("component")).alias("kept"),
        )
    )


def _similar(classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all classes that may be near duplicates."""
    spark = classes.sparkSession
    banded = classes.select("id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("weight")).where("weight > 1")
    members = meet(banded, "key", _chunks(shared, "key", BUCKET_ROWS))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _drawn_in(
        members.join(classes.select("id", "sketch"), "id")
        .select("id", "sketch", "key", "i", "j")
        .repartition(parts, "key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "id")
        .mapInArrow(_bucket_links, "a long, b long")
    )


def _drawn_in(links: DataFrame) -> DataFrame:
    """Fewer links that connect the same ids; ``a < b`` in ``links``.

    Buckets of one group have different first members, so an id has up to a link
    for each of its buckets. It keeps the link to the least of them; the others
    are linked to that one, which many ids say alike. An id has no more links
    here than buckets and chunks, so no task holds more of it.
    """
    least = F.min("a").over(Window.partitionBy("b"))
    other = F.when(F.col("a") == F.col("_least"), F.col("b")).otherwise(F.col("a"))
    return (
        links.repartition("b")
        .distinct()
        .withColumn("_least", least)
        .select(F.col("_least").alias("a"), other.alias("b"))
        .distinct()
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """One whole row of ``docs`` for each near-duplicate component.

    The row with the smallest id stays; null ids stay only where the component
    has no other, and of rows that agree in the id the first stored one. Rows are told apart by a
    number of their own, so rows that repeat an id are judged one by one. Texts
    without words are near no other and stay. Columns may have any name.
    """
    row = "row_number"
    while row in docs.columns:
        row += "_"
    spark, folder = docs.sparkSession, fresh_folder(docs.sparkSession, "near-rows")
    # whole texts are written: small row groups keep the writers small
    counted = docs.withColumn(row, F.monotonically_increasing_id())
    counted.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)
    numbered = spark.read.schema(counted.schema).parquet(folder)
    ids = picked(numbered, id=row, given=id_col)
    found = near_duplicates(numbered, row, text_col, shingle).select("id", "component")
    named = materialize(found.join(ids, "id"), "near-named")
    several = materialize(
        named.groupBy("component")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(F.struct(F.col("given").isNull().alias("none"), "given", "id")).alias("best"),
        )
        .where("rows > 1")
        .select("component", "rows", F.col("best.id").alias("stays")),
        "near-several",
    )
    hot = several.where(F.col("rows") > ROWS_PER_TASK).select(
        "component", F.ceil(F.col("rows") / ROWS_PER_TASK).cast("int").alias("_salts")
    )
    gone = (
        salted_join(named, several.drop("rows"), ["component"], hot=hot, spread=["id"])
        .where("id <> stays")
        .select(F.col("id").alias(row))
    )
    return numbered.join(materialize(gone, "near-gone"), row, "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
