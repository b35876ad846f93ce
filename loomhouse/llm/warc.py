"""WARC archives: one gzip member per record, read back by byte ranges.

Rows with equal payloads of at least ``LEAST_BYTES`` bytes are told by their
SHA-256: the one with the smallest id is written as ``response``, the others as
``revisit``, whose block is the HTTP header alone. Files appear in the shared
folder under a name of their own and are moved into place, so a task that runs
again writes the same file again.

The reader is splittable: files are cut into byte ranges, and a task looks for
gzip magic in its range. A candidate counts only if it inflates to the first
line of a WARC record; chance hits inside compressed data do not. A task owns
the records that start inside its range and reads the last one beyond the end
of it. After a record the next one is expected at once, so the scan resumes
only at the begin of a range or behind a damaged member. (Payloads that hold whole
WARC members in stored, uncompressed blocks could be taken for records there;
text that is compressed, as here, cannot.)
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomhouse.llm.common import picked, small_batches
from loomhouse.llm.simple8b import _place
from loomhouse.operators.skew import ROWS_PER_TASK, salted_join
from loomhouse.session import fresh_folder, materialize

LEAST_BYTES = 100
SPLIT_BYTES = 64 << 20
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAME = "urn:x-page:"
_BLOCK = 1 << 20
_AT = "1970-01-01T00:00:00Z"


def record_roles(
    pages: DataFrame, least_bytes: int = LEAST_BYTES, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``pages(id, url, payload)`` with ``digest`` and ``refers_to``.

    Sizes and least ids of equal payloads are aggregated before the shuffle.
    Only those with several rows are joined back, copies of a very frequent
    payload over several tasks.
    """
    # never null, so the join has no rows without a key to set apart
    hashed = pages.withColumn("digest", F.coalesce(F.sha2(F.col("payload"), 256), F.lit("")))
    sized = hashed.where(F.octet_length("payload") >= least_bytes)
    equal = materialize(
        sized.groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1"),
        "warc-equal",
    )
    hot = equal.where(F.col("rows") > rows_per_task).select(
        "digest", F.ceil(F.col("rows") / rows_per_task).cast("int").alias("_salts")
    )
    known = salted_join(hashed, equal.drop("rows"), ["digest"], "left", hot=hot, spread=["id"])
    later = F.col("id") != F.col("first")
    return known.select(
        "id", "url", "payload", "digest", F.when(later, F.col("first")).alias("refers_to")
    )


def _uri(number: int | None) -> str:
    return f"<{_NAME}{'' if number is None else number}>"


def record(number: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record with its HTTP header; a revisit has no payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    again = refers_to is not None
    block = http if again else http + payload
    # no line break may end a header early
    target = "".join((url or "").splitlines())
    lines = [
        f"WARC-Type: {'revisit' if again else 'response'}",
        f"WARC-Record-ID: {_uri(number)}",
        f"WARC-Date: {_AT}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {PROFILE}"] if again else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    head = "".join(f"{line}\r\n" for line in lines).encode()
    return b"".join([VERSION, head, b"\r\n", block, b"\r\n\r\n"])


def info_record(name: str) -> bytes:
    block = b"software: loomhouse\r\nformat: WARC File Format 1.1\r\n"
    head = (
        f"WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>\r\n"
        f"WARC-Date: {_AT}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\n"
        f"Content-Length: {len(block)}\r\n\r\n"
    ).encode()
    return b"".join([VERSION, head, block, b"\r\n\r\n"])


def member(raw: bytes, level: int = 6) -> bytes:
    """A gzip member; equal input gives equal bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages(id, url, payload, digest, refers_to)``; ``file``, ``records``, ``bytes``.

    Each partition becomes one file, written record by record. The files appear
    when the result is computed.
    """

    def run(batches):
        system, base = _place(folder)
        name = f"{TaskContext.get().partitionId():06d}.warc.gz"
        out, draft, records, size = None, f"{base}/.{name}-{uuid.uuid4().hex}", 0, 0
        for batch in small_batches(batches, "payload", 4_000_000):
            if out is None:
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(draft)
                size += out.write(member(info_record(name)))
            for row in zip(*[batch[c].to_pylist() for c in _WRITTEN], strict=True):
                size += out.write(member(record(*row)))
                records += 1
        if out is not None:
            out.close()
            system.move(draft, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [records], "bytes": [size]})

    return pages.select(*_WRITTEN).mapInArrow(run, "file string, records long, bytes long")


_WRITTEN = ["id", "url", "payload", "digest", "refers_to"]


class _Window:
    """Bytes of a file from a moving place on."""

    def __init__(self, file, size: int):
        self.file, self.size, self.lo, self.held = file, size, 0, b""

    def at(self, offset: int, most: int = _BLOCK) -> bytes:
        """Up to ``most`` bytes at ``offset``, read ahead in blocks."""
        have = self.lo + len(self.held)
        want = min(offset + most, self.size)
        if not self.lo <= offset <= have or want > have:
            self.file.seek(offset)
            self.lo, self.held = offset, self.file.read(min(max(most, _BLOCK), self.size - offset))
        begin = offset - self.lo
        return self.held[begin : begin + most]


def _starts_record(window: _Window, offset: int) -> bool:
    """Whether the bytes at ``offset`` are a member that begins a record."""
    begin = window.at(offset, 4096)
    if not begin.startswith(MAGIC):
        return False
    try:
        return zlib.decompressobj(31).decompress(begin, len(VERSION)).startswith(b"WARC/")
    except zlib.error:
        return False


def _inflate(window: _Window, offset: int) -> tuple[bytes, int]:
    """The content of the member at ``offset`` and where it ends."""
    unpack, parts, at = zlib.decompressobj(31), [], offset
    while not unpack.eof:
        raw = window.at(at, 1 << 16)
        if not raw:
            raise zlib.error("member is cut off")
        parts.append(unpack.decompress(raw))
        at += len(raw) - len(unpack.unused_data)
    return b"".join(parts), at


def _next_magic(window: _Window, offset: int, stop: int) -> int:
    """The next gzip magic that starts before ``stop``, else ``stop``."""
    while offset < stop:
        raw = window.at(offset, min(_BLOCK, stop - offset + len(MAGIC) - 1))
        hit = raw.find(MAGIC)
        if 0 <= hit and offset + hit < stop:
            return offset + hit
        offset += max(len(raw) - len(MAGIC) + 1, 1)
    return stop


def scan_range(file, size: int, lo: int, hi: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each record that starts in ``[lo, hi)``."""
    window, at = _Window(file, size), lo
    while at < hi:
        if _starts_record(window, at):
            try:
                raw, end = _inflate(window, at)
            except zlib.error:
                at += 1  # damaged: look for the next one behind it
                continue
            yield at, raw
            at = end
        else:
            at = _next_magic(window, at + (at > lo or window.at(at, 3) == MAGIC), hi)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and the block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return headers, rest[: int(headers.get("content-length") or 0)]


def _number(uri: str | None) -> int | None:
    text = (uri or "").strip("<>").removeprefix(_NAME)
    return int(text) if text else None


_READ = (
    "id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, intact boolean, payload binary, file string, offset long"
)


def _read_row(raw: bytes) -> dict | None:
    headers, block = parse(raw)
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    _, _, told = http.decode("latin-1").lower().partition("content-length:")
    length = int(told.split("\r\n")[0])
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    again = kind == "revisit"
    return {
        "id": _number(headers.get("warc-record-id")),
        "url": headers.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": _number(headers.get("warc-refers-to")),
        "intact": again
        or (len(payload) == length and hashlib.sha256(payload).hexdigest() == digest),
        "payload": None if again else payload,
    }


def splits(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path``, ``size``, ``lo``, ``hi``: the byte ranges of all archives of a folder."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.warc.gz")
        .load(folder)
        .select("path", F.col("length").alias("size"))
        .where("size > 0")
    )
    ranges = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))
    return files.withColumn("lo", F.explode(ranges)).withColumn(
        "hi", F.least(F.col("lo") + split_bytes, F.col("size"))
    )


def read_archives(
    spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, payloads: bool = True
) -> DataFrame:
    """Every response and revisit record of the archives of a folder.

    ``intact`` tells whether length and digest of a response's payload are those
    of its header; ``payload`` is null for revisits, and throughout without
    ``payloads``. Ranges are dealt over tasks one by one, by path and place.
    """
    ranges = splits(spark, folder, split_bytes)
    count = ranges.count()
    tasks = max(1, min(count, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4))
    schema = _READ if payloads else _READ.replace("payload binary, ", "")

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=_arrow(payloads))

    def run(batches):
        for held in batches:
            for path, size, lo, hi in zip(
                *[held[c].to_pylist() for c in ("path", "size", "lo", "hi")], strict=True
            ):
                system, place = _place(path)
                rows, weight = [], 0
                with system.open_input_file(place) as file:
                    for offset, raw in scan_range(file, size, lo, hi):
                        row = _read_row(raw)
                        if row is None:
                            continue
                        if not payloads:
                            del row["payload"]
                        rows.append(row | {"file": path, "offset": offset})
                        weight += len(raw) if payloads else 300
                        if weight > 4_000_000:
                            yield batch(rows)
                            rows, weight = [], 0
                if rows:
                    yield batch(rows)

    return ranges.repartition(tasks, "path", "lo").mapInArrow(run, schema)


def _arrow(payloads: bool) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.strip().split() for f in _READ.split(",")]
    return pa.schema([(n, kinds[k]) for n, k in fields if payloads or n != "payload"])


def archive_pages(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    folder: str | None = None,
    split_bytes: int = SPLIT_BYTES,
    payloads: bool = False,
) -> DataFrame:
    """Writes every row as a record and reads the archives back.

    Null payloads are empty; those under ``LEAST_BYTES`` bytes are all
    responses. A null id is carried along, never referred to, and its record is
    a response. Rows that repeat id and payload are all responses if theirs is
    the smallest id, else all revisits. A null url is read back as empty, line
    breaks in urls are left out. An empty table gives no records. Other
    columns of ``pages`` are not read.
    """
    spark = pages.sparkSession
    folder = folder or fresh_folder(spark, "warc")
    system, base = _place(folder)
    system.create_dir(base, recursive=True)
    rows = picked(pages, id=id_col, url=url_col, text=text_col).select(
        "id", "url", F.coalesce("text", F.lit("")).cast("binary").alias("payload")
    )
    write_archives(record_roles(rows), folder).toArrow()  # one row per file
    return read_archives(spark, folder, split_bytes, payloads)
