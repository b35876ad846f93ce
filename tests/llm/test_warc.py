"""Archives: exact round trip, byte ranges, damaged members, copies."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomhouse.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages_of(n: int, seed: int):
    rng = random.Random(seed)
    long = [f"<html>{'é' * rng.randrange(20, 400)} {k}</html>" for k in range(6)]
    rows = []
    for i in range(n):
        html = rng.choice([None, "", "short", long[0], long[0], rng.choice(long), f"{i}" + "x" * rng.randrange(3000)])
        rows.append((i * 3 % n, rng.choice([None, f"http://a/{i}?q=é", "http://b/\r\nX-Evil: 1"]), html))
    return rows


def brute(rows):
    first: dict = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if i is not None and len(raw) >= 100:
            first[raw] = min(i, first.get(raw, i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        least = first.get(raw)
        again = i is not None and least is not None and least != i
        out.append(
            (i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", least if again else None)
        )
    return sorted(out, key=repr)


def listed(df):
    columns = ("id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("split", [97, 5_000, warc.SPLIT_BYTES])
def test_round_trip_by_byte_ranges(spark, tmp_path, split):
    rows = pages_of(200, 1) + [(None, None, "n" * 300), (None, "u", "n" * 300), (3, "u", "z" * 5_000_000)]
    rows += rows[:2]
    folder = str(tmp_path / "w")
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for name in ("id", "payload", "digest", "refers_to", "first", "rows"):
        df = df.withColumn(name, F.lit("mine"))
    found = warc.archive_pages(df, folder=folder, split_bytes=max(split, 20_000) if split == 97 else split, payloads=True)
    assert listed(found) == brute(rows)
    assert found.where("not intact").count() == 0
    texts = {r.id: r.payload.decode() for r in found.where("record_type = 'response'").collect()}
    assert all(texts[i] == (h or "") for i, _, h in rows if i in texts and i is not None and i != 3)


def test_records_are_standard_gzip_members(spark, tmp_path):
    folder = tmp_path / "w"
    df = spark.createDataFrame(pages_of(40, 2), SCHEMA).coalesce(1)
    warc.archive_pages(df, folder=str(folder)).count()
    files = list(Path(folder).glob("*.warc.gz"))
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert raw.count(b"WARC/1.1\r\nWARC-Type: warcinfo") == len(files)
    assert raw.count(b"\r\nWARC-Record-ID: <urn:x-page:") == 40
    assert b"\r\nX-Evil" not in raw
    assert not list(Path(folder).glob(".*"))


def scanned(raw: bytes, cuts: list[int]):
    out = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        out += list(warc.scan_range(io.BytesIO(raw), len(raw), lo, hi))
    return out


def record(k: int, body: bytes) -> bytes:
    return warc.record(k, f"http://x/{k}", body, hashlib.sha256(body).hexdigest(), None)


def test_every_cut_gives_each_record_once():
    rng = random.Random(3)
    # stored blocks show the gzip magic of their bodies
    bodies = [rng.randbytes(40) + warc.MAGIC * 5 + rng.randbytes(300) for _ in range(12)]
    members = [warc.member(record(k, b), 0) for k, b in enumerate(bodies)]
    raw = b"".join(members)
    want = scanned(raw, [0, len(raw)])
    assert [warc.parse(r)[0]["warc-record-id"] for _, r in want] == [f"<urn:x-page:{k}>" for k in range(12)]
    assert raw.count(warc.MAGIC) > 12
    for step in (1, 2, 3, 50, 333):
        cuts = [*range(0, len(raw), step), len(raw)]
        assert scanned(raw, cuts) == want


def test_damaged_member_costs_one_record():
    members = [warc.member(record(k, b"body %d " % k * 200)) for k in range(5)]
    bad = bytearray(members[2])
    bad[-6] ^= 0xFF  # the check sum
    raw = b"".join([*members[:2], bytes(bad), *members[3:]])
    found = [warc.parse(r)[0]["warc-record-id"] for _, r in scanned(raw, [0, len(raw)])]
    assert found == [f"<urn:x-page:{k}>" for k in (0, 1, 3, 4)]
    cut = b"".join(members)[:-10]
    assert len(scanned(cut, [0, len(cut)])) == 4


def test_hot_payload_is_spread(spark):
    pages = spark.range(400).select(
        "id", F.lit("u").alias("url"),
        F.when(F.col("id") % 3 > 0, F.lit("x" * 200)).otherwise(F.col("id").cast("string")).cast("binary").alias("payload"),
    )
    got = warc.record_roles(pages, rows_per_task=50).collect()
    assert len(got) == 400
    assert sorted(r.id for r in got if r.refers_to == 1) == [i for i in range(2, 400) if i % 3]
    assert sum(r.refers_to is None for r in got) == 135


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert warc.archive_pages(df).count() == 0
