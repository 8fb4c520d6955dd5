import gzip
import hashlib
import random
from pathlib import Path

from marginflow.llm import queries, warc
from marginflow.llm.common import new_path


def written(spark, rows, chunk=warc.CHUNK_BYTES):
    path = new_path(spark, "warc-test")
    warc.write_archives(warc.dedupe_plan(spark.createDataFrame(rows, "page_id long, url string, html string, digest string"), "page_id", "url", "html"), path, chunk)
    return path


def rows():
    rnd = random.Random(1)
    odd = "".join(rnd.choice("\r\n\r\nab€") for _ in range(5000))
    long = "x€" * 40_000
    return [
        (7, "http://a/1", odd, "c"), (3, "http://a/2", odd, "c"), (9, None, None, "c"), (10, "u\r\nv", "", "c"), (11, "u", "a" * 99, "c"), (12, "u", "a" * 99, "c"),
        (13, "u", "a" * 100, "c"), (14, "u", "a" * 100, "c"), (14, "u", "a" * 100, "c"), (None, "u", "a" * 100, "c"), (None, "w", long, "c"), (20, "w", long, "c"),
        (21, "e", "ends\r\n", "c"), (22, "e", "\r\n\r\n", "c"), (23, "e", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "c"), (24, "e", "\r\n\r", "c"),
    ]


def test_round_trip_in_small_chunks(spark):
    path = written(spark, rows(), chunk=1000)
    chunks = warc.read_chunks(spark, path).collect()
    payload = {}
    for c in sorted(chunks, key=lambda c: c.chunk_number):
        assert c.chunk_bytes == len(c.chunk) <= 1000
        if c.record_type == "response" and not c.record_id.startswith("<urn:page:14:"):  # 14 stands twice
            payload.setdefault(c.record_id, []).append(bytes(c.chunk))
            assert c.chunk_number == len(payload[c.record_id])
            assert c.digest_so_far == hashlib.sha256(b"".join(payload[c.record_id])).hexdigest()
    got = sorted((str(c.record_id.split(":")[2]), c.record_type, c.payload_bytes, c.payload_digest) for c in chunks if c.last)
    first = {}
    for i, _, h, _ in rows():
        b = (h or "").encode()
        if i is not None and len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    want = []
    for i, _, h, _ in rows():
        b = (h or "").encode()
        kind = "revisit" if len(b) >= 100 and b in first and i != first[b] else "response"
        want.append(("" if i is None else str(i), kind, len(b), hashlib.sha256(b).hexdigest()))
    assert got == sorted(want)


def test_files_are_warc(spark):
    path = written(spark, rows(), chunk=1000)
    for f in Path(path).glob("*.gz"):
        data, at = gzip.decompress(f.read_bytes()), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:])
            assert data[at:].startswith(b"WARC/1.1\r\n")
            at = end + 4 + int(head["Content-Length"])
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4


def test_damage_is_found(spark):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1:a>\r\nWARC-Payload-Digest: sha256:00\r\nX-Payload-Length: 1\r\nContent-Length: 5\r\n\r\n\r\n\r\nx"
    for pieces in ([*good.split(b"\r\n\r\n")], good.split(b"\r\n\r\n")[:1]):
        try:
            list(warc._chunks(iter(pieces), True))
        except ValueError:
            continue
        raise AssertionError("damage went unnoticed")


def test_empty_table(spark):
    assert warc.read_records(spark, written(spark, [])).collect() == []


def test_query_returns_every_page(spark):
    assert queries.op1_warc(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
