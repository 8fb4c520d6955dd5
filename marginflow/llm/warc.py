"""WARC archives as chunked record tables.

A record is written as one or more *segments*: the first is a ``response`` (or ``revisit``)
record, each further one a ``continuation`` record as the WARC standard defines them. So an
oversized payload is a run of (record identifier, chunk number) rows of at most
``chunk_bytes`` bytes, and neither the writer's rows nor the reader's buffer ever hold a whole
record. The reader carries one SHA-256 state along the chunks of a record and checks it
against the digest in the header.

Spark writes and reads the archives (gzipped text files whose line separator is the blank
line that ends a WARC record), so any file system that Spark reaches will do. A gzipped file
is read by one task in order; the lines are put back together as a byte stream, because a
payload may itself hold the separator.

Defined results: a null payload is an empty one. Rows that repeat both id and payload are one
record seen twice, and each is a response. A null id sorts after all others; its
``refers_to`` is null. A null url gives no target header; control characters in a url become
percent escapes. An empty table gives an empty archive. Other columns, whatever their names, are not read. Payloads of any length are
read in chunks; a writer's task holds one payload. Records with equal payloads tie by id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payload bytes of one segment.
CHUNK_BYTES = 1 << 20
#: Equal payloads of fewer bytes are stored again rather than revisited.
MIN_REVISIT = 100
WARC_DATE = "1970-01-01T00:00:00Z"
SEPARATOR = "\r\n\r\n"

CHUNK_SCHEMA = (
    "record_id string, chunk_number int, record_type string, refers_to string, target_uri string, "
    "chunk_bytes long, bytes_so_far long, digest_so_far string, last boolean, payload_bytes long, "
    "payload_digest string, chunk binary"
)


def dedupe_plan(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """A row per record: identifier, type, what it refers to, digest, and the payload."""
    p = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary")).alias("payload"),
    )
    p = p.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    firsts = (
        p.filter(F.col("size") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("key"), "first_id")
    )
    # small payloads are never revisited: a key of their own spreads them over all partitions
    key = F.when(F.col("size") >= min_revisit, F.col("digest")).otherwise(F.concat(F.lit("-"), F.col("digest"), F.xxhash64("id", "url").cast("string")))
    j = p.withColumn("key", key).join(firsts.withColumn("dup", F.lit(True)), "key", "left")
    revisit = F.coalesce(F.col("dup"), F.lit(False)) & ~F.col("id").eqNullSafe(F.col("first_id"))
    return j.select(
        _record_id(F.col("id"), F.col("digest")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, _record_id(F.col("first_id"), F.col("digest"))).alias("refers_to"),
        "url", "digest", "size", "payload",
    )


def _record_id(i: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(":"), F.substring(digest, 1, 32), F.lit(">"))


def page_of(record_id: Column) -> Column:
    """The page id in a record identifier; null where the id was null."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:page:([^:]*):", 1), F.lit(""))


def write_archives(records: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Writes the rows of ``dedupe_plan`` as WARC files; the chunks of a record follow each
    other in one file. Chunks are cut on bytes, JVM-side, one row at a time."""
    response = F.col("record_type") == "response"
    chunks = F.when(response, F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(chunk_bytes)))).otherwise(1).cast("int")
    seg = records.withColumn("n_seg", chunks).withColumn("seg", F.explode(F.sequence(F.lit(1), F.col("n_seg"))))
    body = F.when(response, F.substring(F.col("payload"), (F.col("seg") - 1) * chunk_bytes + 1, F.lit(chunk_bytes))).otherwise(F.lit(b"").cast("binary"))
    http = F.when(
        response & (F.col("seg") == 1),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(SEPARATOR)),
    ).otherwise("")
    seg = seg.select("*", body.alias("body"), http.alias("http"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    some = lambda cond, text: F.when(cond, text).otherwise("")
    first, many, last = F.col("seg") == 1, F.col("n_seg") > 1, F.col("seg") == F.col("n_seg")
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    segment_id = F.concat(F.regexp_replace("record_id", ">$", ""), F.lit(":"), F.col("seg").cast("string"), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        line("WARC-Record-ID", F.when(first, F.col("record_id")).otherwise(segment_id)),
        line("WARC-Date", F.lit(WARC_DATE)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        some(first, F.concat(line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), line("X-Payload-Length", F.col("size").cast("string")))),
        F.coalesce(some(first, line("WARC-Refers-To", F.col("refers_to"))), F.lit("")),
        some(F.col("record_type") == "revisit", line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        some(many, line("WARC-Segment-Number", F.col("seg").cast("string"))),
        some(many & ~first, line("WARC-Segment-Origin-ID", F.col("record_id"))),
        some(many & last, line("WARC-Segment-Total-Length", F.col("size").cast("string"))),
        line("Content-Type", F.when(response, "application/http;msgtype=response").otherwise("message/http")),
        F.concat(F.lit("Content-Length: "), (F.octet_length("http") + F.octet_length("body")).cast("string"), F.lit(SEPARATOR)),
    )
    value = F.concat(header.cast("binary"), F.col("http").cast("binary"), F.col("body")).cast("string").alias("value")
    seg.select(value).write.option("compression", "gzip").option("lineSep", SEPARATOR).text(path)


class _Bytes:
    """A byte stream over the pieces between separators; holds one segment at most."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, bytearray()

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        self.held += b"\r\n\r\n"
        return True

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def header(self) -> dict[str, str] | None:
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends inside a header")
                return None
        lines = bytes(self.held[:at]).decode("utf-8").split("\r\n")
        del self.held[: at + 4]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC header: {lines[0][:40]!r}")
        return dict(x.split(": ", 1) for x in lines[1:])


def _chunks(pieces: Iterator[bytes], with_bytes: bool) -> Iterator[tuple]:
    stream = _Bytes(pieces)
    state, head, done, number = None, {}, 0, 0
    while (h := stream.header()) is not None:
        body = stream.take(int(h["Content-Length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        if h["WARC-Type"] == "continuation":
            if h["WARC-Segment-Origin-ID"] != head.get("WARC-Record-ID"):
                raise ValueError("a continuation does not follow its record")
            number += 1
        else:
            head, number, done, state = h, 1, 0, hashlib.sha256()
            if h["WARC-Type"] == "response":
                body = body[body.index(b"\r\n\r\n") + 4 :]
        response = head["WARC-Type"] == "response"
        state.update(body)
        done += len(body)
        last = "WARC-Segment-Number" not in h or "WARC-Segment-Total-Length" in h
        size, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
        if last and response and (done != size or state.hexdigest() != digest):
            raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
        yield (
            head["WARC-Record-ID"], number, head["WARC-Type"], head.get("WARC-Refers-To"), head.get("WARC-Target-URI"),
            len(body), done, state.hexdigest(), last, size, digest, body if with_bytes else None,
        )


def read_chunks(spark: SparkSession, path: str, with_bytes: bool = True) -> DataFrame:
    """A row per chunk of each record, in order within a file, with the running digest.
    ``with_bytes=False`` leaves ``chunk`` null, for audits that need no payload."""
    lines = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    schema = pa.schema(
        [("record_id", pa.string()), ("chunk_number", pa.int32()), ("record_type", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
         ("chunk_bytes", pa.int64()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("chunk", pa.binary())]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((f, v) for b in batches for f, v in zip(b.column(1).to_pylist(), b.column(0), strict=True))
        held = next(rows, None)

        def of_file(name: str) -> Iterator[bytes]:
            nonlocal held
            while held is not None and held[0] == name:
                yield held[1].as_py()
                held = next(rows, None)

        out, size = [], 0
        while held is not None:
            for row in _chunks(of_file(held[0]), with_bytes):
                out.append(row)
                size += len(row[-1] or b"") + 200
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return lines.mapInArrow(parse, CHUNK_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record, from its last chunk; for responses the digest is the one recomputed
    along the chunks."""
    c = read_chunks(spark, path, with_bytes=False).filter("last")
    digest = F.when(F.col("record_type") == "response", F.col("digest_so_far")).otherwise(F.col("payload_digest"))
    return c.select("record_id", "record_type", "refers_to", "target_uri", "payload_bytes", digest.alias("payload_digest"), F.col("chunk_number").alias("chunks"))
