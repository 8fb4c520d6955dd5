"""Secrets in text by a token-efficiency test.

A subword vocabulary spells ordinary words, names and identifiers in few tokens, random strings
in many. Every run of 16 or more characters of the usual key alphabets is a candidate; it is a
secret where it has fewer than ``LEAST_RATIO`` characters per token and its kinds of characters
(lower case, upper case, digits) change often enough for a random string. Excluded before the
test: digests of the usual lengths in hexadecimal or behind their algorithm's name, universally
unique identifiers, and plain numbers. Three base patterns (stated values, access keys,
hexadecimal runs) are always found, excluded forms or not: there the context or the contract
says secret. A random run that lies inside one base span adds nothing and is left out; one that
only overlaps is reported whole.

How it scales: one pass over the texts without a shuffle; a task holds one short batch. Runs
are encoded in slices of ``SLICE`` characters, so the time stays in proportion for very long ones.

Defined results: a null text is empty. Offsets are code points, the end exclusive. Matching is
leftmost and non-overlapping per kind; a match that fails its check is dropped and not tried
again. Letters of the stated names match in ASCII in either case only. Rows with repeated or
null ids each have their own result; other columns, whatever their names, are not read. Very
long texts are read whole. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import short_batches
from marginflow.llm.packing import encoder

#: Fewer characters than this a token expose a random string; prose has 3 to 5, hexadecimal
#: and base64 noise 1.3 to 2.
LEAST_RATIO = 2.25
#: Changes between lower case, upper case and digits per character, at least, in a random run.
LEAST_CHANGES = 0.15
#: Characters encoded at a time.
SLICE = 4096

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = ("passw", "secret", "token", "key")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")
_RUN = re.compile("[A-Za-z0-9+/_=-]{16,}")
#: Known digests (hexadecimal of 128 to 512 bits, or named), identifiers and numbers.
_KNOWN = re.compile(
    r"(?:[0-9a-f]{32}|[0-9A-F]{32}|[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{56}|[0-9A-F]{56}|[0-9a-f]{64}|[0-9A-F]{64}|[0-9a-f]{96}|[0-9A-F]{96}|[0-9a-f]{128}|[0-9A-F]{128})"
    r"|(?:md5|sha1|sha224|sha256|sha384|sha512)[-=_][A-Za-z0-9+/=_-]+"
    r"|[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
    r"|[0-9+/_=-]+"
)
_LOWER, _UPPER, _DIGITS = re.compile("[a-z]+"), re.compile("[A-Z]+"), re.compile("[0-9]+")

SPAN = "struct<kind:string,start:bigint,end:bigint,ratio:double>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in ``KINDS``, end) of the base patterns."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def is_random(run: str, ids, ratio: float = LEAST_RATIO) -> float | None:
    """Characters per token of a run that the test exposes, else None."""
    if _KNOWN.fullmatch(run):
        return None
    pieces = sum(len(p.findall(run)) for p in (_LOWER, _UPPER, _DIGITS))
    if pieces < 1 + LEAST_CHANGES * len(run):
        return None
    tokens = sum(len(ids(run[at : at + SLICE])) for at in range(0, len(run), SLICE))
    return len(run) / tokens if len(run) < ratio * tokens else None


def spans_of(text: str, ids, ratio: float = LEAST_RATIO) -> list[dict]:
    """All spans of a text by start, then kind."""
    base = base_spans(text)
    out = [(s, k, e, None) for s, k, e in base]
    at, reach = 0, -1  # base spans that start at or before the run, the furthest end of these
    for m in _RUN.finditer(text):
        s, e = m.span()
        while at < len(base) and base[at][0] <= s:
            reach = max(reach, base[at][2])
            at += 1
        found = is_random(m[0], ids, ratio) if reach < e else None
        if found is not None:
            out.append((s, 3, e, found))
    return [{"kind": KINDS[k], "start": s, "end": e, "ratio": r} for s, k, e, r in sorted(out, key=lambda x: x[:3])]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: float = LEAST_RATIO, vocabulary: str | None = None) -> DataFrame:
    """(id, spans) of every row, spans as (kind, start, end, ratio). ``vocabulary`` may name
    another file of ranks."""
    short_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(vocabulary)
        for b in batches:
            found = [spans_of(t.as_py(), ids, ratio) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _SPANS)], ["id", "spans"])

    kind = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(run, f"id {kind}, spans array<{SPAN}>").withColumnRenamed("id", id_col)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.getField("kind"), x.getField("start").cast("string"), x.getField("end").cast("string"))), ",")


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of ``scan``'s rows: the id, counts by base kind, ``base_sha256``, ``spans``."""
    of = lambda k: F.size(F.filter("spans", lambda x: x.getField("kind") == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda x: x.getField("kind") != KINDS[3])
    return found.select(id_col, *[of(k) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
