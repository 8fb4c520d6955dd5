"""Ranked lexical search by hashed max-sketches.

The index holds a row per document: its number of terms, its distinct terms (64-bit hashes) with
their occurrences, and a sketch. A sketch hashes terms to ``COORDINATES`` places and keeps, in
each place, the greatest occurrence of the terms that fall there. An impact grows with the
occurrences and all else in it is the document's own, so the impact of a coordinatewise maximum
is the maximum of the impacts; kept this way the sketches stay right when documents are added
and the collection's statistics move.

A search takes the queries in blocks. For each short batch of documents the sketches become a
matrix of maximal impacts; a query's weights times its terms' places are upper bounds of its
scores, for all documents of the batch at once. Documents are then scored exactly, by their
terms, in the order of falling bounds, until the next bound is below the k-th best score that the
task has seen. What the bounds leave out cannot be among the first k. Each task returns its k best
for each query, and a window over these few rows gives the answer.

How it scales: one pass over the texts writes the index; the statistics, a block's document
frequencies and its search each are one pass over the index's columns without a shuffle of its
rows. What goes to the tasks is a block of queries, at most ``BLOCK`` of them or ``BLOCK_TERMS``
distinct terms (one query's terms may be more), read from the driver's iterator one block at a
time; what comes back is k rows a query and task. The driver never holds documents.

Defined results: terms are maximal runs of letters, digits and all code points above ASCII, only
A-Z lower-cased. A null or empty text has no terms; such a document is in no result, such a query
has none. Equal scores stand by id, null ids last. Repeated rows, ids and queries each count as
rows of their own. Other columns, whatever their names, are not read. Very long texts are read
whole, in parts. Empty tables give no rows. Two terms with equal hashes would count as one: with
10^9 distinct terms and 10^5 query terms the probability is below 10^-5.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marginflow.llm.common import short_batches, stored
from marginflow.llm.textbytes import word_bytes

#: Places of a sketch (a power of two).
COORDINATES = 4096
#: Queries, and distinct query terms, of a block.
BLOCK, BLOCK_TERMS = 1024, 200_000
#: Bytes of a text split into terms at a time.
PART = 1 << 20
#: Documents scored exactly between two looks at the threshold.
STEP = 8


def terms_of(text: str | None) -> Counter:
    """Terms of a text with their occurrences."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if len(data) <= PART:
        return Counter(word_bytes(data))
    out, at = Counter(), 0
    while at < len(data):
        end = min(at + PART, len(data))
        while end < len(data) and not (data[end] < 0x30 or 0x3A <= data[end] <= 0x40):  # a part ends at a separator
            end += 1
        out.update(word_bytes(data[at:end]))
        at = end
    return out


def hashes_of(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def places_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)) % np.uint64(COORDINATES)


def sketch_of(hashes: np.ndarray, tfs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, maxima) of a document: the places its terms fall to, ascending."""
    at = places_of(hashes).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, tf = at[order], tfs[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
    return at[first].astype("<u2"), np.maximum.reduceat(tf, first).astype("<u4") if len(at) else tf.astype("<u4")


_PARTS = ["terms", "tfs", "places", "maxima"]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, tfs, places, maxima) of every row, written to the shared folder."""
    short_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, cols = [], {k: [] for k in _PARTS}
            for t in b.column(1):
                count = terms_of(t.as_py())
                h = hashes_of(list(count))
                order = np.argsort(h)
                h, tf = h[order], np.fromiter(count.values(), np.int64, len(count))[order]
                n.append(int(tf.sum()))
                for k, x in zip(_PARTS, (h.astype("<u8"), tf.astype("<u4"), *sketch_of(h, tf)), strict=True):
                    cols[k].append(x.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *[pa.array(cols[k], pa.binary()) for k in _PARTS]], ["id", "n", *_PARTS])

    kind = d.schema["id"].dataType.simpleString()
    return stored(d.mapInArrow(run, f"id {kind}, n bigint, " + ", ".join(f"{k} binary" for k in _PARTS)), "max-sketch-index")


class Query(NamedTuple):
    q: int
    terms: np.ndarray  # distinct hashes, ascending
    counts: np.ndarray  # repeats of each in the query


def blocks_of(queries: DataFrame) -> Iterator[list[Query]]:
    """Blocks of the queries (q, t), one at a time; queries without terms are in none."""
    block, size = [], 0
    for r in queries.toLocalIterator():
        count = terms_of(r.t)
        if not count:
            continue
        if block and (len(block) == BLOCK or size + len(count) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        h = hashes_of(list(count))
        order = np.argsort(h)
        block.append(Query(r.q, h[order], np.fromiter(count.values(), np.int64, len(count))[order]))
        size += len(count)
    if block:
        yield block


def _numbers(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a batch of binary values, and how many each row holds."""
    rows = [x.as_py() for x in column]
    return np.frombuffer(b"".join(rows), dtype), np.fromiter((len(x) for x in rows), np.int64, len(rows)) // np.dtype(dtype).itemsize


def document_frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Documents that hold each term of a sorted vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for b in batches:
            h, _ = _numbers(b.column(0), "<u8")
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["term", "df"])

    out = np.zeros(len(vocabulary), np.int64)
    for r in index.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r.term] = r.df
    return out


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_factors(n: list[int], n_docs: int, n_terms: int) -> np.ndarray:
    """m of each document, in whole numbers of any size."""
    return np.array([100 - 75 + (75 * x * n_docs) // n_terms for x in n], np.int64)


class Best:
    """The k best (score, id) of a query so far."""

    def __init__(self, k: int):
        self.k, self.kept = k, []

    @property
    def least(self) -> int:
        """A score below this cannot enter."""
        return -self.kept[-1][0] if len(self.kept) == self.k else 1

    def offer(self, score: int, ident) -> None:
        if score >= self.least:
            bisect.insort(self.kept, (-score, ident is None, ident), key=lambda x: x[:2] if x[1] else x)
            del self.kept[self.k :]


def search_batch(b: dict[str, pa.Array], m: np.ndarray, queries: list[tuple[np.ndarray, np.ndarray, np.ndarray]], best: list[Best]) -> int:
    """Offers to each query's ``best`` the documents of a batch that may enter; returns how many
    were scored exactly. A query is (hashes, places, weights)."""
    size = len(m)
    at, held = _numbers(b["places"], "<u2")
    tops, _ = _numbers(b["maxima"], "<u4")
    doc = np.repeat(np.arange(size), held)
    sketch = np.zeros((COORDINATES, size), np.int64)
    sketch[at, doc] = impact(tops.astype(np.int64), m[doc])
    terms, held = _numbers(b["terms"], "<u8")
    tfs, _ = _numbers(b["tfs"], "<u4")
    start = np.concatenate(([0], np.cumsum(held)))
    ids, scored = b["id"], 0
    for (h, places, weight), top in zip(queries, best, strict=True):
        bound = weight @ sketch[places]
        may = np.flatnonzero(bound >= top.least)
        may = may[np.argsort(-bound[may], kind="stable")]
        for i, d in enumerate(may.tolist()):
            if i % STEP == 0 and bound[d] < top.least:
                break
            own = terms[start[d] : start[d + 1]]
            there = np.minimum(np.searchsorted(own, h), len(own) - 1)
            same = own[there] == h
            tf = tfs[start[d] + there[same]].astype(np.int64)
            top.offer(int(weight[same] @ impact(tf, m[d])), ids[d].as_py())
            scored += 1
    return scored


def search_block(index: DataFrame, block: list[Query], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(q, id, score): every task's k best documents of each query of a block."""
    vocabulary = np.unique(np.concatenate([x.terms for x in block]))
    df = document_frequencies(index, vocabulary)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    ready = []
    for x in block:
        at = np.searchsorted(vocabulary, x.terms)
        held = df[at] > 0  # terms of no document score nothing
        ready.append((x.terms[held], places_of(x.terms[held]).astype(np.int64), weights[at][held] * x.counts[held]))
    sent = index.sparkSession.sparkContext.broadcast(([x.q for x in block], ready))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = sent.value
        best = [Best(k) for _ in queries]
        kind = None
        for b in batches:
            kind = b.schema.field("id").type
            search_batch({c: b.column(i) for i, c in enumerate(b.schema.names)}, length_factors(b.column(1).to_pylist(), n_docs, n_terms), queries, best)
        out = [(q, ident, -score) for q, top in zip(names, best, strict=True) for score, _, ident in top.kept]
        if out:
            q, ident, score = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(ident, kind), pa.array(score, pa.int64())], ["q", "id", "score"])

    kind = index.schema["id"].dataType.simpleString()
    return index.filter("n > 0").mapInArrow(run, f"q bigint, id {kind}, score bigint")


def search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query's id, rank, id, score): the k best documents of every query row."""
    short_batches(index.sparkSession)
    asked = stored(queries.select(F.monotonically_increasing_id().alias("q"), F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("t")), "max-sketch-queries")
    total = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    found = None
    for block in blocks_of(asked.select("q", "t")) if total.docs else ():
        part = stored(search_block(index, block, total.docs, total.terms, k), "max-sketch-found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = index.limit(0).select(F.lit(0).cast("long").alias("q"), "id", F.lit(0).cast("long").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.join(asked.select("q", "item"), "q").select(F.col("item").alias(id_col), "rank", "id", "score")
