"""Sequences of a fixed number of tokens by sum-of-squares online packing.

Each document's token ids (and an end id) are cut into full windows and a rest. Rests are
placed one by one: of all fill levels that take the rest, the one is chosen that makes the sum
over levels of the squared count of partially filled windows least. A level array holds those
counts. At the end of a partition, the windows left open are closed by cutting pieces of the
emptiest ones to fill the fullest, so that at most one window a partition stays partial.

How it scales: no shuffle; a partition is packed in one pass and holds only its open windows.
Padding is below one window a partition.

Defined results: a null or empty text is the end id alone. Every document appears, whatever
its id (null and repeated ids too); pieces carry the id as it is. Very long texts are cut into
many windows. Of equally good levels the fullest is taken. Other columns, whatever their names, are
not read. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import short_batches

WINDOW = 1024
END_ID = 0
#: The vocabulary's one special token, fixed by the tokenizer file.
SPECIAL = {"<|endoftext|>": 50256}
#: Room for local sequence numbers in a sequence id, below the partition's number.
LOCAL_BITS = 36


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None):
    """A function from text to ids, the same as ``tokenizers`` gives for byte_bpe_50k.json
    with ``add_special_tokens=False``; run by the faster library over the same vocabulary.
    ``path`` may name another file of ranks."""
    import public_tokenizers as public
    import tiktoken

    with open(path or public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("byte_bpe_50k", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def ids(text: str) -> np.ndarray:
        if "<|endoftext|>" in text:
            return np.asarray(enc.encode(text, allowed_special="all"), "<u4")
        return np.asarray(enc.encode_ordinary(text), "<u4")

    return ids


class SumOfSquares:
    """Windows of ``size`` tokens. ``place`` puts a piece somewhere and returns a window once
    it is full; ``close`` returns the rest. A window is a list of pieces."""

    def __init__(self, size: int = WINDOW):
        self.size, self.count = size, np.zeros(size + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def place(self, piece, length: int):
        b, n = self.size, self.count
        if length == b:
            return [piece]
        top = b - length  # highest level that takes the piece
        cost = 2 * n[length : b + 1] + 1  # of raising a window to each level
        cost[top] = 0  # full windows are not partial
        cost[1:] += 1 - 2 * n[1 : top + 1]
        cost[1:][n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        level = top - int(np.argmin(cost[::-1]))  # of equal costs, the fullest
        window = self.open[level].pop() if level else []
        if level:
            n[level] -= 1
        window.append(piece)
        if level + length == b:
            return window
        n[level + length] += 1
        self.open[level + length].append(window)
        return None

    def close(self, cut):
        """All open windows, filled up by cutting pieces: ``cut(piece, k)`` gives the first k
        tokens and the rest. At most the last one is partial."""
        left = [(level, w) for level in range(self.size - 1, 0, -1) for w in self.open[level]]
        out, low, high = [], len(left) - 1, 0
        spare: list = []  # pieces taken from the emptiest windows
        while high <= low:
            level, window = left[high]
            high += 1
            while level < self.size:
                if not spare:
                    if high > low:
                        break
                    spare = left[low][1]
                    low -= 1
                piece, length = spare.pop()
                room = self.size - level
                if length > room:
                    (piece, length), rest = cut((piece, length), room)
                    spare.append(rest)
                window.append((piece, length))
                level += length
            out.append(window)
        while spare:  # what the last donor still holds
            window, level = [], 0
            while spare and level < self.size:
                piece, length = spare.pop()
                room = self.size - level
                if length > room:
                    (piece, length), rest = cut((piece, length), room)
                    spare.append(rest)
                window.append((piece, length))
                level += length
            out.append(window)
        self.count[:] = 0
        self.open = [[] for _ in range(self.size + 1)]
        return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_ids: bool = True, tokenizer: str | None = None) -> DataFrame:
    """A row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and, with ``with_ids``, the token ids."""
    short_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"), F.spark_partition_id().alias("_part"))
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(n, pa.int64()) for n in names] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
    ddl = ", ".join(f"`{n}` long" for n in names) + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, bins, rows, at, part = encoder(tokenizer), SumOfSquares(window), [], 0, 0

        # a piece is ((doc, start, doc_tokens, ids), length)
        def cut(piece, k):
            (doc, start, total, ids), length = piece
            return ((doc, start, total, ids[:k]), k), ((doc, start + k, total, ids[k:]), length - k)

        def emit(pieces) -> None:
            nonlocal at
            offset = 0
            for (doc, start, total, ids), length in pieces:
                row = (doc, start, length, zlib.crc32(ids.tobytes()), total, (part << LOCAL_BITS) + at, offset)
                rows.append((*row, ids.astype(np.int32)) if with_ids else row)
                offset += length
            at += 1

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows.clear()
            return out

        for b in batches:
            docs_, texts = b.column(0).to_pylist(), b.column(1)
            if b.num_rows:
                part = b.column(2)[0].as_py()
            for doc, text in zip(docs_, texts, strict=True):
                ids = np.append(ids_of(text.as_py()), np.uint32(END_ID)).astype("<u4")
                total = len(ids)
                full = total // window * window
                for s in range(0, full, window):
                    emit([((doc, s, total, ids[s : s + window]), window)])
                if full < total:
                    done = bins.place(((doc, full, total, ids[full:].copy()), total - full), total - full)
                    if done is not None:
                        emit(done)
                if len(rows) >= 4096:
                    yield flush()
        for w in bins.close(cut):
            emit(w)
        if rows:
            yield flush()

    return src.mapInArrow(run, ddl)
