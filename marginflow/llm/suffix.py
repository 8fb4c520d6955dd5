"""Repeated substrings by a sampled suffix order, sorted deep-shallow.

Every byte covered by a string of ``min_bytes`` bytes that starts at another place too, in the
same text or another, is removed; strings are judged on the input.

How it works. A window of ``min_bytes`` bytes is filed under its *anchor*, the place in it
where the hash of ``GRAM`` bytes is least (the leftmost of equal ones). Equal windows have
equal anchors at equal places, so each window need be compared only with windows filed under
an equal anchor, and a text of n bytes has some n/150 anchors rather than n suffixes. The
suffixes that start at equal anchors are ordered by deep-shallow sorting: multikey quicksort
on eight bytes at a time to ``SHALLOW`` bytes, then blind tries for the groups that still
agree, and in the same way the reversed bytes to the left. Adjacent common prefixes of the two
orders tell which windows occur twice.

How it scales: equal texts collapse by digest first. Anchors that occur once leave before any
text is moved. Anchors that occur more than ``GROUP`` times (one passage in a large part of
all texts) are not gathered: their windows are tested by counting digests of ever smaller
blocks of windows (``_ladder``), which combines before the shuffle. So no task holds more than
``GROUP`` contexts of at most ``2 * min_bytes`` bytes, and nothing is left out.

Defined results: a null text is empty; texts below ``min_bytes`` bytes have no repeats. Of
equal texts of at least that many bytes each is removed whole (also under repeated or null
ids). Bytes are those of UTF-8; a cut may fall inside a character. Very long texts are hashed
in overlapping parts. Other columns, whatever their names, are not read. An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import short_batches, stored
from marginflow.llm.textbytes import powers, mix, prefix_hash

MIN_BYTES = 400
GRAM = 100
#: Depth that multikey quicksort reaches before blind tries take over.
SHALLOW = 32
#: Contexts that one task sorts together (40 MB at most); beyond, the ladder counts.
GROUP = 50_000
#: Window starts of a text that are hashed at once.
PART = 1 << 20
#: An anchor's context: least and greatest offset of the anchor in a window, bytes.
CONTEXT = "h long, node long, at int, d1 int, d2 int, ctx binary"


def anchors(data: bytes, length: int = MIN_BYTES, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(hash, place, first window start, last window start) of each anchor, by place."""
    out = []
    for at in range(0, max(0, len(data) - length + 1), PART):
        part = np.frombuffer(data, np.uint8)[at : at + PART + length - 1]
        out.append(tuple(x if k == 0 else x + at for k, x in enumerate(_anchors(part, length, gram))))
    if not out:
        return np.zeros(0, np.int64), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _anchors(part: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    n, width = len(part), length - gram + 1
    p = prefix_hash(part)
    h = mix((p[gram:] - p[:-gram]) * powers(n + 1)[1][: n - gram + 1])
    low = np.uint64((1 << 24) - 1)  # places below 2**24 fit beside the hash's upper bits
    m = len(h)
    v = np.full(-(-m // width) * width, np.iinfo(np.uint64).max, np.uint64)
    v[:m] = (h & ~low) | np.arange(m, dtype=np.uint64)
    v = v.reshape(-1, width)
    ahead = np.minimum.accumulate(v, axis=1).ravel()
    back = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    place = (np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts]) & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.append(first[1:], starts) - 1
    return h[place[first]].view(np.int64), place[first], first, last


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    while n - start > 16:
        mid = (start + n) // 2
        if a[start:mid] == b[start:mid]:
            start = mid
        else:
            n = mid
    while a[start] == b[start]:
        start += 1
    return start


def _blind_trie(strings: list[bytes], items: list[int], depth: int) -> tuple[list[int], list[int]]:
    """Order of strings that agree to ``depth``, and adjacent common prefixes.

    A node is [depth, {byte: child}], a leaf [-1, items]; a string's end is byte -1. Insertion
    goes down blindly, compares with one leaf only, and splits where the two differ."""
    byte = lambda s, d: s[d] if d < len(s) else -1
    root = [-1, [items[0]]]
    for k in items[1:]:
        s, t = strings[k], root
        while t[0] >= 0:
            t = t[1].get(byte(s, t[0])) or next(iter(t[1].values()))
        other = strings[t[1][0]]
        same = common(s, other, depth)
        if same == len(s) == len(other):
            t[1].append(k)
            continue
        up, t = None, root
        while 0 <= t[0] < same:
            up, t = t, t[1][byte(s, t[0])]
        if t[0] == same:
            t[1][byte(s, same)] = [-1, [k]]
            continue
        node = [same, {byte(other, same): t, byte(s, same): [-1, [k]]}]
        if up is None:
            root = node
        else:
            up[1][byte(s, up[0])] = node
    order, lcp = [], []
    stack: list = [(root, depth)]  # a subtree and its common prefix with what comes before
    while stack:
        t, before = stack.pop()
        if t[0] < 0:
            lcp += [before] + [len(strings[t[1][0]])] * (len(t[1]) - 1)
            order += t[1]
        else:
            keys = sorted(t[1])
            stack += [(t[1][c], t[0]) for c in reversed(keys[1:])]
            stack.append((t[1][keys[0]], before))
    return order, lcp[1:]


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], np.ndarray]:
    """Sorted order of ``strings`` and the common prefix of each with the one after it."""
    order: list[int] = []
    lcp: list[int] = []
    step = 8
    # parts wait with the depth to which all their strings agree; `before` is the common prefix
    # with the string that precedes the part
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while stack:
        part, depth = stack.pop()
        if len(part) == 1 or depth >= shallow:
            got, inner = (part, []) if len(part) == 1 else _blind_trie(strings, part, depth)
            if order:
                lcp.append(common(strings[order[-1]], strings[got[0]]))
            order += got
            lcp += inner
            continue
        key = {k: strings[k][depth : depth + step] for k in part}
        pivot = key[part[len(part) // 2]]
        less = [k for k in part if key[k] < pivot]
        more = [k for k in part if key[k] > pivot]
        same = [k for k in part if key[k] == pivot]
        if more:
            stack.append((more, depth))
        if len(pivot) < step:  # these have ended: all equal
            stack.append((same, max(depth, shallow)))
        else:
            stack.append((same, depth + step))
        if less:
            stack.append((less, depth))
    return order, np.asarray(lcp, np.int64)


def repeated_windows(members: list[tuple[bytes, int, int, int]], length: int) -> list[list[tuple[int, int]]]:
    """For contexts filed under one anchor, given as (bytes, bytes before the anchor, least and
    greatest offset of the anchor in a window): the runs of offsets whose windows occur at
    another member too."""
    found: list[list[tuple[int, int]]] = [[] for _ in members]
    alike: dict[tuple, list[int]] = {}
    for i, m in enumerate(members):
        alike.setdefault(m, []).append(i)
    for m, at in alike.items():
        if len(at) > 1:
            for i in at:
                found[i] = [(m[2], m[3])]
    if len(alike) == 1:
        return found
    kinds = list(alike)
    if len(kinds) == 2:
        (a, la, lo_a, hi_a), (b, lb, lo_b, hi_b) = kinds
        right = common(a[la:], b[lb:])
        left = common(a[:la][::-1], b[:lb][::-1])
        lo, hi = max(length - right, lo_a, lo_b), min(left, hi_a, hi_b)
        if lo <= hi:
            for at in alike.values():
                for i in at:
                    found[i].append((lo, hi))
        return found
    n = len(kinds)
    classes = []
    for side in ([k[0][k[1] :] for k in kinds], [k[0][: k[1]][::-1] for k in kinds]):
        order, lcp = deep_shallow(side)
        classes.append((np.asarray(order), lcp))
    (ro, rl), (lo_, ll) = classes
    least, most = np.array([k[2] for k in kinds]), np.array([k[3] for k in kinds])
    # classes change only where an offset passes a common prefix or a member's bound
    marks = np.unique(np.concatenate((length - rl, ll + 1, least, most + 1)))
    marks = marks[(marks >= least.min()) & (marks <= most.max() + 1)]
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    hits: list[list[tuple[int, int]]] = [[] for _ in kinds]
    for d, after in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
        right_class[ro] = np.concatenate(([0], np.cumsum(rl < length - d)))
        left_class[lo_] = np.concatenate(([0], np.cumsum(ll < d)))
        on = np.flatnonzero((least <= d) & (d <= most))
        if len(on) < 2:
            continue
        key = right_class[on] * n + left_class[on]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        for i in on[count[back] > 1].tolist():
            runs = hits[i]
            if runs and runs[-1][1] == d - 1:
                runs[-1] = (runs[-1][0], after - 1)
            else:
                runs.append((d, after - 1))
    for m, runs in zip(kinds, hits, strict=True):
        for i in alike[m]:
            found[i] += runs
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of half-open spans; touching ones join."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _digest(text):
    return F.unhex(F.sha2(text, 256))


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    t = F.col(text_col).cast("binary")
    return docs.filter(t.isNotNull()).select(_digest(t).alias("digest"), t.alias("t")).groupBy("digest").agg(F.first("t").alias("t"))


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = MIN_BYTES, gram: int = GRAM, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(nodes, spans): distinct texts of ``length`` bytes or more with ``node``, ``digest``,
    ``copies``; and half-open byte spans (node, s, e) of each node that repeat elsewhere (not
    merged; texts with copies are wholly repeated beyond these)."""
    short_batches(docs.sparkSession, 256)
    t = F.col(text_col).cast("binary")
    src = docs.filter(F.octet_length(t) >= length).select(_digest(t).alias("digest"), t.alias("_t"))
    names = ["digest", "h", "at", "lo", "hi"]
    lists = [pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [anchors(x.as_buffer().to_pybytes(), length, gram) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(lists)]], names=names)

    found = src.mapInArrow(scan, "digest binary, h array<long>, at array<int>, lo array<int>, hi array<int>")
    nodes = found.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.first(F.struct("h", "at", "lo", "hi")).alias("x"))
    nodes = stored(stored(nodes.select("digest", "copies", "x.*"), "anchors").withColumn("node", F.monotonically_increasing_id()), "nodes")
    each = nodes.select("node", F.explode(F.arrays_zip("h", "at", "lo", "hi")).alias("x")).select("node", "x.*")
    twice = each.groupBy("h").agg(F.count(F.lit(1)).alias("n_h")).filter("n_h > 1")
    again = each.join(twice, "h")
    hot = twice.filter(F.col("n_h") > group).limit(1).count() > 0

    def with_text(places: DataFrame) -> DataFrame:
        a = places.groupBy("node").agg(F.collect_list(F.struct("h", "at", "lo", "hi")).alias("a"))
        return a.join(nodes.select("node", "digest"), "node").join(_texts(docs, text_col), "digest").select("node", "a", "t").mapInArrow(cut, CONTEXT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64()), ("node", pa.int64()), ("at", pa.int32()), ("d1", pa.int32()), ("d2", pa.int32()), ("ctx", pa.binary())])
        for b in batches:
            rows, size = [], 0
            for node, a, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                text = t.as_buffer().to_pybytes()
                for x in a:
                    at, lo, hi = x["at"], x["lo"], x["hi"]
                    ctx = text[lo : hi + length]
                    rows.append((x["h"], node, at, at - hi, at - lo, ctx))
                    size += len(ctx)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    usual = with_text(again.filter(F.col("n_h") <= group)).repartition("h").sortWithinPartitions("h")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        held: list[tuple] = []
        now = None

        def done() -> None:
            if len(held) > 1:
                # offsets from the anchor: a window with the anchor at offset d starts at at - d
                for (node, at, *_), runs in zip(held, repeated_windows([(c, d2, d1, d2) for _, _, d1, d2, c in held], length), strict=True):
                    out.extend((node, at - b, at - a + length) for a, b in runs)
            held.clear()

        def batch() -> pa.RecordBatch:
            r = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["node", "s", "e"])
            out.clear()
            return r

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for h, node, at, d1, d2, ctx in zip(*cols, strict=True):
                if h != now:
                    done()
                    now = h
                held.append((node, at, d1, d2, ctx))
            if len(out) > 50_000:
                yield batch()
        done()
        if out:
            yield batch()

    spans = usual.mapInArrow(compare, "node long, s int, e int")
    if hot:
        spans = spans.union(_ladder(with_text(again.filter(F.col("n_h") > group)), length))
    return nodes, spans


#: Sizes of the blocks of offsets that the ladder tests, each a multiple of the next.
RUNGS = (512, 64, 8, 1)


def _ladder(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows under anchors that occur too often to be gathered, by counting.

    For a block of window offsets, the bytes that its windows cover together occur twice: all
    its windows do. The bytes common to its windows occur once: none does. Else the block is
    divided. A block has a digest for each test, counted by an aggregate that combines before
    the shuffle; the last rung's blocks are single windows, where the two tests are one."""
    base = stored(contexts.select("h", "node", "at", "d1", "d2", "ctx").withColumn("row", F.monotonically_increasing_id()), "hot-contexts")
    todo = base.select("row", F.lit(0).alias("block"))
    out = None
    for k, size in enumerate(RUNGS):
        b = todo.join(base, "row")
        if k:
            b = b.withColumn("block", F.explode(F.sequence(F.col("block") * (RUNGS[k - 1] // size), (F.col("block") + 1) * (RUNGS[k - 1] // size) - 1)))
        first, last = F.col("block") * size, F.col("block") * size + size - 1
        a, z = F.greatest(first, F.col("d1")), F.least(last, F.col("d2"))
        b = b.filter(a <= z).withColumns({"a": a, "z": z, "first": first, "last": F.least(last, F.lit(length))})
        # the anchor stands d2 bytes into the context
        whole = F.substring("ctx", F.col("d2") - F.col("z") + 1, F.col("z") - F.col("a") + length)
        core = F.substring("ctx", F.greatest(F.col("d2") - F.col("first"), F.lit(0)) + 1, F.greatest(F.lit(0), F.col("first") - F.col("last") + length))
        name = lambda kind, *x: F.sha2(F.concat(F.lit(kind), *[F.concat(c.cast("string"), F.lit(",")).cast("binary") for c in x[:-1]], x[-1]), 256)
        b = b.select(
            "row", "block", "node", "at", "a", "z",
            name(b"w", F.col("h"), F.col("a"), F.col("z"), whole).alias("w"), name(b"c", F.col("h"), F.col("block"), core).alias("c"),
        )
        b = stored(b, "rung")
        many = b.select(F.explode(F.array("w", "c")).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("x")
        got = b.join(many.select(F.col("x").alias("w"), F.lit(True).alias("all")), "w", "left").join(many.select(F.col("x").alias("c"), F.lit(True).alias("some")), "c", "left")
        got = stored(got, "rung")
        yes = got.filter("all").select("node", (F.col("at") - F.col("z")).cast("int").alias("s"), (F.col("at") - F.col("a") + length).cast("int").alias("e"))
        out = yes if out is None else out.union(yes)
        open_ = got.filter("all is null and some")
        # of the settled blocks, one of each kind stays as a partner for those still open
        partner = got.filter("all").groupBy("c", "w", "block").agg(F.min("row").alias("row")).join(open_.select("c").distinct(), "c", "left_semi")
        todo = open_.select("row", "block").union(partner.select("row", "block"))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = MIN_BYTES, gram: int = GRAM, group: int = GROUP, with_kept: bool = True) -> DataFrame:
    """A row per document: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and,
    with ``with_kept``, the bytes that stay (``kept``)."""
    nodes, spans = repeated_spans(docs, text_col, length, gram, group)
    by_node = spans.groupBy("node").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    once = by_node.join(nodes.filter("copies = 1").select("node", "digest"), "node").join(_texts(docs, text_col), "digest").select("digest", "spans", "t")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, count, sha, kept = [], [], [], []
            for spans_, t in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                text, at, parts = t.as_buffer().to_pybytes(), 0, []
                runs = merged([(x["s"], x["e"]) for x in spans_])
                for s, e in runs:
                    parts.append(text[at:s])
                    at = e
                parts.append(text[at:])
                left = b"".join(parts)
                removed.append(len(text) - len(left))
                count.append(len(runs))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_kept else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], names=["digest", "r", "c", "k", "kept"])

    cut = once.mapInArrow(apply, "digest binary, r long, c long, k string, kept binary")
    whole = nodes.filter("copies > 1").select("digest", F.lit(None).cast("long").alias("r"), F.lit(1).cast("long").alias("c"), F.sha2(F.lit(b""), 256).alias("k"), F.lit(b"").alias("kept"))
    known = cut.union(whole)
    t = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    base = docs.select(F.col(id_col).alias(id_col), F.octet_length(t).cast("long").alias("n_bytes"), _digest(t).alias("digest"), *([t.alias("_t")] if with_kept else []))
    j = base.join(known, "digest", "left")
    return j.select(
        id_col, "n_bytes",
        F.when(F.col("c").isNull(), F.lit(0)).otherwise(F.coalesce("r", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("c", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("k", F.lower(F.hex("digest"))).alias("kept_sha256"),
        *([F.when(F.col("c").isNull(), F.col("_t")).otherwise(F.col("kept")).alias("kept")] if with_kept else []),
    )
