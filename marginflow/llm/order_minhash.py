"""Near duplicates by order MinHash.

A text is its sequence of occurrence-labelled shingles of five words. A sketch samples the
``length`` shingles that are least under one of ``BANDS`` hash orders and keeps them in text
order; texts with an equal sketch are candidates. So a candidate pair shares shingles in the
same order, which tells edit similarity and not just overlap. Candidates are verified by
alignment: the longest run of shingles that both texts hold in the same order, within the band
around the diagonal that the threshold leaves, over all shingles of either. Pairs with a
similarity of 0.8 or more are links; classes are the connected components of links and exact
copies.

Sketch lengths. For texts of more than ``SHORT`` shingles six are sampled, for those of up to
``SHORT_TO`` three; between the two, both are made, and since linked texts differ in size by a
quarter at most, each linked pair shares one kind. A pair at the threshold itself is missed by
all 32 sketches with a probability of some 6e-5 (long) or 2e-9 (short); above it, less.

How it scales: exact copies collapse first, by digest, with a combine before the shuffle, so
copies are one node however many. Within a bucket of equal sketches, pairs are formed with one
hub only, the member that meets most others in all its buckets, so a bucket of n gives n - 1
pairs. Where a bucket of up to ``SMALL`` members then still holds several classes, members of
different classes (and of sizes that can be linked at all) are paired too. In a larger one the
alignment with the hub tells which pairs can be links at all (``_rest_of_hubs``): a text that
is not linked to the hub shares too little with it, so that a link to another member needs
shingles common to the two that the hub lacks; these are joined by a prefix filter, rarest
first. So no link is lost, and no group's pairs are all formed. Components are found by
alternating large-star and small-star steps on tables; the driver sees counts only.

Defined results: a null text is in a class of its own. Texts without words are alike only if
equal. Equal texts are one class, also under repeated or null ids; the class id is the least
non-null id in the class (null if there is none). Very long texts are read whole, their shingles hashed in parts. Other
columns, whatever their names, are kept or not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marginflow.llm.common import numbered, short_batches, stored
from marginflow.llm.textbytes import labelled, mix, shingles, word_bytes

WIDTH = 5
THRESHOLD = 0.8
BANDS = 32
LONG, SHORT_LENGTH = 6, 3
#: Texts of more than SHORT shingles have long sketches, of up to SHORT_TO short ones;
#: SHORT <= THRESHOLD * SHORT_TO, so linked texts share one kind.
SHORT, SHORT_TO = 40, 50
#: Buckets of up to so many members are compared in full where classes remain.
SMALL = 32
#: Shingles whose matrix of hashes is made at once.
BLOCK = 50_000


def sketch(seq: np.ndarray, length: int, tag: int) -> np.ndarray:
    """BANDS keys, each of the ``length`` least shingles of one hash order in text order."""
    n, take = len(seq), min(length, len(seq))
    seeds = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(tag))
    picked = np.empty((BANDS, take), np.int64)
    step = max(1, BLOCK // n)
    for at in range(0, BANDS, step):
        s = seeds[at : at + step, None]
        v = (seq[None, :] ^ s) * (s | np.uint64(1))
        v ^= v >> np.uint64(32)
        v *= np.uint64(0x9FB21C651E98DF25)
        v ^= v >> np.uint64(29)
        picked[at : at + step] = np.argpartition(v, take - 1, axis=1)[:, :take] if take < n else np.arange(n)
    picked.sort(axis=1)
    got = seq[picked]
    key = seeds.copy()
    for j in range(take):
        key = (key ^ got[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return mix(key)


def keys_of(seq: np.ndarray) -> list[int]:
    n = len(seq)
    kinds = [(SHORT_LENGTH, 1)] * (0 < n <= SHORT_TO) + [(LONG, 2)] * (n > SHORT)
    return [int(k) for length, tag in kinds for k in sketch(seq, length, tag).view(np.int64)]


def similarity(a: np.ndarray, b: np.ndarray, least: float = THRESHOLD) -> float:
    """Aligned shingles over all shingles of either text; 0.0 where ``least`` is out of reach.

    Labelled shingles are distinct within a text, so the longest common subsequence is the
    longest increasing run of matched places, found by patience piles."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = n + m - 2 * need  # unmatched shingles that the threshold allows
    near = np.abs(ia - ib) <= band
    if near.sum() < need:
        return 0.0
    order = np.argsort(ia[near])
    at = ib[near][order]
    run = len(at)
    if run > 1 and (np.diff(at) < 0).any():
        from bisect import bisect_left

        tops: list[int] = []
        for x in at.tolist():
            k = bisect_left(tops, x)
            tops[k : k + 1] = [x]
        run = len(tops)
    return run / (n + m - run) if run >= need else 0.0


def _sequence(data: bytes) -> np.ndarray:
    return labelled(shingles(word_bytes(data), WIDTH))


def _digest(text_col: str):
    return F.substring(F.unhex(F.sha2(F.col(text_col).cast("binary"), 256)), 1, 16)


def sketches(docs: DataFrame, text_col: str) -> DataFrame:
    """A row per distinct text: digest, shingle count ``n`` and sketch keys."""
    short_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, keys = [], []
            for x in b.column(1):
                seq = _sequence(x.as_buffer().to_pybytes())
                n.append(len(seq))
                keys.append(keys_of(seq))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["digest", "n", "keys"])

    src = docs.filter(F.col(text_col).isNotNull()).select(_digest(text_col).alias("digest"), F.col(text_col).cast("binary").alias("_t"))
    return src.mapInArrow(run, "digest binary, n long, keys array<long>").dropDuplicates(["digest"])


def _compared(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Node pairs (a, b, wide): the number of shingles of b (``n``), those common with a
    (``common``), whether they are linked and, where ``wide``, the shingles of b that a lacks
    (``added``)."""
    short_batches(pairs.sparkSession, 64)
    d = nodes.select("node", "digest")
    p = pairs.join(d.withColumnsRenamed({"node": "a", "digest": "da"}), "a").join(d.withColumnsRenamed({"node": "b", "digest": "db"}), "b")
    p = p.join(texts.select(F.col("digest").alias("db"), F.col("t").alias("tb")), "db").join(texts.select(F.col("digest").alias("da"), F.col("t").alias("ta")), "da")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for b in batches:
            linked, n, common, added = [], [], [], []
            for wide, ta, tb in zip(b.column(2).to_pylist(), b.column(3), b.column(4), strict=True):
                raw = ta.as_buffer()
                if last[0] is None or not raw.equals(last[0]):
                    last = (raw, _sequence(raw.to_pybytes()))
                x = _sequence(tb.as_buffer().to_pybytes())
                linked.append(similarity(last[1], x) >= THRESHOLD)
                n.append(len(x))
                more = np.setdiff1d(x, last[1], assume_unique=True) if wide else x[:0]
                common.append(len(x) - len(more) if wide else 0)
                added.append(more.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(linked, pa.bool_()), pa.array(n, pa.int64()), pa.array(common, pa.int64()), pa.array(added, pa.list_(pa.int64()))],
                names=["a", "b", "linked", "n", "common", "added"],
            )

    return p.select("a", "b", "wide", "ta", "tb").mapInArrow(run, "a long, b long, linked boolean, n long, common long, added array<long>")


def _rest_of_hubs(seen: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes among the texts compared with one hub that can be
    links. ``seen`` has the comparisons with hubs of many partners (a: the hub).

    A link of x and y needs (n_x + n_y) * THRESHOLD / (1 + THRESHOLD) shingles in common. Of
    these the hub's are at most ``common`` of x, and of y; the rest must be among those that
    both add to the hub, ``need`` of them at least for the shortest partner x can have in the
    group. So of x's added shingles, rarest first, all but the last ``need - 1`` are joined
    with the added ones of the group (one that x alone adds joins nothing). Only two texts so
    far within the hub that its own shingles could make the link are paired without."""
    root = lambda c, name: roots.select(F.col("node").alias(c), F.col("root").alias(name))
    g = seen.join(root("b", "rb"), "b", "left").join(root("a", "ra"), "a", "left")
    g = g.select(F.col("a").alias("hub"), F.col("b").alias("x"), "n", "common", "added", F.coalesce("rb", "b").alias("root"), F.coalesce("ra", "a").alias("hub_root"))
    least = g.groupBy("hub").agg(F.min("n").alias("least"))
    part = THRESHOLD / (1 + THRESHOLD)
    g = g.join(least, "hub").withColumn("need", F.ceil((F.col("n") + F.greatest(F.col("least"), F.col("n") * THRESHOLD)) * part - F.col("common") - 1e-9))
    g = stored(g.drop("least"), "hub-groups")
    # a large group's shingles are spread over all tasks before they become rows
    added = g.repartition("hub", "x").select("hub", "x", "n", "root", F.explode("added").alias("e"))
    often = added.groupBy("hub", "e").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    added = stored(added.join(often, ["hub", "e"]), "hub-added")
    out = g.filter("root <> hub_root")
    mine = added.join(out.select("hub", "x", F.greatest("need", F.lit(1)).alias("need")), ["hub", "x"]).withColumn("k", F.row_number().over(Window.partitionBy("hub", "x").orderBy("f", "e")))
    shared = mine.groupBy("hub", "x").agg(F.count(F.lit(1)).alias("shared"))
    # the shingles that x alone adds come first in its order
    mine = mine.join(shared, ["hub", "x"]).filter(F.col("k") <= F.col("shared") - F.col("need") + 1).select("hub", "e", "x", "n", "root")
    other = lambda df: df.withColumnsRenamed({"x": "y", "n": "m", "root": "other"})
    by_shingle = mine.join(other(added.select("hub", "e", "x", "n", "root")), ["hub", "e"])
    within = (F.col("n") + F.col("m")) * part <= F.least("common", "common_y") + 1e-9
    weak = out.filter("need <= 0").select("hub", "x", "n", "root", "common").join(other(g.select("hub", "x", "n", "root", F.col("common").alias("common_y"))), "hub").filter(within)
    fits = (F.col("root") != F.col("other")) & (F.col("n") >= THRESHOLD * F.col("m")) & (F.col("m") >= THRESHOLD * F.col("n"))
    pair = lambda df: df.filter(fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return pair(by_shingle).union(pair(weak)).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node reached.

    Alternates large-star and small-star steps until the set of edges stays the same; each
    step is written, so the plan stays short."""
    e = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large, "stars")
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        e = stored(small.select("x.u", "x.v").filter("u <> v").distinct(), "stars")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``id_col`` and ``class_id``."""
    return _classes(docs, id_col, text_col).select(F.col("_id").alias(id_col), "class_id")


def _classes(docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    nodes = stored(sketches(docs, text_col).withColumn("node", F.monotonically_increasing_id()), "nodes")
    in_bucket = nodes.select("node", "n", F.explode("keys").alias("key"))
    texts = docs.filter(F.col(text_col).isNotNull()).select(_digest(text_col).alias("digest"), F.col(text_col).cast("binary").alias("t"))
    texts = texts.groupBy("digest").agg(F.first("t").alias("t"))

    sizes = in_bucket.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = stored(in_bucket.join(sizes, "key"), "buckets")
    meets = shared.groupBy("node").agg(F.sum("members").alias("meets"))
    hubs = shared.join(meets, "node").groupBy("key").agg(F.max(F.struct("meets", (-F.col("node")).alias("node"))).alias("hub"))
    hubs = hubs.select("key", (-F.col("hub.node")).alias("a"))
    tried = shared.join(hubs, "key").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    tried = stored(tried, "pairs")
    wide = tried.groupBy("a").agg((F.count(F.lit(1)) >= SMALL).alias("wide"))
    seen = stored(_compared(tried.join(wide, "a").select("a", "b", "wide"), nodes, texts), "compared")
    links = seen.filter("linked").select("a", "b")

    roots = components(links)
    named = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = named.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("key")
    left = stored(named.join(open_, "key", "left_semi"), "open-buckets")
    few = left.filter(F.col("members") <= SMALL)
    x = few.select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"))
    y = few.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"))
    alike = (F.col("na") >= THRESHOLD * F.col("nb")) & (F.col("nb") >= THRESHOLD * F.col("na"))
    rest = x.join(y, "key").filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & alike).select("a", "b")
    crowded = left.filter(F.col("members") > SMALL).select("key").distinct().join(hubs, "key").select("a").distinct()
    rest = rest.union(_rest_of_hubs(seen.join(crowded, "a", "left_semi"), roots)).distinct()
    both = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(rest.join(both, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        more = stored(_compared(rest.withColumn("wide", F.lit(False)), nodes, texts).filter("linked").select("a", "b"), "links")
        if not more.isEmpty():
            roots = components(links.union(more))

    extra = [] if row_col is None else [F.col(row_col).alias("_row")]
    rows = docs.select(F.col(id_col).alias("_id"), _digest(text_col).alias("digest"), *extra)
    known = rows.filter("digest is not null")
    aggs = [F.min("_id").alias("first_id")] + ([] if row_col is None else [F.min("_row").alias("first_row")])
    by_text = known.groupBy("digest").agg(*aggs).join(nodes.select("digest", "node"), "digest").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    top = by_text.groupBy("root").agg(F.min("first_id").alias("class_id"), *([] if row_col is None else [F.min("first_row").alias("keep_row")]))
    cls = by_text.select("digest", "root").join(top, "root").drop("root")
    out = known.join(cls, "digest", "left").drop("digest")
    alone = rows.filter("digest is null").select("_id", *([] if row_col is None else ["_row"]), F.col("_id").alias("class_id"), *([] if row_col is None else [F.col("_row").alias("keep_row")]))
    return out.unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the same on every reading. All columns are kept as they
    are."""
    rows, row = numbered(docs, "_near_row")
    keep = stored(_classes(rows, id_col, text_col, row).filter("_row = keep_row").select(F.col("_row").alias(row)), "kept-rows")
    return rows.join(keep, row, "left_semi").drop(row)
