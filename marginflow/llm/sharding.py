"""Shards of near-equal bytes by best-fit-decreasing bin packing.

Documents with equal texts form an indivisible group. Groups enter, largest first, the bin
with the tightest remaining capacity that still takes them; the bins stand in a balanced
search tree ordered by remaining capacity. The capacity is the least for which so many bins
suffice, found by bisection.

How it scales: every group is packed, none by a hash. Groups of equal size are alike to the
packing, so it sees the number of groups of each size: a run of equal groups fills the
tightest bin until the next no longer fits, then the next tightest, which is what
best-fit-decreasing does with them one by one. Sizes above 2048 are rounded up to eleven
binary digits (by less than a thousandth), so at most 1,024 sizes for each doubling reach the
driver at any input size, some 43,000 up to a petabyte. The groups of a size are numbered, in
sub-buckets shifted by their running counts, and each bin takes its stretch of the numbers.
A row finds its group's bin by a join on the text's digest; groups with more than ``1 / (FINE
* n_shards)`` of all bytes or rows, at most ``2 * FINE * n_shards`` of them, are joined by
broadcast instead, so that no hot key is shuffled. Only a group larger than a whole shard is
divided, by the hash of its rows, since no fixed-capacity shard can hold it. Slots are
numbered within sub-buckets too, so that no shard is sorted in one task.

Defined results: a null text has no bytes (size ``OVERHEAD``) and forms a group apart from
the empty text. Repeated rows are rows of their own; a null id is placed like any other. Ties
between equal sizes are broken by key. Only the bytes of a text count, however long it is. Other
columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marginflow.llm.common import stored

OVERHEAD = 16
#: Groups above this part of a shard, in bytes or rows, find their bin by broadcast.
FINE = 64
#: Binary digits of a size that the packing tells apart.
DIGITS = 11
#: A group larger than a shard is divided into parts of this share of one.
PART = 16
#: Rows (or groups) of a sub-bucket, about.
SLOT_ROWS = 50_000


class BinTree:
    """Bins by (remaining capacity, number) in a treap: insert, remove, and least entry whose
    remaining capacity is at least a size, each in logarithmic time."""

    def __init__(self) -> None:
        self.root = None

    @staticmethod
    def _rank(key: tuple) -> int:
        return hash((key[0] * 2654435761 + key[1] * 40503) & 0xFFFFFFFFFFFF)

    def add(self, key: tuple) -> None:
        def put(t):
            if t is None:
                return [key, self._rank(key), None, None]
            side = 2 if key < t[0] else 3
            t[side] = child = put(t[side])
            if child[1] > t[1]:  # rotate the child up
                t[side], child[5 - side] = child[5 - side], t
                return child
            return t

        self.root = put(self.root)

    def remove(self, key: tuple) -> None:
        def joined(a, b):
            if a is None or b is None:
                return a or b
            if a[1] > b[1]:
                a[3] = joined(a[3], b)
                return a
            b[2] = joined(a, b[2])
            return b

        def cut(t):
            if t[0] == key:
                return joined(t[2], t[3])
            side = 2 if key < t[0] else 3
            t[side] = cut(t[side])
            return t

        self.root = cut(self.root)

    def tightest(self, size: int) -> tuple | None:
        t, best = self.root, None
        while t is not None:
            if t[0][0] >= size:
                best, t = t[0], t[2]
            else:
                t = t[3]
        return best


def best_fit_decreasing(items: list[tuple[int, str]], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each item (sorted by falling size), opening bins as needed; None where more
    than ``most`` bins would be needed or an item exceeds the capacity."""
    tree, n, out = BinTree(), 0, []
    for size, _ in items:
        found = tree.tightest(size)
        if found is None:
            if size > capacity or (most is not None and n == most):
                return None
            found = (capacity, n)
            n += 1
        else:
            tree.remove(found)
        tree.add((found[0] - size, found[1]))
        out.append(found[1])
    return out


def best_fit_runs(runs: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """Best-fit-decreasing of ``runs`` (size, number of items) by falling size: (size, bin,
    number) in the order of placing; None as in ``best_fit_decreasing``."""
    tree, n, out = BinTree(), 0, []
    for size, left in runs:
        if size > capacity:
            return None
        while left:
            found = tree.tightest(size)
            if found is None:
                if most is not None and n == most:
                    return None
                found = (capacity, n)
                n += 1
            else:
                tree.remove(found)
            take = min(left, found[0] // size)
            tree.add((found[0] - take * size, found[1]))
            out.append((size, found[1], take))
            left -= take
    return out


def fewest_capacity(runs: list[tuple[int, int]], n_bins: int, tries: int = 14) -> tuple[int, list[tuple[int, int, int]]]:
    """The least capacity that bisection finds for ``n_bins`` bins, and its packing."""
    if not runs:
        return 0, []
    low = max(math.ceil(sum(s * c for s, c in runs) / n_bins), runs[0][0])
    high = low + runs[0][0]
    while (best := best_fit_runs(runs, high, n_bins)) is None:
        high *= 2
    for _ in range(tries):
        if low >= high:
            break
        mid = (low + high) // 2
        got = best_fit_runs(runs, mid, n_bins)
        if got is None:
            low = mid + 1
        else:
            high, best = mid, got
    return high, best


def size_class(size: Column) -> Column:
    """The size rounded up to ``DIGITS`` binary digits."""
    step = F.pow(F.lit(2), F.greatest(F.length(F.bin(size)) - DIGITS, F.lit(0))).cast("long")
    return (F.ceil(size / step) * step).cast("long")


def numbered(df: DataFrame, keys: list[str], order: str, rows: int, n_keys: int) -> DataFrame:
    """Adds ``number``, gapless from 0 within each value of ``keys``: local numbers within
    sub-buckets of about ``SLOT_ROWS``, shifted by the counts of those before. ``rows`` is the
    number of rows, ``n_keys`` a number of values among which they are about even (1: unknown)."""
    subs = max(1, math.ceil(rows / (n_keys * SLOT_ROWS)))
    cut = df.withColumn("sub", F.pmod(F.xxhash64(order), F.lit(subs)))
    counts = cut.groupBy(*keys, "sub").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy(*keys).orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = counts.select(*keys, "sub", before.alias("before"))
    local = F.row_number().over(Window.partitionBy(*keys, "sub").orderBy(order))
    out = cut.withColumn("local", local).join(shift, [*keys, "sub"])
    return out.withColumn("number", F.col("before") + F.col("local") - 1).drop("sub", "local", "before")


def place_groups(items: DataFrame, n_shards: int) -> DataFrame:
    """``shard`` for each row (item, bytes) of ``items``, a stored table."""
    spark = items.sparkSession
    items = items.withColumn("class", size_class(F.col("bytes")))
    runs = [(int(r["class"]), int(r["n"])) for r in items.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()]
    runs.sort(reverse=True)
    taken: dict[int, int] = {}
    cells = []
    for size, shard, n in fewest_capacity(runs, n_shards)[1]:
        first = taken.get(size, 0)
        cells.append((size, shard, first, first + n))
        taken[size] = first + n
    # a size ends in a bin once, and one bin more for each that it fills: a bounded table
    cells = F.broadcast(spark.createDataFrame(cells, "class long, shard int, first long, past long"))
    ranked = numbered(items, ["class"], "item", sum(n for _, n in runs), 1)
    at = (ranked["class"] == cells["class"]) & (ranked["number"] >= cells["first"]) & (ranked["number"] < cells["past"])
    return ranked.join(cells, at).select("item", "shard")


def assign_shards(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, ``size``, ``text_crc32``, ``shard`` and ``slot``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"").cast("binary"))
    base = docs.select(
        F.col(id_col).alias(id_col),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.sha2(F.col(text_col).cast("binary"), 256), F.lit("null")).alias("text_key"),
        F.monotonically_increasing_id().alias("row"),
    )
    base = stored(base, "shard-rows")
    all_rows = base.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    total, rows = int(all_rows["b"] or 0), int(all_rows["n"])
    shard_bytes = max(1, total // n_shards)
    groups = stored(base.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    hot = (F.col("bytes") * (FINE * n_shards) > total) | (F.col("n") * (FINE * n_shards) > rows)
    parts = F.when(F.col("bytes") > shard_bytes, F.ceil(F.col("bytes") * PART / F.lit(shard_bytes))).otherwise(1).cast("int")
    # at most 2 * FINE * n_shards rows
    big = F.broadcast(groups.filter(hot).select("text_key", parts.alias("parts")))
    item = F.concat(F.col("text_key"), F.lit("/"), F.pmod(F.xxhash64("row"), F.col("parts")).cast("string"))
    of_hot = base.join(big, "text_key").withColumn("item", item)
    of_rest = base.join(big, "text_key", "left_anti").withColumnRenamed("text_key", "item")
    items = groups.filter(~hot).select(F.col("text_key").alias("item"), "bytes")
    items = stored(items.unionByName(of_hot.groupBy("item").agg(F.sum("size").alias("bytes"))), "shard-items")
    place = stored(place_groups(items, n_shards), "shard-places")
    # at most 2 * FINE * n_shards + (PART + 1) * n_shards rows
    place_hot = F.broadcast(place.filter(F.col("item").contains("/")))
    cols = [id_col, "size", "text_crc32", "row", "shard"]
    placed = of_hot.join(place_hot, "item").select(cols).unionByName(of_rest.join(place, "item").select(cols))
    out = numbered(placed, ["shard"], "row", rows, n_shards)
    return out.select(id_col, "size", "text_crc32", "shard", F.col("number").alias("slot"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Writes each document's columns under ``shard=N`` folders; ids must be unique."""
    docs.join(assigned.select(id_col, "shard", "slot"), id_col).write.partitionBy("shard").parquet(path)
