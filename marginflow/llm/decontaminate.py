"""Benchmark passages in documents, by a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` consecutive words (a shorter item is one window).
A window is a set of shingles of ``SHINGLE`` words; a document holds the window only if it
holds each of its shingles. So, with the shingles ordered by rarity over all documents, the
necessary prefix is one: the rarest. The join is on that shingle; the place of the shingle in
the window gives the only start possible (the positional bound), which must leave room for
the window before the document's end (the length bound); the words there are then compared.

How it scales: one pass over the texts makes a small table: per document its word count and
the places where any benchmark shingle stands, with the words around. Counts, join and check
run on that table alone. The benchmark's shingles steer the pass as a literal set, up to
``SET_SHINGLES`` of them (``SET_SHINGLES`` 64-bit hashes); a larger benchmark takes the other
way, in which all shingles of all documents meet the benchmark's in a shuffled join. All
steps are DataFrame functions.

Defined results: a null text has no words; an item without words has no windows. Words are
runs of letters, digits and code points above ASCII; A-Z count as a-z. Repeated rows and ids
are rows of their own; equal items each count, items with one id once. An empty benchmark
leaves all documents clean; an empty table of documents gives no rows. Very long texts are read
whole. Equally rare shingles stand by their place. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marginflow.llm.common import stored

WINDOW = 10
SHINGLE = 3
#: Benchmarks of up to so many distinct shingles are held as a literal set.
SET_SHINGLES = 100_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z as a-z and nothing else folded; none for null."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    ascii_ = F.octet_length(t) == F.char_length(t)
    return F.regexp_extract_all(F.when(ascii_, F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER)), F.lit(WORD), F.lit(0))


def _windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(win, len, size, off, sh): per distinct window its words as one string, their number,
    its shingles' width, and each shingle with its offset."""
    w = benchmark.select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - F.lit(WINDOW), F.lit(0))
    w = w.withColumn("at", F.explode(F.sequence(F.lit(0), last)))
    w = w.select("item", F.slice("w", F.col("at") + 1, F.lit(WINDOW)).alias("w"))
    return w.select("item", F.concat_ws(" ", "w").alias("win"), F.size("w").alias("len"))


def _shingles(win: DataFrame) -> DataFrame:
    w = win.select("win", "len").distinct().withColumn("w", F.split("win", " ")).withColumn("k", F.least(F.col("len"), F.lit(SHINGLE)))
    w = w.withColumn("off", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("k"))))
    return w.select("win", "len", "k", "off", F.concat_ws(" ", F.slice("w", F.col("off") + 1, F.col("k"))).alias("sh"))


def _hash(k: int, word_at) -> Column:
    return F.xxhash64(*[word_at(j) for j in range(k)])


def document_shingles(docs: DataFrame, id_col: str, text_col: str, shingles: DataFrame) -> DataFrame:
    """(row, id, n_words, hits): ``hits`` are (pos, sh, before, around) of the benchmark's
    shingles in a document; ``around`` has the words up to WINDOW - 1 before and after."""
    kinds = [r["k"] for r in shingles.select("k").distinct().collect()]  # 1 to SHINGLE
    distinct = shingles.select("k", "sh").distinct()
    small = distinct.limit(SET_SHINGLES + 1).count() <= SET_SHINGLES
    d = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w")).withColumn("row", F.monotonically_increasing_id())
    n = F.size("w")
    if not small:
        return _joined_shingles(d, distinct, kinds)
    found = []
    for k in kinds:
        of_k = distinct.filter(F.col("k") == k).withColumn("w", F.split("sh", " "))
        hashes = [r["h"] for r in of_k.select(_hash(k, lambda j: F.col("w")[j]).alias("h")).distinct().collect()]
        grams = F.arrays_zip(*[F.slice("w", j + 1, F.greatest(n - (k - 1), F.lit(0))).alias(f"g{j}") for j in range(k)], F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))).alias("at"))
        # the sequence has one element where the text is too short: an incomplete shingle
        grams = F.filter(grams, _among(k, hashes))
        found.append(F.when(n >= k, F.transform(grams, _place(k))).otherwise(F.array().cast("array<struct<pos:int,k:int>>")))
    places = F.concat(*found) if found else F.array().cast("array<struct<pos:int,k:int>>")
    d = d.select("row", "id", n.alias("n_words"), "w", places.alias("p"))
    return d.select("row", "id", "n_words", F.transform("p", lambda x: _hit(x.getField("pos"), x.getField("k"))).alias("hits"))


def _among(k: int, hashes: list[int]):
    return lambda s: _hash(k, lambda j: s.getField(f"g{j}")).isin(hashes)


def _place(k: int):
    return lambda s: F.struct(s.getField("at").alias("pos"), F.lit(k).alias("k"))


def _hit(pos: Column, k: Column) -> Column:
    before = F.least(pos, F.lit(WINDOW - 1))
    return F.struct(
        pos.alias("pos"),
        F.concat_ws(" ", F.slice("w", pos + 1, k)).alias("sh"),
        before.alias("before"),
        F.slice("w", pos - before + 1, before + F.lit(WINDOW)).alias("around"),
    )


def _joined_shingles(d: DataFrame, distinct: DataFrame, kinds: list[int]) -> DataFrame:
    """The same for a benchmark of any size: all shingles of the documents, by shuffled join."""
    d = stored(d, "words")
    n, found = F.size("w"), None
    for k in kinds:
        grams = F.arrays_zip(*[F.slice("w", j + 1, n - (k - 1)).alias(f"g{j}") for j in range(k)])
        e = d.filter(n >= k).select("row", F.posexplode(grams).alias("pos", "g")).select("row", "pos", F.concat_ws(" ", *[F.col("g").getField(f"g{j}") for j in range(k)]).alias("sh"))
        e = e.join(distinct.filter(F.col("k") == k).select("sh"), "sh", "left_semi").select("row", "pos", F.lit(k).alias("k"))
        found = e if found is None else found.union(e)
    if found is None:
        return d.select("row", "id", n.alias("n_words"), F.array().cast("array<struct<pos:int,sh:string,before:int,around:array<string>>>").alias("hits"))
    p = found.groupBy("row").agg(F.collect_list(F.struct("pos", "k")).alias("p"))
    d = d.join(p, "row", "left").withColumn("p", F.coalesce("p", F.array().cast("array<struct<pos:int,k:int>>")))
    return d.select("row", "id", n.alias("n_words"), F.transform("p", lambda x: _hit(x.getField("pos"), x.getField("k"))).alias("hits"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row per document: ``row``, id, ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted
    as strings), ``spans`` of hit words (pos, len) and ``contaminated``."""
    windows = stored(_windows(benchmark, item_col, item_text_col), "windows")
    shingles = stored(_shingles(windows), "shingles")
    rows = stored(document_shingles(docs, id_col, text_col, shingles), "doc-shingles")
    hits = rows.filter(F.size("hits") > 0).select("row", "n_words", F.explode("hits").alias("x")).select("row", "n_words", "x.*")
    rarity = hits.groupBy("sh").agg(F.count(F.lit(1)).alias("freq"))
    order = Window.partitionBy("win").orderBy(F.coalesce("freq", F.lit(0)), "off")
    prefix = shingles.join(rarity, "sh", "left").withColumn("rank", F.row_number().over(order)).filter("rank = 1").select("win", "len", "off", "sh")
    start = F.col("pos") - F.col("off")
    here = F.concat_ws(" ", F.slice("around", F.col("before") - F.col("off") + 1, F.col("len")))
    at = hits.join(prefix, "sh").filter((start >= 0) & (start + F.col("len") <= F.col("n_words"))).filter(here == F.col("win"))
    at = stored(at.select("row", start.alias("pos"), "len", "win"), "window-places")
    span = at.select("row", "pos", "len").distinct().groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "len"))).alias("spans"))
    items = at.select("row", "win").distinct().join(windows.select("win", "item").distinct(), "win").select("row", F.col("item").cast("string").alias("item")).distinct()
    items = items.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    # spans stand by start, so each adds what lies beyond the last end
    grow = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a.getField("end"), s.getField("pos") + s.getField("len")).alias("end"),
            (a.getField("n") + F.greatest(F.lit(0), s.getField("pos") + s.getField("len") - F.greatest(a.getField("end"), s.getField("pos")))).alias("n"),
        ),
        lambda a: a.getField("n"),
    )
    out = rows.select("row", "id", "n_words").join(span.join(items, "row", "left"), "row", "left")
    return out.select(
        "row", F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), F.coalesce(grow, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<pos:int,len:int>>")).alias("spans"), F.col("spans").isNotNull().alias("contaminated"),
    )
