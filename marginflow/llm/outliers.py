"""Robust multivariate outliers over text statistics.

Each text gives a vector of counts (``text_counts``). Hard rules reject what is plainly no
prose (``base_failed``). Of the rest, transformed statistic vectors are compared with others
of their language and source: the minimum-covariance-determinant estimate of centre and
scatter is found by concentration steps, and a text whose robust Mahalanobis distance passes
a chi-square quantile is rejected.

How it scales: counting is one pass over the texts; what follows reads only the small vector
table. Distinct texts are found by digest, combined before the shuffle. A concentration step is one aggregate of sums and products per (language, source),
combined before the shuffle, so a source with a third of all rows is no hot task, and one
approximate quantile per group. Group estimates are solved by Python in parallel, a row per
group.

Defined results: a null or empty text has no words, so it fails the base rules and is not
kept. Null language or source is a group like any other. A group with fewer than
``MIN_GROUP`` vectors takes the estimate of its language, and a language with fewer that of
all texts; with fewer than that in all, nothing but the base rules rejects. Ties in distance
share one verdict. Estimates are fitted on distinct texts, each once per group, so that copies
pull no centre or scatter onto themselves; every row is judged, repeated ones alike. Very long texts are read whole. Other columns, whatever
their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import short_batches, stored

#: Base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
#: A group needs so many vectors for an estimate of its own.
MIN_GROUP = 60
#: The part of a group that the concentration steps keep.
KEPT_PART = 0.75
STEPS = 6
#: Chi-square quantiles for four degrees of freedom: the median of the kept part's cutoff
#: (0.75) and the cutoff of a verdict (upper tail 1e-9).
CHI2_KEPT = 5.385
CHI2_CUTOFF = 46.0
#: Least standard deviations of the vector's parts, in their own units; a part that is the
#: same in most texts would else make any other value infinitely far.
FLOOR = (0.25, 0.2, 0.5, 0.15)
DIM = len(FLOOR)

COUNTS_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
#: The column that tells texts apart where estimates are fitted.
DIGEST = "_text_digest"


def counts_of(data: bytes) -> tuple[int, int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows, lines
    with a word."""
    words = data.split()  # for bytes: \x20 and \x09-\x0D
    n = len(words)
    if not n:
        return 0, 0, len(data) - len(data.translate(None, SYMBOLS)), 0, 0, 0
    chars = len(data.translate(None, SPACE).decode("utf-8", "replace"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return n, chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words), len(lines)


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more, the first included."""
    m = len(words) - width + 1
    if m < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    key, room = ids[:m].copy(), len(seen)
    if room**width < 2**62:  # exact as one number
        for j in range(1, width):
            key = key * room + ids[j : j + m]
    else:  # exact by ranks: pairs, then pairs of pairs, then the last word
        pair = np.unique(ids[:-1] * room + ids[1:], return_inverse=True)[1]
        top = int(pair.max()) + 1
        four = np.unique(pair[:-2] * top + pair[2:], return_inverse=True)[1]
        key = four[:m] * room + ids[width - 1 :]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:m] += twice
    edge[width : width + m] -= twice
    return int(np.count_nonzero(np.cumsum(edge)))


def text_counts(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep``, the counts and the digest of every whole text."""
    short_batches(docs.sparkSession)
    src = docs.select(*keep, F.col(text_col).cast("binary").alias("_text"))
    out_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [COUNTS_SCHEMA, f"`{DIGEST}` binary"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
        for b in batches:
            rows, digests = [], []
            for x in b.column(b.num_columns - 1):
                data = x.as_buffer().to_pybytes() if x.is_valid else b""
                rows.append(counts_of(data))
                digests.append(blake2b(data, digest_size=16).digest())
            cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols, pa.array(digests, pa.binary())], names=[*b.schema.names[:-1], *names, DIGEST])

    return src.mapInArrow(count, out_schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _vector() -> list[Column]:
    """Length, word length, share of symbols (per thousand, log), share of repeated content."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)).cast("double"), F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return [
        F.log1p(n),
        F.log(c / n),
        F.log1p(F.col("n_symbols") * 1000.0 / c),
        F.sqrt(F.col("n_repeat_words") / n) * 0.5 + F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))) * 0.5,
    ]


def _distance(centre: str = "centre", inverse: str = "inverse") -> Column:
    d = [F.col(f"x{i}") - F.col(centre)[i] for i in range(DIM)]
    total = F.lit(0.0)
    for i in range(DIM):
        for j in range(i, DIM):
            total = total + d[i] * d[j] * F.col(inverse)[i * DIM + j] * (1.0 if i == j else 2.0)
    return total


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(DIM)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i in range(DIM) for j in range(i, DIM)]]


def _solve(sums: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """A row per group: centre and inverse scatter (times ``scale``, floored)."""
    schema = ", ".join([*[f"{k} string" for k in keys], "n long", "centre array<double>", "inverse array<double>"])

    def solve(frames):
        import pandas as pd

        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                n = max(1, int(r.n))
                mu = np.array([getattr(r, f"s{i}") for i in range(DIM)]) / n
                cov = np.empty((DIM, DIM))
                for i in range(DIM):
                    for j in range(i, DIM):
                        cov[i, j] = cov[j, i] = getattr(r, f"p{i}_{j}") / n - mu[i] * mu[j]
                cov = cov * scale
                val, vec = np.linalg.eigh(cov / np.outer(FLOOR, FLOOR))
                cov = (vec * np.maximum(val, 1.0)) @ vec.T * np.outer(FLOOR, FLOOR)
                out.append([*[getattr(r, k) for k in keys], int(r.n), mu.tolist(), np.linalg.inv(cov).ravel().tolist()])
            yield pd.DataFrame(out, columns=[*keys, "n", "centre", "inverse"])

    return sums.mapInPandas(solve, schema)


def robust_estimates(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """The minimum-covariance-determinant estimate of each group of ``keys`` (string columns
    without nulls) over the columns x0, x1, ...: concentration steps from the median.

    Each step keeps the ``KEPT_PART`` nearest vectors of a group. The quantile is a mergeable
    sketch of relative error 1/1000 in rank, the same at any size."""
    start = vectors.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.percentile_approx(f"x{i}", 0.5, 1000) for i in range(DIM)]).alias("centre"),
    )
    start = start.withColumn("inverse", F.array(*[F.lit(1.0 / FLOOR[i] ** 2 if i == j else 0.0) for i in range(DIM) for j in range(DIM)]))
    estimate = stored(start, "mcd")
    for step in range(STEPS):
        near = vectors.join(F.broadcast(estimate) if _few(estimate) else estimate, keys).withColumn("d", _distance())
        cut = near.groupBy(*keys).agg(F.percentile_approx("d", KEPT_PART, 1000).alias("cut"))
        cut = stored(cut, "mcd-cut")
        kept = near.join(F.broadcast(cut) if _few(cut) else cut, keys).filter("d <= cut")
        # the kept part's scatter is too small by a known factor, that of a truncated normal
        scale = 1.0 if step < STEPS - 1 else _consistency()
        estimate = stored(_solve(kept.groupBy(*keys).agg(*_sums()), keys, scale), "mcd")
    return estimate


#: A table of group estimates of at most so many rows (some 250 bytes each) is broadcast;
#: larger ones are joined by shuffle.
FEW_GROUPS = 20_000


def _few(groups: DataFrame) -> bool:
    return groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS


def _consistency() -> float:
    """KEPT_PART over P(chi2 with DIM + 2 degrees of freedom <= CHI2_KEPT)."""
    x = CHI2_KEPT / 2
    return KEPT_PART / (1 - np.exp(-x) * (1 + x + x * x / 2))


def judge(counts: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Adds ``base_failed``, ``distance`` (null where none was computed) and ``kept``; drops
    the digest."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    v = counts.withColumn("base_failed", base_failed()).withColumns({"_lang": name(lang_col), "_source": name(source_col)})
    v = v.withColumns({f"x{i}": x for i, x in enumerate(_vector())})
    fit = v.filter(~F.col("base_failed")).select("_lang", "_source", DIGEST, *[f"x{i}" for i in range(DIM)])
    # one table for the three levels: a group too small for an estimate takes the wider one's
    levels = fit.withColumn("_at", F.explode(F.array(
        F.struct(F.col("_lang").alias("l"), F.col("_source").alias("s")), F.struct(F.col("_lang").alias("l"), F.lit("*").alias("s")), F.struct(F.lit("*").alias("l"), F.lit("*").alias("s")),
    ))).select(F.col("_at.l").alias("l"), F.col("_at.s").alias("s"), DIGEST, *[f"x{i}" for i in range(DIM)])
    # equal texts have equal vectors: any of them stands for all
    levels = levels.groupBy("l", "s", DIGEST).agg(*[F.max(f"x{i}").alias(f"x{i}") for i in range(DIM)]).drop(DIGEST)
    levels = stored(levels, "vectors")
    est = robust_estimates(levels, ["l", "s"]).filter(F.col("n") >= int(MIN_GROUP * KEPT_PART)).select("l", "s", F.struct("centre", "inverse").alias("e"))
    few = F.broadcast if _few(est) else (lambda x: x)
    top = est.filter("l = '*'").first()  # one row
    widest = F.lit(None) if top is None else F.struct(*[F.array(*map(F.lit, top["e"][k])).alias(k) for k in ("centre", "inverse")])
    j = v.join(few(est.filter("s <> '*'").withColumnsRenamed({"l": "_lang", "s": "_source", "e": "e0"})), ["_lang", "_source"], "left")
    j = j.join(few(est.filter("l <> '*' and s = '*'").select(F.col("l").alias("_lang"), F.col("e").alias("e1"))), "_lang", "left")
    j = j.withColumn("_e", F.coalesce("e0", "e1", widest.cast("struct<centre:array<double>,inverse:array<double>>")))
    j = j.withColumns({"centre": F.col("_e.centre"), "inverse": F.col("_e.inverse")})
    j = j.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CHI2_CUTOFF, F.lit(True))
    return j.withColumn("kept", kept).select(*[c for c in counts.columns if c != DIGEST], "base_failed", "distance", "kept")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """A row per document: id, language, source, the counts, ``base_failed``, ``distance``,
    ``kept``."""
    counts = stored(text_counts(docs, text_col, (id_col, lang_col, source_col)), "counts")
    return judge(counts, lang_col, source_col)
