"""Personal data by candidate gradient boosting, in DataFrame functions.

High-recall generators propose spans, which may overlap: the four base patterns, and wider
ones for handles, numbers and secrets. Each candidate has format features (generator, digits,
length, characters, separators, check digit, octets) and context features (words before it,
characters at its ends). Boosted trees of depth two score candidates; the threshold is the
least score at which held-out precision reaches ``PRECISION``. Spans of base kinds that pass
their checks always stay; a scored candidate is added where no base span lies.

Fitting. There are no hand labels, so labels are weak: a candidate is positive if it lies in a
valid base span or has the form of a stated credential. Candidates with equal features are one
weighted row, counted over all documents, halved by a hash of the text into fitting and
calibration. Features are bucketed, so the rows that reach the driver are few; the most
frequent ``FIT_ROWS`` of the fitting half at most are used (the bound of the fitting sample).
The trees then are ``CASE`` expressions. Counting, calibration, scoring and selection cover all
data: the threshold is read from running sums over every held-out candidate, on Spark.

How it scales: one pass over the texts writes the candidates, with a few characters around
them, to a small table; all else runs on that table. Offsets are running sums per text. No
Python runs on the executors.

Defined results: a null text is empty. Offsets are code points, the end exclusive. Matching
is leftmost and non-overlapping per kind; a match that fails its check is dropped and not
tried again. Rows with repeated or null ids each have their own result. The patterns hold no
nested backtracking, so very long texts and runs take time in proportion. Spans that start at one
place stand in the order of their kinds. Other columns, whatever their names, are kept or not read.
An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marginflow.llm.common import numbered, stored

PRECISION = 0.99
#: Distinct feature vectors that fitting uses at most, the most frequent first; calibration uses all.
FIT_ROWS = 50_000
#: Blocks of scores in one unit, for the running sums of calibration.
BLOCKS = 64
ROUNDS, RATE, DEPTH, LEAST_WEIGHT = 16, 0.4, 2, 2.0
#: Code points of context kept before and after a candidate.
BEFORE, AFTER = 24, 4

#: kind: (what a text must hold, pattern). The base kinds' patterns are the contract's, with
#: look-behinds and possessive quantifiers where these give the same matches without
#: scanning a run again from each of its characters.
KINDS: dict[str, tuple[str, str]] = {
    "email": ("@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": ("9", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": ("9", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "handle": ("@", r"(?<![^\s<>\"@])[^\s<>\"@]++@[^\s<>\"@]++"),
    "number": ("9", r"(?<![A-Za-z0-9])\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+(?![A-Za-z0-9])"),
    "secret": ("9", r"(?<![A-Za-z0-9_/+-])(?:(?:password|passwd|pwd|token|secret|api[_-]?key)\x20?[=:]\x20?\"?)?+[A-Za-z0-9_/+-]{16,}+\"?"),
}
BASE = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
TAGS = {k: f"[{k.upper()}]" for k in KINDS}


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1))),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, _digit(back, i)).otherwise(2 * _digit(back, i) - F.when(_digit(back, i) > 4, 9).otherwise(0)),
    )
    return total % 10 == 0


def _digit(s: Column, i: Column) -> Column:
    return F.coalesce(F.substring(s, i, F.lit(1)).try_cast("int"), F.lit(0))


def _octets(m: Column) -> Column:
    return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")


def _has(text: Column, what: str) -> Column:
    return text.rlike("[0-9]") if what == "9" else F.instr(text, what) > 0


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, fold, found): every text's candidates, as (kind, i, gap, before, match,
    after), where ``gap`` is the code points between the match before and this one."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), t.alias("t")).withColumn("row", F.monotonically_increasing_id())
    none = F.array().cast("array<string>")
    cols = []
    for k, (what, pattern) in KINDS.items():
        there = _has(F.col("t"), what)
        cols.append(F.when(there, F.split("t", pattern, -1)).otherwise(none).alias(f"p_{k}"))
        cols.append(F.when(there, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none).alias(f"m_{k}"))
    fold = F.pmod(F.xxhash64("t"), F.lit(2)).cast("int")
    d = d.select("row", "id", fold.alias("fold"), *cols)
    return d.select("row", "id", "fold", F.concat(*[F.transform(f"m_{k}", _candidate(k)) for k in KINDS]).alias("found"))


def _candidate(kind: str) -> Callable[[Column, Column], Column]:
    def make(m: Column, i: Column) -> Column:
        piece = F.get(F.col(f"p_{kind}"), i)
        return F.struct(
            F.lit(ORDER[kind]).alias("kind"), i.alias("i"), F.char_length(piece).alias("gap"), F.substring(piece, -BEFORE, BEFORE).alias("before"),
            m.alias("match"), F.substring(F.get(F.col(f"p_{kind}"), i + 1), 1, AFTER).alias("after"),
        )

    return make


def _bucket(x: Column, *edges: int) -> Column:
    out = F.lit(len(edges))
    for k in reversed(range(len(edges))):
        out = F.when(x < edges[k], k).otherwise(out)
    return out.cast("int")


def _flag(x: Column) -> Column:
    return F.coalesce(x, F.lit(False)).cast("int")


def _features() -> dict[str, Column]:
    m, b, a = F.col("match"), F.lower(F.col("before")), F.col("after")
    word = F.when(b.rlike(r"(?:tel|phone|call|mobile|fax)\W*$"), 1).when(b.rlike(r"mail\W*$"), 2).when(b.rlike(r"(?:card|visa|account|iban)\W*$"), 3)
    word = word.when(b.rlike(r"(?:password|passwd|pwd|token|secret|key)[\"'\s]*[=:][\"'\s]*$"), 4).when(b.rlike(r"(?:ip|host|address)\W*$"), 5).otherwise(0)
    return {
        "f_kind": F.col("kind"),
        "f_digits": _bucket(F.char_length("digits"), 1, 4, 7, 10, 12, 14, 16, 17, 20),
        "f_length": _bucket(F.char_length(m), 8, 12, 16, 20, 24, 32, 41),
        "f_lower": _flag(m.rlike("[a-z]")),
        "f_upper": _flag(m.rlike("[A-Z]")),
        "f_hex": _flag(m.rlike(r"[\"=:\x20]?[0-9a-f]{16,}\"?$")),
        "f_stated": _flag(m.rlike(r"^(?:password|passwd|pwd|token|secret|api[_-]?key)\x20?[=:]")),
        "f_prefix": _flag(m.rlike(r"^(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{16,})")),
        "f_plus": _flag(m.startswith("+")),
        "f_dots": _bucket(F.char_length(m) - F.char_length(F.replace(m, F.lit("."))), 1, 2, 3, 4),
        "f_space": _bucket(F.char_length(m) - F.char_length(F.regexp_replace(m, r"[\x20()-]", "")), 1, 2, 4),
        "f_domain": _flag(m.rlike(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$")),
        "f_luhn": _flag((F.char_length("digits") >= 14) & _luhn(F.col("digits"))),
        "f_octets": _flag(_octets(m)),
        "f_word": word.cast("int"),
        "f_left": _flag(b.rlike(r"[a-z0-9]$")),
        "f_right": _flag(a.rlike(r"^[A-Za-z0-9]")),
    }


def spans_of(found: DataFrame) -> DataFrame:
    """(row, fold, kind, s, e, ok, features...): candidates with offsets; ``ok`` marks spans of
    base kinds that pass their checks."""
    c = found.filter(F.size("found") > 0).select("row", "fold", F.explode("found").alias("x")).select("row", "fold", "x.*")
    run = F.sum(F.col("gap") + F.char_length("match")).over(Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    c = c.withColumn("e", run.cast("long")).withColumn("s", F.col("e") - F.char_length("match")).withColumn("digits", _digits(F.col("match")))
    n = F.char_length("digits")
    kind = F.col("kind")
    ok = (
        F.when(kind == ORDER["email"], True)
        .when(kind == ORDER["ip"], _octets(F.col("match")))
        .when(kind == ORDER["card"], n.between(14, 19) & _luhn(F.col("digits")))
        .when(kind == ORDER["phone"], n.between(10, 15))
        .otherwise(False)
    )
    return c.select("row", "fold", "kind", "s", "e", ok.alias("ok"), *[x.alias(k) for k, x in _features().items()])


# --- boosted trees ---------------------------------------------------------------------------


def _best_split(rows: list, names: list[str], grad: list[float], hess: list[float], at: list[int]) -> tuple | None:
    """(gain, feature, value) of the best split "feature <= value" or, for the unordered
    generator and context word, "feature = value"."""
    best = None
    g0, h0 = sum(grad[i] for i in at), sum(hess[i] for i in at)
    for k, name in enumerate(names):
        equal = name in ("f_kind", "f_word")
        sums: dict[int, list[float]] = {}
        for i in at:
            s = sums.setdefault(rows[i][0][k], [0.0, 0.0])
            s[0] += grad[i]
            s[1] += hess[i]
        g = h = 0.0
        for v in sorted(sums)[: None if equal else -1]:
            g, h = (sums[v][0], sums[v][1]) if equal else (g + sums[v][0], h + sums[v][1])
            gain = g * g / (h + 1) + (g0 - g) ** 2 / (h0 - h + 1) - g0 * g0 / (h0 + 1)
            if h >= 1e-3 and h0 - h >= 1e-3 and (best is None or gain > best[0] + 1e-12):
                best = (gain, k, v, equal)
    return best if best and best[0] > 1e-9 else None


def _grow(rows, names, grad, hess, at, depth):
    split = _best_split(rows, names, grad, hess, at) if depth else None
    if split is None:
        return -RATE * sum(grad[i] for i in at) / (sum(hess[i] for i in at) + 1)
    _, k, v, equal = split
    left = [i for i in at if (rows[i][0][k] == v if equal else rows[i][0][k] <= v)]
    inside = set(left)
    right = [i for i in at if i not in inside]
    return (k, v, equal, _grow(rows, names, grad, hess, left, depth - 1), _grow(rows, names, grad, hess, right, depth - 1))


def _value(tree, x) -> float:
    while isinstance(tree, tuple):
        k, v, equal, left, right = tree
        tree = left if (x[k] == v if equal else x[k] <= v) else right
    return tree


def fit(rows: list[tuple[tuple[int, ...], int, float]], names: list[str]) -> list:
    """Trees for weighted rows (features, label, weight), by logistic gradient boosting."""
    score, trees = [0.0] * len(rows), []
    for _ in range(ROUNDS if rows else 0):
        p = [1 / (1 + math.exp(-s)) for s in score]
        grad = [w * (q - y) for (_, y, w), q in zip(rows, p, strict=True)]
        hess = [w * q * (1 - q) for (_, _, w), q in zip(rows, p, strict=True)]
        tree = _grow(rows, names, grad, hess, list(range(len(rows))), DEPTH)
        trees.append(tree)
        score = [s + _value(tree, r[0]) for s, r in zip(score, rows, strict=True)]
    return trees


def threshold(trees: list, held: list[tuple[tuple[int, ...], int, float]]) -> float:
    """The least score at and above which held-out precision is ``PRECISION`` or more, for rows
    at hand; ``calibrated`` tells it for a table."""
    by: dict[float, list[float]] = {}
    for x, y, w in held:
        s = by.setdefault(round(sum(_value(t, x) for t in trees), 9), [0.0, 0.0])
        s[y] += w
    best, good, bad = math.inf, 0.0, 0.0
    for s in sorted(by, reverse=True):
        good, bad = good + by[s][1], bad + by[s][0]
        if good >= LEAST_WEIGHT and good >= PRECISION * (good + bad):
            best = s
    return best


def _as_column(tree, names: list[str]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    k, v, equal, left, right = tree
    test = F.col(names[k]) == v if equal else F.col(names[k]) <= v
    return F.when(test, _as_column(left, names)).otherwise(_as_column(right, names))


def _score(trees: list, names: list[str]) -> Column:
    score = F.lit(0.0)
    for t in trees:
        score = score + _as_column(t, names)
    return F.round(score, 9)


def calibrated(trees: list, names: list[str], held: DataFrame) -> float:
    """The least score at and above which precision is ``PRECISION`` or more, over all rows
    (features, label, n) of ``held``: sums of the blocks of scores above, and running sums within
    each block."""
    weight = lambda y: F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0))
    by = held.withColumn("score", _score(trees, names)).groupBy("score").agg(weight(1).alias("good"), weight(0).alias("bad"))
    by = by.withColumn("block", F.floor(F.col("score") * BLOCKS))
    # trees bound the scores, so the blocks are few, however many the rows
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = by.groupBy("block").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    before = blocks.select("block", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("good", "bad")])
    down = Window.partitionBy("block").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    run = by.join(before, "block").select("score", *[(F.col(f"{c}_above") + F.sum(c).over(down)).alias(c) for c in ("good", "bad")])
    fine = (F.col("good") >= LEAST_WEIGHT) & (F.col("good") >= PRECISION * (F.col("good") + F.col("bad")))
    best = run.filter(fine).agg(F.min("score")).first()[0]
    return math.inf if best is None else best


def _weak_label() -> Column:
    """In a valid base span, or a credential by its form."""
    return (F.col("in_base") | (F.col("f_prefix") == 1) | ((F.col("f_stated") == 1) & (F.col("f_digits") >= 2))).cast("int")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every document's (row, id), and its selected spans (row, kind, s, e,
    base), where kind is the place in ``KINDS``."""
    found = stored(candidates(docs, id_col, text_col), "pii-candidates")
    c = spans_of(found)
    names = list(_features())
    # what lies in or over a base span: running bounds of base spans along the text
    by = Window.partitionBy("row").orderBy("s", F.desc("e"), "kind")
    base_end = F.max(F.when(F.col("ok"), F.col("e"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
    base_start = F.min(F.when(F.col("ok"), F.col("s"))).over(by.rowsBetween(1, Window.unboundedFollowing))
    c = c.withColumn("touches", F.col("ok") | F.coalesce(base_end > F.col("s"), F.lit(False)) | F.coalesce(base_start < F.col("e"), F.lit(False)))
    c = stored(c.withColumn("in_base", F.col("ok") | (F.coalesce(base_end >= F.col("e"), F.lit(False)))), "pii-spans")
    counted = stored(c.groupBy("fold", *names, _weak_label().alias("label")).agg(F.count(F.lit(1)).alias("n")), "pii-counted")
    picked = counted.filter("fold = 0").orderBy(F.desc("n"), "label", *names).limit(FIT_ROWS).collect()
    # labels of fitting rows weigh by the square root of their count: no one format drowns the rest
    trees = fit([(tuple(r[k] for k in names), r["label"], math.sqrt(r["n"])) for r in picked], names)
    least = calibrated(trees, names, counted.filter("fold = 1"))
    extra = c.filter(~F.col("touches")).withColumn("score", _score(trees, names)).filter(F.col("score") >= least) if math.isfinite(least) else c.limit(0)
    # extras that overlap each other are one span, named after the first
    order = Window.partitionBy("row").orderBy("s", F.desc("e"), "kind")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    extra = extra.select("row", "kind", "s", "e").withColumn("new", F.coalesce(F.col("s") >= reach, F.lit(True)).cast("int"))
    extra = extra.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    extra = extra.groupBy("row", "island").agg(F.min_by("kind", F.struct("s", -F.col("e"), "kind")).alias("kind"), F.min("s").alias("s"), F.max("e").alias("e"))
    spans = c.filter("ok").select("row", "kind", "s", "e", F.lit(True).alias("base")).union(extra.select("row", "kind", "s", "e", F.lit(False).alias("base")))
    return found.select("row", F.col("id").alias(id_col)), spans


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x.getField("kind")), x.getField("s").cast("string"), x.getField("e").cast("string"))))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, counts by base kind, ``base_sha256``, ``spans``."""
    rows, spans = find(docs, id_col, text_col)
    item = F.struct("s", "kind", "e")
    per = spans.groupBy("row").agg(
        *[F.sum(F.when(F.col("base") & (F.col("kind") == ORDER[k]), 1).otherwise(0)).alias(f"n_{k}") for k in BASE],
        _joined(F.sort_array(F.collect_list(F.when(F.col("base"), item)))).alias("base"),
        _joined(F.sort_array(F.collect_list(item))).alias("spans"),
    )
    return rows.join(per, "row", "left").select(
        id_col, *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every selected span replaced by its kind's tag; spans that overlap are
    replaced together, under the first one's tag. All columns stay."""
    texts, row = numbered(docs, "_pii_row")
    rows, spans = find(texts, row, text_col)
    merged = stored(_parts(spans).join(rows, "row").drop("row"), "pii-redactions")
    j = texts.join(merged, row, "left")
    t, p = F.col(text_col), F.col("_pii_parts")
    tags = F.array(*[F.lit(TAGS[k]) for k in KINDS])
    parts = F.transform(p, lambda x: F.concat(F.substring(t, x.getField("from") + 1, x.getField("s") - x.getField("from")), F.get(tags, x.getField("kind"))))
    tail = F.substring(t, F.element_at(p, -1).getField("e").cast("int") + 1, F.lit(2**31 - 1))
    new = F.when(p.isNotNull(), F.concat(F.array_join(parts, ""), tail)).otherwise(t)
    return j.select(*[new.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def _parts(spans: DataFrame) -> DataFrame:
    """Merged spans of a text, each with the end of the one before (``from``)."""
    order = Window.partitionBy("row").orderBy("s", F.desc("e"), "kind")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    s = spans.withColumn("new", F.coalesce(F.col("s") >= reach, F.lit(True)).cast("int"))
    s = s.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.groupBy("row", "island").agg(F.min_by("kind", F.struct("s", -F.col("e"), "kind")).alias("kind"), F.min("s").alias("s"), F.max("e").alias("e"))
    before = F.coalesce(F.lag("e").over(Window.partitionBy("row").orderBy("s")), F.lit(0))
    s = s.withColumn("from", before)
    part = F.struct(F.col("s").cast("int").alias("s"), F.col("kind").cast("int").alias("kind"), F.col("e").cast("int").alias("e"), F.col("from").cast("int").alias("from"))
    return s.groupBy("row").agg(F.sort_array(F.collect_list(part)).alias("_pii_parts"))
