import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marginflow.llm import max_sketch as ms
from marginflow.llm import queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    bags = [(i, Counter(WORD.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in bags), sum(c.total() for _, c in bags)
    df = Counter(w for _, c in bags for w in c)
    out = []
    for item, text in items:
        q = Counter(WORD.findall((text or "").translate(LOWER)))
        weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in q if df[w]}
        scores = []
        for i, c in bags:
            m = 25 + (75 * c.total() * n_docs) // n_terms if n_terms else 1
            s = sum(q[w] * weight[w] * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w in q if w in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, ms.search(ms.build_index(d), q, k).collect()), key=str)


def test_whole_table_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted(map(tuple, queries.op12_max_sketch(spark, SF).collect()), key=str)
    assert got == brute(docs, items) and len(got) > 100


def test_edges_ties_copies_and_repeated_queries(spark):
    docs = [(None, "Apple pie"), (5, "apple pie"), (4, "APPLE, pie!"), (4, "apple pie"), (3, None), (2, ""), (1, "?!"), (9, "É é a_b c-d 1a"), (None, "zebra apple apple"), (8, "pie " * 3000)]
    docs += [(100 + i, "apple pie") for i in range(40)] + [(7, "x" * 3_000_000 + " rare " + "y z " * 700_000)]
    items = [(1, "apple pie pie"), (1, "apple pie pie"), (2, None), (3, ""), (None, "é B c"), (4, "nothing here"), (5, "RARE " * 1000), (6, "x" * 3_000_000)]
    for k in (1, 10):
        assert found(spark, docs, items, k) == brute(docs, items, k)


def test_blocks_and_few_places_give_the_same(spark, monkeypatch):
    """Queries in many blocks, and sketches so small that nearly all terms share places."""
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(300)])
    p = 1 / np.arange(1, 301)
    text = lambda n: " ".join(rng.choice(words, n, p=p / p.sum()))
    docs, items = [(i, text(rng.integers(1, 60))) for i in range(400)], [(i, text(rng.integers(1, 12))) for i in range(23)]
    monkeypatch.setattr(ms, "BLOCK", 7)
    assert found(spark, docs, items) == brute(docs, items)


def test_bounds_hold_and_save_exact_scores():
    rng = np.random.default_rng(4)
    rows, m = [], []
    for _ in range(500):
        h = np.unique(rng.integers(1, 2000, 80).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        tf = rng.integers(1, 9, len(h))
        rows.append((h.astype("<u8"), tf.astype("<u4"), *ms.sketch_of(h, tf)))
        m.append(int(rng.integers(25, 300)))
    batch = {"id": pa.array(range(500)), **{k: pa.array([r[i].tobytes() for r in rows], pa.binary()) for i, k in enumerate(("terms", "tfs", "places", "maxima"))}}
    asked = []
    for _ in range(20):
        h = np.unique(np.concatenate([rng.choice(rows[rng.integers(500)][0], 12), rng.integers(1, 2000, 12).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)]))
        asked.append((h, ms.places_of(h).astype(np.int64), rng.integers(1, 9000, len(h))))
    best = [ms.Best(5) for _ in asked]
    scored = ms.search_batch(batch, np.array(m), asked, best)
    for (h, _, w), top in zip(asked, best, strict=True):
        exact = []
        for d, (own, tf, _, _) in enumerate(rows):
            has = dict(zip(own.tolist(), tf.tolist(), strict=True))
            exact.append((-sum(int(x) * (10**9 * has[t] // (1000 * has[t] + 8 * m[d])) for t, x in zip(h.tolist(), w, strict=True) if t in has), False, d))
        assert top.kept == [x for x in sorted(exact)[:5] if x[0]]
    assert scored < 0.2 * 500 * len(asked)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    assert found(spark, docs, items) == []


def test_other_columns_and_names_do_not_matter(spark):
    d = spark.createDataFrame([("b", "u v", 1, 2), ("a", "u v", 3, 4)], "doc_id string, text string, n int, q int")
    q = spark.createDataFrame([("i", "V", "z")], "item_id string, text string, id string")
    assert [tuple(r)[:3] for r in ms.search(ms.build_index(d), q).orderBy("rank").collect()] == [("i", 1, "a"), ("i", 2, "b")]
