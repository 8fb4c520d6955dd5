import hashlib
import random

import pytest

from marginflow.llm import decontaminate as dc
from tests.llm.test_pipeline import words


def brute(docs, items):
    out = []
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[x]
        out.append((str(i), len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def found(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, hits string")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, win string")
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in dc.contamination(d, b).collect())


@pytest.mark.parametrize("limit", [dc.SET_SHINGLES, 3])
def test_small_vocabulary_and_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "SET_SHINGLES", limit)
    rnd = random.Random(limit)
    text = lambda n: " ".join(rnd.choice(["a", "B", "É", "c-d", "1"]) for _ in range(n))
    items = [(i, text(rnd.randrange(1, 25))) for i in range(12)] + [(50, None), (51, ""), (52, "É"), (53, "solo word"), (53, "solo word"), (None, "no id here at all")]
    docs = [(i if i % 5 else None, text(rnd.randrange(0, 60)) + " " + (rnd.choice(items)[1] or "") + "!" + text(5)) for i in range(40)]
    docs += [(90, None), (91, ""), (92, "É"), (93, "x " * 20000 + items[0][1]), (93, "solo, WORD"), (94, "solo word solo word")]
    got, want = found(spark, docs, [x for x in items if x[0] is not None]), brute(docs, [x for x in items if x[0] is not None])
    assert got == want


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b c")]) == []
    assert found(spark, [(1, "a b")], []) == [("1", 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
