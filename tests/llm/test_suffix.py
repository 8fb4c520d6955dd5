import hashlib
import random
from collections import Counter

import pytest

from marginflow.llm import suffix

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.text or "").encode() for r in docs.collect()]
    got = suffix.remove_repeats(docs)
    assert rows(got) == sorted(brute(texts, 400))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())


@pytest.mark.parametrize("group", [suffix.GROUP, 2])
def test_small_alphabet_and_hot_passages(spark, group):
    rnd = random.Random(group)
    word = lambda n: "".join(rnd.choice("ab") for _ in range(n))
    passage = word(90)
    texts = [word(rnd.randrange(30)) + passage[rnd.randrange(4) : rnd.randrange(60, 91)] + word(rnd.randrange(30)) for _ in range(40)]
    texts += ["", None, "a" * 300, "ab" * 100, passage, passage, passage + "é", "é" * 50, word(39), word(40)]
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    got = suffix.remove_repeats(docs, length=40, gram=12, group=group)
    assert rows(got) == sorted(brute([(t or "").encode() for t in texts], 40))


def test_empty_table(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_deep_shallow_orders_like_sorted():
    rnd = random.Random(3)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(70))) for _ in range(400)] + [b"a" * k for k in range(80)]
    order, lcp = suffix.deep_shallow(strings)
    got = [strings[k] for k in order]
    assert got == sorted(strings) and sorted(order) == list(range(len(strings)))
    for a, b, n in zip(got, got[1:], lcp, strict=False):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        assert n == k


def test_long_text_is_hashed_in_parts(monkeypatch):
    data = bytes(random.Random(5).choices(b"abc", k=3000))
    whole = [tuple(x.tolist()) for x in suffix.anchors(data, 40, 12)]
    monkeypatch.setattr(suffix, "PART", 128)
    parts = [tuple(x.tolist()) for x in suffix.anchors(data, 40, 12)]
    cover = lambda a: {p: (h, at) for h, at, lo, hi in zip(*a, strict=True) for p in range(lo, hi + 1)}
    assert cover(whole) == cover(parts)
