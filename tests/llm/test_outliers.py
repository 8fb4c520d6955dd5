import random
from collections import Counter

import numpy as np
import pytest

from marginflow.llm import outliers


def brute(text):
    words = [w for w in "".join("\0" if c in " \t\n\v\f\r" else c for c in text or "").split("\0") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit |= set(range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\v\f\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in outliers.quality_rules(docs).collect()}
    for r in docs.collect():
        g, want = got[r.doc_id], brute(r.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (g.base_failed and g.kept)


@pytest.mark.parametrize("seed", range(6))
def test_counts_of_odd_texts(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(["a", "b", " ", "\n", "\x0b", "\x1c", " ", "é", "#", "<", "\r\n", "aa bb"]) for _ in range(rnd.randrange(3000)))
    assert outliers.counts_of(text.encode())[:5] == brute(text)


def test_estimate_resists_outliers_in_a_hot_group(spark):
    rng = np.random.default_rng(0)
    good, bad = rng.normal([5, 1.6, 0, 0], [1, 0.3, 0.6, 0.2], (3000, 4)), rng.normal([9, 3, 6, 2], 0.1, (600, 4))
    rows = [("a", "b", *map(float, x)) for x in np.vstack([good, bad])]
    v = spark.createDataFrame(rows, "l string, s string, x0 double, x1 double, x2 double, x3 double")
    e = outliers.robust_estimates(v, ["l", "s"]).first()
    assert np.allclose(e.centre, [5, 1.6, 0, 0], atol=0.15)


def test_edges(spark):
    rows = [(1, None, None, None), (1, "", "en", "s"), (None, "w " * 4, "en", None), (5, " ".join(f"t{i}" for i in range(50)), None, "s")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", outliers.F.lit(1))
    got = outliers.quality_rules(docs).collect()
    assert len(got) == 8 and sum(r.kept for r in got) == 2
    assert outliers.quality_rules(docs.limit(0)).collect() == []


def test_copies_reject_no_other_text(spark):
    """A group that is more than half copies of one text: distinct texts keep the verdicts and
    distances they have without the copies."""
    rnd = random.Random(1)
    text = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(n))
    rows = [(i, text(int(np.exp(rnd.gauss(5, 1)) + 10)), "en", "s") for i in range(200)]
    copy = text(150)
    schema = "doc_id long, text string, lang string, source string"
    alone = {r.doc_id: r for r in outliers.quality_rules(spark.createDataFrame([*rows, (1000, copy, "en", "s")], schema)).collect()}
    mixed = {r.doc_id: r for r in outliers.quality_rules(spark.createDataFrame([*rows, *[(1000 + k, copy, "en", "s") for k in range(600)]], schema)).collect()}
    assert len(mixed) == 800 and all(r.kept for r in mixed.values())
    assert all(mixed[i].kept == r.kept and mixed[i].distance == pytest.approx(r.distance, rel=1e-6) for i, r in alone.items())
