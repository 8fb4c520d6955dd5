import re
from collections import defaultdict

import numpy as np
import pytest

from marginflow.llm import order_minhash as om
from marginflow.llm.textbytes import labelled, shingles, word_bytes

SF = "/root/testdata/sf0.001"


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute_classes(rows):
    """Classes by all pairs that share a shingle, with the plain longest common subsequence."""
    ids = [i for i, _ in rows]
    seqs = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if x]
        s, seen = [], defaultdict(int)
        for g in [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []:
            s.append((g, seen[g]))
            seen[g] += 1
        seqs.append(s)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    where = defaultdict(list)
    for k, s in enumerate(seqs):
        for g in s:
            where[g].append(k)
    pairs = {(x, y) for v in where.values() for i, x in enumerate(v) for y in v[i + 1 :]}
    by_text = {}
    for k, (_, t) in enumerate(rows):
        if t is not None:
            pairs.add((by_text.setdefault(t, k), k))
    for x, y in sorted(pairs):
        a, b = seqs[x], seqs[y]
        if rows[x][1] == rows[y][1] and rows[x][1] is not None:
            root[find(x)] = find(y)
            continue
        common = len(set(a) & set(b))
        if not a or not b or common < 0.8 * (len(a) + len(b) - common):
            continue
        n = _lcs(a, b)
        if n >= 0.8 * (len(a) + len(b) - n) - 1e-9:
            root[find(x)] = find(y)
    least = {}
    for k, i in enumerate(ids):
        r = find(k)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted((str(i), str(least.get(find(k)))) for k, i in enumerate(ids))


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = om.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == brute_classes(rows)


def test_nulls_ties_and_clashing_columns(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, base, "x"), (2, base, "y"), (2, base, "y"), (None, base + " more", "z"), (5, None, "n"), (6, None, "n"), (7, "", "e"), (8, "", "e"),
        (9, "!!", "p"), (10, "??", "p"), (11, "a b", "s"), (12, "A b!", "s"), (13, " ".join(base.split()[::-1]), "r"), (14, "x " * 30000, "long"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string").withColumnRenamed("node", "digest")
    got = om.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == sorted([*brute_classes([(a, b) for a, b, _ in rows[:-1]]), ("14", "14")])
    by = defaultdict(set)
    for r in got:
        by[r.class_id].add(r.doc_id)
    assert by[1] == {1, 2, None} and by[5] == {5} and by[6] == {6} and by[7] == {7, 8} and by[9] == {9} and by[11] == {11, 12} and by[13] == {13}
    kept = om.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.class_id for r in got})


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert om.near_duplicates(docs).collect() == []


@pytest.mark.parametrize("small", [om.SMALL, 2])
def test_large_groups_lose_no_link(spark, monkeypatch, small):
    """Copies of one text with many edits each, copies of copies, truncations, shared passages:
    most are not linked to the hub, and the classes must be those of all pairs."""
    monkeypatch.setattr(om, "SMALL", small)
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(220)]

    def edited(words, k):
        out = list(words)
        for _ in range(k):
            i = int(rng.integers(0, len(out)))
            out[i : i + int(rng.integers(0, 2))] = [f"n{rng.integers(0, 10**9)}"]
        return out

    texts = [edited(base, int(rng.integers(0, 14))) for _ in range(60)]
    texts += [edited(texts[int(rng.integers(0, 60))], int(rng.integers(1, 4))) for _ in range(40)]
    texts += [base[: int(rng.integers(120, 220))] for _ in range(20)]
    texts += [[f"u{rng.integers(0, 10**9)}" for _ in range(60)] + base[50:130] for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == brute_classes(rows)


@pytest.mark.parametrize("seed", range(5))
def test_similarity_is_the_longest_common_run(seed):
    rng = np.random.default_rng(seed)
    a = [f"{x}".encode() for x in rng.integers(0, 300, 200)]
    b = list(a)
    for _ in range(seed):
        b[int(rng.integers(0, len(b)))] = b"new"
    x, y = labelled(shingles(a)), labelled(shingles(b))
    n = _lcs(list(x), list(y))
    want = n / (len(x) + len(y) - n)
    assert om.similarity(x, y) == pytest.approx(want if want >= 0.8 else 0.0)


def test_hub_pairs_stay_linear_and_no_link_is_lost(spark):
    """A chain: each text is linked to the next only, all in one class."""
    w = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(w[i * 6 : i * 6 + 100])) for i in range(12)]
    got = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_word_bytes_lowers_ascii_only():
    assert word_bytes("ÉA-b9_c".encode()) == ["Éa".encode(), b"b9", b"c"]


def test_sketches_are_written_once(spark, monkeypatch):
    """Nodes are numbered in the job that writes the sketches, not from a copy written before."""
    names, stored = [], om.stored
    monkeypatch.setattr(om, "stored", lambda df, name: names.append(name) or stored(df, name))
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, "x y")]
    got = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert [n for n in names if n in ("sketches", "nodes")] == ["nodes"]
