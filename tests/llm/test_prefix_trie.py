import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from marginflow.llm import prefix_trie as pt
from marginflow.llm import queries

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    seq = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        seq[c] = own.get(base, [])[:h] + t[h:]
    members, ends, parent, kids = defaultdict(list), defaultdict(list), {}, Counter()
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()
    )


def check(df):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    got = pt.prefix_trie(df)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    assert sorted(map(tuple, queries.op11_prefix_trie(spark, SF).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_shared_prefixes_hot_turns_and_repeats(spark, seed):
    """Few different turns, so that prefixes are shared at all depths; a hot first turn."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), 200):
        for k in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 16, 17, 21])):
            rows.append((c, rng.choice([k, k, k, None]), rng.choice(["user", "assistant", None]) if k else "user", "hello there  you" if k == 0 else rng.choice(["", "a b", None, "c\td\x0be "])))
    rows += rng.sample(rows, 30) + [(None, 0, "user", "lost")]
    check(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_one_conversation_with_nearly_all_turns(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 16)
    rows = [(5, i, "user", f"t{i % 7}") for i in range(400)] + [(25, i, "user", f"t{i % 7}") for i in range(150)] + [(c, 0, "user", "t0") for c in range(100, 140)]
    check(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))


def test_many_equal_conversations_are_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 10)
    rows = [(c * 20, i, "user", f"x{i}") for c in range(300) for i in range(4)] + [(7, 0, "user", "x0")]
    check(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_edges(spark):
    names = "conv_id long, turn long, role string, text string"
    assert pt.prefix_trie(spark.createDataFrame([], names)).collect() == []
    assert pt.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], names)).collect() == []
    check(spark.createDataFrame([(3, 0, "user", "x")], names))  # h turns of an absent conversation: no turns are left
    check(spark.createDataFrame([(c, 0, "u", "w " * 700_000 if c % 2 else None) for c in (0, 1, 20, 21)], names))
    extra = spark.createDataFrame([(c, t, "u", "a", 1, "b", 2) for c in range(30) for t in range(3)], names + ", i int, name string, conv int")
    check(extra)
