import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as public
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marginflow.llm import packing

TOK = Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long").repartition(3)
    out = packing.pack(docs).collect()
    seqs, total = defaultdict(list), 0
    for r in out:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
        seqs[r.sequence_id].append((r.offset, r.length))
    partial = 0
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
        partial += at < packing.WINDOW
        total += at
    assert partial <= 3
    want = defaultdict(int)
    for i, t, _ in rows:
        ids = [*TOK.encode(t or "", add_special_tokens=False).ids, 0]
        want[i] += len(ids)
    got = defaultdict(int)
    for r in out:
        got[r.doc_id] += r.length
    assert got == want and total == sum(want.values())
    return out


def test_round_trip_with_odd_rows(spark):
    rnd = random.Random(0)
    rows = [(i, " ".join(rnd.choice("the of and réeau ing 12 <|endoftext|> \n\n  é😀".split(" ")) for _ in range(rnd.randrange(900))), 1) for i in range(150)]
    out = check(spark, [*rows, (500, None, 1), (501, "", 1), (501, "", 1), (None, "x", 1), (502, "word " * 30000, 1)])
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append((r.start, r.ids))
    for i, t, _ in rows:
        assert [x for _, ids in sorted(by[i]) for x in ids] == [*TOK.encode(t, add_special_tokens=False).ids, 0]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_those_of_tokenizers(text):
    assert packing.encoder()(text).tolist() == TOK.encode(text, add_special_tokens=False).ids


def test_each_placement_is_least_in_squares():
    rnd, bins = random.Random(2), packing.SumOfSquares(32)
    for _ in range(500):
        k = rnd.randrange(1, 33)
        n = bins.count.copy()
        best = None
        for level in range(32 - k + 1):
            if level and not n[level]:
                continue
            m = n.copy()
            if level:
                m[level] -= 1
            if level + k < 32:
                m[level + k] += 1
            best = min(best, (m**2).sum()) if best is not None else (m**2).sum()
        bins.place((("d", 0, k, np.zeros(k, "<u4")), k), k)
        assert (bins.count**2).sum() == best and [len(x) for x in bins.open[1:-1]] == bins.count[1:-1].tolist()
