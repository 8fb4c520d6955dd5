import random

import pytest

from marginflow.operators import borders as B


def rows(n_hot=3000):
    rng = random.Random(7)
    out = [("hot", i, rng.choice([None, None, i])) for i in range(n_hot)]
    out += [(f"k{k}", i, rng.choice([None, i])) for k in range(40) for i in range(rng.randint(1, 5))]
    out += [(None, i, None if i else 5) for i in range(30)]
    rng.shuffle(out)
    return out


@pytest.fixture(params=[3, 16])
def table(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield spark.createDataFrame(rows(), "k string, t long, v long").repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def by_key():
    out = {}
    for k, t, v in sorted(rows(), key=lambda r: (r[0] or "", r[1])):
        out.setdefault(k, []).append((t, v))
    return out


def test_number_within_a_hot_key(table):
    got = {(r.k, r.t): r.n for r in B.number_within(table, ["k"], ["t"], "n", keep=["k", "t"]).collect()}
    assert got == {(k, t): n for k, ts in by_key().items() for n, (t, _) in enumerate(ts)}


def test_fill_down_over_ranges(table):
    want = {}
    for k, ts in by_key().items():
        last = None
        for t, v in ts:
            last = v if v is not None else last
            want[k, t] = last
    assert {(r.k, r.t): r.f for r in B.fill_down(table, ["k"], ["t"], "v", "f").collect()} == want


def test_lead_in_order_with_and_without_keys(table):
    want = {(k, t): (ts[i + 1][1] if i + 1 < len(ts) else None) for k, ts in by_key().items() for i, (t, _) in enumerate(ts)}
    assert {(r.k, r.t): r.nxt for r in B.lead_in_order(table, ["k"], ["t"], "v", "nxt").collect()} == want
    whole = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    got = {(r.k, r.t): r.nxt for r in B.lead_in_order(table, [], ["k", "t"], "t", "nxt").collect()}
    assert got == {(a[0], a[1]): b[1] for a, b in zip(whole, [*whole[1:], (None, None)], strict=True)}


def test_no_window_without_partition_and_empty_table(spark, table):
    plan = B.lead_in_order(table, [], ["k", "t"], "t", "nxt")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    empty = spark.createDataFrame([], "k string, t long, v long")
    assert B.number_within(empty, ["k"], ["t"], "n").collect() == B.fill_down(empty, ["k"], ["t"], "v", "f").collect() == []
    assert B.lead_in_order(empty, [], ["t"], "v", "nxt").collect() == []
