"""Interval algebra and SCD2 against small Python models (property tests)."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginflow.operators import intervals as IV
from marginflow.streaming.pulse import scd2_merge_log
from marginflow.streaming.scd2 import scd2_apply, scd2_from_log

T0 = dt.datetime(2024, 1, 1)


def ts(h):
    return T0 + dt.timedelta(hours=h)


def model_union(iv):
    out = []
    for s, e in sorted(i for i in iv if i[0] < i[1]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def model_points(iv, lo=0, hi=60):
    return {t for s, e in iv for t in range(s, e)}


def frame(spark, iv, key="k"):
    return spark.createDataFrame([(key, ts(s), ts(e)) for s, e in iv], "key string, start timestamp_ntz, end timestamp_ntz")


def back(rows):
    return sorted((int((r.start - T0).total_seconds() // 3600), int((r.end - T0).total_seconds() // 3600)) for r in rows)


intervals = st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=8)


def test_union_edge_cases(spark):
    iv = [(0, 2), (2, 4), (5, 9), (6, 7), (5, 9), (10, 10), (12, 11)]   # touching, nested, identical, empty, reversed
    got = back(IV.interval_union(frame(spark, iv), ["key"]).collect())
    assert got == [(0, 4), (5, 9)]
    assert back(IV.interval_union(frame(spark, iv), ["key"], skew_safe=True).collect()) == got


@settings(max_examples=12, deadline=None)
@given(intervals, intervals)
def test_setops_match_model(spark, a, b):
    A, B = frame(spark, a), frame(spark, b)
    ua, ub = model_points(a), model_points(b)
    sub = back(IV.interval_subtract(A, B, ["key"]).collect())
    inter = back(IV.interval_intersect(A, B, ["key"]).collect())
    assert back(IV.interval_subtract(A, B, ["key"], skew_safe=True).collect()) == sub
    assert back(IV.interval_intersect(A, B, ["key"], skew_safe=True).collect()) == inter
    assert model_points(sub) == ua - ub
    assert model_points(inter) == ua & ub
    # results are merged: no two pieces touch or overlap
    for res in (sub, inter):
        assert all(res[i][1] < res[i + 1][0] for i in range(len(res) - 1))
    assert model_union(sub) == sub


def test_coverage_gap_rule(spark):
    moments = [ts(0), ts(2), ts(4) + dt.timedelta(seconds=1), ts(10)]
    m = spark.createDataFrame([(x,) for x in moments], "moment timestamp_ntz")
    got = [(r.start, r.end) for r in IV.coverage_segments(m, "moment", ts(11)).orderBy("start").collect()]
    # gap of exactly 2 h joins; 2 h + 1 s does not; only the last pulse extends (capped at the window end)
    assert got == [(ts(0), ts(2)), (ts(10), ts(11))]


def _random_log(n_items=6, n_pulses=10, seed=7):
    rnd = random.Random(seed)
    rows = []
    for p in range(n_pulses):
        for i in range(n_items):
            if rnd.random() < 0.7:
                state = rnd.choice([None, "a", "b"])
                rows.append((f"i{i}", ts(p), state, rnd.randint(0, 5)))
    return rows


def _norm(rows):
    return sorted(tuple(r) for r in rows)


def test_scd2_apply_replay_equals_from_log(spark):
    schema = "item string, ts timestamp_ntz, st string, units int"
    log = _random_log()
    full = spark.createDataFrame(log, schema)
    expect = _norm(scd2_from_log(full, "item", "ts", ["st"], ["units"]).select(
        "item", "desde", "hasta", "visto_hasta", "st", "units").collect())
    hist = spark.createDataFrame([], "item string, desde timestamp_ntz, hasta timestamp_ntz, "
                                     "visto_hasta timestamp_ntz, st string, units int")
    for p in sorted({r[1] for r in log}):
        batch = spark.createDataFrame([r for r in log if r[1] == p], schema).drop("ts")
        hist = scd2_apply(hist, batch, F.lit(p).cast("timestamp_ntz"), "item", ["st"], ["units"])
        hist = spark.createDataFrame(hist.collect(), hist.schema)   # small fixture: cut the lineage
    got = _norm(hist.select("item", "desde", "hasta", "visto_hasta", "st", "units").collect())
    assert got == expect
    # at most one open interval per item
    assert all(c == 1 for c in hist.where("hasta IS NULL").groupBy("item").count().toPandas()["count"])


def test_scd2_apply_empty_batch_is_noop(spark):
    hist = spark.createDataFrame([("i", ts(0), None, ts(1), "a")],
                                 "item string, desde timestamp_ntz, hasta timestamp_ntz, visto_hasta timestamp_ntz, st string")
    empty = spark.createDataFrame([], "item string, st string")
    got = scd2_apply(hist, empty, ts(5), "item", ["st"])
    assert sorted(map(str, got.collect())) == sorted(map(str, hist.select(*got.columns).collect()))


def test_merge_log_any_batching_equals_rebuild(spark):
    schema = "item string, ts timestamp_ntz, st string, units int"
    log = _random_log(seed=3)
    full = spark.createDataFrame(log, schema)
    expect = _norm(scd2_from_log(full, "item", "ts", ["st"], ["units"]).collect())
    hist = None
    for chunk in (log[:7], log[7:20], log[20:]):
        hist = scd2_merge_log(hist, spark.createDataFrame(chunk, schema), "item", "ts", ["st"], ["units"])
        hist = spark.createDataFrame(hist.collect(), hist.schema)
    assert _norm(hist.select("item", "desde", "hasta", "visto_hasta", "st", "units").collect()) == expect


def _brute_overlaps(a, b):
    return sorted((k, i, j, max(s, t), min(e, f)) for k, i, s, e in a for l, j, t, f in b if k == l and s < f and t < e and s < e and t < f)


@pytest.mark.parametrize("span", [2, 400, 100_000])
def test_overlap_join_finds_every_pair_once(spark, span):
    """Intervals of minutes up to ten years, empty ones, touching ones, ends on the hour, before 1970."""
    rnd = random.Random(span)
    base = dt.datetime(1969, 12, 25)

    def some(n):
        out = []
        for i in range(n):
            s = base + dt.timedelta(hours=rnd.randrange(span * 2), minutes=rnd.choice([0, 0, 30, 59]))
            out.append((rnd.choice("xy"), i, s, s + rnd.choice([dt.timedelta(0), dt.timedelta(microseconds=1), dt.timedelta(hours=1), dt.timedelta(hours=rnd.randrange(span)), dt.timedelta(minutes=7)])))
        return out

    a, b = some(80), some(80)
    df = lambda rows: spark.createDataFrame(rows, "k string, i int, start timestamp_ntz, end timestamp_ntz")
    got = IV.overlap_join(df(a), df(b), ["k"])
    assert sorted((r.k, r.a_i, r.b_i, r.start, r.end) for r in got.collect()) == _brute_overlaps(a, b)


def test_a_ten_year_interval_has_few_bins(spark):
    from pyspark.sql import functions as F

    n = spark.range(1).select(F.size(IV._cover(F.lit(12_345).cast("long"), F.lit(12_345 + 87_660).cast("long"))).alias("n")).first().n
    assert n <= 34
    a = spark.createDataFrame([("x", dt.datetime(2010, 1, 1), dt.datetime(2020, 1, 1))], "k string, start timestamp_ntz, end timestamp_ntz")
    plan = IV.overlap_join(a, a, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Cartesian" not in plan


def test_empty_overlap_join(spark):
    e = spark.createDataFrame([], "k string, start timestamp_ntz, end timestamp_ntz")
    assert IV.overlap_join(e, e, ["k"]).collect() == []


def test_an_interval_is_listed_under_two_bins_at_most(spark):
    """The join's shuffled rows: one or two of the holding side, one a level of the beginning side."""
    from pyspark.sql import functions as F

    spans = [(s, s + n - 1) for s in (-70, -1, 0, 3, 15, 16, 12_345) for n in (1, 2, 4, 5, 16, 17, 500, 87_660)]
    df = spark.createDataFrame(spans, "f long, l long").select("f", "l", IV._level(F.col("f"), F.col("l")).alias("level"), IV._cover(F.col("f"), F.col("l")).alias("bins"))
    for r in df.collect():
        size = 4**r.level
        assert size >= r.l - r.f + 1 and (r.level == 0 or size < 4 * (r.l - r.f + 1))
        assert sorted(r.bins) == sorted({r.f // size, r.l // size})


def test_consolidation_takes_the_catalog_once(spark, monkeypatch):
    from marginflow.plans import experiment as EX

    calls, catalog = [], EX.item_catalog
    monkeypatch.setattr(EX, "item_catalog", lambda *a: calls.append(a) or catalog(*a))
    EX.experiment_consolidate(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1
