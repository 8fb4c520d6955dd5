"""The keyed pulse over any batching equals the batch rebuild; late rows are kept."""

import datetime as dt
import os
import random
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marginflow.streaming import late
from marginflow.streaming.keyed import KeyedHistory, run_keyed_pulse, runs_after, same
from marginflow.streaming.scd2 import scd2_from_log, scd2_windowed

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id bigint, item string, ts timestamp_ntz, st string, units int, value double"
ARROW = pa.schema([("event_id", pa.int64()), ("item", pa.string()), ("ts", pa.timestamp("us")), ("st", pa.string()), ("units", pa.int32()), ("value", pa.float64())])
ARGS = ("item", "ts", ["st", "value"], ["units"], ["event_id"])


def log(n=240, seed=3, items=4):
    rnd = random.Random(seed)
    return [(k, f"i{rnd.randrange(items)}", T0 + dt.timedelta(minutes=rnd.randrange(6 * 24 * 60) // 7 * 7), rnd.choice([None, "a", "b"]), rnd.randint(0, 9), rnd.choice([None, 1.5, float("nan")])) for k in range(n)]


def write(src, name, rows):
    pq.write_table(pa.table([list(c) for c in zip(*rows)] if rows else [[] for _ in ARROW], schema=ARROW), os.path.join(src, name))


def run(spark, src, root):
    schema = spark.createDataFrame([], SCHEMA).schema
    return run_keyed_pulse(spark, src, schema, lambda s: s, *ARGS, root=root, delay="36 hours", max_files_per_trigger=1)


def shown(df):
    return sorted(str(tuple(r)) for r in df.select("item", "desde", "hasta", "visto_hasta", "st", "value", "units").collect())


def rebuilt(spark, rows):
    return shown(scd2_windowed(spark.createDataFrame(rows, SCHEMA), *ARGS))


@pytest.fixture
def folders():
    return tempfile.mkdtemp(prefix="mf-keyed-src-"), tempfile.mkdtemp(prefix="mf-keyed-")


def test_any_order_restart_and_late_rows(spark, folders):
    """Batches by day, shuffled inside, some rows a day late (within the delay) and some far beyond it; the
    second run goes on from the stored state."""
    src, root = folders
    rows = log()
    rnd = random.Random(5)
    arrival = {}
    for r in rows:
        day = (r[2] - T0).days
        arrival.setdefault(day + rnd.choice([0, 0, 0, 1]) if r[0] % 40 else 6, []).append(r)
    days = sorted(arrival)
    for d in days[:3]:
        write(src, f"d{d}.parquet", arrival[d])
    first = run(spark, src, root)
    seen = [r for d in days[:3] for r in arrival[d]]
    assert shown(first.read()) == rebuilt(spark, seen)
    for d in days[3:]:
        write(src, f"d{d}.parquet", arrival[d])
    second = run(spark, src, root)
    assert shown(second.read()) == rebuilt(spark, rows)
    schema = spark.createDataFrame([], SCHEMA).schema
    n_late = late.late_rows(spark, schema, root).count()
    assert 0 < n_late < len(rows) / 4
    v = second.versions()
    assert v.where("_version is null").count() > 0  # timers settled runs
    # an item without new rows is not written again
    before = v.count()
    write(src, "later.parquet", [(10_000, "i0", T0 + dt.timedelta(days=9), "z", 1, 2.0)])
    third = run(spark, src, root)
    assert shown(third.read()) == rebuilt(spark, [*rows, (10_000, "i0", T0 + dt.timedelta(days=9), "z", 1, 2.0)])
    assert third.versions().count() > before


def test_nothing_new_changes_nothing(spark, folders):
    src, root = folders
    write(src, "a.parquet", log(40))
    a = shown(run(spark, src, root).read())
    assert a == shown(run(spark, src, root).read()) == rebuilt(spark, log(40))


def test_runs_fold_in_parts():
    obs = [(k, None, s, 0) for k, s in enumerate([None, None, 1.0, float("nan"), float("nan"), 1.0])]
    whole = runs_after(None, obs, 1, 1)
    for cut in range(len(obs) + 1):
        head = runs_after(None, obs[:cut], 1, 1)
        last = head.pop() if head else None
        assert str(head + runs_after(last, obs[cut:], 1, 1)) == str(whole)
    assert same((None, float("nan")), (None, float("nan"))) and not same((None,), (0,))


def test_windows_close_once_and_late_rows_are_kept(spark, folders):
    src, root = folders
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = [r for r in log(200, seed=9)]
    rows.sort(key=lambda r: r[2])
    early = [r for r in rows if r[0] % 25 == 0]
    feed = [r for r in rows if r[0] % 25]
    parts = [feed[:90] + feed[:3], feed[90:] + early]  # three rows come twice; ``early`` comes with the last part
    delay = "12 hours"
    for k, p in enumerate(parts):
        write(src, f"p{k}.parquet", p)
        late.part_late(spark, src, schema, "ts", delay, root)
        got = late.run_windows(spark, schema, "ts", "event_id", delay, root, "1 hour", [F.count("event_id").alias("n")])
        closed = got.count()
    late.close_feed(spark, schema, "ts", delay, root)
    got = late.run_windows(spark, schema, "ts", "event_id", delay, root, "1 hour", [F.count("event_id").alias("n")])
    border = max(r[2] for r in parts[0]) - dt.timedelta(hours=12)
    on_time = {r[0]: r for r in [*parts[0], *(r for r in parts[1] if r[2] > border)]}
    want = {}
    for r in on_time.values():
        h = r[2].replace(minute=0)
        want[h] = want.get(h, 0) + 1
    assert {r.start.replace(tzinfo=None): r.n for r in got.where("n > 0").collect()} == want
    assert closed < got.count()
    assert sorted(r.event_id for r in late.late_rows(spark, schema, root).collect()) == sorted(r[0] for r in parts[1] if r[2] <= border)
    # after the end all is late, and nothing is lost
    write(src, "p9.parquet", [rows[-1]])
    late.part_late(spark, src, schema, "ts", delay, root)
    assert late.late_rows(spark, schema, root).where(F.col("event_id") == rows[-1][0]).count() == 1


@pytest.mark.parametrize("width", [3_600_000_000, 86_400_000_000, 10**15])
def test_stitched_buckets_equal_one_window(spark, width):
    rnd = random.Random(1)
    rows = log(400, seed=8) + [(1000 + k, "hot", T0 + dt.timedelta(hours=k // 2), rnd.choice("aaaab"), k, 1.0) for k in range(600)] + [(2000, None, T0, "n", 1, None), (2001, None, None, None, 1, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert shown(scd2_from_log(df, *ARGS, width=width)) == shown(scd2_windowed(df, *ARGS))
    # no task holds the hot item whole
    if width == 86_400_000_000:
        from marginflow.streaming.scd2 import _bucket_runs

        sizes = _bucket_runs(df, *ARGS, width).where("item = 'hot'").groupBy("_b").count().collect()
        assert len(sizes) > 10


def test_history_reader_is_reusable(spark, folders):
    src, root = folders
    write(src, "a.parquet", log(30))
    h = run(spark, src, root)
    again = KeyedHistory(spark, root, h.schema, lambda s: s, "item", "ts", ["st", "value"], ["units"], ["event_id"])
    assert shown(again.read()) == shown(h.read())


def test_a_feed_of_several_files_a_batch_gives_the_same_history(spark, tmp_path, monkeypatch):
    from marginflow import queries_stream as Q
    from marginflow.registry import QUERIES

    days = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * i) for i in range(140)]
    rows = [(i, t, i % 5, ("view", "purchase", "click", "error")[i % 4], float(i), '{"k": %d}' % (i % 9)) for i, t in enumerate(days)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(Q, "FEED_FILE_ROWS", 10)
    assert Q.feed_files(spark, str(tmp_path)) == 2
    got, want = (sorted(map(str, QUERIES[q](spark, str(tmp_path)).select("item_id", "desde", "hasta", "reason", "units").collect())) for q in ("pulse_keyed", "scd2_state"))
    assert got == want and len(got) > 20
