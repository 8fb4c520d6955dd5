"""Interval algebra on rows ``(keys…, start, end)`` — half-open ``[start, end)``.

Empty intervals (``start >= end``) are dropped and touching intervals merge.
Nothing is materialised as an in-memory list: every operation is a sweep
line over endpoint events.  By default the sweep is a window per key; with
``skew_safe=True`` its running scans are cut into (key, time-bucket)
segments with carries (``operators.scan``), so a hot key is split over many
tasks; each scan writes its local part once (``session.stored``).

* ``interval_union``  — running coverage count over ±1 endpoint events;
* ``interval_setop``  — one sweep over tagged events (+1 at a start, −1 at an
  end, per input set) gives elementary segments with a cover count per set;
  a predicate on the counts selects A−B, A∩B, A∪B, …; adjacent selected
  segments are merged back by ``interval_union``.
* ``overlap_join``    — equi-key join with an overlap residual
  (``a.start < b.end AND a.end > b.start``) and the clipped piece.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.operators.borders import lead_in_order
from marginflow.operators.scan import running_sums
from marginflow.session import stored

MICROS_PER_HOUR = 3_600_000_000


def duration_micros(start: str | Column, end: str | Column) -> Column:
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", s, e)


def hours(start: str | Column, end: str | Column) -> Column:
    return duration_micros(start, end) / float(MICROS_PER_HOUR)


def total_hours(start: str | Column = "start", end: str | Column = "end") -> Column:
    """Σ of the lengths in hours, exact: whole microseconds are summed."""
    return F.sum(duration_micros(start, end)).cast("double") / float(MICROS_PER_HOUR)


def normalize(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    return df.select(*keys, F.col(start).alias("start"), F.col(end).alias("end")).where(F.col("start") < F.col("end"))


def _boundaries_to_intervals(bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``(keys, t, is_start)`` that strictly alternate start/end per key
    → intervals ``[start, next boundary)``."""
    nxt = running_sums(bounds, keys, ["t"], {}, next_of="t")
    return nxt.where("is_start").select(*keys, F.col("t").alias("start"), F.col("next_t").alias("end"))


def _union_windowed(d: DataFrame, keys: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("start", "end")
    prev_max = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_new", F.when(prev_max.isNull() | (F.col("start") > prev_max), 1).otherwise(0))
    d = d.withColumn("_isl", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return d.groupBy(*keys, "_isl").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_isl")


def interval_union(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end",
                   skew_safe: bool = False) -> DataFrame:
    """Merge overlapping or touching intervals per key.

    Default: islands of a running ``max(end)`` in one per-key window.
    ``skew_safe``: a sweep over ±1 endpoint events netted per (key, t) with a
    map-side partial aggregate; the running coverage (a bucketed scan that
    splits a hot key, ``operators.scan``) crosses 0→positive at an island
    start and positive→0 at its end."""
    d = normalize(df, keys, start, end)
    if not skew_safe:
        return _union_windowed(d, keys)
    ev = (d.select(*keys, F.col("start").alias("t"), F.lit(1).alias("delta"))
           .unionByName(d.select(*keys, F.col("end").alias("t"), F.lit(-1).alias("delta"))))
    per_t = ev.groupBy(*keys, "t").agg(F.sum("delta").alias("delta")).where(F.col("delta") != 0)
    cov = running_sums(per_t, keys, ["t"], {"c": "delta"})
    before = F.col("c") - F.col("delta")
    bounds = cov.where(((before <= 0) & (F.col("c") > 0)) | ((before > 0) & (F.col("c") <= 0))) \
                .select(*keys, "t", (F.col("c") > 0).alias("is_start"))
    return _boundaries_to_intervals(bounds, keys)


def interval_setop(sets: dict[str, DataFrame], keys: Sequence[str],
                   pred: Callable[[dict[str, Column]], Column], skew_safe: bool = False) -> DataFrame:
    """Segments (per key) where ``pred(counts)`` holds; ``counts[name]`` is
    how many intervals of set ``name`` cover the segment.  One sweep gives
    the counts after every event time and the next event time (a per-key
    window, or with ``skew_safe`` a bucketed scan); the chosen elementary
    segments are merged by ``interval_union``."""
    names = list(sets)
    events = None
    for n in names:
        d = normalize(sets[n], keys)
        s = d.select(*keys, F.col("start").alias("t"),
                     *[F.lit(1 if m == n else 0).alias(f"_d_{m}") for m in names])
        e = d.select(*keys, F.col("end").alias("t"),
                     *[F.lit(-1 if m == n else 0).alias(f"_d_{m}") for m in names])
        ev = s.unionByName(e)
        events = ev if events is None else events.unionByName(ev)
    per_t = events.groupBy(*keys, "t").agg(*[F.sum(f"_d_{m}").alias(f"_d_{m}") for m in names])
    if skew_safe:
        seg = running_sums(per_t, keys, ["t"], {f"_c_{m}": f"_d_{m}" for m in names}, next_of="t")
    else:
        w = Window.partitionBy(*keys).orderBy("t")
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        seg = per_t.select("*", F.lead("t").over(w).alias("next_t"),
                           *[F.sum(f"_d_{m}").over(run).alias(f"_c_{m}") for m in names])
    counts = {m: F.col(f"_c_{m}") for m in names}
    chosen = seg.where(F.col("next_t").isNotNull() & pred(counts)) \
                .select(*keys, F.col("t").alias("start"), F.col("next_t").alias("end"))
    return interval_union(chosen, keys, skew_safe=skew_safe)


def interval_subtract(a: DataFrame, b: DataFrame, keys: Sequence[str], skew_safe: bool = False) -> DataFrame:
    return interval_setop({"a": a, "b": b}, keys, lambda c: (c["a"] > 0) & (c["b"] <= 0), skew_safe)


def interval_intersect(a: DataFrame, b: DataFrame, keys: Sequence[str], skew_safe: bool = False) -> DataFrame:
    return interval_setop({"a": a, "b": b}, keys, lambda c: (c["a"] > 0) & (c["b"] > 0), skew_safe)


def interval_hours(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Σ length in hours per key (intervals assumed disjoint)."""
    return df.groupBy(*keys).agg(total_hours().alias("hours"))


#: Grain of the bins (microseconds); a bin of a level has 4^level grains.
GRAIN = MICROS_PER_HOUR


def _down(x: Column, level: Column) -> Column:
    return F.call_function("shiftright", x, level * 2)


def _level(first: Column, last: Column) -> Column:
    """The least level with bins as long as the grains ``first`` to ``last``."""
    size = last - first
    return F.when(size > 0, F.floor((F.length(F.bin(size)) + 1) / 2)).otherwise(0).cast("int")


def _cover(first: Column, last: Column) -> Column:
    """The bins of its level, one or two, that the grains ``first`` to ``last`` touch."""
    level = _level(first, last)
    return F.array_distinct(F.array(_down(first, level), _down(last, level)))


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str],
                 a_prefix: str = "a_", b_prefix: str = "b_") -> DataFrame:
    """Pairs of overlapping intervals on equal keys, with the clipped piece
    ``[greatest(starts), least(ends))``.

    Two intervals overlap where one begins inside the other, so a pair is found
    once: ``b`` begins in ``a``, or ``a`` begins in ``b`` and after it.  The
    longer side is listed under the one or two bins that it touches, of the
    level whose bins are about as long as it is; the side that begins is listed
    under the bin above its start, of each level that the other side uses (a
    ten-year interval uses the ninth).  A scalar subquery brings these levels
    from a written column.  So a key with long histories is not paired all with
    all, however long intervals are: a start is only compared with intervals
    at most some four of their lengths away."""
    grain = lambda c, less=0: F.floor((F.unix_micros(F.col(c).cast("timestamp")) - less) / F.lit(GRAIN)).cast("bigint")
    some = F.col("start") < F.col("end")

    def side(df: DataFrame, prefix: str) -> DataFrame:
        named = df.where(some).withColumns({"_first": grain("start"), "_last": grain("end", 1)}).withColumn("_level", _level(F.col("_first"), F.col("_last")))
        return named.select(*keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys], *[F.col(c).alias(prefix + c) for c in own])

    own = ["_first", "_last", "_level"]
    # each side is read three times: as the one that begins, as the one that holds, and for its levels
    aa, bb = stored(side(a, a_prefix), "overlap-side"), stored(side(b, b_prefix), "overlap-side")

    def begins_in(starting: DataFrame, p: str, holding: DataFrame, q: str, later: bool) -> DataFrame:
        used = holding.agg(F.collect_set(q + "_level")).scalar()
        begin = starting.withColumn("_used", used).withColumn("_bin_level", F.explode("_used"))
        begin = begin.withColumn("_bin_at", _down(F.col(p + "_first"), F.col("_bin_level"))).drop("_used")
        held = holding.withColumns({"_bin_level": F.col(q + "_level"), "_bin_at": F.explode(_cover(F.col(q + "_first"), F.col(q + "_last")))})
        j = begin.join(held, [*keys, "_bin_level", "_bin_at"])
        after = F.col(p + "start") > F.col(q + "start") if later else F.col(p + "start") >= F.col(q + "start")
        return j.where(after & (F.col(p + "start") < F.col(q + "end")))

    hidden = {p + c for p in (a_prefix, b_prefix) for c in own}
    cols = [c for c in aa.columns + [c for c in bb.columns if c not in keys] if c not in hidden]
    j = begins_in(bb, b_prefix, aa, a_prefix, False).select(*cols).unionByName(begins_in(aa, a_prefix, bb, b_prefix, True).select(*cols))
    return j.withColumn("start", F.greatest(a_prefix + "start", b_prefix + "start")) \
            .withColumn("end", F.least(a_prefix + "end", b_prefix + "end"))


def coverage_segments(moments: DataFrame, ts: str, window_end, max_gap_hours: float = 2.0,
                      keys: Sequence[str] = ()) -> DataFrame:
    """Spans where the observer was running: consecutive moments at most
    ``max_gap`` apart are joined; the last moment covers forward
    ``min(max_gap, window_end)``; no moments → no rows.

    Moments are ordered by ranges with border rows (``operators.borders``), so
    no key, and not the whole table where there are no keys, is sorted in one
    task.  Only the moments at which a span begins or ends are looked at again
    to pair them."""
    longest = int(max_gap_hours * MICROS_PER_HOUR)
    d = moments.select(*keys, F.col(ts).alias("t")).where(F.col("t").isNotNull()).distinct()
    near = lambda a, b: F.coalesce(duration_micros(a, b) <= F.lit(longest), F.lit(False))
    d = lead_in_order(d, keys, ["t"], "t", "_next").withColumn("_goes_on", near("t", "_next"))
    d = lead_in_order(d, keys, [F.desc("t")], "t", "_prev").withColumn("_came", near("_prev", "t"))
    # a last moment covers forward; any other needs a neighbour to be a span
    last = F.greatest("t", F.least(F.col("t") + F.expr(f"INTERVAL {longest} MICROSECONDS"), F.lit(window_end)))
    border = d.where((~F.col("_came")) | (~F.col("_goes_on"))).withColumn("_end", F.when(F.col("_next").isNull(), last).when(~F.col("_goes_on"), F.col("t")))
    border = lead_in_order(border, keys, ["t"], "_end", "_next_end")
    end = F.when(F.col("_goes_on"), F.col("_next_end")).otherwise(F.col("_end"))
    return border.where(~F.col("_came")).select(*keys, F.col("t").alias("start"), end.alias("end")).where(F.col("start") < F.col("end"))
