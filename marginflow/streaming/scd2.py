"""Validity-interval (SCD type 2) histories.

A history row is ``(item, desde, hasta, visto_hasta, <state…>, <extras…>)``:
``hasta IS NULL`` marks the open interval, ``visto_hasta`` the last moment
the state was confirmed.  Two equivalent builders:

* ``scd2_apply(history, batch, now)`` — one observation batch against the
  open intervals (the incremental / streaming form, used by ``foreachBatch``);
* ``scd2_from_log(log)`` — rebuild all intervals from an observation log:
  runs per (item, time bucket), stitched at the buckets' borders.

State comparison is null-safe (``IS DISTINCT FROM``): null → value and
value → null are changes, null → null is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.operators.dedupe import keep_one_per_key, latest_per_key
from marginflow.operators.scan import DAY_MICROS, bucket_of
from marginflow.session import stored


def _same_state(a: str, b: str, state: Sequence[str]) -> Column:
    out = F.lit(True)
    for s in state:
        out = out & F.col(f"{a}.{s}").eqNullSafe(F.col(f"{b}.{s}"))
    return out


def scd2_apply(history: DataFrame, batch: DataFrame, now, item: str, state: Sequence[str],
               extras: Sequence[str] = ()) -> DataFrame:
    """Apply one pulse.  ``batch`` holds ``item, state…, extras…`` (latest
    per item if repeated); ``now`` is the pulse moment (a literal or column).

    1. open rows whose state changed are closed: ``hasta = visto_hasta = now``;
    2. open rows with unchanged state advance ``visto_hasta`` and refresh extras;
    3. items without an open row (new, or just closed) get one from ``now``.
    Items not in the batch and closed rows are untouched, so an empty batch
    changes nothing.
    """
    now_c = now if isinstance(now, Column) else F.lit(now)
    cols = [item, *state, *extras]
    b = batch.select(*cols)
    if "ts" in batch.columns:
        b = latest_per_key(batch.select(*cols, "ts"), [item], "ts").select(*cols)
    else:
        b = keep_one_per_key(b, [item], [])
    closed = history.where(F.col("hasta").isNotNull())
    open_ = history.where(F.col("hasta").isNull())
    j = open_.alias("o").join(b.alias("b"), F.col(f"o.{item}") == F.col(f"b.{item}"), "full_outer")
    has_o, has_b = F.col(f"o.{item}").isNotNull(), F.col(f"b.{item}").isNotNull()
    same = _same_state("o", "b", state)
    out_cols = [item, "desde", "hasta", "visto_hasta", *state, *extras]
    never = F.lit(None).cast(history.schema["hasta"].dataType)

    def row(desde, hasta, visto, keep: str, fresh: str):
        return F.struct(F.coalesce(f"o.{item}", f"b.{item}").alias(item), desde.alias("desde"), hasta.alias("hasta"), visto.alias("visto_hasta"),
                        *[F.col(f"{keep}.{s}").alias(s) for s in state], *[F.col(f"{fresh}.{x}").alias(x) for x in extras])

    # what becomes of an item's open row and what opens: an array per item, so the join runs once
    o_desde, opened = F.col("o.desde"), row(now_c, never, now_c, "b", "b")
    rows = (F.when(~has_b, F.array(row(o_desde, F.col("o.hasta"), F.col("o.visto_hasta"), "o", "o")))
            .when(~has_o, F.array(opened))
            .when(same, F.array(row(o_desde, never, now_c, "o", "b")))
            .otherwise(F.array(row(o_desde, now_c, now_c, "o", "o"), opened)))
    return closed.select(*out_cols).unionByName(j.select(F.explode(rows).alias("r")).select("r.*").select(*out_cols))


#: Width of the time buckets into which an item's log is cut (microseconds).
BUCKET = 7 * DAY_MICROS


def _bucket_runs(log: DataFrame, item: str, ts: str, state: Sequence[str], extras: Sequence[str],
                 tiebreak: Sequence[str], width: int | None) -> DataFrame:
    """Runs of equal state inside each (item, bucket): the first and the last moment, state,
    the extras of the last observation, and the start of the bucket's next run."""
    order = [F.col(ts), *[F.col(t) for t in tiebreak]]
    w = Window.partitionBy(item, "_b").orderBy(*order)
    changed = F.lit(False)
    for s in state:
        changed = changed | ~F.col(s).eqNullSafe(F.lag(s).over(w))
    first = F.row_number().over(w) == 1
    bucket = F.lit(0).cast("bigint") if width is None else bucket_of(log, ts, width)
    d = log.select(item, ts, *state, *extras, *tiebreak, bucket.alias("_b")).withColumn("_chg", (first | changed).cast("int"))
    d = d.withColumn("_run", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = [F.max_by(F.struct(*[F.col(x) for x in extras]), F.struct(*order)).alias("_x")] if extras else []
    runs = d.groupBy(item, "_b", "_run").agg(
        F.min(ts).alias("desde"), F.max(ts).alias("_last"),
        *[F.first(s).alias(s) for s in state],   # constant within a run (null-safe equal)
        *last)
    runs = runs.select(item, "_b", "_run", "desde", "_last", *state, *[F.col(f"_x.{x}").alias(x) for x in extras])
    return runs.withColumn("_next", F.lead("desde").over(Window.partitionBy(item, "_b").orderBy("_run")))


def scd2_windowed(log: DataFrame, item: str, ts: str, state: Sequence[str],
                  extras: Sequence[str] = (), tiebreak: Sequence[str] = ()) -> DataFrame:
    """``scd2_from_log`` with one window per item: for batches, where no item has much."""
    runs = _bucket_runs(log, item, ts, state, extras, tiebreak, None)
    return runs.select(item, "desde", F.col("_next").alias("hasta"), F.coalesce("_next", "_last").alias("visto_hasta"), *state, *extras)


def scd2_from_log(log: DataFrame, item: str, ts: str, state: Sequence[str],
                  extras: Sequence[str] = (), tiebreak: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """Intervals equal to replaying ``scd2_apply`` once per observation moment.

    A run is a maximal streak of equal state per item; it closes at the first
    observation of the next run (``hasta = visto_hasta = that moment``); the
    last run stays open with ``visto_hasta`` = its last observation.  Extras
    carry the last observation of the run.

    Runs are found per (item, time bucket), so an item that holds most of the
    log is as many tasks as it has buckets (``width`` microseconds each).  What
    is stitched at the buckets' borders is a summary of each: its first and
    last state, where its first two runs begin, and its last observation.  A
    bucket's first run goes on from the bucket before if their states are
    equal; its last run ends where the next bucket that changes state does so.
    """
    runs = stored(_bucket_runs(log, item, ts, state, extras, tiebreak, width or BUCKET), "scd2-runs")
    states, more = F.struct(*[F.col(s) for s in state]), F.struct(F.lit(0).alias("_none"), *[F.col(x) for x in extras])
    summary = runs.groupBy(item, "_b").agg(
        F.max("_run").alias("_n"), F.min_by(states, "_run").alias("_fs"), F.max_by(states, "_run").alias("_ls"),
        F.min_by(more, "_run").alias("_fx"), F.max_by(more, "_run").alias("_lx"), F.max("_last").alias("_seen"),
        F.min(F.when(F.col("_run") == 1, F.col("desde"))).alias("_d1"), F.min(F.when(F.col("_run") == 2, F.col("desde"))).alias("_d2"))
    onward = Window.partitionBy(item).orderBy("_b")
    back = Window.partitionBy(item).orderBy(F.desc("_b"))
    same = F.row_number().over(onward) > 1
    for s in state:
        same = same & F.col(f"_fs.{s}").eqNullSafe(F.lag(F.col(f"_ls.{s}")).over(onward))
    summary = summary.select("*", (~same).alias("_head"), F.lag("_lx").over(onward).alias("_before"))
    # where a run that comes from earlier buckets ends, and the extras of its last observation
    ends = (F.when(F.col("_head"), F.struct(F.col("_d1").alias("at"), F.col("_before").alias("x")))
            .when(F.col("_n") > 1, F.struct(F.col("_d2").alias("at"), F.col("_fx").alias("x"))))
    summary = summary.withColumn("_ends", ends)
    summary = summary.select(
        F.col(item).alias("_item"), F.col("_b").alias("_sb"), "_n", "_head",
        F.last("_ends", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("_ends"),
        F.first("_seen").over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_seen"),
        F.first("_lx").over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_final"))
    j = runs.join(summary, F.col(item).eqNullSafe(F.col("_item")) & F.col("_b").eqNullSafe(F.col("_sb")))
    j = j.where((F.col("_run") > 1) | F.col("_head"))
    inside = F.col("_run") < F.col("_n")
    hasta = F.when(inside, F.col("_next")).otherwise(F.col("_ends.at"))
    kept = lambda x: F.when(inside, F.col(x)).when(F.col("_ends").isNotNull(), F.col(f"_ends.x.{x}")).otherwise(F.col(f"_final.{x}"))
    return j.select(item, "desde", hasta.alias("hasta"), F.coalesce(hasta, "_seen").alias("visto_hasta"),
                    *state, *[kept(x).alias(x) for x in extras])


def clip_end(hasta: str = "hasta", visto: str = "visto_hasta", window_end=None) -> Column:
    """``least(coalesce(hasta, visto_hasta), window_end)``."""
    e = F.coalesce(F.col(hasta), F.col(visto))
    return F.least(e, F.lit(window_end)) if window_end is not None else e
