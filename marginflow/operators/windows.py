"""Window-based operators: change points, consecutive pairs, streaks, and
a scalable global numbering.

Windows over raw rows are partitioned by an entity key, or are cut into range
partitions whose border rows carry over (``operators.borders``).  The numbering
of all rows (``global_index``) range-partitions, counts each partition, and adds
the partition's offset (one number per partition, however large the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.operators.borders import lead_in_order, number_within
from marginflow.session import stored


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def change_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], state: Sequence[str]) -> DataFrame:
    """Rows that start a run of equal state per key, with a run number.
    ``order`` should be total within a key (a time and a tie-breaker).

    The state before and the number come over range partitions and their border
    rows, so a hot key is many tasks."""
    d = df.withColumn("_state", F.struct(*[F.col(s) for s in state]))
    d = lead_in_order(d, keys, [F.desc(o) for o in order], "_state", "_was")
    changed = F.col("_was").isNull()
    for s in state:
        changed = changed | ~F.col(s).eqNullSafe(F.col(f"_was.{s}"))
    heads = d.where(changed).drop("_state", "_was")
    return number_within(heads, keys, order, "run_no").withColumn("run_no", F.col("run_no") + 1)


def gap_pairs(df: DataFrame, ts: str, max_gap_seconds: int, keys: Sequence[str] = ()) -> DataFrame:
    """Consecutive (ts, next_ts) pairs whose gap is ≤ ``max_gap_seconds``.

    The next moment comes over range partitions and their border rows, so
    neither a hot key nor, without keys, the whole table is one task."""
    d = df.select(*keys, F.col(ts).alias("start"))
    out = lead_in_order(d, keys, ["start"], "start", "end")
    gap = F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))
    return out.where(F.col("end").isNotNull() & (gap <= F.lit(max_gap_seconds * 1_000_000)))


def streaks(df: DataFrame, keys: Sequence[str], day: str, flag: str) -> DataFrame:
    """Gaps-and-islands: runs of consecutive calendar days where ``flag`` is
    true, per key → (keys, start_day, end_day, days)."""
    d = df.where(F.col(flag)).select(*keys, day).distinct()
    w = Window.partitionBy(*keys).orderBy(day)
    d = d.withColumn("_grp", F.date_sub(F.col(day), F.row_number().over(w).cast("int")))
    return (d.groupBy(*keys, "_grp")
             .agg(F.min(day).alias("start_day"), F.max(day).alias("end_day"),
                  F.count(F.lit(1)).alias("days"))
             .drop("_grp"))


def last_streak(df: DataFrame, keys: Sequence[str], day: str, flag: str) -> DataFrame:
    """Latest run per key (max start day)."""
    s = streaks(df, keys, day, flag)
    return (s.groupBy(*keys).agg(F.max_by(F.struct("start_day", "end_day", "days"), "start_day").alias("_s"))
             .select(*keys, "_s.start_day", "_s.end_day", "_s.days"))


def global_index(df: DataFrame, order: Sequence[Column], out: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in a total order, without moving all rows
    to one partition.

    ``repartitionByRange`` puts ordered key ranges in ordered partitions;
    inside each (sorted) partition ``monotonically_increasing_id`` minus the
    partition's base id is the local position; a partition's offset is the
    row count of the partitions before it (one number per partition, so that
    table is tiny and broadcast by construction).  The locally numbered rows
    are written once and both sides read them: a second range partitioning
    would sample bounds of its own and give other partitions.  ``order`` must
    be a total order (add tie-breakers) for the result to be deterministic.
    """
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_local", F.monotonically_increasing_id()
                                - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)), "global-index")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(wo), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
                  .drop("_pid", "_local", "_off"))


def serpentine_groups(df: DataFrame, order: Sequence[Column], groups: int = 3,
                      out: str = "grp") -> DataFrame:
    """Snake assignment in ``order``: 1,2,3,3,2,1,1,2,3,…  (round i div g,
    position i mod g; even rounds ascend, odd rounds descend)."""
    idx = global_index(df, order, out="_i")
    rnd = F.floor(F.col("_i") / groups)
    pos = F.col("_i") % groups
    grp = F.when(rnd % 2 == 0, pos + 1).otherwise(F.lit(groups) - pos)
    return idx.withColumn(out, grp.cast("int")).drop("_i")
