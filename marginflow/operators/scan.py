"""Skew-safe ordered scans per key (running sums, next value).

``Window.partitionBy(key).orderBy(t)`` puts every row of a key into one
task, so a key holding a third of the data runs on one core.  Here each key
is cut into consecutive *buckets* of its ordering column (fixed-width time
or number ranges — deterministic, no sampling job):

1. the scan runs locally per ``(key, bucket)`` — a hot key spreads over its
   buckets, so the work is balanced across tasks;
2. a per-``(key, bucket)`` summary (one row per bucket a key touches) gives
   each bucket the carry from the buckets before it (running sum) or the
   first value of the bucket after it (next value);
3. the carry is joined back on ``(key, bucket)``.

The local scan is written once to the shared folder; summary and join read
it from there, so a chain of scans reads its input once and its plan stays
short.

The summary is tiny next to the data (≤ span/width rows per key), so its
own per-key window is cheap even for the hottest key.  Hash partitioning is
deterministic, so recomputing a lost partition gives the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.session import stored

# Default bucket widths: one day for time orderings, a fixed span for numbers.
DAY_MICROS = 86_400_000_000
NUMERIC_WIDTH = 1_000


def bucket_of(df: DataFrame, col: str, width: int | None = None) -> Column:
    """Deterministic bucket of an ordering column."""
    t = df.schema[col].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        w = width or DAY_MICROS
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(t), F.col(col))
        return F.floor(micros / F.lit(w)).cast("bigint")
    if isinstance(t, T.DateType):
        return F.floor(F.datediff(F.col(col), F.lit("1970-01-01").cast("date")) / F.lit(width or 1)).cast("bigint")
    return F.floor(F.col(col) / F.lit(width or NUMERIC_WIDTH)).cast("bigint")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str | Column],
                 width: int | None = None, next_of: str | None = None) -> DataFrame:
    """Add inclusive running sums ``values`` (out name → column) per key in
    ``order`` (a total order within the key; its first column is bucketed);
    optionally also ``next_<next_of>``: the value of ``next_of`` on the
    following row of the same key (null on the last row)."""
    vals = {k: (F.col(v) if isinstance(v, str) else v) for k, v in values.items()}
    base = df.select("*", bucket_of(df, order[0], width).alias("_b"),
                     *[c.alias(f"_v_{k}") for k, c in vals.items()])
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = stored(base.select("*", *[F.sum(f"_v_{k}").over(run).alias(f"_l_{k}") for k in vals],
                               *([F.lead(next_of).over(w).alias("_lnext")] if next_of else [])), "scan")
    summ = local.groupBy(*keys, "_b").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in vals],
                                          *([F.min_by(next_of, F.struct(*order)).alias("_first")] if next_of else []))
    ws = Window.partitionBy(*keys).orderBy("_b")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_cb"),
                        *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_c_{k}") for k in vals],
                        *([F.lead("_first").over(ws).alias("_cnext")] if next_of else []))
    same = F.col("_b") == F.col("_cb")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return local.join(carry, same, "left").select(
        *df.columns, *[(F.col(f"_c_{k}") + F.col(f"_l_{k}")).alias(k) for k in vals],
        *([F.coalesce("_lnext", "_cnext").alias(f"next_{next_of}")] if next_of else []))
