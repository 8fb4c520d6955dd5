"""Ordered operations over range partitions, stitched by border rows.

A window over one key, or over no key at all, sorts that key's rows in one task. Here the rows
are put in ranges of a total order, by ``repartitionByRange``, and written once. A hot key, or
the whole table, is then many consecutive ranges. Each range is scanned alone, and what it
needs of the ranges before or after it comes from their border rows: the first and the last row
of each range, so as many rows as the shuffle has partitions, whatever the size of the table.
Those few rows are folded on the driver, as the sampled bounds of the ranges themselves are,
and sent back to the tasks.

``order`` should be total; rows that are equal in it may come in any order. Keys are compared
null-safe. Ranges without rows are skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.session import stored

PID, AT = "_pid", "_at"


def ordered_ranges(df: DataFrame, order: Sequence[str | Column], keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) in consecutive ranges of ``order``, written once, with
    the range's number and the row's place in it."""
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    sorted_ = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stored(sorted_.select(*(keep or df.columns), F.spark_partition_id().alias(PID), place.alias(AT)), "ranges")


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))


def _border_rows(ranges: DataFrame, keys: Sequence[str], *aggregates: Column) -> list[Row]:
    """Per range, in order: its first and last key, and ``aggregates`` over its rows."""
    key = _key(keys)
    b = ranges.groupBy(PID).agg(F.min_by(key, F.col(AT)).alias("first_key"), F.max_by(key, F.col(AT)).alias("last_key"), *aggregates)
    return sorted(b.collect(), key=lambda r: r[PID])


def _attach(ranges: DataFrame, carried: list[tuple[int, object]], dtype: T.DataType, out: str) -> DataFrame:
    """``ranges`` with a value per range (at most one row a range, so sent to every task)."""
    schema = T.StructType([T.StructField(PID, T.IntegerType()), T.StructField(out, dtype)])
    small = ranges.sparkSession.createDataFrame(carried, schema)
    return ranges.join(F.broadcast(small), PID, "left")


def _local(keys: Sequence[str]) -> Window:
    return Window.partitionBy(PID, *keys).orderBy(AT)


def _first_key(ranges: DataFrame, keys: Sequence[str], borders: list[Row]) -> DataFrame:
    """``ranges`` with ``__head``: whether the row has its range's first key."""
    dtype = ranges.select(_key(keys).alias("k")).schema["k"].dataType
    r = _attach(ranges, [(b[PID], b.first_key) for b in borders], dtype, "__first")
    return r.withColumn("__head", _key(keys).eqNullSafe(F.col("__first"))).drop("__first")


def _fold(borders: list[Row], start, step: Callable[[Row, object], object]) -> list[tuple[int, object]]:
    """What each range's first key brings from the ranges before it. ``step`` gives, of a range
    and what its first key brought, what its last key hands on."""
    out, carry, last = [], start, None
    for b in borders:
        carry = carry if last is not None and last == b.first_key else start
        out.append((b[PID], carry))
        carry, last = step(b, carry), b.last_key
    return out


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str, keep: Sequence[str] | None = None) -> DataFrame:
    """The 0-based place of each row among its key's rows in ``order``; a key of any size is
    spread over many tasks."""
    r = ordered_ranges(df, [*keys, *order], keep)
    local = r.withColumn("__n", F.row_number().over(_local(keys)).cast("long"))
    last_n = F.max_by("__n", F.col(AT)).alias("last_n")
    borders = _border_rows(local, keys, last_n)
    carried = _fold(borders, 0, lambda b, carry: b.last_n + (carry if b.first_key == b.last_key else 0))
    h = _attach(_first_key(local, keys, borders), carried, T.LongType(), "__carry")
    place = F.col("__n") - 1 + F.when(F.col("__head"), F.col("__carry")).otherwise(0)
    return h.withColumn(out, place).drop("__n", "__carry", "__head", PID, AT)


def fill_down(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, out: str) -> DataFrame:
    """The last value that is not null at or before each row among its key's rows in ``order``."""
    r = ordered_ranges(df, [*keys, *order])
    local = r.withColumn(out, F.last(value, ignorenulls=True).over(_local(keys)))
    borders = _border_rows(local, keys, F.max_by(out, F.col(AT)).alias("last_value"))
    carried = _fold(borders, None, lambda b, carry: b.last_value if b.last_value is not None or b.first_key != b.last_key else carry)
    h = _attach(_first_key(local, keys, borders), carried, df.schema[value].dataType, "__carry")
    return h.withColumn(out, F.coalesce(out, F.when(F.col("__head"), F.col("__carry")))).drop("__carry", "__head", PID, AT)


def lead_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, out: str) -> DataFrame:
    """``value`` of the next row of the same key in ``order`` (null on a key's last row). With
    no keys, of the next row of the whole table."""
    r = ordered_ranges(df, [*keys, *order])
    borders = _border_rows(r, keys, F.min_by(F.struct(value), F.col(AT)).alias("first_value"))
    following = [(b[PID], (after.first_key, after.first_value[0])) for b, after in zip(borders, borders[1:], strict=False)]
    dtype = r.select(F.struct(_key(keys).alias("k"), F.col(value).alias("v")).alias("x")).schema["x"].dataType
    h = _attach(r, following, dtype, "__after")
    here = Window.partitionBy(PID).orderBy(AT)
    nxt = F.coalesce(F.lead(F.struct(_key(keys).alias("k"), F.col(value).alias("v"))).over(here), F.col("__after"))
    h = h.withColumn("__next", nxt)
    return h.withColumn(out, F.when(F.col("__next.k").eqNullSafe(_key(keys)), F.col("__next.v"))).drop("__next", "__after", PID, AT)
