"""Data-quality and reconciliation operators.

All of them are aggregations (partial on the map side) returning small
result frames; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_audit(df: DataFrame, keys: Sequence[str], label: str | None = None) -> DataFrame:
    """rows, distinct keys, excess rows (= rows − distinct keys)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    out = per_key.agg(F.sum("_n").cast("bigint").alias("rows"),
                      F.count(F.lit(1)).alias("distinct_keys"))
    out = out.select(F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), "distinct_keys")
    out = out.withColumn("excess", F.col("rows") - F.col("distinct_keys"))
    if label is not None:
        out = out.select(F.lit(label).alias("table_name"), "*")
    return out


def contradiction_audit(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys carrying more than one distinct value of ``value``."""
    return (df.groupBy(*keys).agg(F.countDistinct(value).alias("distinct_values"))
              .where(F.col("distinct_values") > 1))


def repeated_key_excess(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Σ(count − 1) over keys that appear more than once, and how many such keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return per_key.agg(F.count(F.lit(1)).alias("repeated_keys"),
                       F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("excess_rows"))


def unique_key_guard(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Offending keys (must be empty)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def mismatch_count(stored: Column, recomputed: Column, tol: float = 0.01) -> Column:
    """count of rows whose stored value differs from the recomputed one by
    more than ``tol`` (null on either side does not count)."""
    return F.count_if(F.abs(stored - recomputed) > tol)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: total rows and non-null count (a single pass)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}")
                                                      for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, non_null)", "_rows AS rows") \
              .select("column_name", "rows", "non_null", (F.col("rows") - F.col("non_null")).alias("nulls"))


def find_value_in_row(df: DataFrame, key: str, needle: str | None = None,
                      lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Scan every column of every row for a substring (text columns) or a
    numeric range (numeric columns): unpivot with ``stack``, then filter."""
    from pyspark.sql import types as T

    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != key]
    num_cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, T.NumericType) and f.name != key]
    parts = []
    if needle is not None and text_cols:
        st = ", ".join(f"'{c}', `{c}`" for c in text_cols)
        t = df.selectExpr(f"`{key}`", f"stack({len(text_cols)}, {st}) AS (column_name, value)")
        parts.append(t.where(F.col("value").contains(needle)))
    if lo is not None and hi is not None and num_cols:
        st = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in num_cols)
        n = df.selectExpr(f"`{key}`", f"stack({len(num_cols)}, {st}) AS (column_name, num)")
        parts.append(n.where(F.col("num").between(lo, hi))
                     .select(key, "column_name", F.col("num").cast("string").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
