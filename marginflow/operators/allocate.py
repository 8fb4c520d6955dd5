"""Proportional allocation of a group-level amount across the group's rows.

Group totals are computed with ``groupBy().agg()`` (map-side partial sums)
and joined back on the key, instead of ``sum() over (partition by key)``:
a window keeps a whole group in one task, while the aggregate pre-reduces a
hot key on every mapper and the join back is split by AQE's skew-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.operators.aggregates import exact_sum


def share(amount: Column, weight: Column, total: Column) -> Column:
    """``amount · weight / total``; 0 when the total is null or not positive."""
    return F.when(total > 0, amount * (weight / total)).otherwise(F.lit(0.0))


def with_group_total(df: DataFrame, keys: Sequence[str], value: str | Column,
                     out: str = "group_total", null_keys_group: bool = False) -> DataFrame:
    """Add Σ value over the row's group.  Rows whose key is null get a null
    total unless ``null_keys_group`` (then nulls form one group)."""
    v = F.col(value) if isinstance(value, str) else value
    tot = df.groupBy(*keys).agg(exact_sum(v).alias(out))
    if null_keys_group:
        cond = [df[k].eqNullSafe(tot[k]) for k in keys]
        joined = df.join(tot, cond, "left")
        return joined.select(*[df[c] for c in df.columns], tot[out])
    return df.join(tot, list(keys), "left").select(*df.columns, out)


def allocate_proportional(df: DataFrame, keys: Sequence[str], amount: str | Column,
                          weight: str | Column, out: str = "allocated") -> DataFrame:
    """Give each row ``amount · weight / Σ_group weight`` (0 when Σ ≤ 0).

    ``amount`` is the group's amount repeated on each row (e.g. an order's
    freight).
    """
    a = F.col(amount) if isinstance(amount, str) else amount
    w = F.col(weight) if isinstance(weight, str) else weight
    tmp = df.withColumn("_w", w)
    tmp = with_group_total(tmp, keys, "_w", out="_tot")
    return tmp.withColumn(out, share(a, F.col("_w"), F.col("_tot"))).drop("_w", "_tot")
