"""Keep-one-row-per-key operators (DISTINCT ON, keep last, latest per key).

They are written as ``groupBy(key).agg(max_by(struct(row), order))``
rather than ``row_number() over (partition by key order by ...)``: the
aggregate has a map-side partial step, so a hot key holding a third of the
rows is pre-reduced on every mapper before the shuffle instead of being
sorted whole inside one task (struct rows are aggregated by sorting, on
either side of the shuffle).  Ties on ``order`` are broken by the full
row, so the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                     last: bool = True) -> DataFrame:
    """One row per ``keys``: the row with the greatest (``last=True``) or the
    smallest ``order``; remaining ties go to the greatest/smallest full row."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(c) for c in others])
    rank = F.struct(*_as_cols(order), row.alias("_row"))
    pick = F.max_by if last else F.min_by
    agg = df.groupBy(*keys).agg(pick(row, rank).alias("_keep"))
    return agg.select(*keys, *[F.col("_keep")[c].alias(c) for c in others])


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Later rows (by ``order``, e.g. an ingest sequence) overwrite earlier ones."""
    return keep_one_per_key(df, keys, order, last=True)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str | Column) -> DataFrame:
    """``DISTINCT ON (keys) ORDER BY keys, ts DESC``."""
    return keep_one_per_key(df, keys, [ts], last=True)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``DISTINCT ON (keys)`` with no order: we pick the smallest row, so the
    choice is reproducible."""
    return keep_one_per_key(df, keys, [], last=False)
