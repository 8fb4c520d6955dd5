"""Projected, filtered reads of the landed tables (``scan_table``).

Reads go through ``spark.read.parquet`` so Catalyst pushes the projection
(``ReadSchema``) and the predicate (``PushedFilters``) into the scan.  Keep
predicates on bare columns: wrapping a column in a cast or a function blocks
Parquet statistics, exactly as it blocked the index in the original system.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from marginflow.session import table_path

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet read of one landed table."""
    return spark.read.parquet(table_path(sf_dir, name))


def scan_table(spark: SparkSession, sf_dir: str, name: str,
               cols: Sequence[str | Column] | None = None,
               pred: Column | str | None = None) -> DataFrame:
    """``SELECT cols FROM name WHERE pred`` with pushdown-friendly shape:
    filter first (on raw columns), then project."""
    df = read_table(spark, sf_dir, name)
    if pred is not None:
        df = df.where(pred)
    if cols:
        df = df.select(*cols)
    return df
