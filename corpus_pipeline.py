"""The corpus pipeline: quality rules, near-dedup, decontamination, PII, packing.

Each stage takes what its predecessor kept as Parquet and calls one corpus operator; all but
the last return the columns of ``documents``. Documents are the rows of the table: repeated
ids and null ids are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm import decontaminate, order_minhash, outliers, packing, pii
from marginflow.llm.common import new_path, numbered

#: A word of the decontamination stage, fixed as in its operator.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows, row = numbered(docs, "_row")
    kept = outliers.quality_rules(rows, row).filter("kept").select(row)
    return rows.join(kept, row, "left_semi").drop(row)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return order_minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item of ten words or more. An item of fewer words
    is one window, which clean texts may hold by chance, so hits of such items reject a document only
    where they cover half of its words or more."""
    rows, row = numbered(docs, "_row")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumn("_words", F.regexp_count("text", F.lit(WORD)))
    found = decontaminate.contamination(rows, items.filter(F.col("_words") >= decontaminate.WINDOW), id_col=row)
    clean = found.filter("not contaminated").select(row)
    short = items.filter(F.col("_words").between(1, decontaminate.WINDOW - 1))
    if not short.isEmpty():
        mostly = decontaminate.contamination(rows, short, id_col=row).filter("contaminated and 2 * n_hit >= n_words")
        clean = clean.join(mostly.select(row), row, "left_anti")
    return rows.join(clean, row, "left_semi").drop(row)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by tags."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The method's verdicts and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
