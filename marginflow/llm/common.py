"""Helpers shared by the corpus operators: the shared folder, tables written to it, sources."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one Arrow batch carries to Python; texts may be long, so batches are kept short.
ARROW_ROWS = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent (unit tests on a local master) a folder of our own is set;
    on any other master the missing setting is an error, since a machine-local folder would
    not be seen by the executors.
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    there = tempfile.mkdtemp(prefix="marginflow-shared-")
    spark.conf.set("spark.checkpoint.dir", there)
    return there


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps start from files, so a
    lost executor costs no recomputation, and each row is computed once."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bounds the rows of an Arrow batch for the jobs that follow, so that a batch of long
    texts stays small in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def numbered(docs: DataFrame, stem: str) -> tuple[DataFrame, str]:
    """``docs`` with a row key, under a name of its own, that every reading gives alike, however the
    files are split among the cores at hand. Rows of a plain file scan are named by file and place in
    the file (the path by 64 bits of hash); other rows are numbered and written once."""
    name = stem
    while name in docs.columns:
        name += "_"
    scan = docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    if scan and docs.inputFiles() and "_metadata" not in docs.columns:
        key = F.concat(F.hex(F.xxhash64("_metadata.file_path")), F.lit(":"), F.col("_metadata.row_index").cast("string"))
        return docs.select("*", key.alias(name)), name
    return stored(docs.withColumn(name, F.monotonically_increasing_id().cast("string")), "numbered"), name
