"""Session helpers.

The library never assumes it owns the session: every function takes the
caller's ``SparkSession``.  ``local_session`` exists for tests, benches and
examples only; on a cluster the session (and ``spark.checkpoint.dir``) comes
from the platform.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes
# (broadcast only when a side is *measured* small), coalesces tiny shuffle
# partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Split a skewed join even where the split costs an extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


WRITERS, FOLDERS = "spark.sql.maxConcurrentOutputFileWriters", 8


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "marginflow") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A folder of our own is made only on a ``local`` master (tests on one
    machine); elsewhere a missing setting is an error, because executors do
    not see the driver's disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not current:
        current = sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="marginflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once to the shared folder and read back; with ``by`` (the
    last columns, of few values) in folders of these columns.

    Every later use sees the same rows (also rows numbered by partition), no
    step is computed twice, and a lost executor costs no recomputation."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    spark = df.sparkSession
    before = spark.conf.get(WRITERS)
    if by:  # a writer per folder instead of a sort by the folders' columns
        spark.conf.set(WRITERS, str(FOLDERS))
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(WRITERS, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
