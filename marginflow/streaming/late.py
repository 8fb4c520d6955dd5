"""Late data: an event-time watermark that loses nothing.

Spark's stateful operators drop rows behind the watermark without a trace.  Here a feed is first
parted by the same rule, in a stream of its own: a row is late if its time is at or before the
greatest time of all earlier batches less the delay.  Late rows go to a table of their own, the
others go on, batch by batch, and no operator that reads them with the same delay drops any, as
its watermark is never ahead of the parting one.

    root/on_time/epoch=N, root/late/epoch=N   the rows of batch N
    root/high_water/epoch=N                   the greatest time up to batch N

All are written per epoch, overwritten when an epoch is tried again.  ``close_feed`` ends a feed:
a row without values, later than all windows that are open, drives the watermark over them, so the
last windows come out.  What arrives after that is late.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CLOCK = "_clock"


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp with or without a zone."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def delay_micros(delay: str) -> int:
    """"7 days", "90 minutes", … as microseconds."""
    n, unit = re.fullmatch(r"(\d+) (second|minute|hour|day)s?", delay).groups()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit] * 1_000_000


def _files(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _high_water(spark: SparkSession, root: str, epoch: int | None = None) -> int | None:
    """The greatest time, to the millisecond as the watermark has it, of the batches before ``epoch``."""
    path = os.path.join(root, "high_water")
    if not _files(spark, path):
        return None
    h = spark.read.schema("at bigint, epoch bigint").parquet(path)
    at = (h if epoch is None else h.where(F.col("epoch") < epoch)).agg(F.max("at").alias("at")).first().at
    return None if at is None else at // 1000 * 1000


def part_late(spark: SparkSession, source_path: str, schema: StructType, ts: str, delay: str, root: str,
              max_files_per_trigger: int | None = None) -> None:
    """Parts the files available now; a second run on the same ``root`` goes on where the first ended."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def part(batch: DataFrame, epoch: int) -> None:
        at = _high_water(spark, root, epoch)
        rows = batch.withColumn(CLOCK, micros(ts))
        late = F.lit(False) if at is None else F.coalesce(F.col(CLOCK) <= at - delay_micros(delay), F.lit(False))
        folder = lambda kind: os.path.join(root, kind, f"epoch={epoch}")
        rows = rows.withColumn("_late", late | F.col(ts).isNull())
        rows.where("_late").drop("_late", CLOCK).write.mode("overwrite").parquet(folder("late"))
        rows.where("not _late").drop("_late", CLOCK).write.mode("overwrite").parquet(folder("on_time"))
        high = spark.read.schema(schema).parquet(folder("on_time")).agg(F.max(micros(ts)).alias("at"))
        high.coalesce(1).write.mode("overwrite").parquet(folder("high_water"))

    q = (reader.parquet(source_path).writeStream.foreachBatch(part)
         .option("checkpointLocation", os.path.join(root, "part_checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()


def on_time(spark: SparkSession, schema: StructType, root: str) -> DataFrame:
    """The rows on time as a stream."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(os.path.join(root, "on_time"))


def with_clock(s: DataFrame, ts: str, delay: str) -> DataFrame:
    """``s`` with ``_clock``, the event time, as its last column and ``delay`` as its watermark."""
    return s.withColumn(CLOCK, F.timestamp_micros(micros(ts))).withWatermark(CLOCK, delay)


def late_rows(spark: SparkSession, schema: StructType, root: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(os.path.join(root, "late"))


def close_feed(spark: SparkSession, schema: StructType, ts: str, delay: str, root: str, longest_window: str = "1 day") -> None:
    """Ends the feed: a row with a time only, beyond every open window."""
    at = _high_water(spark, root)
    if at is None:
        return
    at += delay_micros(delay) + delay_micros(longest_window) + 1000
    moment = F.timestamp_micros(F.lit(at)).cast(schema[ts].dataType)
    row = spark.range(1, numPartitions=1).select(*[moment.alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    row.write.mode("overwrite").parquet(os.path.join(root, "on_time", "closing"))
    spark.range(1, numPartitions=1).select(F.lit(at).cast("bigint").alias("at")).write.mode("overwrite").parquet(os.path.join(root, "high_water", "epoch=-1"))


def run_windows(spark: SparkSession, schema: StructType, ts: str, key: str, delay: str, root: str, window: str,
                aggregates: Sequence[Column]) -> DataFrame:
    """Tumbling windows over the rows on time: a ``key`` that comes again within the delay counts once,
    and a window is written when the watermark has passed it, once and for all.  Returns the closed
    windows as (start, end, aggregates…)."""
    s = with_clock(on_time(spark, schema, root), ts, delay).dropDuplicatesWithinWatermark([key])
    w = s.groupBy(F.window(CLOCK, window).alias("w")).agg(*aggregates)
    out = os.path.join(root, "windows")
    q = (w.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *[c for c in w.columns if c != "w"])
         .writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(root, "window_checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
