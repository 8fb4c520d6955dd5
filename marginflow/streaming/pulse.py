"""Observation pulses as a Structured Streaming job.

Each micro-batch of observations is merged into the validity-interval
history with ``scd2_merge_log``: the open interval of an item is turned into
two synthetic observations (at ``desde`` and at ``visto_hasta``), the batch's
observations are added, and the runs are rebuilt with ``scd2_from_log``.
Items with an observation at or before what their open interval has seen are
late; their runs are rebuilt from the kept observations.  So a batch may hold
many observations per item in any order, and replaying the log in any
batching gives the same history as one batch rebuild.

State lives in Parquet under the cluster's shared ``spark.checkpoint.dir``:
per epoch the observations, the intervals it closed and the items it rebuilt
(all append-only), and versions of the open intervals, the only part that a
batch writes anew.  Version *n* is the state after epoch *n − 1*: a run that
starts again reads the newest complete version from storage, and a retried
epoch reads the same input version and writes the same output.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.session import ensure_checkpoint_dir, stored
from marginflow.streaming.late import close_feed, part_late, run_windows
from marginflow.streaming.scd2 import scd2_from_log, scd2_windowed


def merge_open(open_: DataFrame, batch: DataFrame, item: str, ts: str, state: Sequence[str], extras: Sequence[str] = (),
               tiebreak: Sequence[str] = (), log: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(runs, untouched, late): the runs of the batch's items, open and newly
    closed; the open intervals of all other items; and the late items, whose
    runs are complete and stand for all their earlier intervals.

    ``log`` holds all observations so far, the batch's too; without it the
    batches must come in order of time per item."""
    cols = [item, ts, *state, *extras, *tiebreak]
    untouched = open_.join(batch.select(item).distinct(), item, "left_anti")
    late = None
    if log is not None:
        since = batch.groupBy(item).agg(F.min(ts).alias("_since"))
        late = since.join(open_.select(item, F.col("visto_hasta").alias("_seen")), item).where(F.col("_since") <= F.col("_seen")).select(item)
        known = scd2_from_log(log.select(*cols).join(late, item, "left_semi"), item, ts, state, extras, tiebreak)
        batch = batch.join(late, item, "left_anti")
        open_ = open_.join(late, item, "left_anti")
    obs = batch.select(*cols).withColumn("_src", F.lit(1))
    tb = [F.lit(None).cast(batch.schema[t].dataType).alias(t) for t in tiebreak]
    moments = F.explode(F.array("desde", "visto_hasta")).alias(ts)
    syn = open_.join(batch.select(item).distinct(), item, "left_semi").select(item, moments, *state, *extras, *tb).withColumn("_src", F.lit(0))
    runs = scd2_windowed(syn.unionByName(obs), item, ts, state, extras, ["_src", *tiebreak])
    return (runs if late is None else runs.unionByName(known)), untouched.select(*runs.columns), late


def scd2_merge_log(history: DataFrame | None, batch: DataFrame, item: str, ts: str,
                   state: Sequence[str], extras: Sequence[str] = (),
                   tiebreak: Sequence[str] = (), log: DataFrame | None = None) -> DataFrame:
    """``history`` after the observations of ``batch`` (see ``merge_open``)."""
    if history is None:
        return scd2_windowed(batch.select(item, ts, *state, *extras, *tiebreak), item, ts, state, extras, tiebreak)
    closed = history.where(F.col("hasta").isNotNull())
    runs, untouched, late = merge_open(history.where(F.col("hasta").isNull()), batch, item, ts, state, extras, tiebreak, log)
    if late is not None:
        closed = closed.join(late, item, "left_anti")
    return closed.select(*runs.columns).unionByName(untouched).unionByName(runs)


class HistoryTable:
    """History in a shared folder: ``closed/epoch=N`` and ``late/epoch=N``,
    append-only, and ``open/v=N``.

    ``version`` is the newest complete one (its ``_SUCCESS`` file is there);
    of closed intervals those of its epochs count, and of an item rebuilt in
    an epoch only those written then or later."""

    def __init__(self, spark: SparkSession, base: str, item: str):
        self.spark, self.base, self.item = spark, base, item

    def path(self, kind: str, n: int) -> str:
        return os.path.join(self.base, kind, f"v={n:06d}" if kind == "open" else f"epoch={n:06d}")

    def _numbers(self, kind: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = path(os.path.join(self.base, kind))
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        done = [st.getPath() for st in fs.listStatus(root) if fs.exists(path(st.getPath(), "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in done)

    def versions(self) -> list[int]:
        return self._numbers("open")

    @property
    def version(self) -> int:
        return max(self.versions(), default=0)

    def read_open(self, below: int | None = None) -> DataFrame | None:
        """Open intervals of the newest version, or of the newest one before ``below``."""
        v = max((x for x in self.versions() if below is None or x < below), default=0)
        return self.spark.read.parquet(self.path("open", v)) if v else None

    def read(self) -> DataFrame | None:
        """All intervals of the newest version."""
        v, open_ = self.version, self.read_open()
        if open_ is None:
            return None
        epochs = [e for e in self._numbers("closed") if e < v]
        closed = self.spark.read.option("basePath", os.path.join(self.base, "closed")).parquet(*[self.path("closed", e) for e in epochs])
        late = [e for e in self._numbers("late") if e < v]
        if late:
            rebuilt = self.spark.read.option("basePath", os.path.join(self.base, "late")).parquet(*[self.path("late", e) for e in late])
            last = rebuilt.groupBy(self.item).agg(F.max("epoch").alias("_rebuilt"))
            closed = closed.join(last, self.item, "left").where(F.col("_rebuilt").isNull() | (F.col("epoch") >= F.col("_rebuilt")))
        return closed.select(*open_.columns).unionByName(open_)

    def write(self, runs: DataFrame, untouched: DataFrame | None, late: DataFrame | None, epoch: int) -> None:
        """The outcome of an epoch.  The same epoch again overwrites it, but a
        version that newer ones stand on stays.  The open intervals come last:
        they make the version complete."""
        if self.version > epoch + 1:
            raise ValueError(f"history has version {self.version}; version {epoch + 1} would be lost work")
        runs = stored(runs, "pulse-runs")
        runs.where(F.col("hasta").isNotNull()).write.mode("overwrite").parquet(self.path("closed", epoch))
        if late is not None:
            late.write.mode("overwrite").parquet(self.path("late", epoch))
        open_ = runs.where(F.col("hasta").isNull())
        (open_ if untouched is None else untouched.unionByName(open_)).write.mode("overwrite").parquet(self.path("open", epoch + 1))


def run_pulse_stream(spark: SparkSession, source_path: str, schema, to_observations,
                     item: str, ts: str, state: Sequence[str], extras: Sequence[str] = (),
                     tiebreak: Sequence[str] = (), base: str | None = None,
                     max_files_per_trigger: int | None = None) -> HistoryTable:
    """Drain the observation files available now through ``foreachBatch``
    and return the history table.  A second run on the same ``base`` goes on
    where the first one ended."""
    root = base or os.path.join(ensure_checkpoint_dir(spark), f"pulse-{uuid.uuid4().hex[:8]}")
    table = HistoryTable(spark, os.path.join(root, "history"), item)
    reader = spark.readStream.schema(schema)
    if not source_path.endswith("/") and source_path.endswith(".parquet"):
        reader = reader.option("pathGlobFilter", os.path.basename(source_path))
        source_path = os.path.dirname(source_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = to_observations(reader.parquet(source_path))

    log_path = os.path.join(root, "observations")

    def merge(batch_df: DataFrame, epoch_id: int) -> None:
        path = os.path.join(log_path, f"epoch={epoch_id:06d}")
        batch_df.write.mode("overwrite").parquet(path)
        batch = spark.read.schema(batch_df.schema).parquet(path)
        if batch.isEmpty():
            return
        before = table.read_open(epoch_id + 1)
        if before is None:
            table.write(scd2_merge_log(None, batch, item, ts, state, extras, tiebreak), None, None, epoch_id)
            return
        log = spark.read.schema(batch_df.schema).parquet(log_path)
        table.write(*merge_open(before, batch, item, ts, state, extras, tiebreak, log), epoch_id)

    q = (stream.writeStream.foreachBatch(merge)
         .option("checkpointLocation", os.path.join(root, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table


def windowed_revenue_stream(spark: SparkSession, source_path: str, schema, out_root: str | None = None,
                            watermark: str = "7 days", window: str = "1 hour") -> DataFrame:
    """Tumbling revenue of the files available now, the last windows too: the
    feed is closed at its end.  Rows beyond the watermark are not dropped but
    kept under ``out_root/late`` (``streaming.late``)."""
    root = out_root or os.path.join(ensure_checkpoint_dir(spark), f"revenue-{uuid.uuid4().hex[:8]}")
    part_late(spark, source_path, schema, "ts", watermark, root)
    close_feed(spark, schema, "ts", watermark, root, window)
    w = run_windows(spark, schema, "ts", "event_id", watermark, root, window, [F.sum("value").alias("revenue"), F.count("event_id").alias("events")])
    return w.where("events > 0").select(F.struct("start", "end").alias("w"), "revenue", "events")
