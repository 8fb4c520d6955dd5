"""Registered streaming and run-log queries."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from marginflow.plans import experiment as EX
from marginflow.registry import query
from marginflow.session import ensure_checkpoint_dir, stored, table_path
from marginflow.sources import roles as R
from marginflow.sources.tables import read_table
from marginflow.streaming.keyed import run_keyed_pulse
from marginflow.streaming.late import close_feed, late_rows, part_late, run_windows
from marginflow.streaming.pulse import run_pulse_stream

FRESHNESS_NOW = dt.datetime(2024, 1, 31)
OVERDUE_HOURS = 2
FEED_START = dt.date(2024, 1, 1)


@query("pulse_stream")
def q_pulse_stream(spark, sf):
    """Listing observations streamed through foreachBatch into the state
    history; the final table equals ``scd2_state``."""
    schema = read_table(spark, sf, "events").schema

    def to_obs(events):
        return EX.observed_states(R.project_observations(events))

    table = run_pulse_stream(spark, table_path(sf, "events"), schema, to_obs, "item_id", "ts",
                             EX.STATE_COLS, EX.STATE_EXTRAS, ["event_id"])
    return table.read()


FEED_BATCHES, FEED_DELAY = 6, "7 days"
#: Rows of a file of the feed, where several files make a batch.
FEED_FILE_ROWS = 250_000


def feed_files(spark, sf) -> int:
    """Files that a batch of the feed is dealt to, so that no task writes or reads more as the feed grows."""
    return max(1, read_table(spark, sf, "events").count() // (FEED_BATCHES * FEED_FILE_ROWS))


def write_feed(spark, sf, path, files=1):
    """Events as a feed of files in the order of arrival, five days each; every 31st comes a batch late,
    every 97th three batches late, and every 53rd comes again in the batch after its own."""
    e = read_table(spark, sf, "events")
    day = F.datediff(F.to_date("ts"), F.lit(FEED_START))
    k = F.col("event_id")
    behind = F.when(k % 97 == 0, 3).when(k % 31 == 0, 1).otherwise(0)
    e = e.withColumn("_batch", F.least(F.floor(day / 5) + behind, F.lit(FEED_BATCHES - 1)))
    again = e.where(k % 53 == 0).withColumn("_batch", F.least(F.col("_batch") + 1, F.lit(FEED_BATCHES - 1)))
    feed = stored(e.unionByName(again), "feed")
    for b in range(FEED_BATCHES):  # one after the other: a file stream takes files in the order of their times
        batch = feed.where(F.col("_batch") == b).drop("_batch")
        (batch.coalesce(1) if files == 1 else batch.repartition(files)).write.parquet(os.path.join(path, f"batch-{b}"))
    return read_table(spark, sf, "events").schema


@query("late_data_stream")
def q_late_data_stream(spark, sf):
    """Hourly revenue of a feed behind a seven-day watermark: an event that comes again counts once, an
    hour is written when the watermark has passed it (the last ones when the feed is closed), and rows
    beyond the watermark are kept apart and counted by hour."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"late-{uuid.uuid4().hex}")
    schema = write_feed(spark, sf, os.path.join(root, "feed"))
    part_late(spark, os.path.join(root, "feed", "*"), schema, "ts", FEED_DELAY, root, max_files_per_trigger=1)
    close_feed(spark, schema, "ts", FEED_DELAY, root, "1 hour")
    w = run_windows(spark, schema, "ts", "event_id", FEED_DELAY, root, "1 hour", [
        F.sum(F.col("value").cast("decimal(28,6)")).alias("revenue"), F.count("event_id").alias("events")])
    late = late_rows(spark, schema, root).groupBy(F.date_trunc("hour", F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("late_events"))
    hour = F.col("start").cast(schema["ts"].dataType).alias("hour")
    w = w.where("events > 0").select(hour, F.round(F.col("revenue").cast("double"), 2).alias("revenue"), "events")
    late = late.select(F.col("hour").cast(schema["ts"].dataType).alias("hour"), "late_events")
    return w.join(late, "hour", "full_outer").select("hour", "revenue", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("late_events", F.lit(0)).alias("late_events"))


@query("pulse_keyed")
def q_pulse_keyed(spark, sf):
    """The feed's listing observations, out of order, late and repeated, kept as keyed state with timers;
    the history equals the batch rebuild."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"keyed-{uuid.uuid4().hex}")
    files = feed_files(spark, sf)
    schema = write_feed(spark, sf, os.path.join(root, "feed"), files)
    observed = lambda events: EX.observed_states(R.project_observations(events))
    h = run_keyed_pulse(spark, os.path.join(root, "feed", "*"), schema, observed, "item_id", "ts", EX.STATE_COLS, EX.STATE_EXTRAS,
                        ["event_id"], root, FEED_DELAY, max_files_per_trigger=2 * files)
    return h.read()


def run_log(spark, sf):
    """Step run log: each event is a run of step ``event_type``; a run fails
    when its value is below 5."""
    e = read_table(spark, sf, "events")
    return e.select(F.col("event_type").alias("step"), "ts", "event_id", (F.col("value") >= 5).alias("ok"))


@query("freshness_report")
def q_freshness_report(spark, sf):
    """Per step: last OK run, consecutive failures since it, overdue flag."""
    log = run_log(spark, sf)
    out = log.groupBy("step").agg(F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_ok"))
    tail = log.join(out, "step").where(F.col("last_ok").isNull() | (F.col("ts") > F.col("last_ok")))
    streak = tail.groupBy("step").agg(F.count(F.lit(1)).alias("failure_streak"))
    out = out.join(streak, "step", "left")
    overdue = (F.col("last_ok").isNull()
               | (F.col("last_ok") < F.lit(FRESHNESS_NOW) - F.expr(f"INTERVAL {OVERDUE_HOURS} HOURS")))
    return out.select("step", "last_ok", F.coalesce("failure_streak", F.lit(0)).alias("failure_streak"),
                      overdue.alias("overdue"))
