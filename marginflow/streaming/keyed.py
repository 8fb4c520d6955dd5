"""The observation pulse with keyed state and timers.

The state of an item is its run as of the watermark and the observations after it; both live in the
state store, and a batch reads and writes the state of the items it touches, no others.  Rows come
in any order within the delay (rows beyond it were parted before, ``streaming.late``).  What they make
of an item's unsettled end is written anew, with a version; a timer at the item's oldest unsettled
observation fires when the watermark has passed it, folds what is settled into the run, and writes the
runs that ended, once and for all.

    root/runs       the stream's output: settled runs, and versions of the unsettled ends
    root/late       rows beyond the delay

``KeyedHistory.read`` joins them: settled runs, the last version of each item's end, and, for items
that have late rows, a rebuild of these items alone from their observations.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructType

from marginflow.streaming.late import CLOCK, late_rows, micros, on_time, part_late, with_clock
from marginflow.streaming.scd2 import scd2_from_log

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def same(a: tuple, b: tuple) -> bool:
    """Equal states; nulls are equal, and so are two NaN."""
    return all(x == y or (x != x and y != y) for x, y in zip(a, b, strict=True))


def place(o: tuple, n_tie: int) -> tuple:
    """Sort key of an observation (moment, tie breakers…): nulls first."""
    return tuple((x is not None, x) if x is not None else (False,) for x in o[: 1 + n_tie])


def runs_after(run: tuple | None, later: Sequence[tuple], n_tie: int, n_state: int) -> list[tuple]:
    """Runs (first, end, last, state, extras) that ``run`` and the observations after it, in order, make;
    the last one is open (end null)."""
    runs = [] if run is None else [run]
    for o in later:
        at, state, extras = o[0], o[1 + n_tie : 1 + n_tie + n_state], o[1 + n_tie + n_state :]
        if runs and same(runs[-1][3], state):
            runs[-1] = (*runs[-1][:2], at, runs[-1][3], extras)
            continue
        if runs:
            runs[-1] = (runs[-1][0], at, at, *runs[-1][3:])
        runs.append((at, None, at, state, extras))
    return runs


class RunProcessor(StatefulProcessor):
    """Runs of equal state per item; see the module's text."""

    def __init__(self, columns: Sequence[str], observation: str, run: str, n_tie: int, n_state: int, n_extras: int):
        self.columns, self.observation, self.run = list(columns), observation, run
        self.n_tie, self.n_state, self.n_extras = n_tie, n_state, n_extras

    def init(self, handle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", self.run)
        self.later = handle.getListState("later", self.observation)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return self._step(key, [tuple(r)[1:-1] for r in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._step(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _step(self, key, new: list[tuple], watermark: int) -> Iterator[Row]:
        version, run = 0, None
        value = self.settled.get()
        if value is not None:
            version, first, last, *rest = value
            if first is not None:
                run = (first, None, last, tuple(rest[: self.n_state]), tuple(rest[self.n_state :]))
        later = sorted([*(tuple(o) for o in self.later.get()), *new], key=lambda o: place(o, self.n_tie))
        done = [o for o in later if o[0] < watermark * 1000]
        if not new and not done:  # a timer of rows that a batch has settled since: nothing to write anew
            return iter(())
        rest = later[len(done) :]
        settled = runs_after(run, done, self.n_tie, self.n_state)
        run = settled.pop() if settled else None
        values = (run[0], run[2], *run[3], *run[4]) if run else (None,) * (2 + self.n_state + self.n_extras)
        self.settled.update((version + 1, *values))
        if rest:
            self.later.put(rest)
            self.handle.registerTimer(rest[0][0] // 1000 + 1)
        else:
            self.later.clear()
        out = [(key[0], None, *self._flat(r)) for r in settled]
        out += [(key[0], version + 1, *self._flat(r)) for r in runs_after(run, rest, self.n_tie, self.n_state)]
        named = Row(*self.columns)
        return iter([named(*o) for o in out])

    @staticmethod
    def _flat(r: tuple) -> tuple:
        first, end, last, state, extras = r
        return (first, end, last, *state, *extras)


def _ddl(df: DataFrame, cols: Sequence[str]) -> str:
    return "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


class KeyedHistory:
    """The history that ``run_keyed_pulse`` keeps under ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, to_observations, item: str, ts: str,
                 state: Sequence[str], extras: Sequence[str], tiebreak: Sequence[str]):
        self.spark, self.root, self.schema, self.to_observations = spark, root, schema, to_observations
        self.item, self.ts, self.state, self.extras, self.tiebreak = item, ts, list(state), list(extras), list(tiebreak)

    def versions(self) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.root, "runs"))

    def read(self) -> DataFrame:
        """All intervals: (item, desde, hasta, visto_hasta, state…, extras…)."""
        item, v = self.item, self.versions()
        obs = self.to_observations
        kind = obs(self.spark.createDataFrame([], self.schema)).schema[self.ts].dataType
        moment = lambda c: F.timestamp_micros(F.col(c)).cast(kind)
        late = obs(late_rows(self.spark, self.schema, self.root))
        newest = v.where(F.col("_version").isNotNull()).groupBy(item).agg(F.max("_version").alias("_newest"))
        kept = v.join(newest, item).where(F.col("_version").isNull() | (F.col("_version") == F.col("_newest")))
        cols = [F.col(item), moment("first").alias("desde"), moment("end").alias("hasta"), moment("last").alias("visto_hasta"), *self.state, *self.extras]
        kept = kept.join(late.select(item).distinct(), item, "left_anti").select(*cols)
        there = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(os.path.join(self.root, "on_time"))
        log = obs(there.unionByName(late_rows(self.spark, self.schema, self.root)))
        again = log.join(late.select(item).distinct(), item, "left_semi")
        return kept.unionByName(scd2_from_log(again, item, self.ts, self.state, self.extras, self.tiebreak).select(*kept.columns))


def run_keyed_pulse(spark: SparkSession, source_path: str, schema: StructType, to_observations, item: str, ts: str,
                    state: Sequence[str], extras: Sequence[str], tiebreak: Sequence[str], root: str, delay: str = "1 day",
                    max_files_per_trigger: int | None = None) -> KeyedHistory:
    """Drains the observation files available now; a second run on the same ``root`` goes on where the first
    ended.  Observations without an item or a moment are left out (those without a moment are in ``late``)."""
    history = KeyedHistory(spark, root, schema, to_observations, item, ts, state, extras, tiebreak)
    part_late(spark, source_path, schema, ts, delay, root, max_files_per_trigger)
    o = with_clock(to_observations(on_time(spark, schema, root)), ts, delay)
    o = o.select(item, micros(ts).alias("_at"), *tiebreak, *state, *extras, CLOCK).where(F.col(item).isNotNull())
    observation = "_at bigint" + _ddl(o, [*tiebreak, *state, *extras])
    run = "version bigint, first bigint, last bigint" + _ddl(o, [*state, *extras])
    out = f"`{item}` {o.schema[item].dataType.simpleString()}, _version bigint, first bigint, end bigint, last bigint" + _ddl(o, [*state, *extras])
    columns = [item, "_version", "first", "end", "last", *state, *extras]
    processor = RunProcessor(columns, observation, run, len(tiebreak), len(state), len(extras))
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        runs = o.groupBy(item).transformWithState(processor, out, "Append", "EventTime")
        q = (runs.writeStream.outputMode("append").format("parquet").option("path", os.path.join(root, "runs"))
             .option("checkpointLocation", os.path.join(root, "keyed_checkpoint")).trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before)
    q.awaitTermination()
    return history
