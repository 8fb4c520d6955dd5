"""Table mutations as pure functions ``(current, incoming) -> next`` plus
writers.

Plain Parquet has no transactions, so a replace never deletes first: the
next version is computed as a DataFrame and written to a *new* path; the
reader switches to it (``publish_version``).  An empty incoming batch is a
no-op everywhere (an aborted extraction must never blank a table).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# pure functions
# ---------------------------------------------------------------------------


def _if_any(kept: DataFrame, dropped: DataFrame, incoming: DataFrame) -> DataFrame:
    """``kept``, and ``dropped`` too if ``incoming`` turns out empty: decided inside the plan by a
    one-row flag, so no job runs while the plan is built."""
    none = incoming.limit(1).agg(F.count(F.lit(1)).alias("_rows")).where("_rows = 0")
    back = dropped.withColumn("_rows", F.lit(0).cast("bigint")).join(F.broadcast(none), "_rows", "left_semi").drop("_rows")
    return kept.unionByName(back)


def replace_all(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Whole-table replace; empty incoming keeps the current table."""
    return _if_any(current.limit(0), current, incoming).unionByName(incoming, allowMissingColumns=True)


def replace_window(current: DataFrame, incoming: DataFrame, date_col: str,
                   cutoff: dt.date | Column) -> DataFrame:
    """Drop current rows with ``date >= cutoff`` and append incoming."""
    cut = F.lit(cutoff) if not isinstance(cutoff, Column) else cutoff
    old = F.coalesce(F.col(date_col) < cut, F.lit(False))
    return _if_any(current.where(old), current.where(~old), incoming).unionByName(incoming, allowMissingColumns=True)


def replace_window_and_keys(current: DataFrame, incoming: DataFrame, date_col: str,
                            cutoff: dt.date, keys: Sequence[str]) -> DataFrame:
    """As ``replace_window``, and also drop any current row whose key is in
    incoming (a row that moved across the cutoff is not duplicated)."""
    old = F.coalesce(F.col(date_col) < F.lit(cutoff), F.lit(False))
    keep = current.where(old).join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    # with nothing incoming, no old row was dropped
    return _if_any(keep, current.where(~old), incoming).unionByName(incoming, allowMissingColumns=True)


def replace_keys(current: DataFrame, incoming: DataFrame, requested: DataFrame,
                 keys: Sequence[str], also_received: bool = True) -> DataFrame:
    """Delete the *requested* keys (and, by default, every key received —
    see README D18), then append incoming.  Nothing requested → no-op."""
    drop = requested.select(*keys)
    if also_received:
        drop = drop.unionByName(incoming.select(*keys))
    keep = current.join(drop.distinct(), list(keys), "left_anti")
    return keep.unionByName(incoming, allowMissingColumns=True)


def additive_evolution(current: T.StructType, incoming: T.StructType) -> list[tuple[str, str]]:
    """Columns present in incoming but not in the table, with the type to add
    (bool → boolean, integral → bigint, fractional → double, else string).
    Never drops or retypes."""
    have = {f.name for f in current.fields}
    out = []
    for f in incoming.fields:
        if f.name in have:
            continue
        t = f.dataType
        if isinstance(t, T.BooleanType):
            s = "boolean"
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            s = "bigint"
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            s = "double"
        else:
            s = "string"
        out.append((f.name, s))
    return out


def evolve_union(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append with additive evolution: new columns appear (null in old rows)."""
    cur = current
    for name, typ in additive_evolution(current.schema, incoming.schema):
        cur = cur.withColumn(name, F.lit(None).cast(typ))
    inc = incoming
    for f in cur.schema.fields:
        if f.name in inc.columns:
            inc = inc.withColumn(f.name, F.col(f.name).cast(f.dataType))
    return cur.unionByName(inc, allowMissingColumns=True)


def schema_contract(declared: T.StructType, actual: T.StructType | None) -> list[str]:
    """Declared columns missing from the actual table (absent table = ok)."""
    if actual is None:
        return []
    have = {f.name for f in actual.fields}
    return [f.name for f in declared.fields if f.name not in have]


def guarded(df: DataFrame, unique: Sequence[str] = (), required: Sequence[str] = (), declared: T.StructType | None = None,
            label: str = "table") -> DataFrame:
    """``df``, but a job that reads it whole fails where a key of ``unique`` repeats or a ``required``
    column is null; declared columns that it lacks fail at once.

    The guards are part of the plan of the write itself, so nothing runs before it and a broken batch
    never becomes a version: its job ends before the version is complete. Keys are counted with a
    map-side combine; only the keys are shuffled, never the rows."""
    if declared is not None and (missing := schema_contract(declared, df.schema)):
        raise ValueError(f"{label}: declared columns are missing: {', '.join(missing)}")
    out = df
    for c in required:
        message = F.concat(F.lit(f"{label}: {c} is null in "), F.to_json(F.struct(*[F.col(x) for x in df.columns])))
        kind = df.schema[c].dataType
        out = out.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(message).cast(kind)).otherwise(F.col(c)))
    if not unique:
        return out
    repeated = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    message = F.concat(F.lit(f"{label}: key repeats: "), F.to_json(F.struct(*[F.col(x) for x in unique], "_n")))
    # no row ever comes out of this branch: the first one ends the job
    broken = repeated.select(*[F.raise_error(message).cast(f.dataType).alias(f.name) for f in out.schema.fields])
    return out.unionByName(broken)


def snapshot_rows(photo: DataFrame, day: dt.date, error_col: str = "error") -> DataFrame:
    """Today's photo without error rows, stamped with the day."""
    return photo.where(F.col(error_col).isNull()).withColumn("fecha", F.lit(day))


# ---------------------------------------------------------------------------
# writers
# ---------------------------------------------------------------------------

def new_version_path(base: str) -> str:
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S.%f")
    return os.path.join(base, f"v={stamp}-{uuid.uuid4().hex[:8]}")


def publish_version(spark: SparkSession, df: DataFrame, base: str,
                    partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new immutable version under ``base`` and return its
    path; readers pick the newest complete version (``_SUCCESS`` present).
    Making a table from a query again never blanks it."""
    path = new_version_path(base)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def replace_all_version(spark: SparkSession, df: DataFrame, base: str) -> str | None:
    """Publish ``df`` as the table's next version, unless it is empty.  Rows are written
    once, aside; the folder becomes the version by its new name, an empty one goes."""
    staged, path = new_version_path(os.path.join(base, "_staged")), new_version_path(base)
    df.write.parquet(staged)
    empty = spark.read.schema(df.schema).parquet(staged).isEmpty()
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    if empty:
        fs.delete(at(staged), True)
        return None
    if not fs.rename(at(staged), at(path)):
        raise OSError(f"{staged} could not become {path}")
    return path


def latest_version(spark: SparkSession, base: str) -> str | None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return None
    done = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            done.append(st.getPath().toString())
    return sorted(done)[-1] if done else None


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite);
    with no rows no partition is touched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def daily_snapshot(photo: DataFrame, path: str, day: dt.date, error_col: str = "error") -> None:
    """Idempotent per day: rewrite the day's partition with the error-free
    rows; an empty photo changes nothing."""
    replace_partitions(snapshot_rows(photo, day, error_col), path, ["fecha"])


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows whose columns differ from the stored ones: new columns come in with the types that
    ``additive_evolution`` gives, known ones keep theirs, and no stored file is touched."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        there = read_evolving(spark, path).schema
        kinds = {f.name: f.dataType for f in there.fields} | dict(additive_evolution(there, df.schema))
        df = df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in df.columns])
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All rows of files of different schemas; columns that a file lacks are null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def bucketed(df: DataFrame, name: str, keys: Sequence[str], path: str, bytes_per_bucket: int = 128 << 20,
             buckets: int | None = None) -> DataFrame:
    """``df`` as table ``name`` at ``path``, bucketed and sorted by ``keys``: joins of tables with the
    same keys and number of buckets need neither an exchange nor a sort.  The number follows the
    plan's size (a power of two, so that tables of different sizes still line up) unless given."""
    if buckets is None:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        buckets = 1 << max(0, (min(size // bytes_per_bucket, 1 << 14)).bit_length())
    # rows of a bucket come from one task: one sorted file a bucket
    one = df.repartition(buckets, *[F.col(k) for k in keys])
    one.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def append_incremental(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append the rows whose key the table lacks, so a run that was broken
    off goes on where it ended and a repeated one adds nothing."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        df = df.join(spark.read.schema(df.schema).parquet(path).select(*keys).distinct(), list(keys), "left_anti")
    df.write.mode("append").parquet(path)
