"""Schema found in documents, manifest state, guards in the write, evolving and bucketed tables, and
counts that a write takes of itself."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.sinks import writers as W
from marginflow.sources import nested as N

PART = "/root/testdata/sf0.001"


def test_flatten_finds_differing_nested_and_conflicting_fields(spark):
    docs = [
        '{"id": 1, "a": {"b": 1, "c": {"d": "x"}}}', '{"id": 2, "a": {"b": 2.5}, "t": true}', '{"id": 3, "a": "plain"}', '{"id": "four", "l": [1, {"k": null}]}',
        '{"a_b": 9, "odd.name": 1, "with`tick": 2, "sp ace": 3, "quo\'te": 4, "both\'\\"": 5}', "{broken", "[1]", "7", "null", None, "{}", '{"n": null}',
    ]
    df = spark.createDataFrame([(k, d) for k, d in enumerate(docs)], "key int, doc string")
    out = N.flatten_documents(df, "doc", keep=["key"])
    got = {r.key: r.asDict() for r in out.collect()}
    assert len(got) == len(docs)
    # "a" is an object in some documents and text in one: the value's JSON text
    assert got[0]["a"] == '{"b":1,"c":{"d":"x"}}' and got[2]["a"] == "plain"
    assert got[0]["id"] == "1" and got[3]["id"] == "four" and got[1]["t"] is True and got[0]["t"] is None
    assert got[3]["l"] == '[1,{"k":null}]'
    assert got[4]["a_b"] == 9 and got[4]["odd.name"] == 1 and got[4]["with`tick"] == 2 and got[4]["sp ace"] == 3 and got[4]["quo'te"] == 4
    assert got[4]["both'\""] == 5
    assert all(v is None for k in (5, 6, 7, 8, 9, 10, 11) for c, v in got[k].items() if c != "key")
    nested = N.flatten_documents(df.where("key in (0, 1)"), "doc", keep=["key"])
    assert nested.columns == ["key", "a_b", "a_c_d", "id", "t"] and dict(nested.dtypes)["a_b"] == "double"
    assert {r.key: (r.a_b, r.a_c_d) for r in nested.collect()} == {0: (1.0, "x"), 1: (2.5, None)}
    assert N.flatten_documents(df.limit(0), "doc", keep=["key"]).columns == ["key"]
    clash = N.flatten_documents(spark.createDataFrame([('{"a": {"b": 1}, "a_b": 2, "key": 3}', 5)], "doc string, key int"), "doc", keep=["key"])
    assert clash.columns == ["key", "a_b", "a_b_2", "key_2"] and clash.first()[0] == 5


def test_manifest_diff_and_broken_state(spark, tmp_path):
    base, state = f"{tmp_path}/sheets", f"{tmp_path}/state"
    for name, n in (("a/x=1", 3), ("b/x=1", 3)):
        spark.range(n, numPartitions=1).selectExpr("cast(id as string) s").write.text(f"{base}/{name}")
    kept = lambda: N.stored_manifest(spark, state)
    diff = lambda: {r.name: r.change for r in N.manifest_diff(N.sheet_manifest(spark, base), kept()).collect()}
    assert diff() == {"a/x=1": "added", "b/x=1": "added"}
    N.store_manifest(N.sheet_manifest(spark, base), state)
    assert diff() == {"a/x=1": "same", "b/x=1": "same"}
    spark.range(9, numPartitions=1).selectExpr("cast(id as string) s").write.mode("overwrite").text(f"{base}/b/x=1")
    spark.range(1, numPartitions=1).selectExpr("cast(id as string) s").write.text(f"{base}/c/x=1")
    assert diff() == {"a/x=1": "same", "b/x=1": "changed", "c/x=1": "added"}
    gone = N.sheet_manifest(spark, base).where("name <> 'a/x=1'")
    assert {r.name: r.change for r in N.manifest_diff(gone, kept()).collect()}["a/x=1"] == "removed"
    spark.range(1).selectExpr("'no manifest' s").write.mode("overwrite").text(state)
    assert kept() is None and set(diff().values()) == {"added"}


def test_guards_fail_the_write_and_leave_the_table(spark, tmp_path):
    base = f"{tmp_path}/t"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    good = spark.createDataFrame([(1, "a"), (2, None)], schema)
    publish = lambda df, **k: W.publish_version(spark, W.guarded(df, ["id"], ["id"], schema, "t"), base)
    first = publish(good)
    for bad, why in ((spark.createDataFrame([(1, "a"), (1, "b")], schema), "t: key repeats"), (spark.createDataFrame([(None, "a")], schema), "t: id is null")):
        with pytest.raises(Exception, match=why):
            publish(bad)
    with pytest.raises(ValueError, match="declared columns are missing: v"):
        publish(good.drop("v"))
    assert W.latest_version(spark, base).endswith(os.path.basename(first))
    assert {tuple(r) for r in spark.read.parquet(W.latest_version(spark, base)).collect()} == {(1, "a"), (2, None)}
    assert publish(good.limit(0))
    # rows are not shuffled, only their keys are: the rows' branch has no exchange
    plan = W.guarded(good.withColumn("wide", F.repeat("v", 100)), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert all("wide" not in line for line in plan.splitlines() if "Exchange" in line)


def test_replace_all_writes_once_and_leaves_nothing_aside(spark, tmp_path):
    base = f"{tmp_path}/r"
    path = W.replace_all_version(spark, spark.range(5), base)
    assert W.replace_all_version(spark, spark.range(0), base) is None
    assert W.latest_version(spark, base).endswith(os.path.basename(path)) and spark.read.parquet(path).count() == 5
    assert os.listdir(f"{base}/_staged") == []


def test_evolving_files(spark, tmp_path):
    path = f"{tmp_path}/e"
    W.append_evolving(spark.createDataFrame([(1, 1.5)], "k int, x double"), path)
    W.append_evolving(spark.createDataFrame([(2, 7, True)], "k long, n int, b boolean"), path)
    W.append_evolving(spark.createDataFrame([(3, 8)], "k int, n int"), path)
    got = W.read_evolving(spark, path)
    assert dict(got.dtypes) == {"k": "int", "x": "double", "n": "bigint", "b": "boolean"}
    assert sorted((r.k, r.x, r.n, r.b) for r in got.collect()) == [(1, 1.5, None, None), (2, None, 7, True), (3, None, 8, None)]


def test_bucketed_joins_need_no_exchange(spark, tmp_path):
    tag = uuid.uuid4().hex
    a = W.bucketed(spark.range(1000).withColumnRenamed("id", "k"), f"a_{tag}", ["k"], f"{tmp_path}/a", buckets=4)
    b = W.bucketed(spark.range(500).selectExpr("id * 3 as k", "id as v"), f"b_{tag}", ["k"], f"{tmp_path}/b", buckets=4)
    j = a.hint("merge").join(b.groupBy("k").agg(F.sum("v").alias("v")).hint("merge"), "k", "left")
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert j.where("v is null").count() == 1000 - 334
    assert W.bucketed(spark.range(10), f"c_{tag}", ["id"], f"{tmp_path}/c").count() == 10


def test_the_write_counts_its_rejects(spark, tmp_path):
    rows = [(200, (1, "a")), (404, (2, "b")), (None, (3, "c")), (200, (4, "d"))]
    df = spark.createDataFrame(rows, "code int, body struct<id: int, v: string>")
    assert N.land_multiget(df, f"{tmp_path}/m") == {"rows": 4, "rejected": 2}
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/m").collect()) == [1, 4]
    assert N.land_multiget(df.limit(0), f"{tmp_path}/n") == {"rows": 0, "rejected": 0}
