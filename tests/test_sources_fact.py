"""Landed documents, proportional allocation, and costs beyond any fixed range of months."""

import os
import shutil

import duckdb
from pyspark.sql import functions as F

from marginflow.operators.aggregates import exact_sum
from marginflow.operators.allocate import allocate_proportional
from marginflow.registry import QUERIES
from marginflow.sources import nested as N

from .conftest import SF_SMALL


def test_allocation_conserves_each_group(spark):
    rows = [(k, float(k % 7) * 3.3, float(w)) for k in range(20) for w in (0.1, 2.5, 7.0)] + [(99, 5.0, 0.0), (99, 5.0, 0.0)]
    df = spark.createDataFrame(rows, "k int, amount double, w double")
    got = allocate_proportional(df, ["k"], "amount", "w").groupBy("k").agg(F.sum("allocated").alias("s"), F.max("amount").alias("a")).collect()
    assert all(abs(r.s - (0.0 if r.k == 99 else r.a)) < 1e-9 for r in got)


def test_data_ten_years_later_has_the_same_margins(spark, tmp_path):
    for name in ("customer", "lineitem", "part"):
        shutil.copy(os.path.join(SF_SMALL, f"{name}.parquet"), tmp_path)
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (o_orderdate + INTERVAL 120 MONTH AS o_orderdate) FROM '{SF_SMALL}/orders.parquet') TO '{tmp_path}/orders.parquet' (FORMAT parquet)")
    rows = lambda sf: sorted(tuple(map(str, r)) for r in QUERIES["fact_sales"](spark, sf).select("channel", "order_id", "sku", "unit_cost", "margin").collect())
    now, later = rows(SF_SMALL), rows(str(tmp_path))
    assert now == later and any(r[3] != "None" for r in now)


def test_sums_keep_nan_and_small_values(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.5), ("b", 2.8e-8), ("b", 2.8e-8), ("c", None)], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("v", 12).alias("s")).collect()}
    assert got["a"] != got["a"] and abs(got["b"] - 5.6e-8) < 1e-12 and got["c"] is None


def test_documents_with_nulls(spark):
    df = spark.createDataFrame([(1, (None, 1)), (2, None)], "id int, s struct<a:int,b:int>")
    assert [r.s for r in N.nested_to_text(df).orderBy("id").collect()] == ['{"a":null,"b":1}', None]
    env = spark.createDataFrame([(200, (1,)), (404, (2,)), (None, (3,))], "code int, body struct<id:int>")
    ok, rejects = N.multiget_envelope(env)
    assert [r.id for r in ok.collect()] == [1] and rejects.first().rejected == 2
    prep = spark.createDataFrame(
        [(1, None, "D1", None, None, [("7",), ("7",), ("8",)]), (2, "", "D2", [(None, "pallet")], [(3, 1500), (None, None)], [("9",)])],
        "id int, despachoDescripcion string, despachoCodigo string, contenedores array<struct<cantidadBulto:int,tipo:string>>, "
        "items array<struct<volumen:int,peso:int>>, pedidos array<struct<codigo:string>>")
    got = sorted(tuple(r) for r in N.preparation_rollup(prep).select(
        "preparacion_id", "pedido_codigo", "transporte", "bultos_preparacion", "volumen_preparacion", "kg_preparacion", "tipo_preparacion", "cant_pedidos_en_prep").collect())
    assert got == [(1, "7", "D1", 0.0, 0.0, 0.0, "Bultos", 3), (1, "8", "D1", 0.0, 0.0, 0.0, "Bultos", 3), (2, "9", "D2", 0.0, 3.0, 1.5, "Pallets", 1)]
