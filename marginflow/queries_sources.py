"""Registered queries for landed documents, sheets, files and table writers
(SURVEY §2.1, §2.2, §2.9, §2.10).  Documents are built from the given tables
as the sources would send them; writers write to the shared folder and the
query returns what a reader then sees."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.functions import scalars as S
from marginflow.operators.aggregates import exact_sum
from marginflow.operators.allocate import allocate_proportional
from marginflow.operators.dedupe import dedupe_keep_last, latest_per_key
from marginflow.plans import experiment as EX
from marginflow.registry import query
from marginflow.session import ensure_checkpoint_dir, stored
from marginflow.sinks import writers as W
from marginflow.sources import nested as N
from marginflow.sources import roles as R
from marginflow.sources.tables import read_table
from marginflow.streaming.scd2 import scd2_apply, scd2_from_log

SELLER_ID = 3
PULSE = dt.datetime(2024, 1, 15)


def _place(spark, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


# --- documents ----------------------------------------------------------------------


@query("flatten_json")
def q_flatten_json(spark, sf):
    """Order documents as JSON text, parsed with a schema and flattened."""
    o = read_table(spark, sf, "orders")
    doc = F.struct(
        F.col("o_orderkey").alias("id"), F.struct(F.concat(F.lit("buyer"), F.col("o_custkey").cast("string")).alias("nickname")).alias("buyer"),
        F.struct(F.col("o_totalprice").alias("amount"), F.struct(F.col("o_orderstatus").alias("code")).alias("status")).alias("payment"))
    schema = "id bigint, buyer struct<nickname: string>, payment struct<amount: double, status: struct<code: string>>"
    return N.flatten_struct_columns(o.select(F.from_json(F.to_json(doc), schema).alias("d")).select("d.*"), sep="_")


@query("nested_to_text")
def q_nested_to_text(spark, sf):
    o = read_table(spark, sf, "orders")
    status = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus"))
    return N.nested_to_text(o.select(
        F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("code"), status.alias("status")).alias("buyer"),
        F.array(F.col("o_custkey"), F.col("o_orderkey") % 5).alias("tags")))


def _envelopes(spark, sf):
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey") % 10
    return o.select(F.when(k == 0, 404).when(k != 1, 200).alias("code"),
                    F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer")).alias("body"))


@query("multiget_envelope")
def q_multiget_envelope(spark, sf):
    """The bodies kept, and one row with id null that counts the rejects."""
    ok, rejects = N.multiget_envelope(_envelopes(spark, sf))
    return ok.select("id", "customer", F.lit(None).cast("bigint").alias("rejected")).unionByName(
        rejects.select(F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("customer"), F.col("rejected").cast("bigint")))


@query("wms_order_project")
def q_wms_order_project(spark, sf):
    """Every 11th order has no customer place, every 13th a place without customer."""
    o, k = read_table(spark, sf, "orders"), F.col("o_orderkey")
    customer = F.struct(F.col("o_custkey").alias("codigo"), F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("descripcion"))
    place = F.struct(F.when(k % 13 != 0, customer).alias("cliente"), (F.col("o_custkey") % 25).alias("provincia"),
                     (F.col("o_custkey") % 100).alias("localidad"), F.concat(F.lit("street "), (k % 1000).cast("string")).alias("direccion"))
    return N.wms_order_project(o.select(
        k.alias("codigo"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"), F.col("o_orderstatus").alias("estado"),
        F.col("o_totalprice").alias("importe"), F.when(k % 11 != 0, place).alias("clienteUbicacion"), (k % 4).alias("codigoDespacho"),
        F.col("o_orderpriority").alias("servicioDeEnvioTipo"), F.floor(k / 3).alias("ordenPreparacion")))


def preparation_documents(spark, sf):
    """A preparation per order key div 3, with containers, items and orders as arrays."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    prep = F.floor(F.col("l_orderkey") / 3).cast("bigint")
    item = F.struct(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), (F.col("l_quantity") * 2).cast("bigint").alias("volumen"),
                    F.when(F.col("l_linenumber") != 3, F.col("l_partkey") % 1000).alias("peso"))
    items = li.groupBy(prep.alias("id")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    prep = F.floor(F.col("o_orderkey") / 3).cast("bigint")
    name = F.when(F.col("o_orderkey") % 7 == 0, "PALLET eur").when(F.col("o_orderkey") % 7 == 1, "box")
    box = F.struct(F.col("o_orderkey").alias("o"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderkey") % 6).alias("cantidadBulto"), name.alias("tipo"))
    order = F.struct(F.col("o_orderkey").alias("codigo"))
    heads = o.groupBy(prep.alias("id")).agg(F.sort_array(F.collect_list(box)).alias("c"), F.sort_array(F.collect_list(order)).alias("pedidos"))
    k = F.col("id")
    return heads.join(items, "id", "left").select(
        "id", F.when(k % 4 == 0, "").when(k % 4 != 1, F.concat(F.lit("carrier "), (k % 9).cast("string"))).alias("despachoDescripcion"),
        F.concat(F.lit("D"), (k % 9).cast("string")).alias("despachoCodigo"), F.when(k % 17 != 0, F.col("c")).alias("contenedores"), "items",
        # every 5th preparation lists its orders twice
        F.when(k % 5 == 0, F.concat("pedidos", "pedidos")).otherwise(F.col("pedidos")).alias("pedidos"))


@query("preparation_rollup")
def q_preparation_rollup(spark, sf):
    return N.preparation_rollup(preparation_documents(spark, sf))


@query("first_matching_cost")
def q_first_matching_cost(spark, sf):
    """Shipping cost of the seller among the senders of each marketplace order."""
    m, k = R.market_orders(spark, sf), F.col("id")
    sender = lambda user, cost: F.struct(user.alias("user_id"), cost.cast("double").alias("cost"))
    senders = F.array(sender(k % 5, k % 100), sender(k % 4, k % 70), sender(F.lit(SELLER_ID), F.lit(None)))
    return m.select("id", N.first_matching_cost(F.when(k % 3 != 0, senders), SELLER_ID).alias("cost"))


@query("attribute_lookup")
def q_attribute_lookup(spark, sf):
    """SKU of a listing from its attributes' JSON text; none, broken or without the attribute: null."""
    p, k = read_table(spark, sf, "part"), F.col("p_partkey")
    attr = lambda i, v: F.struct(F.lit(i).alias("id"), v.alias("value_name"))
    text = F.to_json(F.array(attr("BRAND", F.col("p_brand")), attr("SELLER_SKU", k.cast("string")), attr("SELLER_SKU", F.lit("second"))))
    text = F.when(k % 9 == 0, F.lit(None)).when(k % 9 == 1, F.lit("[broken")).when(k % 9 == 2, F.to_json(F.array(attr("BRAND", F.col("p_brand"))))).otherwise(text)
    return p.select("p_partkey", N.attribute_value_from_text(text).alias("sku"))


# --- sheets and files -------------------------------------------------------------------


def _comma(x):
    cents = F.round(x * 100).cast("bigint")
    return F.concat(F.floor(cents / 100).cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))


@query("cost_sheets_load")
def q_cost_sheets_load(spark, sf):
    """Sheets written as CSV, one folder per month, loaded again; some keys stand twice, the
    later (here cheaper) row wins."""
    c = R.cost_sheet(spark, sf)
    again = c.where(F.col("sku").cast("bigint") % 7 == 0).withColumn("costo_teorico", F.col("costo_teorico") - 1)
    rows = c.withColumn("n", F.lit(1)).unionByName(again.withColumn("n", F.lit(2)))
    costs = _place(spark, "cost-sheets")
    (rows.repartition("mes_comercial").sortWithinPartitions("mes_comercial", "n", "sku")
     .select(F.concat("sku", F.lit(".0")).alias("Codigo"), _comma(F.col("costo_teorico")).alias("Costo Teorico"), "mes_comercial")
     .write.partitionBy("mes_comercial").option("header", True).csv(costs))
    o = R.offer_sheet(spark, sf)
    offers = _place(spark, "offer-sheets")
    (o.repartition("mes_comercial").sortWithinPartitions("mes_comercial", "_seq", "sku")
     .select(F.col("sku").alias("SKU"), F.concat(F.regexp_replace(F.col("oferta_pct").cast("string"), r"\.", ","), F.lit("%")).alias("DESCUENTO TOTAL PROVEEDOR"), "mes_comercial")
     .write.partitionBy("mes_comercial").option("header", True).csv(offers))
    cs, of = N.cost_sheets_load(spark, costs, offers)
    keys = ["sku", "mes_comercial"]
    cs = dedupe_keep_last(cs, keys, ["_seq"]).drop("_seq")
    of = dedupe_keep_last(of, keys, ["_seq"]).drop("_seq")
    return cs.join(of, keys, "left").select(*keys, "costo_teorico", S.nz("oferta_pct").alias("oferta_pct"))


@query("file_manifest_changed")
def q_file_manifest_changed(spark, sf):
    """Files of the order table, and whether their fingerprint differs from the stored one."""
    now = N.file_manifest(spark, os.path.join(sf, "orders.parquet"))
    stored = F.lit(None).cast("string")  # nothing stored yet: changed
    return now.agg(F.count(F.lit(1)).alias("files"), N.fingerprint().alias("fingerprint")).select(
        "files", N.manifest_changed(F.col("fingerprint"), stored).alias("changed"))


def _sheets(df, base, name):
    df.repartition(1).write.mode("overwrite").partitionBy("o_orderstatus").csv(os.path.join(base, name))


@query("file_manifest_diff")
def q_file_manifest_diff(spark, sf):
    """Order sheets by status, loaded three times against the stored manifest: first all is new; then
    one folder's sheet has more rows and another's sheets went for others; then the state is broken, so
    all counts as new again."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    base, state = _place(spark, "order-sheets"), _place(spark, "manifest")

    def load(run):
        now = N.sheet_manifest(spark, base)
        diff = stored(N.manifest_diff(now, N.stored_manifest(spark, state)), "manifest-diff")
        N.store_manifest(now, state)
        return diff.select(F.lit(run).alias("run"), "name", "change")

    _sheets(o.where("o_orderstatus = 'F'"), base, "kept")
    _sheets(o.where("o_orderstatus = 'O' and o_orderkey % 2 = 0"), base, "grown")
    _sheets(o.where("o_orderstatus = 'F'"), base, "moved")
    first = load(1)
    _sheets(o.where("o_orderstatus = 'O'"), base, "grown")
    _sheets(o.where("o_orderstatus <> 'F'"), base, "moved")
    second = load(2)
    o.limit(1).select("o_orderstatus").write.mode("overwrite").text(state)  # no manifest any more
    return first.unionByName(second).unionByName(load(3))


@query("flatten_documents")
def q_flatten_documents(spark, sf):
    """Event documents whose shape is found in them: the table's own JSON text nested under a name,
    fields that only some have, one field that is text in some and a number in others, an array, and
    texts that are broken or no object."""
    e = read_table(spark, sf, "events")
    j = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    ident, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    kind = F.col("event_type")
    doc = (
        F.when(kind == "view", j('{"id":', ident, ',"props":', F.col("props"), ',"ref":null}'))
        .when(kind == "click", j('{"props":', F.col("props"), ',"id":', ident, ',"pos":', (F.col("event_id") % 7).cast("string"), '.5}'))
        .when(kind == "purchase", j('{"id":', ident, ',"amount":"n-', ident, '","buyer":{"code":', user, ',"tags":[', user, ',"x"],"place":{"city":"c', (F.col("user_id") % 9).cast("string"), '"}}}'))
        .when(kind == "signup", j('{"id":', ident, ',"amount":', user, ',"buyer":{"code":', user, "}}"))
        .when(F.col("event_id") % 2 == 0, F.lit("{broken")).otherwise(F.lit("[1, 2]"))
    )
    return N.flatten_documents(e.select("event_id", doc.alias("doc")), "doc", keep=["event_id"])


@query("multiget_landed")
def q_multiget_landed(spark, sf):
    """The bodies as they were landed, and one row with id null for the rejects that the write counted."""
    path = _place(spark, "multiget")
    seen = N.land_multiget(_envelopes(spark, sf), path)
    count = spark.range(1).select(F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("customer"), F.lit(seen["rejected"]).cast("bigint").alias("rejected"))
    return spark.read.parquet(path).select("id", "customer", F.lit(None).cast("bigint").alias("rejected")).unionByName(count)


# --- writers ------------------------------------------------------------------------------


@query("catalog_loads")
def q_catalog_loads(spark, sf):
    """Customer documents flattened, and the whole table replaced by them."""
    c = read_table(spark, sf, "customer")
    doc = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.struct(F.col("c_nationkey").alias("provincia")).alias("lugar")))
    incoming = N.flatten_struct_columns(
        c.select(F.from_json(doc, "id bigint, nombre string, lugar struct<provincia: bigint>").alias("d")).select("d.*"), sep="_")
    base = _place(spark, "catalog")
    W.publish_version(spark, incoming.where("id % 2 = 0"), base)
    W.replace_all_version(spark, incoming, base)
    return spark.read.parquet(W.latest_version(spark, base))


@query("replace_all")
def q_replace_all(spark, sf):
    """A full replace, then an empty one, which changes nothing."""
    c = R.erp_customers(spark, sf)
    base = _place(spark, "replace-all")
    W.publish_version(spark, c.where("id % 3 = 0"), base)
    W.replace_all_version(spark, c, base)
    W.replace_all_version(spark, c.limit(0), base)
    return spark.read.parquet(W.latest_version(spark, base))


@query("replace_partition")
def q_replace_partition(spark, sf):
    """Cost sheet by month; one month is replaced, all others stay."""
    c = R.cost_sheet(spark, sf)
    path = _place(spark, "replace-partition")
    c.repartition("mes_comercial").write.partitionBy("mes_comercial").parquet(path)
    month = c.where("mes_comercial = '1998-05'").withColumn("costo_teorico", F.col("costo_teorico") + 1)
    W.replace_partitions(month.where("sku % 2 = 0"), path, ["mes_comercial"])
    return spark.read.parquet(path).select("sku", F.col("mes_comercial").cast("string").alias("mes_comercial"), "costo_teorico")


@query("daily_snapshot")
def q_daily_snapshot(spark, sf):
    """Latest stock written for two days, the second one twice; error rows stay out."""
    o = R.listing_observations(spark, sf).select("item_id", "ts", "event_id", "available_quantity", "status")
    photo = latest_per_key(o, ["item_id"], F.struct("ts", "event_id")).select(
        "item_id", "available_quantity", F.when(F.col("status") == "closed", "gone").alias("error"))
    path = _place(spark, "snapshots")
    for day in (dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 1, 31)):
        W.daily_snapshot(photo, path, day)
    return spark.read.parquet(path).select("item_id", "available_quantity", F.col("fecha").cast("date").alias("fecha"))


@query("append_incremental")
def q_append_incremental(spark, sf):
    """Shipments fetched in two runs; the second takes up what the first left out."""
    s = R.market_shipments(spark, sf)
    path = _place(spark, "appended")
    W.append_incremental(s.where(F.col("shipping_id").cast("bigint") % 3 != 0), path, ["shipping_id"])
    W.append_incremental(s, path, ["shipping_id"])
    W.append_incremental(s, path, ["shipping_id"])
    return spark.read.parquet(path)


@query("create_table_as")
def q_create_table_as(spark, sf):
    """A table made from a query, and made again: readers see the newest complete version."""
    g = R.erp_customers(spark, sf).groupBy("rubro").agg(F.count(F.lit(1)).alias("customers"))
    base = _place(spark, "ctas")
    W.publish_version(spark, g.limit(1), base)
    W.publish_version(spark, g, base)
    return spark.read.parquet(W.latest_version(spark, base))


@query("additive_evolution")
def q_additive_evolution(spark, sf):
    """Incoming rows bring two new columns and lack one."""
    p = R.preparations(spark, sf)
    cur = p.where("preparacion_id % 2 = 0")
    inc = p.where("preparacion_id % 2 = 1").select("preparacion_id", "pedido_codigo", (F.col("preparacion_id") % 3 == 0).alias("urgent"),
                                                 (F.col("preparacion_id") % 100).cast("int").alias("kg"))
    return W.evolve_union(cur, inc)


@query("schema_contract")
def q_schema_contract(spark, sf):
    """Declared columns that the landed order table lacks, with its rows."""
    actual = read_table(spark, sf, "orders")
    declared = T.StructType([*actual.schema.fields, T.StructField("o_channel", T.StringType()), T.StructField("o_weight", T.DoubleType())])
    missing = F.array(*[F.lit(c) for c in W.schema_contract(declared, actual.schema)])
    return actual.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(missing).alias("column_name"), "rows")


@query("evolved_table")
def q_evolved_table(spark, sf):
    """``additive_evolution`` on stored files: rows with two new columns and without one are appended,
    and a reader sees files of both schemas as one table."""
    p = R.preparations(spark, sf)
    path = _place(spark, "evolving")
    W.append_evolving(p.where("preparacion_id % 2 = 0"), path)
    W.append_evolving(p.where("preparacion_id % 2 = 1").select(
        "preparacion_id", "pedido_codigo", (F.col("preparacion_id") % 3 == 0).alias("urgent"), (F.col("preparacion_id") % 100).cast("int").alias("kg")), path)
    return W.read_evolving(spark, path)


@query("guarded_write")
def q_guarded_write(spark, sf):
    """A table of customers by key; batches with a key twice, with a null, and without a declared column
    are refused by their own writes, and readers go on seeing the last good version. The row with id
    null counts the refusals."""
    c = R.erp_customers(spark, sf).select("id", "rubro")
    base, declared = _place(spark, "guarded"), c.schema
    publish = lambda df: W.publish_version(spark, W.guarded(df, ["id"], ["id"], declared, "customers"), base)
    publish(c)
    refused = 0
    for bad in (c.unionByName(c.where("id % 5 = 0")), c.withColumn("id", F.when(F.col("id") % 5 != 0, F.col("id"))), c.drop("rubro")):
        try:
            publish(bad)
        except Exception as e:
            if "customers: " not in str(e):
                raise
            refused += 1
    one = spark.range(1).select(F.lit(None).cast(declared["id"].dataType).alias("id"), F.lit(None).cast("string").alias("rubro"), F.lit(refused).cast("bigint").alias("refused"))
    return spark.read.parquet(W.latest_version(spark, base)).select("id", "rubro", F.lit(None).cast("bigint").alias("refused")).unionByName(one)


@query("bucketed_joins")
def q_bucketed_joins(spark, sf):
    """Orders, their lines and the lines' totals as tables bucketed by order: orders without a line, and
    each order's lines, quantity and share of the whole order in its dearest line, without an exchange."""
    tag = uuid.uuid4().hex
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    li = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity", "l_extendedprice")
    ob = W.bucketed(o, f"orders_{tag}", ["k"], _place(spark, "bucketed-orders"), buckets=16)
    lb = W.bucketed(li, f"lines_{tag}", ["k"], _place(spark, "bucketed-lines"), buckets=16)
    per = lb.groupBy("k").agg(F.count(F.lit(1)).alias("n_lines"), exact_sum("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("dearest"))
    return (ob.hint("merge").join(per.hint("merge"), "k", "left")
            .select("k", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.round("quantity", 2).alias("quantity"), F.col("n_lines").isNull().alias("missing"),
                    "dearest"))


# --- histories and allocation ------------------------------------------------------------------


@query("scd2_apply")
def q_scd2_apply(spark, sf):
    """The price history up to a pulse, and the pulse of the day after applied to it: an item's
    last observation of that day."""
    o = EX.observations(spark, sf)
    before = scd2_from_log(o.where(F.col("ts") < F.lit(PULSE)), "item_id", "ts", ("price",), ("sku",), ["event_id"])
    now = PULSE + dt.timedelta(days=1)
    day = o.where((F.col("ts") >= F.lit(PULSE)) & (F.col("ts") < F.lit(now)))
    batch = latest_per_key(day.select("item_id", "ts", "event_id", "price", "sku"), ["item_id"], F.struct("ts", "event_id"))
    return scd2_apply(before, batch.select("item_id", "price", "sku"), now, "item_id", ("price",), ("sku",))


@query("allocate_proportional")
def q_allocate_proportional(spark, sf):
    """Shipping of each web order over its valid lines by value; parts add up to the whole."""
    w = R.web_order_items(spark, sf).where(S.webstore_valid("estado_pago", "estado"))
    w = w.select("pedido_id", "renglon", "sku", S.nz(F.col("precio").try_cast("double")).alias("precio"), "cantidad",
                 S.nz(F.col("envio_costo_tienda").try_cast("double")).alias("envio"))
    a = allocate_proportional(w, ["pedido_id"], "envio", F.col("precio") * F.col("cantidad"))
    return a.select("pedido_id", "renglon", "sku", F.round("allocated", 4).alias("allocated"))
