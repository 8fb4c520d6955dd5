"""Role views: the landed driver tables re-read in the shape of the retail
sources the library works on (ERP sales, web-store items, marketplace
orders, shipments, preparations, freight invoices, cost sheets, listing
observations ...).

Every role is a lazy DataFrame derived from the given tables, so its size
grows with them.  The mapping is deterministic and mirrored one-to-one by
``marginflow.oracle.roles_sql`` for the DuckDB oracle.

Channel by ``o_orderpriority``: 1,2 wholesale · 3 web store · 4,5 marketplace.
Order status: F paid · P partially refunded · O cancelled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.functions.time import COMMERCIAL_MONTH_FIRST_DAY, month_text
from marginflow.session import stored
from marginflow.sources.tables import read_table

WHOLESALE_PRIORITIES = ("1-URGENT", "2-HIGH")
WEBSTORE_PRIORITIES = ("3-MEDIUM",)
MARKETPLACE_PRIORITIES = ("4-NOT SPECIFIED", "5-LOW")

SEGMENT_COMPANY = {"AUTOMOBILE": "0001", "BUILDING": "0002", "FURNITURE": "0003",
                   "HOUSEHOLD": "0004"}          # anything else → "0005"

SPLIT_CARRIERS = ("SEBASTIAN EXPRESS", "sebastian cargas")
OTHER_CARRIERS = ("SOUTH ROUTE FREIGHT", "NORTH LINE CARGO")

SECOND_PREP_OFFSET = 1_000_000_000


def _orders(spark, sf_dir, priorities, since: dt.date | None = None) -> DataFrame:
    """Orders of a channel; with ``since``, only those whose local date can be
    that day or later (a local date is at most a day off the order date): a
    filter on the bare column, which reaches the Parquet statistics."""
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin(*priorities))
    if since is None:
        return o
    floor = dt.datetime.combine(since - dt.timedelta(days=1), dt.time())
    return o.where(F.col("o_orderdate") >= F.lit(floor))


def _lines(spark, sf_dir, priorities, order_cols, since: dt.date | None = None,
           landed: DataFrame | None = None) -> DataFrame:
    if landed is not None:
        return landed.where(F.col("channel") == _CHANNEL[priorities[0]])
    o = _orders(spark, sf_dir, priorities, since).select("o_orderkey", *order_cols)
    li = read_table(spark, sf_dir, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


_CHANNEL = ({p: "wholesale" for p in WHOLESALE_PRIORITIES} | {p: "webstore" for p in WEBSTORE_PRIORITIES}
            | {p: "marketplace" for p in MARKETPLACE_PRIORITIES})


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sales line with its order, joined and written once, in a folder per
    channel: plans over several channels (and the sold months of all) read
    ``lineitem`` and shuffle it once, then only their channel's folder and
    columns.  Orders of no known priority stand under ``other``."""
    channel = F.lit("other")
    for priority, name in _CHANNEL.items():
        channel = F.when(F.col("o_orderpriority") == priority, F.lit(name)).otherwise(channel)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice")
    return stored(li.join(o, li.l_orderkey == o.o_orderkey).withColumn("channel", channel),
                  "landed-lines", by=("channel",))


def _shifted_text(ts_col: str, hours_col, suffix: str):
    shifted = F.expr(f"timestampadd(HOUR, {hours_col}, {ts_col})")
    return F.concat(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(suffix))


def _gross_unit_price():
    return F.round(F.col("l_extendedprice") / F.col("l_quantity") * (F.lit(1.0) + F.col("l_tax")), 2)


# ---------------------------------------------------------------------------
# wholesale (ERP)
# ---------------------------------------------------------------------------

def company_code(segment):
    out = F.lit("0005")
    expr = None
    for seg, code in SEGMENT_COMPANY.items():
        expr = (F.when(segment == seg, F.lit(code)) if expr is None
                else expr.when(segment == seg, F.lit(code)))
    return expr.otherwise(out)


def erp_sales(spark: SparkSession, sf_dir: str, since: dt.date | None = None,
              landed: DataFrame | None = None) -> DataFrame:
    """One row per ERP sales line (list price without tax + 3 discounts)."""
    lines = _lines(spark, sf_dir, WHOLESALE_PRIORITIES,
                   ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"], since, landed)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    df = lines.join(cust, lines.o_custkey == cust.c_custkey, "inner")
    return df.select(
        company_code(F.col("c_mktsegment")).alias("empresa"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("0001")).otherwise(F.lit("0002")).alias("sucursal"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
        F.col("l_partkey").cast("string").alias("articulo_id"),
        F.col("l_quantity").alias("cantidad"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("precio_lista"),
        (F.col("l_discount") * 100.0 + 0.0).alias("descuento"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(5.0)).otherwise(F.lit(0.0)).alias("descuento_global"),
        F.when(F.col("o_orderstatus") == "F", F.lit(2.0))
         .when(F.col("o_orderstatus") == "O", F.lit(None).cast("double"))
         .otherwise(F.lit(0.0)).alias("descuento_financiero"),
        F.col("o_orderkey").cast("string").alias("pedido_id"),
        F.lpad((F.col("o_custkey") % 7).cast("string"), 3, "0").alias("vendedor"),
        F.when(F.col("o_orderstatus") == "F", F.lit("FA")).otherwise(F.lit("FB")).alias("comprobante_tipo"),
        F.when(F.col("l_linenumber") % 4 == 0, F.lit(""))
         .otherwise(F.lpad((F.col("l_suppkey") % 10).cast("string"), 4, "0")).alias("comprobante_codigo"),
        F.col("o_orderkey").cast("string").alias("comprobante_numero"),
        F.col("o_custkey").alias("cliente_id"),
        F.col("c_name").alias("cliente_nombre"),
        F.col("l_linenumber").alias("renglon"),
        line_id().alias("linea_id"),
    )


def line_id():
    """Unique text id of a landed line (integers only, so every engine
    renders it the same way)."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.round("l_quantity").cast("bigint"),
                       F.round(F.col("l_extendedprice") * 100).cast("bigint"))


def erp_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article catalog: tax %, supplier, brand, litres per unit.  Some parts
    are missing on purpose (default tax, null attributes)."""
    p = read_table(spark, sf_dir, "part").where(F.col("p_partkey") % 97 != 0)
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("descripcion"),
        F.when(size % 4 == 0, F.lit(10.5)).when(size % 4 == 1, F.lit(None).cast("double"))
         .otherwise(F.lit(21.0)).alias("iva_pct"),
        F.col("p_type").alias("proveedor"),
        F.col("p_brand").alias("marca"),
        F.when(size % 50 == 0, F.lit(None).cast("double")).when(size % 50 == 25, F.lit(0.0))
         .otherwise(size.cast("double") / 10.0).alias("litros"),
    )


def erp_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"),
                    F.col("c_mktsegment").alias("rubro"), F.col("c_nationkey").alias("provincia"))


# ---------------------------------------------------------------------------
# costs
# ---------------------------------------------------------------------------

def _month_number(day):
    """Commercial month as a number: twelve times the year, plus months."""
    back = F.when(F.dayofmonth(day) >= COMMERCIAL_MONTH_FIRST_DAY, 0).otherwise(1)
    return F.year(day) * 12 + F.month(day) - 1 - back


def sold_sku_months(spark: SparkSession, sf_dir: str, landed: DataFrame | None = None) -> DataFrame:
    """Distinct (part, commercial month) sold in any channel.  A channel's
    local date is up to a day off the order date, so the months of the days
    around it count too: a second month at the border of two only.  Months are
    numbers until each pair stands once."""
    if landed is None:
        o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
        li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
        landed = li.join(o, li.l_orderkey == o.o_orderkey)
    day = F.to_date("o_orderdate")
    pairs = landed.select(F.col("l_partkey").alias("partkey"), _month_number(F.date_sub(day, 1)).alias("_first"),
                          _month_number(F.date_add(day, 1)).alias("_last")).distinct()
    months = F.when(F.col("_first") == F.col("_last"), F.array("_first")).otherwise(F.array("_first", "_last"))
    sold = pairs.select("partkey", F.explode(months).alias("_month")).distinct()
    year, month = F.floor(F.col("_month") / 12).cast("int"), F.pmod("_month", F.lit(12)) + 1
    return sold.select("partkey", month_text(year, month, F.format_string("%04d-%02d", year, month)).alias("mes_comercial"))


def cost_sheet(spark: SparkSession, sf_dir: str, landed: DataFrame | None = None) -> DataFrame:
    """Monthly theoretical cost sheet (sku, month, cost) for every part and
    commercial month sold, whatever range the sales span.  Parts with
    ``p_size <= 2`` have no cost (their margin stays null)."""
    p = read_table(spark, sf_dir, "part").where(F.col("p_size") > 2).select("p_partkey", "p_retailprice")
    sold = sold_sku_months(spark, sf_dir, landed)
    pm = sold.join(p, sold.partkey == p.p_partkey)
    m = F.substring("mes_comercial", 6, 2).cast("int")
    return pm.select(F.col("p_partkey").cast("string").alias("sku"), "mes_comercial",
                     F.round(F.col("p_retailprice") * (F.lit(0.40) + F.lit(0.02) * m), 2).alias("costo_teorico"))


def offer_sheet(spark: SparkSession, sf_dir: str, costs: DataFrame | None = None) -> DataFrame:
    """Supplier offers per (sku, month) of the cost sheet, with a sheet row
    order ``_seq``; some keys are repeated (the later row wins)."""
    c = cost_sheet(spark, sf_dir) if costs is None else costs
    k = F.col("sku").cast("bigint")
    pct = (k % 4).cast("double") * 5.0
    row = lambda value, seq: F.struct(value.alias("oferta_pct"), F.lit(seq).alias("_seq"))
    rows = F.when(k % 10 == 0, F.array(row(pct, 1), row(pct + 2.5, 2))).otherwise(F.array(row(pct, 1)))
    return c.where(k % 5 == 0).select("sku", "mes_comercial", F.explode(rows).alias("r")).select("sku", "mes_comercial", "r.*")


# ---------------------------------------------------------------------------
# web store
# ---------------------------------------------------------------------------

def web_order_items(spark: SparkSession, sf_dir: str, landed: DataFrame | None = None) -> DataFrame:
    """Header fields repeated on each product row; numbers arrive as text."""
    lines = _lines(spark, sf_dir, WEBSTORE_PRIORITIES,
                   ["o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice"], landed=landed)
    ok, st = F.col("o_orderkey"), F.col("o_orderstatus")
    return lines.select(
        ok.alias("pedido_id"),
        ok.cast("string").alias("pedido_numero"),
        _shifted_text("o_orderdate", "o_orderkey % 24", "+0000").alias("fecha"),
        F.when(st == "O", F.lit("cancelled")).otherwise(F.lit("open")).alias("estado"),
        F.when((st == "O") & (ok % 2 == 0), F.lit("paid"))
         .when((st == "P") & (ok % 7 == 0), F.lit("voided"))
         .when(st.isin("F", "P"), F.lit("paid")).otherwise(F.lit("pending")).alias("estado_pago"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.col("l_quantity").alias("cantidad"),
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(""))
         .otherwise(_gross_unit_price().cast("string")).alias("precio"),
        F.when(ok % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.round(F.col("o_totalprice") * 0.01, 2).cast("string")).alias("envio_costo_tienda"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("cliente_nombre"),
        F.col("l_linenumber").alias("renglon"),
    )


# ---------------------------------------------------------------------------
# marketplace
# ---------------------------------------------------------------------------

def _market_status():
    st = F.col("o_orderstatus")
    return (F.when(st == "F", F.lit("paid")).when(st == "P", F.lit("partially_refunded"))
             .otherwise(F.lit("cancelled")))


def _shipping_id():
    return (F.col("o_custkey") * 100 + F.month("o_orderdate")).cast("double")


def market_orders(spark: SparkSession, sf_dir: str, since: dt.date | None = None) -> DataFrame:
    o = _orders(spark, sf_dir, MARKETPLACE_PRIORITIES, since)
    ok = F.col("o_orderkey")
    return o.select(
        ok.alias("id"),
        _shifted_text("o_orderdate", "o_orderkey % 24", ".000-04:00").alias("date_created"),
        _market_status().alias("status"),
        F.when(ok % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("total_amount"),
        F.concat(F.lit("buyer"), F.col("o_custkey").cast("string")).alias("buyer_nickname"),
        _shipping_id().alias("shipping_id"),
    )


def market_order_items(spark: SparkSession, sf_dir: str, landed: DataFrame | None = None) -> DataFrame:
    """Marketplace items already exploded: one row per (order, item)."""
    lines = _lines(spark, sf_dir, MARKETPLACE_PRIORITIES, [], landed=landed)
    price = _gross_unit_price()
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("renglon"),
        F.col("l_partkey").cast("string").alias("seller_sku"),
        F.concat(F.lit("item "), F.col("l_partkey").cast("string")).alias("title"),
        F.col("l_quantity").alias("quantity"),
        price.alias("unit_price"),
        F.round(price * 0.12, 2).alias("sale_fee"),
    )


def market_orders_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketplace orders with ``order_items`` as an array of structs, the way
    the API returns them (one collect per order: bounded by order size)."""
    items = market_order_items(spark, sf_dir)
    packed = (items.groupBy("order_id")
              .agg(F.sort_array(F.collect_list(F.struct(
                  F.col("renglon"),
                  F.struct(F.col("seller_sku"), F.col("title")).alias("item"),
                  F.col("quantity"), F.col("unit_price"), F.col("sale_fee")))).alias("order_items")))
    o = market_orders(spark, sf_dir)
    return o.join(packed, o.id == packed.order_id, "left").drop("order_id")


def market_orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same orders with ``order_items`` stored as JSON text (null when the
    order has no items)."""
    n = market_orders_nested(spark, sf_dir)
    return n.withColumn("order_items", F.to_json("order_items"))


def market_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per shipment (package): its cost and ONE of its orders.
    Every ninth package was never fetched."""
    o = _orders(spark, sf_dir, MARKETPLACE_PRIORITIES)
    pk = _shipping_id().cast("bigint")
    return (o.select(pk.alias("pk"), "o_orderkey", "o_totalprice")
            .where(pk % 9 != 0)
            .groupBy("pk")
            .agg(F.min("o_orderkey").alias("o"), F.max("o_totalprice").alias("mx"))
            .select(F.col("pk").cast("string").alias("shipping_id"),
                    F.col("o").cast("string").alias("order_id"),
                    F.round(F.col("mx") * 0.02, 2).alias("costo_envio")))


# ---------------------------------------------------------------------------
# logistics
# ---------------------------------------------------------------------------

def preparations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preparation_log(spark, sf_dir).drop("fila")


def preparation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse preparations per wholesale order: ``prep = order div 3`` (so
    several orders share one), repeated pairs (every 4th order), a second
    preparation for every 9th order, none for orders ≡ 7 (mod 8); ``fila`` is
    the order in which an order's rows arrived."""
    o = _orders(spark, sf_dir, WHOLESALE_PRIORITIES).where(F.col("o_orderkey") % 8 != 7)
    ok = F.col("o_orderkey")
    carrier = (F.when(ok % 5 == 0, F.lit(SPLIT_CARRIERS[0]))
                .when(ok % 5 == 1, F.lit(SPLIT_CARRIERS[1]))
                .when(ok % 5 == 2, F.lit(None).cast("string"))
                .when(ok % 5 == 3, F.lit(OTHER_CARRIERS[0]))
                .otherwise(F.lit(OTHER_CARRIERS[1])))
    pid = F.floor(ok / 3).cast("bigint")
    ids = F.array(pid, F.when(ok % 4 == 0, pid), F.when(ok % 9 == 0, pid + SECOND_PREP_OFFSET))
    rows = o.select(F.posexplode(ids).alias("fila", "preparacion_id"), ok.cast("string").alias("pedido_codigo"), carrier.alias("transporte"))
    return rows.where(F.col("preparacion_id").isNotNull()).select("preparacion_id", "pedido_codigo", "transporte", "fila")


def freight_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier invoices keyed like ``freight_key``: per preparation, and per
    preparation and unit for split carriers.  Every 4th preparation has none."""
    p = preparations(spark, sf_dir).select("preparacion_id").distinct().where(F.col("preparacion_id") % 4 != 3)
    pid = F.col("preparacion_id")
    s = pid.cast("string")
    row = lambda key, net: F.struct(key.alias("clave_fila"), net.alias("neto_cobrado_transporte"))
    rows = F.array(row(s, F.lit(100.0) + (pid % 50).cast("double") * 10.0),
                   row(F.concat(s, F.lit("-A")), F.lit(60.0) + (pid % 30).cast("double") * 5.0),
                   row(F.concat(s, F.lit("-B")), F.lit(40.0) + (pid % 20).cast("double") * 5.0))
    return p.select(F.explode(rows).alias("r")).select("r.*")


# ---------------------------------------------------------------------------
# listings and observations (events)
# ---------------------------------------------------------------------------

def listing_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is one observation of one listing (item = user)."""
    return project_observations(read_table(spark, sf_dir, "events"))


def project_observations(e: DataFrame) -> DataFrame:
    """Events as listing observations (batch or stream): four listings share
    a SKU and six an inventory, so both grow with the listings."""
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("item_id"),
        F.col("ts"),
        F.floor(F.col("user_id") / 4).cast("bigint").cast("string").alias("sku"),
        F.when(F.col("user_id") % 3 == 0,
               F.concat(F.lit("INV"), F.floor(F.col("user_id") / 6).cast("bigint").cast("string"))).alias("inventory_id"),
        F.when(et == "signup", F.lit("closed")).when(et == "click", F.lit("paused"))
         .otherwise(F.lit("active")).alias("status"),
        F.when(et == "error", F.array(F.lit("out_of_stock")))
         .when(et == "click", F.array(F.lit("paused_by_seller")))
         .when(et == "view", F.array(F.lit("b_tag"), F.lit("a_tag")))
         .otherwise(F.array().cast("array<string>")).alias("sub_status"),
        F.when((et == "purchase") & (k % 5 == 0), F.lit(0)).otherwise(k).alias("available_quantity"),
        F.col("value").alias("price"),
        (F.col("user_id") % 4 == 0).alias("catalog_listing"),
        F.when(F.col("user_id") % 2 == 0, F.lit("fulfillment")).otherwise(F.lit("drop_off")).alias("logistic_type"),
    )


def pulse_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation moments: distinct event hours, with holes (hours 3–8 of
    every fifth day) so coverage has gaps."""
    e = read_table(spark, sf_dir, "events").select("ts")
    h = F.date_trunc("hour", "ts")
    return (e.where(~((F.dayofmonth("ts") % 5 == 0) & F.hour("ts").between(3, 8)))
            .select(h.alias("moment")).distinct())
