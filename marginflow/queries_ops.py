"""Registered queries for the scalar, aggregation, window, set, sink and
quality operators (SURVEY §2.1–2.7, §2.11).  Each runs over whole role views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marginflow.functions import scalars as S
from marginflow.functions.time import commercial_month, local_date
from marginflow.operators import quality as QL
from marginflow.operators import windows as WN
from marginflow.operators.aggregates import exact_sum, weighted_average
from marginflow.operators.dedupe import any_per_key, dedupe_keep_last, keep_one_per_key, latest_per_key
from marginflow.plans import fact as FCT
from marginflow.registry import QUERIES, costs, q_fact_sales, query
from marginflow.sinks import writers as W
from marginflow.sources import roles as R
from marginflow.sources.tables import read_table, scan_table

# Fixed evaluation dates for the windowed operators (the data spans 1995–2001).
AS_OF = dt.date(2000, 1, 1)
CUTOFF = dt.date(1999, 1, 1)

# --- §2.3 scalars -------------------------------------------------------------


@query("commercial_month")
def q_commercial_month(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", commercial_month(F.to_date("o_orderdate")).alias("commercial_month"))


@query("local_date")
def q_local_date(spark, sf):
    m = R.market_orders(spark, sf).select(F.lit("marketplace").alias("source"), F.col("id"),
                                           local_date("date_created").alias("local_date"))
    w = R.web_order_items(spark, sf).select(F.lit("webstore").alias("source"), F.col("pedido_id").alias("id"),
                                             local_date("fecha").alias("local_date")).distinct()
    e = R.erp_sales(spark, sf).select(F.lit("erp").alias("source"), F.col("pedido_id").cast("bigint").alias("id"),
                                       local_date("fecha").alias("local_date")).distinct()
    return m.unionByName(w).unionByName(e)


@query("code_label")
def q_code_label(spark, sf):
    """Seller codes with labels read from a table (here the nations); codes
    without one keep their raw code."""
    labels = read_table(spark, sf, "nation").where("n_nationkey <= 4").select(
        F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("code"), F.col("n_name").alias("label"))
    s = R.erp_sales(spark, sf).select("linea_id", "vendedor")
    return S.label_codes(s, "vendedor", labels, "Seller", "seller").select("linea_id", "seller")


@query("business_unit")
def q_business_unit(spark, sf):
    s = R.erp_sales(spark, sf)
    return s.select("linea_id", S.business_unit("empresa", "sucursal").alias("unit"),
                    S.fiscal_flag("empresa").alias("fiscal"))


@query("fiscal_flag")
def q_fiscal_flag(spark, sf):
    """Lines and list value by the fiscal flag of their company."""
    s = R.erp_sales(spark, sf)
    return s.groupBy(S.fiscal_flag("empresa").alias("fiscal"), "empresa").agg(
        F.count(F.lit(1)).alias("lines"), F.round(exact_sum("precio_lista"), 2).alias("list_value"))


@query("chained_discount")
def q_chained_discount(spark, sf):
    s = R.erp_sales(spark, sf)
    d = ("descuento", "descuento_global", "descuento_financiero")
    return s.select("linea_id", S.chained_discount("precio_lista", *d).alias("price"),
                    S.combined_discount_pct(*d).alias("offer_pct"))


@query("tax_net")
def q_tax_net(spark, sf):
    it = R.market_order_items(spark, sf)
    a = FCT.article_lookup(R.erp_articles(spark, sf)).select(F.col("sku").alias("_s"), "iva_pct")
    j = it.join(a, it.seller_sku == a._s, "left")
    t = F.coalesce(F.col("iva_pct"), F.lit(21.0))
    return j.select("order_id", "renglon", S.tax_net("unit_price", t).alias("net_price"),
                    S.tax_gross(S.tax_net("unit_price", t), t).alias("gross_again"),
                    S.fee_net("sale_fee").alias("fee_net"))


@query("tax_gross")
def q_tax_gross(spark, sf):
    """ERP list prices (without tax) with each article's tax."""
    s = R.erp_sales(spark, sf).select("linea_id", "articulo_id", "precio_lista")
    a = FCT.article_lookup(R.erp_articles(spark, sf)).select(F.col("sku").alias("_s"), "iva_pct")
    j = s.join(a, s.articulo_id == a._s, "left")
    return j.select("linea_id", S.tax_gross("precio_lista", F.coalesce(F.col("iva_pct"), F.lit(21.0))).alias("gross_price"))


def _pct_text(c):
    return F.concat(F.regexp_replace(c.cast("string"), r"\.", ","), F.lit("%"))


@query("parse_percent")
def q_parse_percent(spark, sf):
    o = R.offer_sheet(spark, sf)
    k = F.col("sku").cast("bigint")
    txt = (F.when(k % 3 == 0, _pct_text(F.col("oferta_pct")))
            .when(k % 3 == 1, F.col("oferta_pct").cast("string"))
            .otherwise(F.when(F.col("oferta_pct") == 0, F.lit("")).otherwise(F.lit("x"))))
    return o.select("sku", "mes_comercial", "_seq", txt.alias("raw"),
                    S.parse_percent(txt).alias("pct_text"),
                    S.parse_percent(F.col("oferta_pct") / 100.0, numeric_input=True).alias("pct_number"))


def _comma_text(v):
    cents = F.round(v * 100).cast("bigint")
    ip, cp = F.floor(cents / 100).cast("bigint"), (cents % 100)
    int_txt = F.when(ip >= 1000, F.concat(F.floor(ip / 1000).cast("bigint").cast("string"), F.lit("."),
                                          F.lpad((ip % 1000).cast("string"), 3, "0"))).otherwise(ip.cast("string"))
    return F.concat(int_txt, F.lit(","), F.lpad(cp.cast("string"), 2, "0"))


@query("parse_decimal_comma")
def q_parse_decimal_comma(spark, sf):
    c = R.cost_sheet(spark, sf)
    txt = _comma_text(F.col("costo_teorico") * 3.0)
    return c.select("sku", "mes_comercial", txt.alias("raw"), S.parse_decimal_comma(txt).alias("value"))


@query("normalize_sku")
def q_normalize_sku(spark, sf):
    a = R.erp_articles(spark, sf)
    k = F.col("id").cast("bigint")
    raw = (F.when(k % 3 == 0, F.concat("id", F.lit(".0"))).when(k % 3 == 1, F.concat(F.lit(" "), "id", F.lit(" ")))
            .when(k % 11 == 2, F.lit("nan")).otherwise(F.col("id")))
    return a.select("id", raw.alias("raw")).select("id", "raw", S.normalize_sku("raw").alias("sku")) \
            .where(F.col("sku").isNotNull())


@query("document_number")
def q_document_number(spark, sf):
    s = R.erp_sales(spark, sf)
    return s.select("linea_id", S.document_number("comprobante_tipo", "comprobante_codigo",
                                                  "comprobante_numero").alias("document"))


@query("numeric_code_only")
def q_numeric_code_only(spark, sf):
    w = R.web_order_items(spark, sf)
    code = F.when(F.col("pedido_id") % 10 == 0, F.concat(F.lit("A"), "pedido_numero")).otherwise(F.col("pedido_numero"))
    return w.select(code.alias("code")).distinct().where(S.numeric_code_only("code"))


@query("listing_state")
def q_listing_state(spark, sf):
    o = R.listing_observations(spark, sf)
    reason = S.listing_reason("status", "sub_status", "available_quantity")
    return o.select("event_id", reason.alias("reason"), (reason == S.REASON_OK).alias("sellable"))


@query("canonical_list_text")
def q_canonical_list_text(spark, sf):
    o = R.listing_observations(spark, sf)
    return o.select("event_id", S.canonical_list_text("sub_status").alias("sub_status_text"))


@query("order_validity")
def q_order_validity(spark, sf):
    w = R.web_order_items(spark, sf).select(
        F.lit("webstore").alias("channel"), F.col("pedido_id").alias("id"),
        S.webstore_valid("estado_pago", "estado").alias("valid")).distinct()
    m = R.market_orders(spark, sf).select(F.lit("marketplace").alias("channel"), "id",
                                          S.marketplace_valid("status").alias("valid"))
    return w.unionByName(m)


@query("sargable_floor")
def q_sargable_floor(spark, sf):
    pre = R.market_orders(spark, sf, since=CUTOFF)      # bare order date: reaches the scan
    return pre.withColumn("local_date", local_date("date_created")) \
              .where(F.col("local_date") >= F.lit(CUTOFF)).select("id", "local_date")


def _margin_pct_col():
    q = F.col("quantity")
    gross = F.try_divide(F.col("line_total"), F.when(q != 0, q))
    return S.margin_pct(gross, gross - F.col("net_price"), F.col("unit_cost"), F.col("commission"),
                        F.try_divide(S.nz("freight"), F.when(q != 0, q)))


@query("margin_pct")
def q_margin_pct(spark, sf):
    f = q_fact_sales(spark, sf)
    return f.select("channel", "order_id", "sku", "quantity", "line_total",
                    F.round(_margin_pct_col(), 4).alias("margin_pct"))


@query("margin_band")
def q_margin_band(spark, sf):
    f = q_fact_sales(spark, sf)
    f = f.select("channel", _margin_pct_col().alias("margin_pct"))
    return f.groupBy("channel", S.margin_band("margin_pct").alias("band")).agg(F.count(F.lit(1)).alias("lines"))


# --- §2.4 joins -----------------------------------------------------------------

@query("cost_lookup")
def q_cost_lookup(spark, sf):
    f = FCT.fact_wholesale(R.erp_sales(spark, sf), R.erp_articles(spark, sf), costs(spark, sf),
                           with_line_id=True)
    return f.select("line_id", "commercial_month", "unit_cost", "margin")


@query("attribute_lookup_last_wins")
def q_attribute_lookup_last_wins(spark, sf):
    """Supplier and brand by the trimmed article id, tax by the id as it is; of
    repeated ids the last catalog row wins (every 20th article stands again,
    later, with a blank before its id)."""
    s = R.erp_sales(spark, sf).select("linea_id", "articulo_id")
    first = R.erp_articles(spark, sf).select("id", "iva_pct", "proveedor", "marca", F.lit(1).alias("fila"))
    again = first.where(F.col("id").cast("bigint") % 20 == 0).select(
        F.concat(F.lit(" "), "id").alias("id"), F.lit(27.0).alias("iva_pct"), F.concat(F.lit("late "), "proveedor").alias("proveedor"),
        "marca", F.lit(2).alias("fila"))
    a = first.unionByName(again)
    tax = dedupe_keep_last(a.select(F.col("id").alias("_id"), "iva_pct", "fila"), ["_id"], ["fila"]).drop("fila")
    attr = dedupe_keep_last(a.select(F.trim("id").alias("_sku"), "proveedor", "marca", "fila"), ["_sku"], ["fila"]).drop("fila")
    j = s.join(tax, s.articulo_id == F.col("_id"), "left").join(attr, F.trim(s.articulo_id) == F.col("_sku"), "left")
    return j.select("linea_id", F.coalesce("iva_pct", F.lit(21.0)).alias("tax_pct"),
                    F.col("proveedor").alias("supplier"), F.col("marca").alias("brand"))


@query("cost_offer_join")
def q_cost_offer_join(spark, sf):
    """Costs that an offer lowers, with what it takes off."""
    c = costs(spark, sf).where(F.col("oferta_pct") > 0)
    return c.select("sku", "mes_comercial", "oferta_pct", F.round(F.col("costo_teorico") - F.col("costo_real"), 4).alias("off"))


@query("observation_catalog_join")
def q_observation_catalog_join(spark, sf):
    o = R.listing_observations(spark, sf)
    cat = latest_per_key(o.select("item_id", "ts", "sku", "inventory_id"), ["item_id"], "ts") \
        .select("item_id", F.col("sku").alias("catalog_sku"), F.col("inventory_id").alias("catalog_inventory"))
    return o.select("event_id", "item_id").join(cat, "item_id", "left")


@query("anti_existing")
def q_anti_existing(spark, sf):
    """Valid marketplace orders whose package has no shipment row (NOT EXISTS)."""
    o = R.market_orders(spark, sf).where(S.marketplace_valid("status"))
    sh = R.market_shipments(spark, sf)
    o = o.withColumn("_sid", F.col("shipping_id").cast("bigint").cast("string"))
    return o.join(sh, o._sid == sh.shipping_id, "left_anti").select("id", "_sid").withColumnRenamed("_sid", "shipping_id")


@query("missing_shipping")
def q_missing_shipping(spark, sf):
    """Packages without a shipment row, by status of their orders: orders and amount."""
    o = R.market_orders(spark, sf).withColumn("_sid", F.col("shipping_id").cast("bigint").cast("string"))
    sh = R.market_shipments(spark, sf).select(F.col("shipping_id").alias("_sid"))
    lost = o.join(sh, "_sid", "left_anti")
    return lost.groupBy("status").agg(F.countDistinct("_sid").alias("packages"), F.count(F.lit(1)).alias("orders"),
                                      F.round(exact_sum("total_amount"), 2).alias("amount"))


@query("self_dedupe_join")
def q_self_dedupe_join(spark, sf):
    """Of repeated (preparation, order) rows the first that arrived stays; how
    many went is told too."""
    p = R.preparation_log(spark, sf)
    keys = ["preparacion_id", "pedido_codigo"]
    first = keep_one_per_key(p, keys, ["fila"], last=False)
    n = p.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("removed"))
    return first.join(n, keys)


# --- §2.5 aggregations ----------------------------------------------------------

@query("order_value")
def q_order_value(spark, sf):
    w = R.web_order_items(spark, sf).where(S.webstore_valid("estado_pago", "estado"))
    v = S.nz(F.col("precio").try_cast("double")) * S.nz("cantidad")
    return w.groupBy("pedido_id").agg(F.round(exact_sum(v), 2).alias("order_value"))


@query("sales_by_sku_day")
def q_sales_by_sku_day(spark, sf):
    f = q_fact_sales(spark, sf)
    q = F.col("quantity")
    return f.groupBy("sku", "date").agg(
        F.round(exact_sum(q), 2).alias("units"),
        F.countDistinct("order_id").alias("orders"),
        F.round(exact_sum("line_total"), 2).alias("revenue"),
        F.round(exact_sum(F.col("unit_cost") * q), 2).alias("cost"),
        F.round(exact_sum(F.col("commission") * q), 2).alias("commission"),
        F.round(exact_sum("freight"), 2).alias("freight"),
        F.round(exact_sum(F.col("net_price") * q), 2).alias("net_revenue"))


@query("listing_flags")
def q_listing_flags(spark, sf):
    o = R.listing_observations(spark, sf)
    return o.groupBy("sku").agg(F.bool_or(F.col("status") == "active").alias("any_active"),
                                F.bool_or("catalog_listing").alias("any_catalog"))


@query("weighted_average")
def q_weighted_average(spark, sf):
    it = R.market_order_items(spark, sf)
    return it.groupBy("seller_sku").agg(F.round(weighted_average("unit_price", "quantity"), 4).alias("avg_price"))


@query("pulse_summary")
def q_pulse_summary(spark, sf):
    o = R.listing_observations(spark, sf)
    reason = S.listing_reason("status", "sub_status", "available_quantity")
    return o.groupBy(F.date_trunc("hour", "ts").alias("moment")).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(reason == S.REASON_OK).alias("sellable"),
        F.count_if(reason == S.REASON_OUT_OF_STOCK).alias("out_of_stock"))


@query("month_summary")
def q_month_summary(spark, sf):
    return costs(spark, sf).groupBy("mes_comercial").agg(F.count(F.lit(1)).alias("rows")).orderBy("mes_comercial")


@query("consolidated_preparations")
def q_consolidated_preparations(spark, sf):
    p = R.preparations(spark, sf)
    return p.groupBy("preparacion_id").agg(F.countDistinct("pedido_codigo").alias("orders")).where("orders > 1")


@query("value_counts")
def q_value_counts(spark, sf):
    return R.erp_customers(spark, sf).groupBy("provincia").agg(F.count(F.lit(1)).alias("customers"))


def _latest_stock(spark, sf):
    o = R.listing_observations(spark, sf)
    return latest_per_key(o.select("item_id", "ts", "inventory_id", "available_quantity", "logistic_type"),
                          ["item_id"], "ts")


@query("shared_stock_total")
def q_shared_stock_total(spark, sf):
    """Naive Σ over listings vs true Σ over distinct inventories (each
    inventory counted once, at its most recent observation)."""
    lat = _latest_stock(spark, sf).where(F.col("inventory_id").isNotNull())
    naive = lat.agg(F.sum("available_quantity").cast("bigint").alias("naive_total"),
                    F.count(F.lit(1)).alias("listings"))
    per_inv = lat.groupBy("inventory_id").agg(
        F.max_by("available_quantity", F.struct("ts", "item_id")).alias("q"), F.count(F.lit(1)).alias("n"))
    true = per_inv.agg(F.sum("q").cast("bigint").alias("true_total"), F.count(F.lit(1)).alias("inventories"),
                       F.count_if(F.col("n") > 1).alias("shared_inventories"))
    return naive.crossJoin(true)  # one row × one row


@query("conditional_counts")
def q_conditional_counts(spark, sf):
    m = R.market_orders(spark, sf)
    st = F.col("status")
    return m.agg(F.count(F.lit(1)).alias("orders"), F.count_if(st == "paid").alias("paid"),
                 F.count_if(st == "partially_refunded").alias("partially_refunded"),
                 F.count_if(st == "cancelled").alias("cancelled"))


# --- §2.6 windows / dedupe --------------------------------------------------------

@query("latest_per_key")
def q_latest_per_key(spark, sf):
    o = R.listing_observations(spark, sf).select("sku", "ts", "item_id", "price")
    return latest_per_key(o, ["sku"], "ts")


@query("any_per_key")
def q_any_per_key(spark, sf):
    m = R.market_orders(spark, sf).select("shipping_id", "id", "status")
    return any_per_key(m, ["shipping_id"])


@query("dedupe_keep_last")
def q_dedupe_keep_last(spark, sf):
    return dedupe_keep_last(R.offer_sheet(spark, sf), ["sku", "mes_comercial"], ["_seq"])


@query("group_total_transform")
def q_group_total_transform(spark, sf):
    from marginflow.operators.allocate import with_group_total

    w = R.web_order_items(spark, sf).select("pedido_id", "renglon", "sku", "cantidad")
    return with_group_total(w, ["pedido_id"], "cantidad", out="order_units")


@query("gap_pairs")
def q_gap_pairs(spark, sf):
    return WN.gap_pairs(R.pulse_moments(spark, sf), "moment", 2 * 3600)


@query("change_points")
def q_change_points(spark, sf):
    o = R.listing_observations(spark, sf).withColumn(
        "reason", S.listing_reason("status", "sub_status", "available_quantity"))
    return WN.change_points(o.select("item_id", "ts", "event_id", "reason"), ["item_id"], ["ts", "event_id"], ["reason"]) \
             .select("item_id", "event_id", "reason", "run_no")


@query("top_n_preview")
def q_top_n_preview(spark, sf):
    f = q_fact_sales(spark, sf)
    return (f.groupBy("sku").agg(F.round(exact_sum("line_total"), 2).alias("revenue"))
             .orderBy(F.desc("revenue"), "sku").limit(10))


@query("ordered")
def q_ordered(spark, sf):
    """Every SKU by revenue: a total order over the whole result (range
    partitioned, no row is left out)."""
    f = q_fact_sales(spark, sf)
    return f.groupBy("sku").agg(F.round(exact_sum("line_total"), 2).alias("revenue")).orderBy(F.desc("revenue"), "sku")


@query("last_run_streak")
def q_last_run_streak(spark, sf):
    """Per listing: the latest run of consecutive days with stock in the
    day's snapshot and no sale that day (snapshots without a match in the
    sales)."""
    o = R.listing_observations(spark, sf).withColumn("day", F.to_date("ts"))
    stock = o.groupBy("item_id", "day").agg(F.max("available_quantity").alias("most")).where("most > 0")
    sold = o.where((F.size("sub_status") == 0) & (F.col("status") == "active")).select("item_id", "day").distinct()
    idle = stock.join(sold, ["item_id", "day"], "left_anti").withColumn("idle", F.lit(True))
    return WN.last_streak(idle, ["item_id"], "day", "idle")


@query("serpentine_assign")
def q_serpentine_assign(spark, sf):
    """SKUs ordered by (any active desc, units desc, sku) dealt 1-2-3,3-2-1."""
    from marginflow.plans.experiment import experiment_skus

    skus = experiment_skus(spark, sf)
    return WN.serpentine_groups(skus, [F.desc("any_active"), F.desc("units"), F.asc("sku")], 3, "grp") \
             .select("sku", "any_active", "units", "grp")


# --- §2.7 set operations ----------------------------------------------------------

@query("union_channels")
def q_union_channels(spark, sf):
    """The three channels' facts, each built on its own, by name."""
    parts = [QUERIES[f"fact_{c}"](spark, sf).select("channel", "order_id", "sku", "quantity", "line_total")
             for c in ("wholesale", "webstore", "marketplace")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("union_months")
def q_union_months(spark, sf):
    c = R.cost_sheet(spark, sf)
    m = F.substring("mes_comercial", 6, 2).cast("int")
    even = c.where(m % 2 == 0).withColumn("_seq", F.lit(1))
    odd = c.where(m % 2 == 1).withColumn("_seq", F.lit(2))
    again = c.where(F.col("sku").cast("bigint") % 7 == 0).withColumn("_seq", F.lit(3)) \
             .withColumn("costo_teorico", F.col("costo_teorico") + 1.0)
    return dedupe_keep_last(even.unionByName(odd).unionByName(again), ["sku", "mes_comercial"], ["_seq"])


@query("union_all_audit")
def q_union_all_audit(spark, sf):
    a = QL.duplicate_audit(R.preparations(spark, sf), ["preparacion_id", "pedido_codigo"], "preparations")
    b = QL.duplicate_audit(R.market_order_items(spark, sf), ["order_id", "seller_sku"], "market_items")
    return a.unionByName(b)


@query("schema_diff")
def q_schema_diff(spark, sf):
    """SKUs sold on the web store that the article catalog lacks."""
    w = R.web_order_items(spark, sf).select(F.col("sku")).distinct()
    a = R.erp_articles(spark, sf).select(F.col("id").alias("sku"))
    return w.exceptAll(a.distinct())


# --- §2.1 sources -----------------------------------------------------------------

@query("scan_table")
def q_scan_table(spark, sf):
    return scan_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"],
                      F.col("l_shipdate") >= F.lit(dt.datetime(1999, 1, 1)))


@query("catalog_dedupe_ids")
def q_catalog_dedupe_ids(spark, sf):
    lat = _latest_stock(spark, sf)
    return lat.where((F.col("logistic_type") == "fulfillment") & F.col("inventory_id").isNotNull()) \
              .select("inventory_id").distinct()


@query("missing_keys")
def q_missing_keys(spark, sf):
    """Shipments of paid orders (one row per shipping id, smallest order)
    that are not fetched yet, from a date floor on."""
    m = R.market_orders(spark, sf, since=CUTOFF).where(F.col("status") == "paid")
    m = m.where(local_date("date_created") >= F.lit(CUTOFF))
    m = m.withColumn("shipping", F.col("shipping_id").cast("bigint").cast("string"))
    per_ship = any_per_key(m.select("shipping", "id"), ["shipping"])
    sh = R.market_shipments(spark, sf)
    return per_ship.join(sh, per_ship.shipping == sh.shipping_id, "left_anti")


@query("offers_active")
def q_offers_active(spark, sf):
    o = dedupe_keep_last(R.offer_sheet(spark, sf), ["sku", "mes_comercial"], ["_seq"])
    valid_to = F.last_day(F.to_date(F.concat("mes_comercial", F.lit("-01"))))
    return o.where(valid_to >= F.lit(AS_OF)).agg(F.count(F.lit(1)).alias("active_offers"))


@query("stock_with_expiry")
def q_stock_with_expiry(spark, sf):
    li = read_table(spark, sf, "lineitem")
    exp = F.when(F.col("l_linenumber") % 3 == 0, F.lit(None)).otherwise(F.col("l_shipdate"))
    return li.agg(F.count(F.lit(1)).alias("rows"), F.count(exp).alias("with_expiry"))


@query("order_items_explode")
def q_order_items_explode(spark, sf):
    from marginflow.sources.nested import explode_items

    return explode_items(R.market_orders_nested(spark, sf))


@query("order_items_from_json_text")
def q_order_items_from_json_text(spark, sf):
    from marginflow.sources.nested import explode_items, items_from_json_text

    return explode_items(items_from_json_text(R.market_orders_json(spark, sf)))


# --- §2.2 sinks as functions ---------------------------------------------------------

def _fact_versions(spark, sf):
    cur = FCT.fact_wholesale(R.erp_sales(spark, sf), R.erp_articles(spark, sf), costs(spark, sf),
                             with_line_id=True)
    inc = cur.where(F.col("date") >= F.lit(CUTOFF)).withColumn("margin", F.round("margin", 0))
    return cur, inc


@query("replace_window")
def q_replace_window(spark, sf):
    cur, inc = _fact_versions(spark, sf)
    return W.replace_window(cur, inc, "date", CUTOFF).select("line_id", "date", "margin")


@query("replace_window_and_keys")
def q_replace_window_and_keys(spark, sf):
    cur, inc = _fact_versions(spark, sf)
    # incoming re-dates some lines one year back across the cutoff
    moved = inc.withColumn("date", F.when(F.col("line_id").endswith("7"), F.add_months("date", -12))
                           .otherwise(F.col("date")))
    return W.replace_window_and_keys(cur, moved, "date", CUTOFF, ["line_id"]).select("line_id", "date", "margin")


@query("replace_keys")
def q_replace_keys(spark, sf):
    cur = R.preparations(spark, sf)
    req = cur.select("pedido_codigo").distinct().where(F.col("pedido_codigo").cast("bigint") % 10 == 3)
    inc = cur.join(req, "pedido_codigo").distinct() \
             .withColumn("transporte", F.upper("transporte"))
    return W.replace_keys(cur, inc, req, ["pedido_codigo"])


@query("unique_key_guard")
def q_unique_key_guard(spark, sf):
    return QL.unique_key_guard(R.preparations(spark, sf), ["preparacion_id", "pedido_codigo"])


# --- §2.11 quality --------------------------------------------------------------------

@query("duplicate_audit")
def q_duplicate_audit(spark, sf):
    return QL.duplicate_audit(R.preparations(spark, sf), ["preparacion_id", "pedido_codigo"])


@query("contradiction_audit")
def q_contradiction_audit(spark, sf):
    return QL.contradiction_audit(R.preparations(spark, sf), ["pedido_codigo"], "preparacion_id")


@query("fact_duplicate_audit")
def q_fact_duplicate_audit(spark, sf):
    return QL.repeated_key_excess(q_fact_sales(spark, sf), ["channel", "order_id", "sku"])


def _recomputed_margin():
    q = F.col("quantity")
    return (F.col("net_price") - F.col("unit_cost") - F.col("commission")) * q - S.nz("freight")


def _stored_margin():
    """The margin as a table with faults would hold it: every 50th order's is off by one."""
    return F.col("margin") + F.when(F.col("order_id").try_cast("bigint") % 50 == 0, 1.0).otherwise(0.0)


@query("margin_audit")
def q_margin_audit(spark, sf):
    f = q_fact_sales(spark, sf)
    return f.groupBy("channel").agg(F.count(F.lit(1)).alias("lines"),
                                    QL.mismatch_count(_stored_margin(), _recomputed_margin()).alias("mismatched"))


@query("margin_backfill")
def q_margin_backfill(spark, sf):
    """The whole marketplace table: lines whose margin carried one commission
    instead of one per unit get it recomputed, all others stay."""
    f = q_fact_sales(spark, sf).where(F.col("channel") == FCT.CHANNEL_MARKETPLACE)
    buggy = (F.col("net_price") - F.col("unit_cost")) * F.col("quantity") - F.col("commission") - S.nz("freight")
    f = f.withColumn("margin_before", buggy)
    cond = F.coalesce(F.col("unit_cost").isNotNull() & (F.col("commission") != 0) & (F.col("quantity") > 1), F.lit(False))
    after = F.when(cond, _recomputed_margin()).otherwise(F.col("margin_before"))
    return f.select("order_id", "sku", F.round("margin_before", 2).alias("margin_before"),
                    F.round(after, 2).alias("margin_after"), cond.alias("corrected"))


@query("reject_count")
def q_reject_count(spark, sf):
    o = R.listing_observations(spark, sf)
    err = F.when(F.array_contains("sub_status", "out_of_stock"), F.lit("not_found"))
    return o.agg(F.count(F.lit(1)).alias("rows"), F.count(err).alias("rejected"))


@query("max_date_gap")
def q_max_date_gap(spark, sf):
    f = q_fact_sales(spark, sf)
    start = AS_OF - dt.timedelta(days=7)
    return f.agg(F.max("date").alias("max_date")).select(
        "max_date", F.lit(start).alias("window_start"),
        F.datediff(F.lit(start), F.col("max_date")).alias("uncovered_days"))


@query("order_status_matrix")
def q_order_status_matrix(spark, sf):
    w = R.web_order_items(spark, sf).select("pedido_id", "estado", "estado_pago").distinct()
    return w.groupBy("estado", "estado_pago").agg(F.count(F.lit(1)).alias("orders"))


@query("cancelled_panel")
def q_cancelled_panel(spark, sf):
    m = R.market_orders(spark, sf)
    c = F.col("status") == "cancelled"
    return m.agg(F.count_if(c).alias("cancelled"),
                 F.round(exact_sum(F.when(c, F.col("total_amount"))), 2).alias("cancelled_amount"),
                 F.round(F.count_if(c) / F.count(F.lit(1)), 6).alias("cancelled_share"))


@query("null_profile")
def q_null_profile(spark, sf):
    return QL.null_profile(R.market_orders(spark, sf))


@query("find_value_in_row")
def q_find_value_in_row(spark, sf):
    """Every column of the order table: text that holds the needle, numbers in the range."""
    m = R.market_orders(spark, sf).withColumn("total_amount", F.round("total_amount", 0)).withColumn("shipping_id", F.col("shipping_id").cast("bigint"))
    out = QL.find_value_in_row(m, "id", needle="1999-12-31", lo=50_000.0, hi=50_100.0)
    number = F.col("column_name").isin("total_amount", "shipping_id")
    return out.withColumn("value", F.when(number, F.col("value").cast("double").cast("bigint").cast("string")).otherwise(F.col("value")))


# --- flagship ------------------------------------------------------------------------

@query("margin_by_month")
def q_margin_by_month(spark, sf):
    """Revenue and margin by commercial month and channel over the unified
    fact; lines without a known cost are counted, not zero-filled."""
    f = q_fact_sales(spark, sf)
    return f.groupBy("commercial_month", "channel").agg(
        F.count(F.lit(1)).alias("lines"), F.round(exact_sum("line_total"), 2).alias("revenue"),
        F.round(exact_sum("margin"), 2).alias("margin"),
        F.count_if(F.col("margin").isNull()).alias("lines_without_cost"))
