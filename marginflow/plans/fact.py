"""The unified sales fact: one row per sales line with tax, commission,
freight share and margin, for three channels.

Each channel is one lazy DataFrame chain; the only shuffles are the joins
to orders/packages (on the order key, so items, orders and the per-order
package lookup co-partition), and the lookups by SKU (article attributes)
and (SKU, commercial month) (costs).  Catalyst/AQE pick broadcast for the
lookups whenever their measured size allows it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions import scalars as S
from marginflow.functions.time import commercial_month, local_date
from marginflow.operators.allocate import allocate_proportional, share
from marginflow.operators.aggregates import exact_sum
from marginflow.operators.dedupe import keep_one_per_key

CHANNEL_WHOLESALE = "wholesale"
CHANNEL_WEBSTORE = "webstore"
CHANNEL_MARKETPLACE = "marketplace"

# Earliest date any rebuild may touch (fixed floor of the history).
HISTORY_FLOOR = dt.date(1990, 1, 1)

FACT_COLUMNS = ["channel", "unit", "fiscal", "company", "order_id", "date", "commercial_month",
                "sku", "product", "quantity", "unit_price", "net_price", "tax_pct", "unit_cost",
                "commission", "freight", "line_total", "margin", "supplier", "brand", "customer",
                "seller", "document", "offer_pct"]


def window_start(as_of: dt.date | None = None, window_days: int | None = None,
                 floor: dt.date = HISTORY_FLOOR) -> dt.date:
    """``max(floor, as_of − window_days)``; no window → the floor (full rebuild)."""
    if as_of is None or window_days is None:
        return floor
    return max(floor, as_of - dt.timedelta(days=window_days))


# ---------------------------------------------------------------------------
# lookups
# ---------------------------------------------------------------------------

def cost_history(costs: DataFrame, offers: DataFrame) -> DataFrame:
    """Real cost per (sku, commercial month) = theoretical × (1 − offer/100).

    Both sheets are deduped per (sku, month) *before* the join with cheap
    numeric aggregates (a later sheet row wins when the sheet carries a
    ``_seq``; otherwise the highest cost, deterministically); a missing offer
    counts as 0.  The join of two key-unique sides is key-unique, so no
    dedupe of the (large) result is needed."""
    keys = ["sku", "mes_comercial"]
    pick = (F.max_by("costo_teorico", "_seq") if "_seq" in costs.columns else F.max("costo_teorico"))
    c = costs.groupBy(*keys).agg(pick.alias("costo_teorico"))
    off = offers.groupBy(*keys).agg(F.max_by("oferta_pct", "_seq").alias("oferta_pct"))
    j = c.join(off, keys, "left")
    return j.select("sku", "mes_comercial", "costo_teorico",
                    S.nz("oferta_pct").alias("oferta_pct"),
                    (F.col("costo_teorico") * (F.lit(1.0) - S.nz("oferta_pct") / 100.0)).alias("costo_real"))


def article_lookup(articles: DataFrame) -> DataFrame:
    """(sku → tax %, supplier, brand, litres, description); duplicate ids keep
    the greatest row (deterministic stand-in for 'last one wins')."""
    a = articles.select(F.trim(F.col("id")).alias("sku"), "iva_pct", "proveedor", "marca",
                        "litros", "descripcion")
    return keep_one_per_key(a, ["sku"], [])


_FACT_TYPES = {"quantity": "double", "unit_price": "double", "net_price": "double",
               "tax_pct": "double", "unit_cost": "double", "commission": "double",
               "freight": "double", "line_total": "double", "margin": "double",
               "offer_pct": "double", "date": "date"}

# Columns every channel's line builder produces before pricing.
LINE_COLUMNS = ["channel", "unit", "fiscal", "company", "order_id", "date", "commercial_month", "sku",
                "title", "quantity", "unit_price", "commission", "_freight", "_line_total", "customer",
                "seller", "document", "offer_pct", "line_id"]
_LINE_TYPES = dict(_FACT_TYPES, _freight="double", _line_total="double")


def _lines_schema(df: DataFrame) -> DataFrame:
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(_LINE_TYPES.get(c, "string")).alias(c)
                       for c in LINE_COLUMNS])


def price_lines(lines: DataFrame, costs: DataFrame, articles: DataFrame,
                extra: list[str] | None = None) -> DataFrame:
    """The single pricing step shared by all channels: one cost lookup on
    (sku, commercial month), one article lookup on sku, then

    * net price = list price for wholesale (already without tax), else
      price / (1 + tax/100);
    * line total = qty·price·(1 + tax/100) for wholesale, else qty·price;
    * margin = (net − cost − commission)·qty − freight  (null when the cost
      is unknown; commission and freight are 0 where a channel has none).
    """
    c = costs.select(F.col("sku").alias("_csku"), F.col("mes_comercial").alias("_cmes"),
                     F.col("costo_real").alias("unit_cost"))
    a = article_lookup(articles).select(F.col("sku").alias("_asku"), "iva_pct", "proveedor", "marca",
                                        "descripcion")
    j = lines.join(c, (lines.sku == c._csku) & (lines.commercial_month == c._cmes), "left")
    j = j.join(a, F.trim(j.sku) == a._asku, "left")
    tax = F.coalesce(F.col("iva_pct"), F.lit(21.0))
    wholesale = F.col("channel") == CHANNEL_WHOLESALE
    price, q = F.col("unit_price"), F.col("quantity")
    net = F.when(wholesale, price).otherwise(S.tax_net(price, tax))
    freight = S.nz("_freight")
    out = j.select(
        "*", tax.alias("tax_pct"), net.alias("net_price"),
        F.when(wholesale, q * S.tax_gross(price, tax)).otherwise(F.col("_line_total")).alias("line_total"),
        ((net - F.col("unit_cost") - F.col("commission")) * q - freight).alias("margin"),
        F.when(wholesale, F.lit(None).cast("double")).otherwise(F.round(freight, 2)).alias("freight"),
        F.col("proveedor").alias("supplier"), F.col("marca").alias("brand"),
        F.when(F.col("channel") == CHANNEL_MARKETPLACE, F.col("title")).otherwise(F.col("descripcion"))
         .alias("product"))
    return out.select(*[F.col(c).cast(_FACT_TYPES.get(c, "string")).alias(c) for c in FACT_COLUMNS],
                      *(extra or []))


# ---------------------------------------------------------------------------
# channel line builders (everything a channel knows before the lookups)
# ---------------------------------------------------------------------------

def _text_floor(start: dt.date) -> str:
    return (start - dt.timedelta(days=1)).isoformat()


def wholesale_lines(sales: DataFrame, start: dt.date = HISTORY_FLOOR) -> DataFrame:
    """ERP lines: unit/fiscal CASE, chained discounts (price already net of tax)."""
    s = sales.where(F.col("empresa").isin(*S.COMPANY_CODES))
    # sargable pre-filter on the raw text column, exact filter after parsing
    s = s.where(F.col("fecha") >= F.lit(_text_floor(start)))
    s = s.withColumn("date", local_date("fecha")).where(F.col("date") >= F.lit(start))
    d = ("descuento", "descuento_global", "descuento_financiero")
    return _lines_schema(s.select(
        F.lit(CHANNEL_WHOLESALE).alias("channel"),
        S.business_unit("empresa", "sucursal").alias("unit"),
        S.fiscal_flag("empresa").alias("fiscal"),
        S.code_text("empresa", "Company").alias("company"),
        F.col("pedido_id").alias("order_id"), "date", commercial_month("date").alias("commercial_month"),
        F.col("articulo_id").alias("sku"), S.nz("cantidad").alias("quantity"),
        S.chained_discount("precio_lista", *d).alias("unit_price"), F.lit(0.0).alias("commission"),
        F.col("cliente_nombre").alias("customer"),
        S.code_text("vendedor", "Seller").alias("seller"),
        S.document_number("comprobante_tipo", "comprobante_codigo", "comprobante_numero").alias("document"),
        S.combined_discount_pct(*d).alias("offer_pct"), F.col("linea_id").alias("line_id")))


def webstore_lines(items: DataFrame, start: dt.date = HISTORY_FLOOR) -> DataFrame:
    """Paid, not cancelled web-store lines with the order's store freight
    (net of 21 %) shared by line value; commission unknown → 0."""
    it = items.where(S.webstore_valid("estado_pago", "estado"))
    it = it.where(F.col("fecha") >= F.lit(_text_floor(start)))
    price = S.nz(F.col("precio").try_cast("double"))
    it = it.select("*", price.alias("_price"), S.nz("cantidad").alias("_qty"),
                   S.nz(F.col("envio_costo_tienda").try_cast("double")).alias("_store_freight"))
    # order value over all valid lines of the order (before the exact date filter)
    it = allocate_proportional(it, ["pedido_id"], S.fee_net("_store_freight"),
                               F.col("_price") * F.col("_qty"), out="_freight")
    it = it.withColumn("date", local_date("fecha")).where(F.col("date") >= F.lit(start))
    return _lines_schema(it.select(
        F.lit(CHANNEL_WEBSTORE).alias("channel"), F.lit(S.UNIT_A).alias("unit"),
        F.lit(S.FISCAL).alias("fiscal"), F.col("pedido_numero").alias("order_id"), "date",
        commercial_month("date").alias("commercial_month"), "sku",
        F.col("_qty").alias("quantity"), F.col("_price").alias("unit_price"),
        F.lit(0.0).alias("commission"), "_freight",
        (F.col("_qty") * F.col("_price")).alias("_line_total"),
        F.col("cliente_nombre").alias("customer")))


def package_orders(shipments: DataFrame, orders: DataFrame,
                   statuses: tuple[str, ...] = ("paid",)) -> DataFrame:
    """Shipments ⋈ orders of the listed statuses on the text shipping id;
    one row per (shipment, order) with the order total (null → 0).

    Only ``paid`` by default: partially refunded orders are sales but not in
    the package denominator (kept as found, see README D3)."""
    o = orders.where(F.col("status").isin(*statuses)).select(
        F.col("shipping_id").cast("bigint").cast("string").alias("_sid"),
        F.col("id").cast("string").alias("order_id"),
        S.nz("total_amount").alias("total_amount"))
    sh = shipments.select("shipping_id", "costo_envio")
    j = sh.join(o, sh.shipping_id == o._sid, "inner").drop("_sid")
    # a repeated pair keeps its smallest values: numbers, so a hash aggregate
    return j.groupBy("shipping_id", "order_id").agg(F.min("costo_envio").alias("costo_envio"),
                                                    F.min("total_amount").alias("total_amount"))


def package_totals(pk_orders: DataFrame) -> DataFrame:
    return pk_orders.groupBy("shipping_id").agg(exact_sum("total_amount").alias("package_total"))


def order_to_package(pk_orders: DataFrame) -> DataFrame:
    """order → (package cost, package total); an order in two packages keeps
    the package with the greatest id."""
    tot = package_totals(pk_orders)
    j = pk_orders.join(tot, "shipping_id")
    return keep_one_per_key(j.select("order_id", "shipping_id", "costo_envio", "package_total"),
                            ["order_id"], ["shipping_id"]).drop("shipping_id")


def marketplace_lines(orders: DataFrame, items: DataFrame, shipments: DataFrame,
                      start: dt.date = HISTORY_FLOOR) -> DataFrame:
    """Valid marketplace orders × their items: per-unit commission (net of
    21 %), package freight shared by line value across all orders of the
    package.  Items, orders and the per-order package lookup all join on the
    order key, so they share one hash partitioning."""
    o = orders.where(S.marketplace_valid("status"))
    o = o.where(F.col("date_created") >= F.lit(_text_floor(start)))
    o = o.withColumn("date", local_date("date_created")).where(F.col("date") >= F.lit(start))
    pk = order_to_package(package_orders(shipments, orders)).select(
        F.col("order_id").cast("bigint").alias("_pk_order"), "costo_envio", "package_total")
    o = o.join(pk, o.id == pk._pk_order, "left")
    j = items.join(o, items.order_id == o.id, "inner")
    qty, price = S.nz("quantity"), S.nz("unit_price")
    return _lines_schema(j.select(
        F.lit(CHANNEL_MARKETPLACE).alias("channel"), F.lit(S.UNIT_A).alias("unit"),
        F.lit(S.FISCAL).alias("fiscal"), F.col("id").cast("string").alias("order_id"), "date",
        commercial_month("date").alias("commercial_month"), F.col("seller_sku").alias("sku"),
        "title", qty.alias("quantity"), price.alias("unit_price"),
        S.fee_net(S.nz("sale_fee")).alias("commission"),
        share(S.fee_net(S.nz("costo_envio")), price * qty, F.col("package_total")).alias("_freight"),
        (qty * price).alias("_line_total"), F.col("buyer_nickname").alias("customer")))


# ---------------------------------------------------------------------------
# facts
# ---------------------------------------------------------------------------

def fact_wholesale(sales: DataFrame, articles: DataFrame, costs: DataFrame,
                   start: dt.date = HISTORY_FLOOR, with_line_id: bool = False) -> DataFrame:
    """Wholesale fact: margin ``(net − cost)·qty``."""
    return price_lines(wholesale_lines(sales, start), costs, articles, ["line_id"] if with_line_id else [])


def fact_webstore(items: DataFrame, articles: DataFrame, costs: DataFrame,
                  start: dt.date = HISTORY_FLOOR) -> DataFrame:
    """Web-store fact: margin ``(net − cost)·qty − freight``."""
    return price_lines(webstore_lines(items, start), costs, articles)


def fact_marketplace(orders: DataFrame, items: DataFrame, shipments: DataFrame,
                     articles: DataFrame, costs: DataFrame,
                     start: dt.date = HISTORY_FLOOR) -> DataFrame:
    """Marketplace fact: margin ``(net − cost − commission)·qty − freight``."""
    return price_lines(marketplace_lines(orders, items, shipments, start), costs, articles)


def union_channels(*frames: DataFrame) -> DataFrame:
    """Concatenate channel frames by column name; missing columns → null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def fact_sales(sources: dict[str, DataFrame], start: dt.date = HISTORY_FLOOR) -> DataFrame:
    """All channels: their lines are unioned first and priced once, so the
    cost and article lookups each run as a single join."""
    costs = cost_history(sources["cost_sheet"], sources["offer_sheet"])
    lines = union_channels(
        wholesale_lines(sources["erp_sales"], start),
        webstore_lines(sources["web_order_items"], start),
        marketplace_lines(sources["market_orders"], sources["market_order_items"],
                          sources["market_shipments"], start))
    return price_lines(lines, costs, sources["erp_articles"])
