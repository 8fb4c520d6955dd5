"""Oracle SQL for the sales fact, costs and package allocation."""

from __future__ import annotations

from marginflow.functions import scalars as S
from marginflow.oracle import sqlfrag as Q
from marginflow.oracle.roles_sql import with_roles

LD, CM, SR = Q.local_date_sql, Q.commercial_month_sql, Q.sround
FLOOR = "DATE '1990-01-01'"
TEXT_FLOOR = "'1989-12-31'"
TAX = "coalesce(a.iva_pct, 21.0)"

CTE: dict[str, str] = {}
CTE["offers_last"] = """SELECT sku, mes_comercial, arg_max(oferta_pct, _seq) AS oferta_pct
FROM offer_sheet GROUP BY sku, mes_comercial"""
CTE["cost_history"] = """SELECT c.sku, c.mes_comercial, c.costo_teorico, coalesce(o.oferta_pct, 0.0) AS oferta_pct,
       c.costo_teorico * (1.0 - coalesce(o.oferta_pct, 0.0) / 100.0) AS costo_real
FROM cost_sheet c LEFT JOIN offers_last o ON c.sku = o.sku AND c.mes_comercial = o.mes_comercial"""
CTE["arts"] = "SELECT trim(id) AS sku, iva_pct, proveedor, marca, litros, descripcion FROM erp_articles"

_DISC = ("descuento", "descuento_global", "descuento_financiero")
CTE["ws_lines"] = f"""SELECT *, {CM('d')} AS cm FROM (
  SELECT *, {LD('fecha')} AS d, {Q.nz('precio_lista')} * {Q.discount_factor(*_DISC)} AS price
  FROM erp_sales WHERE empresa IN ('0001', '0002', '0003', '0004') AND fecha >= {TEXT_FLOOR})
WHERE d >= {FLOOR}"""
CTE["fact_wholesale"] = f"""SELECT 'wholesale' AS channel, {Q.business_unit('empresa', 'sucursal')} AS unit,
  {Q.fiscal_flag('empresa')} AS fiscal, 'Company ' || empresa AS company,
  pedido_id AS order_id, d AS date, cm AS commercial_month, articulo_id AS sku, a.descripcion AS product,
  {Q.nz('cantidad')} AS quantity, price AS unit_price, price AS net_price, {TAX} AS tax_pct,
  ch.costo_real AS unit_cost, 0.0::DOUBLE AS commission, NULL::DOUBLE AS freight,
  {Q.nz('cantidad')} * {Q.tax_gross('price', TAX)} AS line_total,
  (price - ch.costo_real) * {Q.nz('cantidad')} AS margin, a.proveedor AS supplier, a.marca AS brand,
  cliente_nombre AS customer, 'Seller ' || vendedor AS seller,
  {Q.document_number('comprobante_tipo', 'comprobante_codigo', 'comprobante_numero')} AS document,
  {SR('1.0 - ' + Q.discount_factor(*_DISC) + ') * (100.0')} AS offer_pct, linea_id AS line_id
FROM ws_lines LEFT JOIN cost_history ch ON ch.sku = articulo_id AND ch.mes_comercial = cm
LEFT JOIN arts a ON a.sku = trim(articulo_id)"""

CTE["web_valid"] = f"""SELECT *, {Q.nz(Q.try_double('precio'))} AS _price, {Q.nz('cantidad')} AS _qty,
  {Q.nz(Q.try_double('envio_costo_tienda'))} AS _sf
FROM web_order_items WHERE estado_pago = 'paid' AND estado <> 'cancelled' AND fecha >= {TEXT_FLOOR}"""
CTE["web_tot"] = f"SELECT pedido_id, {Q.xsum('_price * _qty')} AS _tot FROM web_valid GROUP BY pedido_id"
CTE["web_lines"] = f"""SELECT *, {CM('d')} AS cm FROM (
  SELECT v.*, {Q.share('(_sf / 1.21)', '(_price * _qty)', 't._tot')} AS _freight, {LD('fecha')} AS d
  FROM web_valid v LEFT JOIN web_tot t ON v.pedido_id = t.pedido_id) WHERE d >= {FLOOR}"""
CTE["fact_webstore"] = f"""SELECT 'webstore' AS channel, 'A' AS unit, 'Fiscal' AS fiscal,
  NULL::VARCHAR AS company, pedido_numero AS order_id, d AS date, cm AS commercial_month, web_lines.sku,
  a.descripcion AS product, _qty AS quantity, _price AS unit_price, {Q.tax_net('_price', TAX)} AS net_price,
  {TAX} AS tax_pct, ch.costo_real AS unit_cost, 0.0::DOUBLE AS commission, {SR('_freight')} AS freight,
  _qty * _price AS line_total, ({Q.tax_net('_price', TAX)} - ch.costo_real) * _qty - _freight AS margin,
  a.proveedor AS supplier, a.marca AS brand, cliente_nombre AS customer, NULL::VARCHAR AS seller,
  NULL::VARCHAR AS document, NULL::DOUBLE AS offer_pct
FROM web_lines LEFT JOIN cost_history ch ON ch.sku = web_lines.sku AND ch.mes_comercial = cm
LEFT JOIN arts a ON a.sku = trim(web_lines.sku)"""

CTE["pk_orders"] = """SELECT DISTINCT s.shipping_id, s.costo_envio, CAST(o.id AS VARCHAR) AS order_id,
  coalesce(o.total_amount, 0.0) AS total_amount
FROM market_shipments s JOIN market_orders o ON CAST(CAST(o.shipping_id AS BIGINT) AS VARCHAR) = s.shipping_id
WHERE o.status IN ('paid')"""
CTE["pk_tot"] = f"SELECT shipping_id, {Q.xsum('total_amount')} AS package_total FROM pk_orders GROUP BY shipping_id"
CTE["o2p"] = """SELECT order_id, arg_max(costo_envio, shipping_id) AS costo_envio,
  arg_max(package_total, shipping_id) AS package_total
FROM (SELECT p.order_id, p.shipping_id, p.costo_envio, t.package_total FROM pk_orders p
      JOIN pk_tot t ON p.shipping_id = t.shipping_id) GROUP BY order_id"""
CTE["mk_orders"] = f"""SELECT *, {CM('d')} AS cm FROM (
  SELECT *, {LD('date_created')} AS d FROM market_orders
  WHERE status IN ('paid', 'partially_refunded') AND date_created >= {TEXT_FLOOR}) WHERE d >= {FLOOR}"""
_Q, _P = Q.nz("i.quantity"), Q.nz("i.unit_price")
_FR = Q.share(f"({Q.nz('p.costo_envio')} / 1.21)", f"({_P} * {_Q})", "p.package_total")
CTE["fact_marketplace"] = f"""SELECT 'marketplace' AS channel, 'A' AS unit, 'Fiscal' AS fiscal,
  NULL::VARCHAR AS company, CAST(o.id AS VARCHAR) AS order_id, o.d AS date, o.cm AS commercial_month,
  i.seller_sku AS sku, i.title AS product, {_Q} AS quantity, {_P} AS unit_price,
  {Q.tax_net(_P, TAX)} AS net_price, {TAX} AS tax_pct, ch.costo_real AS unit_cost,
  {Q.nz('i.sale_fee')} / 1.21 AS commission, {SR(_FR)} AS freight, {_Q} * {_P} AS line_total,
  (({Q.tax_net(_P, TAX)} - ch.costo_real) - {Q.nz('i.sale_fee')} / 1.21) * {_Q} - {_FR} AS margin,
  a.proveedor AS supplier, a.marca AS brand, o.buyer_nickname AS customer, NULL::VARCHAR AS seller,
  NULL::VARCHAR AS document, NULL::DOUBLE AS offer_pct
FROM market_order_items i JOIN mk_orders o ON i.order_id = o.id
LEFT JOIN o2p p ON CAST(p.order_id AS BIGINT) = o.id
LEFT JOIN cost_history ch ON ch.sku = i.seller_sku AND ch.mes_comercial = o.cm
LEFT JOIN arts a ON a.sku = trim(i.seller_sku)"""
CTE["fact_sales"] = """SELECT * EXCLUDE (line_id) FROM fact_wholesale UNION ALL BY NAME SELECT * FROM fact_webstore
UNION ALL BY NAME SELECT * FROM fact_marketplace"""

_DEPS = {
    "offers_last": ((), ()), "cost_history": ((), ("offers_last",)), "arts": ((), ()),
    "ws_lines": ((), ()), "fact_wholesale": ((), ("ws_lines", "cost_history", "arts")),
    "web_valid": ((), ()), "web_tot": ((), ("web_valid",)), "web_lines": ((), ("web_valid", "web_tot")),
    "fact_webstore": ((), ("web_lines", "cost_history", "arts")),
    "pk_orders": ((), ()), "pk_tot": ((), ("pk_orders",)), "o2p": ((), ("pk_orders", "pk_tot")),
    "mk_orders": ((), ()),
    "fact_marketplace": ((), ("mk_orders", "o2p", "cost_history", "arts")),
    "fact_sales": ((), ("fact_wholesale", "fact_webstore", "fact_marketplace")),
}
_ROLE_NEEDS = {
    "offers_last": ("offer_sheet",), "cost_history": ("cost_sheet",), "arts": ("erp_articles",),
    "ws_lines": ("erp_sales",), "web_valid": ("web_order_items",),
    "pk_orders": ("market_shipments", "market_orders"), "mk_orders": ("market_orders",),
    "fact_marketplace": ("market_order_items",),
}


def fact_sql(body: str, *ctes: str, roles: tuple[str, ...] = (), extra: dict | None = None) -> str:
    """Build ``WITH roles, fact CTEs (with deps), extra`` + body."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in _DEPS[n][1]:
            visit(d)
        order.append(n)

    for c in ctes:
        visit(c)
    need = list(roles)
    for n in order:
        need.extend(_ROLE_NEEDS.get(n, ()))
    ex = {n: CTE[n] for n in order}
    ex.update(extra or {})
    return with_roles(body, *dict.fromkeys(need), extra=ex)


ORACLE = {
    "cost_history": fact_sql("SELECT * FROM cost_history", "cost_history"),
    "fact_wholesale": fact_sql("SELECT * EXCLUDE (line_id) FROM fact_wholesale", "fact_wholesale"),
    "fact_webstore": fact_sql("SELECT * FROM fact_webstore", "fact_webstore"),
    "fact_marketplace": fact_sql("SELECT * FROM fact_marketplace", "fact_marketplace"),
    "fact_sales": fact_sql("SELECT * FROM fact_sales", "fact_sales"),
    "package_totals": fact_sql("SELECT * FROM pk_tot", "pk_tot"),
    "package_join": fact_sql("SELECT * FROM pk_orders", "pk_orders"),
    "order_to_package": fact_sql("SELECT * FROM o2p", "o2p"),
}
