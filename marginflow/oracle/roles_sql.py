"""DuckDB SQL mirror of ``marginflow.sources.roles``.

The oracle only sees the pre-registered driver tables, so every role is a
CTE.  ``with_roles(body, *names)`` prepends the CTEs a query needs (with
their dependencies, in order).
"""

from __future__ import annotations

TZ = "America/Argentina/Buenos_Aires"


def local_date_sql(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    return (f"(CASE WHEN regexp_full_match({s}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST({s} AS DATE) "
            f"WHEN regexp_matches({s}, '(Z|[+-]\\d{{2}}:?\\d{{2}})$') "
            f"THEN CAST(timezone('{TZ}', TRY_CAST({s} AS TIMESTAMPTZ)) AS DATE) "
            f"ELSE CAST(TRY_CAST({s} AS TIMESTAMP) AS DATE) END)")


def commercial_month_sql(d: str) -> str:
    return (f"strftime(CAST({d} AS DATE) - to_months(CASE WHEN day(CAST({d} AS DATE)) >= 6 THEN 0 ELSE 1 END), "
            f"'%Y-%m')")


def shifted_text_sql(suffix: str) -> str:
    return (f"(strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') "
            f"|| '{suffix}')")


def sround(x: str, n: int = 2) -> str:
    """Spark's ``round`` on a double: HALF_UP on the shortest decimal text."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


GROSS_UNIT_PRICE = sround("l_extendedprice / l_quantity * (1.0 + l_tax)")

LINE_ID = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_quantity) AS BIGINT), "
           "CAST(round(l_extendedprice * 100) AS BIGINT))")

ROLES: dict[str, tuple[tuple[str, ...], str]] = {}


def _role(name: str, deps: tuple[str, ...], sql: str) -> None:
    ROLES[name] = (deps, sql)


_role("erp_sales", (), f"""
SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '0001' WHEN 'BUILDING' THEN '0002'
            WHEN 'FURNITURE' THEN '0003' WHEN 'HOUSEHOLD' THEN '0004' ELSE '0005' END AS empresa,
       CASE WHEN o_custkey % 3 = 0 THEN '0001' ELSE '0002' END AS sucursal,
       strftime(o_orderdate, '%Y-%m-%d') AS fecha,
       CAST(l_partkey AS VARCHAR) AS articulo_id,
       l_quantity AS cantidad,
       {sround('l_extendedprice / l_quantity')} AS precio_lista,
       l_discount * 100.0 + 0.0 AS descuento,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS descuento_global,
       CASE WHEN o_orderstatus = 'F' THEN 2.0::DOUBLE WHEN o_orderstatus = 'O' THEN NULL::DOUBLE
            ELSE 0.0::DOUBLE END AS descuento_financiero,
       CAST(o_orderkey AS VARCHAR) AS pedido_id,
       lpad(CAST(o_custkey % 7 AS VARCHAR), 3, '0') AS vendedor,
       CASE WHEN o_orderstatus = 'F' THEN 'FA' ELSE 'FB' END AS comprobante_tipo,
       CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE lpad(CAST(l_suppkey % 10 AS VARCHAR), 4, '0') END
           AS comprobante_codigo,
       CAST(o_orderkey AS VARCHAR) AS comprobante_numero,
       o_custkey AS cliente_id, c_name AS cliente_nombre, l_linenumber AS renglon, {LINE_ID} AS linea_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")

_role("erp_articles", (), """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS descripcion,
       CASE WHEN p_size % 4 = 0 THEN 10.5::DOUBLE WHEN p_size % 4 = 1 THEN NULL::DOUBLE ELSE 21.0::DOUBLE END
           AS iva_pct,
       p_type AS proveedor, p_brand AS marca,
       CASE WHEN p_size % 50 = 0 THEN NULL::DOUBLE WHEN p_size % 50 = 25 THEN 0.0::DOUBLE
            ELSE CAST(p_size AS DOUBLE) / 10.0 END AS litros
FROM part WHERE p_partkey % 97 <> 0""")

_role("erp_customers", (), """
SELECT c_custkey AS id, c_name AS nombre, c_mktsegment AS rubro, c_nationkey AS provincia FROM customer""")

_role("sold_sku_months", (), f"""
SELECT DISTINCT l_partkey AS partkey, mes_comercial FROM lineitem JOIN
  (SELECT o_orderkey, unnest([{commercial_month_sql('o_orderdate - INTERVAL 1 DAY')}, {commercial_month_sql('o_orderdate')},
                              {commercial_month_sql('o_orderdate + INTERVAL 1 DAY')}]) AS mes_comercial FROM orders) ON l_orderkey = o_orderkey""")

_role("cost_sheet", ("sold_sku_months",), f"""
SELECT CAST(p_partkey AS VARCHAR) AS sku, mes_comercial,
       {sround('p_retailprice * (0.40::DOUBLE + 0.02::DOUBLE * CAST(substr(mes_comercial, 6, 2) AS INTEGER))')} AS costo_teorico
FROM part JOIN sold_sku_months ON partkey = p_partkey
WHERE p_size > 2""")

_role("offer_sheet", ("cost_sheet",), """
SELECT sku, mes_comercial, CAST(CAST(sku AS BIGINT) % 4 AS DOUBLE) * 5.0 AS oferta_pct, 1 AS _seq
FROM cost_sheet WHERE CAST(sku AS BIGINT) % 5 = 0
UNION ALL
SELECT sku, mes_comercial, CAST(CAST(sku AS BIGINT) % 4 AS DOUBLE) * 5.0 + 2.5 AS oferta_pct, 2 AS _seq
FROM cost_sheet WHERE CAST(sku AS BIGINT) % 10 = 0""")

_role("web_order_items", (), f"""
SELECT o_orderkey AS pedido_id, CAST(o_orderkey AS VARCHAR) AS pedido_numero,
       {shifted_text_sql('+0000')} AS fecha,
       CASE WHEN o_orderstatus = 'O' THEN 'cancelled' ELSE 'open' END AS estado,
       CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'paid'
            WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN 'voided'
            WHEN o_orderstatus IN ('F', 'P') THEN 'paid' ELSE 'pending' END AS estado_pago,
       CAST(l_partkey AS VARCHAR) AS sku, l_quantity AS cantidad,
       CASE WHEN l_suppkey % 50 = 0 THEN '' ELSE CAST({GROSS_UNIT_PRICE} AS VARCHAR) END AS precio,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST({sround('o_totalprice * 0.01')} AS VARCHAR) END
           AS envio_costo_tienda,
       'Customer ' || CAST(o_custkey AS VARCHAR) AS cliente_nombre, l_linenumber AS renglon
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderpriority IN ('3-MEDIUM')""")

_role("market_orders", (), f"""
SELECT o_orderkey AS id, {shifted_text_sql('.000-04:00')} AS date_created,
       CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'P' THEN 'partially_refunded' ELSE 'cancelled' END AS status,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS total_amount,
       'buyer' || CAST(o_custkey AS VARCHAR) AS buyer_nickname,
       CAST(o_custkey * 100 + month(o_orderdate) AS DOUBLE) AS shipping_id
FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')""")

_role("market_order_items", (), f"""
SELECT l_orderkey AS order_id, l_linenumber AS renglon, CAST(l_partkey AS VARCHAR) AS seller_sku,
       'item ' || CAST(l_partkey AS VARCHAR) AS title, l_quantity AS quantity,
       {GROSS_UNIT_PRICE} AS unit_price, {sround(GROSS_UNIT_PRICE + ' * 0.12')} AS sale_fee
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')""")

_role("market_shipments", (), f"""
SELECT CAST(pk AS VARCHAR) AS shipping_id, CAST(min(o_orderkey) AS VARCHAR) AS order_id,
       {sround('max(o_totalprice) * 0.02')} AS costo_envio
FROM (SELECT CAST(CAST(o_custkey * 100 + month(o_orderdate) AS DOUBLE) AS BIGINT) AS pk, o_orderkey, o_totalprice
      FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW'))
WHERE pk % 9 <> 0
GROUP BY pk""")

_role("preparations", (), """
WITH base AS (
  SELECT CAST(floor(o_orderkey / 3) AS BIGINT) AS preparacion_id, CAST(o_orderkey AS VARCHAR) AS pedido_codigo,
         CASE o_orderkey % 5 WHEN 0 THEN 'SEBASTIAN EXPRESS' WHEN 1 THEN 'sebastian cargas' WHEN 2 THEN NULL
              WHEN 3 THEN 'SOUTH ROUTE FREIGHT' ELSE 'NORTH LINE CARGO' END AS transporte,
         o_orderkey AS _ok
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 8 <> 7)
SELECT preparacion_id, pedido_codigo, transporte FROM base
UNION ALL SELECT preparacion_id, pedido_codigo, transporte FROM base WHERE _ok % 4 = 0
UNION ALL SELECT preparacion_id + 1000000000, pedido_codigo, transporte FROM base WHERE _ok % 9 = 0""")

_role("freight_invoices", ("preparations",), """
WITH p AS (SELECT DISTINCT preparacion_id FROM preparations WHERE preparacion_id % 4 <> 3)
SELECT CAST(preparacion_id AS VARCHAR) AS clave_fila,
       100.0 + CAST(preparacion_id % 50 AS DOUBLE) * 10.0 AS neto_cobrado_transporte FROM p
UNION ALL
SELECT CAST(preparacion_id AS VARCHAR) || '-A', 60.0 + CAST(preparacion_id % 30 AS DOUBLE) * 5.0 FROM p
UNION ALL
SELECT CAST(preparacion_id AS VARCHAR) || '-B', 40.0 + CAST(preparacion_id % 20 AS DOUBLE) * 5.0 FROM p""")

_role("listing_observations", (), """
SELECT event_id, CAST(user_id AS VARCHAR) AS item_id, ts, CAST(CAST(floor(user_id / 4) AS BIGINT) AS VARCHAR) AS sku,
       CASE WHEN user_id % 3 = 0 THEN 'INV' || CAST(CAST(floor(user_id / 6) AS BIGINT) AS VARCHAR) END AS inventory_id,
       CASE event_type WHEN 'signup' THEN 'closed' WHEN 'click' THEN 'paused' ELSE 'active' END AS status,
       CASE event_type WHEN 'error' THEN ['out_of_stock'] WHEN 'click' THEN ['paused_by_seller']
            WHEN 'view' THEN ['b_tag', 'a_tag'] ELSE []::VARCHAR[] END AS sub_status,
       CASE WHEN event_type = 'purchase' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 = 0 THEN 0
            ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS available_quantity,
       value AS price, (user_id % 4 = 0) AS catalog_listing,
       CASE WHEN user_id % 2 = 0 THEN 'fulfillment' ELSE 'drop_off' END AS logistic_type
FROM events""")

_role("pulse_moments", (), """
SELECT DISTINCT date_trunc('hour', ts) AS moment FROM events
WHERE NOT (day(ts) % 5 = 0 AND hour(ts) BETWEEN 3 AND 8)""")


def with_roles(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <roles and extra CTEs> <body>``; dependencies first."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in ROLES[n][0]:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} AS ({ROLES[n][1]}\n)" for n in ordered]
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v}\n)")
    if not ctes:
        return body
    b = body.lstrip()
    if b[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + b[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
