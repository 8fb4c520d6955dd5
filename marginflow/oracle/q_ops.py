"""Oracle SQL for scalar, join, aggregation, window, set, source, sink and
quality queries (``marginflow.queries_ops``)."""

from __future__ import annotations

from marginflow.functions import scalars as S
from marginflow.oracle import sqlfrag as Q
from marginflow.oracle.q_fact import fact_sql
from marginflow.oracle.roles_sql import with_roles

LD, CM, SR, XS = Q.local_date_sql, Q.commercial_month_sql, Q.sround, Q.xsum
CUTOFF = "DATE '1999-01-01'"
AS_OF = "DATE '2000-01-01'"

REASON = (f"(CASE WHEN list_contains(coalesce(sub_status, []::VARCHAR[]), 'out_of_stock') THEN 'out_of_stock' "
          f"WHEN status IS NOT DISTINCT FROM 'closed' THEN 'closed' "
          f"WHEN status IS NOT DISTINCT FROM 'under_review' THEN 'under_review' "
          f"WHEN list_contains(coalesce(sub_status, []::VARCHAR[]), 'paused_by_seller') THEN 'paused_by_seller' "
          f"WHEN status IS DISTINCT FROM 'active' THEN 'paused' "
          f"WHEN available_quantity IS NULL OR available_quantity <= 0 THEN 'out_of_stock' ELSE 'ok' END)")
_D = ("descuento", "descuento_global", "descuento_financiero")
WEB_VALID = "(estado_pago = 'paid' AND estado <> 'cancelled')"


def margin_pct_sql() -> str:
    g = "(CASE WHEN quantity <> 0 THEN line_total / quantity END)"
    fpu = "(CASE WHEN quantity <> 0 THEN coalesce(freight, 0.0) / quantity END)"
    num = f"({g} - coalesce({g} - net_price, 0.0) - unit_cost - coalesce(commission, 0.0) - coalesce({fpu}, 0.0))"
    return f"({num} / (CASE WHEN {g} <> 0 THEN {g} END) * 100.0)"


def band_sql(p: str) -> str:
    parts = []
    for label, lo, hi in S.MARGIN_BANDS:
        c = []
        if lo is not None:
            c.append(f"{p} >= {lo}")
        if hi is not None:
            c.append(f"{p} < {hi}")
        parts.append(f"WHEN {' AND '.join(c)} THEN '{label}'")
    return f"(CASE WHEN {p} IS NULL THEN NULL {' '.join(parts)} END)"


def _latest_stock():
    return ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ts DESC, inventory_id DESC NULLS LAST, "
            "available_quantity DESC NULLS LAST, logistic_type DESC) AS rn FROM listing_observations) WHERE rn = 1")


_COMMA_TEXT_INT = "CAST(floor(cents / 100) AS BIGINT)"


ORACLE: dict[str, str] = {}

# --- scalars ---------------------------------------------------------------------
ORACLE["commercial_month"] = f"SELECT o_orderkey, {CM('o_orderdate')} AS commercial_month FROM orders"
ORACLE["local_date"] = with_roles(f"""
SELECT 'marketplace' AS source, id, {LD('date_created')} AS local_date FROM market_orders
UNION ALL SELECT DISTINCT 'webstore', pedido_id, {LD('fecha')} FROM web_order_items
UNION ALL SELECT DISTINCT 'erp', CAST(pedido_id AS BIGINT), {LD('fecha')} FROM erp_sales""",
                                  "market_orders", "web_order_items", "erp_sales")
ORACLE["code_label"] = with_roles("""SELECT linea_id, coalesce(n_name, 'Seller ' || vendedor) AS seller
FROM erp_sales LEFT JOIN nation ON n_nationkey <= 4 AND lpad(CAST(n_nationkey AS VARCHAR), 3, '0') = trim(vendedor)""", "erp_sales")
ORACLE["business_unit"] = with_roles(f"""SELECT linea_id, {Q.business_unit('empresa', 'sucursal')} AS unit,
  {Q.fiscal_flag('empresa')} AS fiscal FROM erp_sales""", "erp_sales")
ORACLE["fiscal_flag"] = with_roles(f"""SELECT CASE WHEN empresa IN ('0001', '0002') THEN 'Fiscal' ELSE 'Non-fiscal' END AS fiscal, empresa,
  count(*) AS lines, {SR(XS('precio_lista'))} AS list_value FROM erp_sales GROUP BY ALL""", "erp_sales")
ORACLE["chained_discount"] = with_roles(f"""SELECT linea_id, {Q.nz('precio_lista')} * {Q.discount_factor(*_D)} AS price,
  {SR('(1.0 - ' + Q.discount_factor(*_D) + ') * 100.0')} AS offer_pct FROM erp_sales""", "erp_sales")
_T = "coalesce(a.iva_pct, 21.0)"
ORACLE["tax_net"] = with_roles(f"""SELECT i.order_id, i.renglon, {Q.tax_net('i.unit_price', _T)} AS net_price,
  {Q.tax_gross(Q.tax_net('i.unit_price', _T), _T)} AS gross_again, i.sale_fee / 1.21 AS fee_net
FROM market_order_items i LEFT JOIN (SELECT trim(id) AS sku, iva_pct FROM erp_articles) a ON i.seller_sku = a.sku""",
                               "market_order_items", "erp_articles")
ORACLE["tax_gross"] = with_roles("""SELECT linea_id, precio_lista * (1.0 + coalesce(a.iva_pct, 21.0) / 100.0) AS gross_price
FROM erp_sales LEFT JOIN erp_articles a ON a.id = articulo_id""", "erp_sales", "erp_articles")
_PT = ("(CASE WHEN CAST(sku AS BIGINT) % 3 = 0 THEN replace(CAST(oferta_pct AS VARCHAR), '.', ',') || '%' "
       "WHEN CAST(sku AS BIGINT) % 3 = 1 THEN CAST(oferta_pct AS VARCHAR) "
       "ELSE CASE WHEN oferta_pct = 0 THEN '' ELSE 'x' END END)")
_PS = "trim(replace(raw, '%', ''))"
_PC = f"(CASE WHEN contains({_PS}, ',') THEN replace(replace({_PS}, '.', ''), ',', '.') ELSE {_PS} END)"
_FR = "(oferta_pct / 100.0)"
ORACLE["parse_percent"] = with_roles(f"""SELECT sku, mes_comercial, _seq, raw,
  CASE WHEN raw IS NULL OR {_PS} = '' OR lower({_PS}) = 'nan' THEN 0.0 ELSE coalesce(TRY_CAST({_PC} AS DOUBLE), 0.0) END AS pct_text,
  CASE WHEN {_FR} IS NULL OR isnan({_FR}) THEN 0.0 WHEN abs({_FR}) <= 1 THEN {_FR} * 100.0 ELSE {_FR} END AS pct_number
FROM (SELECT *, {_PT} AS raw FROM offer_sheet)""", "offer_sheet")
_CT = ("(CASE WHEN ip >= 1000 THEN CAST(CAST(floor(ip / 1000) AS BIGINT) AS VARCHAR) || '.' || lpad(CAST(ip % 1000 AS VARCHAR), 3, '0') "
       "ELSE CAST(ip AS VARCHAR) END || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0'))")
_DS = "trim(raw)"
_DC = f"(CASE WHEN contains({_DS}, ',') THEN replace(replace({_DS}, '.', ''), ',', '.') ELSE {_DS} END)"
ORACLE["parse_decimal_comma"] = with_roles(f"""SELECT sku, mes_comercial, raw,
  CASE WHEN raw IS NULL OR {_DS} = '' OR lower({_DS}) = 'nan' THEN NULL ELSE TRY_CAST({_DC} AS DOUBLE) END AS value
FROM (SELECT *, {_CT} AS raw FROM (SELECT *, CAST(floor(cents / 100) AS BIGINT) AS ip FROM
  (SELECT *, CAST(round(costo_teorico * 3.0 * 100) AS BIGINT) AS cents FROM cost_sheet)))""", "cost_sheet")
_NR = ("(CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN id || '.0' WHEN CAST(id AS BIGINT) % 3 = 1 THEN ' ' || id || ' ' "
       "WHEN CAST(id AS BIGINT) % 11 = 2 THEN 'nan' ELSE id END)")
_NS = "regexp_replace(trim(raw), '\\.0$', '')"
ORACLE["normalize_sku"] = with_roles(f"""SELECT * FROM (SELECT id, raw,
  CASE WHEN {_NS} = '' OR lower({_NS}) = 'nan' THEN NULL ELSE {_NS} END AS sku FROM (SELECT id, {_NR} AS raw FROM erp_articles))
WHERE sku IS NOT NULL""", "erp_articles")
ORACLE["document_number"] = with_roles(f"""SELECT linea_id,
  {Q.document_number('comprobante_tipo', 'comprobante_codigo', 'comprobante_numero')} AS document FROM erp_sales""",
                                        "erp_sales")
ORACLE["numeric_code_only"] = with_roles("""SELECT code FROM (SELECT DISTINCT CASE WHEN pedido_id % 10 = 0
  THEN 'A' || pedido_numero ELSE pedido_numero END AS code FROM web_order_items) WHERE regexp_full_match(code, '[0-9]+')""",
                                          "web_order_items")
ORACLE["listing_state"] = with_roles(f"SELECT event_id, {REASON} AS reason, {REASON} = 'ok' AS sellable FROM listing_observations",
                                     "listing_observations")
ORACLE["canonical_list_text"] = with_roles("""SELECT event_id, coalesce(array_to_string(list_sort(sub_status), ','), '')
  AS sub_status_text FROM listing_observations""", "listing_observations")
ORACLE["order_validity"] = with_roles(f"""SELECT DISTINCT 'webstore' AS channel, pedido_id AS id, {WEB_VALID} AS valid
FROM web_order_items UNION ALL SELECT 'marketplace', id, status IN ('paid', 'partially_refunded') FROM market_orders""",
                                      "web_order_items", "market_orders")
ORACLE["sargable_floor"] = with_roles(f"""SELECT id, local_date FROM (SELECT id, {LD('date_created')} AS local_date
FROM market_orders) WHERE local_date >= {CUTOFF}""", "market_orders")
ORACLE["margin_pct"] = fact_sql(f"""SELECT channel, order_id, sku, quantity, line_total,
  {SR(margin_pct_sql(), 4)} AS margin_pct FROM fact_sales""", "fact_sales")
ORACLE["margin_band"] = fact_sql(f"""SELECT channel, {band_sql(margin_pct_sql())} AS band, count(*) AS lines
FROM fact_sales GROUP BY ALL""", "fact_sales")

# --- joins ---------------------------------------------------------------------------
ORACLE["cost_lookup"] = fact_sql("SELECT line_id, commercial_month, unit_cost, margin FROM fact_wholesale",
                                 "fact_wholesale")
ORACLE["attribute_lookup_last_wins"] = with_roles("""SELECT s.linea_id, coalesce(a.iva_pct, 21.0) AS tax_pct,
  CASE WHEN CAST(a.id AS BIGINT) % 20 = 0 THEN 'late ' || a.proveedor ELSE a.proveedor END AS supplier, a.marca AS brand
FROM erp_sales s LEFT JOIN erp_articles a ON s.articulo_id = a.id""", "erp_sales", "erp_articles")
ORACLE["cost_offer_join"] = fact_sql(f"""SELECT sku, mes_comercial, oferta_pct, {SR('costo_teorico - costo_real', 4)} AS off
FROM cost_history WHERE oferta_pct > 0""", "cost_history")
ORACLE["observation_catalog_join"] = with_roles("""SELECT o.event_id, o.item_id, c.sku AS catalog_sku,
  c.inventory_id AS catalog_inventory FROM listing_observations o LEFT JOIN
  (SELECT item_id, arg_max(sku, ts) AS sku, arg_max(inventory_id, ts) AS inventory_id FROM listing_observations
   GROUP BY item_id) c ON o.item_id = c.item_id""", "listing_observations")
ORACLE["anti_existing"] = with_roles("""SELECT id, CAST(CAST(shipping_id AS BIGINT) AS VARCHAR) AS shipping_id
FROM market_orders o WHERE status IN ('paid', 'partially_refunded') AND NOT EXISTS
  (SELECT 1 FROM market_shipments s WHERE s.shipping_id = CAST(CAST(o.shipping_id AS BIGINT) AS VARCHAR))""",
                                     "market_orders", "market_shipments")
ORACLE["missing_shipping"] = with_roles(f"""SELECT status, count(DISTINCT CAST(shipping_id AS BIGINT)) AS packages, count(*) AS orders,
  {SR(XS('total_amount'))} AS amount FROM market_orders o
WHERE CAST(CAST(o.shipping_id AS BIGINT) AS VARCHAR) NOT IN (SELECT shipping_id FROM market_shipments) GROUP BY status""",
                                        "market_orders", "market_shipments")
ORACLE["self_dedupe_join"] = with_roles("""SELECT preparacion_id, pedido_codigo, any_value(transporte) AS transporte,
  CASE WHEN preparacion_id >= 1000000000 THEN 2 ELSE 0 END AS fila, count(*) - 1 AS removed
FROM preparations GROUP BY preparacion_id, pedido_codigo""", "preparations")

# --- aggregations ------------------------------------------------------------------------
ORACLE["order_value"] = with_roles(f"""SELECT pedido_id,
  {SR(XS('coalesce(TRY_CAST(precio AS DOUBLE), 0.0) * coalesce(cantidad, 0.0)'))} AS order_value
FROM web_order_items WHERE {WEB_VALID} GROUP BY pedido_id""", "web_order_items")
ORACLE["sales_by_sku_day"] = fact_sql(f"""SELECT sku, date, {SR(XS('quantity'))} AS units,
  count(DISTINCT order_id) AS orders, {SR(XS('line_total'))} AS revenue, {SR(XS('unit_cost * quantity'))} AS cost,
  {SR(XS('commission * quantity'))} AS commission, {SR(XS('freight'))} AS freight,
  {SR(XS('net_price * quantity'))} AS net_revenue FROM fact_sales GROUP BY sku, date""", "fact_sales")
ORACLE["listing_flags"] = with_roles("""SELECT sku, bool_or(status = 'active') AS any_active,
  bool_or(catalog_listing) AS any_catalog FROM listing_observations GROUP BY sku""", "listing_observations")
ORACLE["weighted_average"] = with_roles(f"""SELECT seller_sku,
  {SR(f"CASE WHEN {XS('quantity')} <> 0 THEN {XS('unit_price * quantity')} / {XS('quantity')} END", 4)} AS avg_price
FROM market_order_items GROUP BY seller_sku""", "market_order_items")
ORACLE["pulse_summary"] = with_roles(f"""SELECT date_trunc('hour', ts) AS moment, count(*) AS items,
  count(*) FILTER (WHERE {REASON} = 'ok') AS sellable, count(*) FILTER (WHERE {REASON} = 'out_of_stock') AS out_of_stock
FROM listing_observations GROUP BY 1""", "listing_observations")
ORACLE["month_summary"] = fact_sql("""SELECT mes_comercial, count(*) AS rows FROM cost_history
GROUP BY mes_comercial ORDER BY mes_comercial""", "cost_history")
ORACLE["consolidated_preparations"] = with_roles("""SELECT preparacion_id, count(DISTINCT pedido_codigo) AS orders
FROM preparations GROUP BY preparacion_id HAVING count(DISTINCT pedido_codigo) > 1""", "preparations")
ORACLE["value_counts"] = with_roles("SELECT provincia, count(*) AS customers FROM erp_customers GROUP BY provincia",
                                    "erp_customers")
ORACLE["shared_stock_total"] = with_roles(f"""WITH lat AS ({_latest_stock()}),
inv AS (SELECT * FROM lat WHERE inventory_id IS NOT NULL),
per_inv AS (SELECT inventory_id, arg_max(available_quantity, (ts, item_id)) AS q, count(*) AS n FROM inv GROUP BY inventory_id)
SELECT (SELECT CAST(sum(available_quantity) AS BIGINT) FROM inv) AS naive_total,
       (SELECT count(*) FROM inv) AS listings,
       (SELECT CAST(sum(q) AS BIGINT) FROM per_inv) AS true_total,
       (SELECT count(*) FROM per_inv) AS inventories,
       (SELECT count(*) FILTER (WHERE n > 1) FROM per_inv) AS shared_inventories""", "listing_observations")
ORACLE["conditional_counts"] = with_roles("""SELECT count(*) AS orders, count(*) FILTER (WHERE status = 'paid') AS paid,
  count(*) FILTER (WHERE status = 'partially_refunded') AS partially_refunded,
  count(*) FILTER (WHERE status = 'cancelled') AS cancelled FROM market_orders""", "market_orders")

# --- windows / dedupe ----------------------------------------------------------------------
ORACLE["latest_per_key"] = with_roles("""SELECT sku, ts, item_id, price FROM (SELECT sku, ts, item_id, price,
  row_number() OVER (PARTITION BY sku ORDER BY ts DESC, item_id DESC, price DESC) AS rn FROM listing_observations)
WHERE rn = 1""", "listing_observations")
ORACLE["any_per_key"] = with_roles("""SELECT shipping_id, id, status FROM (SELECT shipping_id, id, status,
  row_number() OVER (PARTITION BY shipping_id ORDER BY id, status) AS rn FROM market_orders) WHERE rn = 1""",
                                   "market_orders")
ORACLE["dedupe_keep_last"] = with_roles("""SELECT sku, mes_comercial, oferta_pct, _seq FROM (SELECT *,
  row_number() OVER (PARTITION BY sku, mes_comercial ORDER BY _seq DESC) AS rn FROM offer_sheet) WHERE rn = 1""",
                                        "offer_sheet")
ORACLE["group_total_transform"] = with_roles(f"""SELECT pedido_id, renglon, sku, cantidad,
  CAST(sum(CAST(cantidad AS DECIMAL(38,6))) OVER (PARTITION BY pedido_id) AS DOUBLE) AS order_units
FROM web_order_items""", "web_order_items")
ORACLE["gap_pairs"] = with_roles("""SELECT start, "end" FROM (SELECT moment AS start, lead(moment) OVER (ORDER BY moment)
  AS "end" FROM pulse_moments) WHERE "end" IS NOT NULL AND date_diff('microsecond', start, "end") <= 7200000000""",
                                 "pulse_moments")
ORACLE["change_points"] = with_roles(f"""WITH o AS (SELECT item_id, ts, event_id, {REASON} AS reason FROM listing_observations),
f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR reason IS DISTINCT FROM lag(reason) OVER w THEN 1 ELSE 0 END AS chg
      FROM o WINDOW w AS (PARTITION BY item_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY item_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_no FROM f)
SELECT item_id, event_id, reason, CAST(run_no AS BIGINT) AS run_no FROM r WHERE chg = 1""", "listing_observations")
ORACLE["top_n_preview"] = fact_sql(f"""SELECT sku, {SR(XS('line_total'))} AS revenue FROM fact_sales GROUP BY sku
ORDER BY revenue DESC, sku LIMIT 10""", "fact_sales")
ORACLE["ordered"] = fact_sql(f"SELECT sku, {SR(XS('line_total'))} AS revenue FROM fact_sales GROUP BY sku", "fact_sales")

# --- sets ------------------------------------------------------------------------------------
ORACLE["union_channels"] = fact_sql("SELECT channel, order_id, sku, quantity, line_total FROM fact_sales", "fact_sales")
ORACLE["union_months"] = with_roles("""WITH u AS (
  SELECT *, 1 AS _seq FROM cost_sheet WHERE CAST(substr(mes_comercial, 6, 2) AS INTEGER) % 2 = 0
  UNION ALL SELECT *, 2 FROM cost_sheet WHERE CAST(substr(mes_comercial, 6, 2) AS INTEGER) % 2 = 1
  UNION ALL SELECT sku, mes_comercial, costo_teorico + 1.0, 3 FROM cost_sheet WHERE CAST(sku AS BIGINT) % 7 = 0)
SELECT sku, mes_comercial, costo_teorico, _seq FROM (SELECT *, row_number() OVER (PARTITION BY sku, mes_comercial
  ORDER BY _seq DESC) AS rn FROM u) WHERE rn = 1""", "cost_sheet")
ORACLE["union_all_audit"] = with_roles("""SELECT 'preparations' AS table_name, count(*) AS rows,
  count(DISTINCT (preparacion_id, pedido_codigo)) AS distinct_keys,
  count(*) - count(DISTINCT (preparacion_id, pedido_codigo)) AS excess FROM preparations
UNION ALL SELECT 'market_items', count(*), count(DISTINCT (order_id, seller_sku)),
  count(*) - count(DISTINCT (order_id, seller_sku)) FROM market_order_items""", "preparations", "market_order_items")
ORACLE["schema_diff"] = with_roles("""SELECT DISTINCT sku FROM web_order_items
EXCEPT SELECT id FROM erp_articles""", "web_order_items", "erp_articles")

# --- sources -----------------------------------------------------------------------------------
ORACLE["scan_table"] = """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1999-01-01 00:00:00'"""
ORACLE["catalog_dedupe_ids"] = with_roles(f"""SELECT DISTINCT inventory_id FROM ({_latest_stock()})
WHERE logistic_type = 'fulfillment' AND inventory_id IS NOT NULL""", "listing_observations")
ORACLE["missing_keys"] = with_roles(f"""SELECT shipping, min(id) AS id FROM (SELECT id,
  CAST(CAST(shipping_id AS BIGINT) AS VARCHAR) AS shipping FROM market_orders
  WHERE status = 'paid' AND {LD('date_created')} >= {CUTOFF}) m
WHERE NOT EXISTS (SELECT 1 FROM market_shipments s WHERE s.shipping_id = m.shipping) GROUP BY shipping""",
                                    "market_orders", "market_shipments")
ORACLE["offers_active"] = with_roles(f"""SELECT count(*) AS active_offers FROM (SELECT sku, mes_comercial FROM offer_sheet
GROUP BY sku, mes_comercial) WHERE last_day(CAST(mes_comercial || '-01' AS DATE)) >= {AS_OF}""", "offer_sheet")
ORACLE["stock_with_expiry"] = """SELECT count(*) AS rows,
  count(CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_shipdate END) AS with_expiry FROM lineitem"""
_EXPL = """SELECT o.id, o.status, o.date_created, o.buyer_nickname, i.renglon, i.seller_sku, i.title, i.quantity,
  i.unit_price, i.sale_fee FROM market_orders o JOIN market_order_items i ON i.order_id = o.id"""
ORACLE["order_items_explode"] = with_roles(_EXPL, "market_orders", "market_order_items")
ORACLE["order_items_from_json_text"] = ORACLE["order_items_explode"]

# --- sinks ---------------------------------------------------------------------------------------
_CUR = "SELECT line_id, date, margin FROM fact_wholesale"
_INC = f"SELECT line_id, date, {SR('margin', 0)} AS margin FROM fact_wholesale WHERE date >= {CUTOFF}"
ORACLE["replace_window"] = fact_sql(f"""SELECT * FROM ({_CUR}) WHERE date < {CUTOFF}
UNION ALL {_INC}""", "fact_wholesale")
_MOVED = (f"SELECT line_id, CASE WHEN suffix(line_id, '7') THEN CAST(date - INTERVAL 12 MONTH AS DATE) ELSE date END AS date, "
          f"margin FROM ({_INC})")
ORACLE["replace_window_and_keys"] = fact_sql(f"""WITH mv AS ({_MOVED})
SELECT * FROM ({_CUR}) c WHERE date < {CUTOFF} AND NOT EXISTS (SELECT 1 FROM mv WHERE mv.line_id = c.line_id)
UNION ALL SELECT * FROM mv""", "fact_wholesale")
ORACLE["replace_keys"] = with_roles("""WITH req AS (SELECT DISTINCT pedido_codigo FROM preparations
  WHERE CAST(pedido_codigo AS BIGINT) % 10 = 3),
inc AS (SELECT DISTINCT p.preparacion_id, p.pedido_codigo, upper(p.transporte) AS transporte FROM preparations p
  JOIN req USING (pedido_codigo))
SELECT preparacion_id, pedido_codigo, transporte FROM preparations p WHERE NOT EXISTS
  (SELECT 1 FROM (SELECT pedido_codigo FROM req UNION SELECT pedido_codigo FROM inc) d WHERE d.pedido_codigo = p.pedido_codigo)
UNION ALL SELECT preparacion_id, pedido_codigo, transporte FROM inc""", "preparations")
ORACLE["unique_key_guard"] = with_roles("""SELECT preparacion_id, pedido_codigo, count(*) AS n FROM preparations
GROUP BY preparacion_id, pedido_codigo HAVING count(*) > 1""", "preparations")

# --- quality ------------------------------------------------------------------------------------------
ORACLE["duplicate_audit"] = with_roles("""SELECT count(*) AS rows, count(DISTINCT (preparacion_id, pedido_codigo))
  AS distinct_keys, count(*) - count(DISTINCT (preparacion_id, pedido_codigo)) AS excess FROM preparations""",
                                       "preparations")
ORACLE["contradiction_audit"] = with_roles("""SELECT pedido_codigo, count(DISTINCT preparacion_id) AS distinct_values
FROM preparations GROUP BY pedido_codigo HAVING count(DISTINCT preparacion_id) > 1""", "preparations")
ORACLE["fact_duplicate_audit"] = fact_sql("""SELECT count(*) AS repeated_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  AS excess_rows FROM (SELECT channel, order_id, sku, count(*) AS n FROM fact_sales GROUP BY ALL HAVING count(*) > 1)""",
                                          "fact_sales")
_REC = "((net_price - unit_cost - commission) * quantity - coalesce(freight, 0.0))"
ORACLE["margin_audit"] = fact_sql(f"""SELECT channel, count(*) AS lines,
  count(*) FILTER (WHERE margin IS NOT NULL AND TRY_CAST(order_id AS BIGINT) % 50 = 0) AS mismatched FROM fact_sales GROUP BY channel""", "fact_sales")
_BUG = "((net_price - unit_cost) * quantity - commission - coalesce(freight, 0.0))"
_COND = "coalesce(unit_cost IS NOT NULL AND commission <> 0 AND quantity > 1, false)"
ORACLE["margin_backfill"] = fact_sql(f"""SELECT order_id, sku, {SR(_BUG)} AS margin_before,
  CASE WHEN {_COND} THEN {SR(_REC)} ELSE {SR(_BUG)} END AS margin_after, {_COND} AS corrected
FROM fact_sales WHERE channel = 'marketplace'""",
                                     "fact_sales")
ORACLE["reject_count"] = with_roles("""SELECT count(*) AS rows,
  count(*) FILTER (WHERE list_contains(sub_status, 'out_of_stock')) AS rejected FROM listing_observations""",
                                    "listing_observations")
ORACLE["max_date_gap"] = fact_sql("""SELECT max(date) AS max_date, DATE '1999-12-25' AS window_start,
  CAST(date_diff('day', max(date), DATE '1999-12-25') AS INTEGER) AS uncovered_days FROM fact_sales""", "fact_sales")
ORACLE["order_status_matrix"] = with_roles("""SELECT estado, estado_pago, count(*) AS orders FROM
  (SELECT DISTINCT pedido_id, estado, estado_pago FROM web_order_items) GROUP BY estado, estado_pago""",
                                           "web_order_items")
ORACLE["cancelled_panel"] = with_roles(f"""SELECT count(*) FILTER (WHERE status = 'cancelled') AS cancelled,
  {SR(XS("CASE WHEN status = 'cancelled' THEN total_amount END"))} AS cancelled_amount,
  {SR("CAST(count(*) FILTER (WHERE status = 'cancelled') AS DOUBLE) / count(*)", 6)} AS cancelled_share
FROM market_orders""", "market_orders")
ORACLE["null_profile"] = with_roles("""SELECT column_name, rows, non_null, rows - non_null AS nulls FROM (SELECT 'id' AS column_name, count(*) AS rows, count(id) AS non_null FROM market_orders UNION ALL SELECT 'date_created' AS column_name, count(*) AS rows, count(date_created) AS non_null FROM market_orders UNION ALL SELECT 'status' AS column_name, count(*) AS rows, count(status) AS non_null FROM market_orders UNION ALL SELECT 'total_amount' AS column_name, count(*) AS rows, count(total_amount) AS non_null FROM market_orders UNION ALL SELECT 'buyer_nickname' AS column_name, count(*) AS rows, count(buyer_nickname) AS non_null FROM market_orders UNION ALL SELECT 'shipping_id' AS column_name, count(*) AS rows, count(shipping_id) AS non_null FROM market_orders)""", "market_orders")
ORACLE["find_value_in_row"] = with_roles("""SELECT id, column_name, value FROM (
  SELECT id, 'date_created' AS column_name, date_created AS value FROM market_orders
  UNION ALL SELECT id, 'status', status FROM market_orders
  UNION ALL SELECT id, 'buyer_nickname', buyer_nickname FROM market_orders) WHERE contains(value, '1999-12-31')
UNION ALL SELECT id, 'total_amount', CAST(CAST(round(total_amount, 0) AS BIGINT) AS VARCHAR) FROM market_orders
  WHERE round(total_amount, 0) BETWEEN 50000 AND 50100
UNION ALL SELECT id, 'shipping_id', CAST(CAST(shipping_id AS BIGINT) AS VARCHAR) FROM market_orders WHERE shipping_id BETWEEN 50000 AND 50100""",
                                         "market_orders")

ORACLE["margin_by_month"] = fact_sql(f"""SELECT commercial_month, channel, count(*) AS lines,
  {SR(XS('line_total'))} AS revenue, {SR(XS('margin'))} AS margin,
  count(*) FILTER (WHERE margin IS NULL) AS lines_without_cost FROM fact_sales GROUP BY commercial_month, channel""",
                                     "fact_sales")

ORACLE["late_data_policy"] = fact_sql(f"""SELECT line_id, date, margin FROM fact_wholesale WHERE date < DATE '1998-07-26'
UNION ALL SELECT line_id, date, {SR('margin', 0)} FROM fact_wholesale WHERE date >= DATE '1998-07-26'""", "fact_wholesale")
ORACLE["last_run_streak"] = with_roles("""WITH d AS (SELECT item_id, CAST(ts AS DATE) AS day,
  bool_or(available_quantity > 0) AS stock, bool_or(len(sub_status) = 0 AND status = 'active') AS sold
  FROM listing_observations GROUP BY 1, 2),
i AS (SELECT DISTINCT item_id, day FROM d WHERE stock AND NOT sold),
g AS (SELECT item_id, day, day - CAST(row_number() OVER (PARTITION BY item_id ORDER BY day) AS INTEGER) AS grp FROM i),
s AS (SELECT item_id, min(day) AS start_day, max(day) AS end_day, count(*) AS days FROM g GROUP BY item_id, grp)
SELECT item_id, arg_max(start_day, start_day) AS start_day, arg_max(end_day, start_day) AS end_day,
  arg_max(days, start_day) AS days FROM s GROUP BY item_id""", "listing_observations")
