"""Oracle SQL for landed documents, sheets and table writers."""

from __future__ import annotations

from marginflow.oracle.q_hist import _obs_state, scd2_sql
from marginflow.oracle.roles_sql import sround, with_roles

ORACLE: dict[str, str] = {}

ORACLE["flatten_json"] = """SELECT o_orderkey AS id, 'buyer' || o_custkey AS buyer_nickname, o_totalprice AS payment_amount,
  o_orderstatus AS payment_status_code FROM orders"""
ORACLE["nested_to_text"] = """SELECT o_orderkey AS id, '{"code":' || o_custkey || ',"status":' ||
  CASE WHEN o_orderkey % 13 <> 0 THEN '"' || o_orderstatus || '"' ELSE 'null' END || '}' AS buyer,
  '[' || o_custkey || ',' || (o_orderkey % 5) || ']' AS tags FROM orders"""
ORACLE["multiget_envelope"] = """SELECT o_orderkey AS id, o_custkey AS customer, CAST(NULL AS BIGINT) AS rejected FROM orders
WHERE o_orderkey % 10 > 1 UNION ALL SELECT NULL, NULL, count(*) FROM orders WHERE o_orderkey % 10 <= 1"""
ORACLE["wms_order_project"] = """SELECT o_orderkey AS codigo, strftime(o_orderdate, '%Y-%m-%d') AS fecha, o_orderstatus AS estado,
  o_totalprice AS importe,
  CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 THEN o_custkey END AS cliente_codigo,
  CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 THEN 'Customer ' || o_custkey END AS cliente_nombre,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey % 25 END AS provincia, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey % 100 END AS localidad,
  CASE WHEN o_orderkey % 11 <> 0 THEN 'street ' || (o_orderkey % 1000) END AS direccion, o_orderkey % 4 AS codigo_despacho,
  o_orderpriority AS servicio_envio, CAST(floor(o_orderkey / 3) AS BIGINT) AS orden_preparacion FROM orders"""
ORACLE["preparation_rollup"] = f"""WITH o AS (SELECT *, CAST(floor(o_orderkey / 3) AS BIGINT) AS id FROM orders),
h AS (SELECT id, sum(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 6 ELSE 0 END) AS bultos, bool_or(o_orderkey % 7 = 0) AS pallets, count(*) AS n
      FROM o GROUP BY id),
i AS (SELECT CAST(floor(l_orderkey / 3) AS BIGINT) AS id, sum(CAST(l_quantity * 2 AS BIGINT)) AS volumen,
             sum(CASE WHEN l_linenumber <> 3 THEN l_partkey % 1000 ELSE 0 END) AS peso FROM lineitem GROUP BY 1)
SELECT o.id AS preparacion_id, CAST(o.o_orderkey AS VARCHAR) AS pedido_codigo,
  CASE WHEN o.id % 4 IN (0, 1) THEN 'D' || (o.id % 9) ELSE 'carrier ' || (o.id % 9) END AS transporte,
  CASE WHEN o.id % 17 <> 0 THEN CAST(h.bultos AS DOUBLE) ELSE 0.0::DOUBLE END AS bultos_preparacion,
  coalesce(CAST(i.volumen AS DOUBLE), 0.0) AS volumen_preparacion, {sround('coalesce(CAST(i.peso AS DOUBLE), 0.0) / 1000.0::DOUBLE', 3)} AS kg_preparacion,
  CASE WHEN o.id % 17 <> 0 AND h.pallets THEN 'Pallets' ELSE 'Bultos' END AS tipo_preparacion,
  CAST(CASE WHEN o.id % 5 = 0 THEN 2 * h.n ELSE h.n END AS INTEGER) AS cant_pedidos_en_prep
FROM o JOIN h ON h.id = o.id LEFT JOIN i ON i.id = o.id"""
ORACLE["first_matching_cost"] = with_roles("""SELECT id, CASE WHEN id % 3 = 0 THEN 0.0::DOUBLE WHEN id % 5 = 3 THEN CAST(id % 100 AS DOUBLE)
  WHEN id % 4 = 3 THEN CAST(id % 70 AS DOUBLE) ELSE 0.0::DOUBLE END AS cost FROM market_orders""", "market_orders")
ORACLE["attribute_lookup"] = "SELECT p_partkey, CASE WHEN p_partkey % 9 > 2 THEN CAST(p_partkey AS VARCHAR) END AS sku FROM part"
ORACLE["cost_sheets_load"] = with_roles("""SELECT c.sku, c.mes_comercial,
  CAST(round(CASE WHEN CAST(c.sku AS BIGINT) % 7 = 0 THEN c.costo_teorico - 1 ELSE c.costo_teorico END, 2) AS DOUBLE) AS costo_teorico,
  coalesce(o.oferta_pct, 0.0) AS oferta_pct
FROM cost_sheet c LEFT JOIN (SELECT sku, mes_comercial, arg_max(oferta_pct, _seq) AS oferta_pct FROM offer_sheet GROUP BY ALL) o
  ON o.sku = c.sku AND o.mes_comercial = c.mes_comercial""", "cost_sheet", "offer_sheet")
ORACLE["catalog_loads"] = "SELECT c_custkey AS id, c_name AS nombre, c_nationkey AS lugar_provincia FROM customer"
ORACLE["replace_all"] = with_roles("SELECT id, nombre, rubro, provincia FROM erp_customers", "erp_customers")
ORACLE["replace_partition"] = with_roles("""SELECT sku, mes_comercial, costo_teorico FROM cost_sheet WHERE mes_comercial <> '1998-05'
UNION ALL SELECT sku, mes_comercial, costo_teorico + 1 FROM cost_sheet WHERE mes_comercial = '1998-05' AND CAST(sku AS BIGINT) % 2 = 0""", "cost_sheet")
ORACLE["daily_snapshot"] = with_roles("""WITH l AS (SELECT * FROM (SELECT item_id, available_quantity, status,
  row_number() OVER (PARTITION BY item_id ORDER BY ts DESC, event_id DESC) AS rn FROM listing_observations) WHERE rn = 1 AND status <> 'closed')
SELECT item_id, available_quantity, d AS fecha FROM l, (VALUES (DATE '2024-01-30'), (DATE '2024-01-31')) AS t(d)""", "listing_observations")
ORACLE["append_incremental"] = with_roles("SELECT shipping_id, order_id, costo_envio FROM market_shipments", "market_shipments")
ORACLE["create_table_as"] = with_roles("SELECT rubro, count(*) AS customers FROM erp_customers GROUP BY rubro", "erp_customers")
ORACLE["additive_evolution"] = with_roles("""SELECT preparacion_id, pedido_codigo, transporte, CAST(NULL AS BOOLEAN) AS urgent, CAST(NULL AS BIGINT) AS kg
FROM preparations WHERE preparacion_id % 2 = 0
UNION ALL SELECT preparacion_id, pedido_codigo, NULL, preparacion_id % 3 = 0, preparacion_id % 100 FROM preparations WHERE preparacion_id % 2 = 1""",
                                           "preparations")
ORACLE["schema_contract"] = """SELECT c AS column_name, (SELECT count(*) FROM orders) AS rows FROM (VALUES ('o_channel'), ('o_weight')) AS t(c)"""
ORACLE["scd2_apply"] = with_roles(f"""WITH h AS ({scd2_sql(['price'], ['sku'])}),
b AS (SELECT item_id, price, sku FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ts DESC, event_id DESC) AS rn FROM all_obs
  WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16') WHERE rn = 1),
j AS (SELECT h.*, b.item_id IS NOT NULL AS seen, b.price IS NOT DISTINCT FROM h.price AS same, b.sku AS new_sku FROM h LEFT JOIN b
  ON b.item_id = h.item_id AND h.hasta IS NULL)
SELECT item_id, desde, CASE WHEN seen AND NOT same THEN TIMESTAMP '2024-01-16' ELSE hasta END AS hasta,
  CASE WHEN seen THEN TIMESTAMP '2024-01-16' ELSE visto_hasta END AS visto_hasta, price, CASE WHEN seen AND same THEN new_sku ELSE sku END AS sku FROM j
UNION ALL
SELECT b.item_id, TIMESTAMP '2024-01-16', NULL, TIMESTAMP '2024-01-16', b.price, b.sku FROM b
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.item_id = b.item_id AND h.hasta IS NULL AND h.price IS NOT DISTINCT FROM b.price)""",
                                  "listing_observations",
                                  extra={"all_obs": _obs_state(), "obs": "SELECT * FROM all_obs WHERE ts < TIMESTAMP '2024-01-15'"})
ORACLE["allocate_proportional"] = with_roles(f"""WITH w AS (SELECT pedido_id, renglon, sku,
  coalesce(TRY_CAST(precio AS DOUBLE), 0.0) * cantidad AS weight, coalesce(TRY_CAST(envio_costo_tienda AS DOUBLE), 0.0) AS envio
  FROM web_order_items WHERE estado_pago = 'paid' AND estado <> 'cancelled'),
t AS (SELECT pedido_id, CAST(sum(CAST(weight AS DECIMAL(38,6))) AS DOUBLE) AS total FROM w GROUP BY pedido_id)
SELECT w.pedido_id, w.renglon, w.sku, {sround('CASE WHEN t.total > 0 THEN w.envio * (w.weight / t.total) ELSE 0.0 END', 4)} AS allocated
FROM w JOIN t ON t.pedido_id = w.pedido_id""", "web_order_items")

ORACLE["file_manifest_diff"] = """WITH s AS (SELECT DISTINCT o_orderstatus AS st FROM orders),
one AS (SELECT 'kept/o_orderstatus=F' AS name FROM s WHERE st = 'F' UNION ALL SELECT 'grown/o_orderstatus=O' FROM s WHERE st = 'O'
        UNION ALL SELECT 'moved/o_orderstatus=F' FROM s WHERE st = 'F'),
two AS (SELECT 'kept/o_orderstatus=F' AS name, 'same' AS change FROM s WHERE st = 'F' UNION ALL SELECT 'grown/o_orderstatus=O', 'changed' FROM s WHERE st = 'O'
        UNION ALL SELECT 'moved/o_orderstatus=F', 'removed' FROM s WHERE st = 'F' UNION ALL SELECT 'moved/o_orderstatus=' || st, 'added' FROM s WHERE st <> 'F')
SELECT 1 AS run, name, 'added' AS change FROM one UNION ALL SELECT 2, name, change FROM two
UNION ALL SELECT 3, name, 'added' FROM two WHERE change <> 'removed'"""
ORACLE["flatten_documents"] = """SELECT event_id,
  CASE WHEN event_type = 'purchase' THEN 'n-' || event_id WHEN event_type = 'signup' THEN CAST(user_id AS VARCHAR) END AS amount,
  CASE WHEN event_type IN ('purchase', 'signup') THEN user_id END AS buyer_code,
  CASE WHEN event_type = 'purchase' THEN 'c' || (user_id % 9) END AS buyer_place_city,
  CASE WHEN event_type = 'purchase' THEN '[' || user_id || ',"x"]' END AS buyer_tags,
  CASE WHEN event_type IN ('view', 'click', 'purchase', 'signup') THEN event_id END AS id,
  CASE WHEN event_type = 'click' THEN CAST(event_id % 7 AS DOUBLE) + 0.5 END AS pos,
  CASE WHEN event_type IN ('view', 'click') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS props_k,
  CAST(NULL AS VARCHAR) AS ref FROM events"""
ORACLE["multiget_landed"] = ORACLE["multiget_envelope"]
ORACLE["evolved_table"] = ORACLE["additive_evolution"]
ORACLE["guarded_write"] = """SELECT c_custkey AS id, c_mktsegment AS rubro, CAST(NULL AS BIGINT) AS refused FROM customer
UNION ALL SELECT NULL, NULL, 3"""
ORACLE["bucketed_joins"] = """WITH p AS (SELECT l_orderkey AS k, count(*) AS n_lines, sum(CAST(l_quantity AS DECIMAL(38,6))) AS q, max(l_extendedprice) AS dearest FROM lineitem GROUP BY 1)
SELECT o_orderkey AS k, coalesce(n_lines, 0) AS n_lines, round(CAST(q AS DOUBLE), 2) AS quantity, n_lines IS NULL AS missing, dearest
FROM orders LEFT JOIN p ON p.k = o_orderkey"""
