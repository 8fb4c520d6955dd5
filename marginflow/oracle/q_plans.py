"""Oracle SQL for freight allocation and customer segmentation."""

from __future__ import annotations

from marginflow.functions import scalars as S
from marginflow.oracle import sqlfrag as Q
from marginflow.oracle.q_fact import fact_sql

SR = Q.sround

FREIGHT_KEY = (f"(CASE WHEN preparacion_id IS NULL THEN NULL "
               f"WHEN upper(coalesce(transporte, '')) LIKE '%{S.SPLIT_CARRIER_MARKER}%' "
               f"THEN CAST(preparacion_id AS VARCHAR) || '-' || CASE WHEN unit = '{S.UNIT_A}' THEN '{S.UNIT_A}' "
               f"ELSE '{S.UNIT_B}' END ELSE CAST(preparacion_id AS VARCHAR) END)")

FREIGHT = {
    "fw_lines": f"""SELECT line_id, order_id, sku, unit, quantity, net_price FROM fact_wholesale
WHERE unit IN ('{S.UNIT_A}', '{S.UNIT_B}') AND order_id IS NOT NULL""",
    "fr_merged": """SELECT DISTINCT l.*, p.preparacion_id, p.transporte FROM fw_lines l
LEFT JOIN preparations p ON l.order_id = p.pedido_codigo""",
    "fr_keyed": f"""SELECT m.*, {FREIGHT_KEY} AS freight_key,
  CASE WHEN a.litros IS NOT NULL AND a.litros <> 0 THEN a.litros * coalesce(m.quantity, 0.0)
       ELSE coalesce(m.quantity, 0.0) END AS volume
FROM fr_merged m LEFT JOIN erp_articles a ON m.sku = a.id""",
    "fr_kv": f"SELECT freight_key, {Q.xsum('volume')} AS key_volume FROM fr_keyed GROUP BY freight_key",
    "fr_inv": """SELECT clave_fila AS freight_key, neto_cobrado_transporte AS key_freight FROM freight_invoices
WHERE neto_cobrado_transporte IS NOT NULL""",
    "fr_lines": f"""SELECT *, CASE WHEN is_real THEN {Q.share('key_freight', 'volume', 'key_volume')} END AS real_part
FROM (SELECT k.*, v.key_volume, i.key_freight,
        (k.freight_key IS NOT NULL AND i.key_freight IS NOT NULL AND coalesce(v.key_volume > 0, false)) AS is_real
      FROM fr_keyed k LEFT JOIN fr_kv v ON k.freight_key = v.freight_key
      LEFT JOIN fr_inv i ON k.freight_key = i.freight_key)""",
    "fr_per_line": f"""SELECT order_id, sku, line_id, bool_and(is_real) AS all_real, {Q.xsum('real_part')} AS real_sum,
  min(coalesce(net_price, 0.0) * coalesce(quantity, 0.0)) AS net_sale,
  min((coalesce(net_price, 0.0) * coalesce(quantity, 0.0)) * 0.05) AS fb,
  coalesce(list(DISTINCT freight_key) FILTER (WHERE freight_key IS NOT NULL), []) AS keys
FROM fr_lines GROUP BY order_id, sku, line_id""",
    "fr_group": f"""SELECT order_id, sku, bool_and(all_real) AS has_real_freight, {Q.xsum('real_sum')} AS real_sum,
  {Q.xsum('net_sale')} AS net_sale, {Q.xsum('fb')} AS fb_sum, list_distinct(flatten(list(keys))) AS keys
FROM fr_per_line GROUP BY order_id, sku""",
}


def freight_sql(body: str) -> str:
    return fact_sql(body, "fact_wholesale", roles=("preparations", "freight_invoices", "erp_articles"),
                    extra=FREIGHT)


SEG = {
    "seg_base": """SELECT * FROM erp_sales WHERE empresa IN ('0001', '0003') AND cliente_id IS NOT NULL""",
    "tickets_dia": f"""SELECT cliente_id, CAST(fecha AS DATE) AS dia, {Q.xsum('precio_lista * cantidad')} AS ticket_dia
FROM seg_base GROUP BY cliente_id, CAST(fecha AS DATE)""",
    "resumen": f"""SELECT cliente_id, {SR(Q.xavg('ticket_dia'))} AS avg_ticket, {SR(Q.xsum('ticket_dia'))} AS total_amount,
  count(*) AS ticket_count FROM tickets_dia GROUP BY cliente_id""",
    "flags": """SELECT cliente_id, bool_or(empresa = '0001') AS buys_0001, bool_or(empresa = '0003') AS buys_0003
FROM seg_base GROUP BY cliente_id""",
    "segments": f"""SELECT c.id AS customer_id, c.nombre AS name, c.rubro AS segment, c.provincia AS province,
  coalesce(r.avg_ticket, 0.0) AS avg_ticket, coalesce(r.total_amount, 0.0) AS total_amount,
  coalesce(r.ticket_count, 0) AS ticket_count, coalesce(f.buys_0001, false) AS buys_0001,
  coalesce(f.buys_0003, false) AS buys_0003,
  CASE WHEN f.cliente_id IS NULL THEN 'C'
       WHEN f.buys_0001 AND f.buys_0003 THEN 'B1'
       WHEN f.buys_0001 AND NOT f.buys_0003 AND r.avg_ticket > {S.TIER_A_MIN_TICKET} THEN 'A'
       WHEN f.buys_0001 AND NOT f.buys_0003 THEN 'B1'
       WHEN f.buys_0003 AND NOT f.buys_0001 AND r.avg_ticket > {S.TIER_B2_MIN_TICKET} THEN 'B2'
       ELSE 'C' END AS tier
FROM erp_customers c LEFT JOIN flags f ON f.cliente_id = c.id LEFT JOIN resumen r ON r.cliente_id = c.id""",
}


def seg_sql(body: str) -> str:
    from marginflow.oracle.roles_sql import with_roles
    return with_roles(body, "erp_sales", "erp_customers", extra=SEG)


ORACLE = {
    "freight_allocation": freight_sql(f"""SELECT order_id, sku,
  CASE WHEN len(keys) > 0 THEN array_to_string(list_sort(keys), ', ') END AS freight_keys,
  {SR('CASE WHEN has_real_freight THEN real_sum ELSE net_sale * 0.05 END')} AS allocated_freight,
  has_real_freight FROM fr_group"""),
    "fanout_safe_join": freight_sql("SELECT line_id, order_id, sku, preparacion_id, transporte FROM fr_merged"),
    "freight_key": freight_sql("SELECT line_id, preparacion_id, transporte, unit, freight_key FROM fr_keyed"),
    "all_or_nothing_regroup": freight_sql(f"""SELECT order_id, sku, has_real_freight AS all_real,
  {SR('CASE WHEN has_real_freight THEN real_sum ELSE fb_sum END')} AS value,
  CASE WHEN len(keys) > 0 THEN array_to_string(list_sort(keys), ', ') END AS labels FROM fr_group"""),
    "daily_ticket": seg_sql("SELECT * FROM resumen"),
    "company_flags": seg_sql("SELECT * FROM flags"),
    "customer_segments": seg_sql("SELECT * FROM segments"),
    "segment_join": seg_sql("SELECT linea_id, cliente_id, tier FROM erp_sales LEFT JOIN segments ON customer_id = cliente_id"),
    "customer_tier": seg_sql("SELECT customer_id, tier FROM segments"),
    "tier_distribution": seg_sql("SELECT tier, count(*) AS customers FROM segments GROUP BY tier"),
}
