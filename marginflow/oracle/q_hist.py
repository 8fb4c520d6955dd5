"""Oracle SQL for SCD2 histories (batch rebuild; the streamed history must
equal it) and for interval union / hours / coverage."""

from __future__ import annotations

from marginflow.oracle.q_fact import fact_sql
from marginflow.oracle.q_ops import REASON
from marginflow.oracle.roles_sql import sround, with_roles


def SR6(x: str) -> str:
    return sround(x, 6)

def scd2_sql(state: list[str], extras: list[str]) -> str:
    chg = " OR ".join(f"{s} IS DISTINCT FROM lag({s}) OVER w" for s in state)
    order = "ts, event_id"
    return f"""WITH f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR {chg} THEN 1 ELSE 0 END AS chg
  FROM obs WINDOW w AS (PARTITION BY item_id ORDER BY {order})),
r AS (SELECT *, sum(chg) OVER (PARTITION BY item_id ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  AS run FROM f),
runs AS (SELECT item_id, run, min(ts) AS desde, max(ts) AS _last,
  {', '.join(f'any_value({s}) AS {s}' for s in state)}
  {''.join(f', arg_max_null({x}, ({order})) AS {x}' for x in extras)}
  FROM r GROUP BY item_id, run)
SELECT item_id, desde, lead(desde) OVER (PARTITION BY item_id ORDER BY run) AS hasta,
  coalesce(lead(desde) OVER (PARTITION BY item_id ORDER BY run), _last) AS visto_hasta,
  {', '.join(state + extras)} FROM runs"""


def _obs_state():
    # observations with sub_status as canonical text (state column name kept)
    return f"""SELECT event_id, item_id, ts, sku, inventory_id, status, price,
  coalesce(array_to_string(list_sort(sub_list), ','), '') AS sub_status, reason, reason = 'ok' AS sellable,
  available_quantity AS units,
  CASE WHEN len(sub_list) = 2 THEN false
       WHEN status = 'active' AND len(sub_list) = 0 AND available_quantity > 0 THEN true END AS winning,
  price * 0.97 AS winner_price
FROM (SELECT * EXCLUDE (sub_status), sub_status AS sub_list, {REASON} AS reason FROM listing_observations)"""


def history_sql(state, extras, body_suffix: str = "") -> str:
    return with_roles(f"WITH h AS ({scd2_sql(state, extras)}) SELECT * FROM h {body_suffix}",
                      "listing_observations", extra={"obs": _obs_state()})


STATE = (["sellable", "status", "sub_status", "reason"], ["sku", "inventory_id", "units"])
ISLANDS = f"""WITH h AS ({scd2_sql(*STATE)}),
a AS (SELECT DISTINCT sku AS key, desde AS start, coalesce(hasta, visto_hasta) AS "end" FROM h
      WHERE sellable AND desde < coalesce(hasta, visto_hasta)),
m AS (SELECT *, max("end") OVER (PARTITION BY key ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS pm FROM a),
i AS (SELECT *, sum(CASE WHEN pm IS NULL OR start > pm THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY start, "end"
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM m),
u AS (SELECT key, min(start) AS start, max("end") AS "end" FROM i GROUP BY key, isl)"""

COVERAGE = """WITH m AS (SELECT moment FROM pulse_moments
  WHERE moment BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-22 00:00:00'),
p AS (SELECT moment AS start, lead(moment) OVER (ORDER BY moment) AS nxt FROM m),
s AS (SELECT start, CASE WHEN nxt IS NULL THEN least(start + INTERVAL 7200 SECOND, TIMESTAMP '2024-01-22 00:00:00')
  WHEN date_diff('microsecond', start, nxt) <= 7200000000 THEN nxt END AS "end" FROM p),
a AS (SELECT DISTINCT start, "end" FROM s WHERE "end" IS NOT NULL AND start < "end"),
mm AS (SELECT *, max("end") OVER (ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM a),
i AS (SELECT *, sum(CASE WHEN pm IS NULL OR start > pm THEN 1 ELSE 0 END) OVER (ORDER BY start, "end"
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM mm)
SELECT min(start) AS start, max("end") AS "end" FROM i GROUP BY isl"""

ORACLE = {
    "scd2_state": history_sql(*STATE),
    "scd2_from_log": history_sql(*STATE),
    "pulse_stream": history_sql(*STATE),
    "pulse_keyed": history_sql(*STATE),
    "scd2_price": history_sql(["price"], ["sku"]),
    "scd2_buybox": history_sql(["winning", "status"], ["winner_price"]),
    "interval_union": with_roles(ISLANDS + " SELECT * FROM u", "listing_observations", extra={"obs": _obs_state()}),
    "interval_hours": with_roles(ISLANDS + """ SELECT key, round(sum(date_diff('microsecond', start, "end")) / 3600000000.0, 6)
  AS hours FROM u GROUP BY key""", "listing_observations", extra={"obs": _obs_state()}),
    "observation_coverage": with_roles(COVERAGE, "pulse_moments"),
}


# --- interval set operations on the state history ---------------------------------

def _setop_sql(a: str, b: str, pred: str) -> str:
    return f"""WITH h AS ({scd2_sql(*STATE)}),
si AS (SELECT item_id, sku, sellable, reason, desde AS start, coalesce(hasta, visto_hasta) AS "end" FROM h),
a AS ({a}), b AS ({b}),
ev AS (SELECT key, start AS t, 1 AS da, 0 AS db FROM a WHERE start < "end"
       UNION ALL SELECT key, "end", -1, 0 FROM a WHERE start < "end"
       UNION ALL SELECT key, start, 0, 1 FROM b WHERE start < "end"
       UNION ALL SELECT key, "end", 0, -1 FROM b WHERE start < "end"),
pt AS (SELECT key, t, sum(da) AS da, sum(db) AS db FROM ev GROUP BY key, t),
seg AS (SELECT key, t AS start, lead(t) OVER (PARTITION BY key ORDER BY t) AS "end",
  sum(da) OVER (PARTITION BY key ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca,
  sum(db) OVER (PARTITION BY key ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cb FROM pt),
ch AS (SELECT key, start, "end" FROM seg WHERE "end" IS NOT NULL AND {pred}),
m AS (SELECT *, max("end") OVER (PARTITION BY key ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS pm FROM ch),
i AS (SELECT *, sum(CASE WHEN pm IS NULL OR start > pm THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY start, "end"
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM m)
SELECT key, min(start) AS start, max("end") AS "end" FROM i GROUP BY key, isl"""


_SELL = 'SELECT sku AS key, start, "end" FROM si WHERE sellable'
_OOS = "SELECT sku AS key, start, \"end\" FROM si WHERE reason = 'out_of_stock'"
_EVEN = 'SELECT sku AS key, start, "end" FROM si WHERE CAST(item_id AS BIGINT) % 2 = 0'
ORACLE["interval_subtract"] = with_roles(_setop_sql(_OOS, _SELL, "ca > 0 AND cb <= 0"), "listing_observations",
                                         extra={"obs": _obs_state()})
ORACLE["interval_intersect"] = with_roles(_setop_sql(_SELL, _EVEN, "ca > 0 AND cb > 0"), "listing_observations",
                                          extra={"obs": _obs_state()})

# --- experiment universe and assignment -------------------------------------------------

EXP = {
    "cat": """SELECT item_id, arg_max(sku, (ts, event_id)) AS sku, arg_max(status, (ts, event_id)) AS status,
  arg_max(catalog_listing, (ts, event_id)) AS catalog_listing FROM listing_observations GROUP BY item_id""",
    "xsales": """SELECT event_id AS order_id, sku, CAST(ts AS DATE) AS date,
  CAST(available_quantity % 5 + 1 AS DOUBLE) AS quantity FROM listing_observations
  WHERE len(sub_status) = 0 AND status = 'active'""",
    "skus": """SELECT p.sku, p.any_active, p.any_catalog, coalesce(v.units, 0.0) AS units, coalesce(v.orders, 0) AS orders
FROM (SELECT sku, bool_or(status = 'active') AS any_active, bool_or(catalog_listing) AS any_catalog FROM cat GROUP BY sku) p
LEFT JOIN (SELECT sku, CAST(sum(CAST(quantity AS DECIMAL(38,6))) AS DOUBLE) AS units, count(DISTINCT order_id) AS orders
           FROM xsales WHERE date >= DATE '2023-12-02' GROUP BY sku) v ON p.sku = v.sku
WHERE p.sku IS NOT NULL""",
    "grp": """SELECT *, CAST(CASE WHEN floor(i / 3) % 2 = 0 THEN i % 3 + 1 ELSE 3 - i % 3 END AS INTEGER) AS grp
FROM (SELECT *, row_number() OVER (ORDER BY any_active DESC, units DESC, sku ASC) - 1 AS i FROM skus)""",
    "assign": """SELECT sku, grp, week, ['10-18', '18-25', '25-35'][((grp - 1 + week - 1) % 3) + 1] AS band,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((week - 1) * 7 AS INTEGER)) AS week_start,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((week - 1) * 7 + 7 AS INTEGER)) AS week_end
FROM grp, (SELECT unnest([1, 2, 3]) AS week)""",
}


def exp_sql(body: str) -> str:
    return with_roles(body, "listing_observations", extra=EXP)


ORACLE["listing_sales_join"] = exp_sql("SELECT * FROM skus")
ORACLE["serpentine_assign"] = exp_sql("SELECT sku, any_active, units, grp FROM grp")
ORACLE["latin_square_assign"] = exp_sql("SELECT * FROM assign")
ORACLE["group_balance"] = exp_sql("""SELECT grp, count(*) AS skus,
  round(CAST(sum(CAST(units AS DECIMAL(38,6))) AS DECIMAL(38,6)), 4)::DOUBLE AS units FROM grp GROUP BY grp""")
ORACLE["active_membership"] = exp_sql("""SELECT DISTINCT item_id FROM cat WHERE sku IN (SELECT sku FROM assign
  WHERE week_start <= TIMESTAMP '2024-01-10 12:00:00' AND week_end >= TIMESTAMP '2024-01-10 12:00:00')""")

# --- streams and run log ----------------------------------------------------------------------

ORACLE["sales_per_hour"] = with_roles("""SELECT date_trunc('hour', ts) AS hour,
  CAST(round(CAST(sum(CAST(price AS DECIMAL(38,6))) AS DECIMAL(38,6)), 2) AS DOUBLE) AS revenue, count(*) AS events
FROM listing_observations WHERE len(sub_status) = 0 GROUP BY 1""", "listing_observations")
ORACLE["coverage_sessions"] = with_roles("""WITH m AS (SELECT moment, CASE WHEN lag(moment) OVER (ORDER BY moment) IS NULL
  OR date_diff('microsecond', lag(moment) OVER (ORDER BY moment), moment) > 7200000000 THEN 1 ELSE 0 END AS new
  FROM pulse_moments),
s AS (SELECT moment, sum(new) OVER (ORDER BY moment ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM m)
SELECT min(moment) AS start, max(moment) + INTERVAL 2 HOUR AS "end", count(*) AS pulses FROM s GROUP BY sid""",
                                         "pulse_moments")
ORACLE["freshness_report"] = """WITH log AS (SELECT event_type AS step, ts, value >= 5 AS ok FROM events),
lo AS (SELECT step, max(ts) AS last_ok FROM log WHERE ok GROUP BY step),
st AS (SELECT l.step, count(*) AS failure_streak FROM log l LEFT JOIN lo ON l.step = lo.step
       WHERE lo.last_ok IS NULL OR l.ts > lo.last_ok GROUP BY l.step)
SELECT s.step, lo.last_ok, coalesce(st.failure_streak, 0) AS failure_streak,
  (lo.last_ok IS NULL OR lo.last_ok < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 2 HOUR) AS overdue
FROM (SELECT DISTINCT step FROM log) s LEFT JOIN lo ON s.step = lo.step LEFT JOIN st ON s.step = st.step"""


# --- joins on histories ----------------------------------------------------------------------

BB = (["winning", "status"], ["winner_price"])
PRICE = (["price"], ["sku"])


def _hist_cte(name: str, spec) -> str:
    return f"{name} AS ({scd2_sql(*spec)})"


def hist_sql(body: str, **specs) -> str:
    ctes = ",\n".join(_hist_cte(n, sp) for n, sp in specs.items())
    return with_roles(f"WITH {ctes}\n{body}", "listing_observations", "pulse_moments",
                      extra=dict(EXP, obs=_obs_state()))


ORACLE["buybox_to_sku"] = hist_sql(f"""SELECT c.sku, b.item_id, b.desde,
  coalesce(b.hasta, b.visto_hasta) AS "end" FROM bb b JOIN cat c ON b.item_id = c.item_id
WHERE b.winning""", bb=BB)
ORACLE["null_safe_change_join"] = hist_sql("""SELECT o.item_id, o.winning AS open_winning, l.winning FROM
  (SELECT item_id, winning FROM bb WHERE hasta IS NULL) o JOIN
  (SELECT item_id, winning FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ts DESC, event_id DESC) AS rn FROM obs)
   WHERE rn = 2) l ON o.item_id = l.item_id
WHERE o.winning IS DISTINCT FROM l.winning""", bb=BB)
ORACLE["interval_overlap_join"] = hist_sql(f"""SELECT p.item_id, p.price AS a_price, greatest(p.desde, s.desde) AS start,
  least(coalesce(p.hasta, p.visto_hasta), coalesce(s.hasta, s.visto_hasta)) AS "end"
FROM ph p JOIN (SELECT * FROM st WHERE sellable) s ON p.item_id = s.item_id
  AND p.desde < coalesce(s.hasta, s.visto_hasta)
  AND coalesce(p.hasta, p.visto_hasta) > s.desde""", ph=PRICE, st=STATE)
ORACLE["broken_days"] = hist_sql(f"""SELECT o.sku, o.day FROM
  (SELECT DISTINCT sku, CAST(ts AS DATE) AS day FROM obs
   WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(moment AS DATE) FROM pulse_moments)) o
WHERE NOT EXISTS (SELECT 1 FROM (
  SELECT DISTINCT sku, CAST(unnest(generate_series(f, l, INTERVAL 1 DAY)) AS DATE) AS day FROM (
    SELECT sku, CAST(desde + INTERVAL 86399999999 MICROSECOND AS DATE) AS f,
           CAST(coalesce(hasta, visto_hasta) AS DATE) - 1 AS l FROM st WHERE sellable)
  WHERE f <= l) fd WHERE fd.sku = o.sku AND fd.day = o.day)""", st=STATE)


# --- exposure split ------------------------------------------------------------------------

def _islands(src: str, keys: str) -> str:
    """Union of intervals in CTE-able SELECT ``src`` (columns keys, start, "end")."""
    return f"""SELECT {keys}, min(start) AS start, max("end") AS "end" FROM (
  SELECT *, sum(CASE WHEN pm IS NULL OR start > pm THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY start, "end"
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM (
    SELECT *, max("end") OVER (PARTITION BY {keys} ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AS pm FROM (SELECT DISTINCT * FROM ({src})) WHERE start < "end"))
GROUP BY {keys}, isl"""


def _subtract(a: str, b: str, keys: str, pred: str = "ca > 0 AND cb <= 0") -> str:
    k = keys
    chosen = f"""SELECT {k}, start, "end" FROM (
  SELECT {k}, t AS start, lead(t) OVER (PARTITION BY {k} ORDER BY t) AS "end",
    sum(da) OVER (PARTITION BY {k} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca,
    sum(db) OVER (PARTITION BY {k} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cb
  FROM (SELECT {k}, t, sum(da) AS da, sum(db) AS db FROM (
    SELECT {k}, start AS t, 1 AS da, 0 AS db FROM ({a}) WHERE start < "end"
    UNION ALL SELECT {k}, "end", -1, 0 FROM ({a}) WHERE start < "end"
    UNION ALL SELECT {k}, start, 0, 1 FROM ({b}) WHERE start < "end"
    UNION ALL SELECT {k}, "end", 0, -1 FROM ({b}) WHERE start < "end") GROUP BY {k}, t))
WHERE "end" IS NOT NULL AND {pred}"""
    return _islands(chosen, keys)


XEND = "TIMESTAMP '2024-01-22 00:00:00'"
XSTART = "TIMESTAMP '2024-01-01 00:00:00'"
HRS = "(CAST(sum(date_diff('microsecond', start, \"end\")) AS DOUBLE) / 3600000000.0)"  # whole microseconds

EXPOSURE = {
    "cov": """SELECT min(start) AS start, max("end") AS "end" FROM (
  SELECT *, sum(CASE WHEN pm IS NULL OR start > pm THEN 1 ELSE 0 END) OVER (ORDER BY start, "end"
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM (
    SELECT *, max("end") OVER (ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM (
      SELECT start, CASE WHEN nxt IS NULL THEN least(start + INTERVAL 7200 SECOND, TIMESTAMP '2024-01-22 00:00:00')
        WHEN date_diff('microsecond', start, nxt) <= 7200000000 THEN nxt END AS "end"
      FROM (SELECT moment AS start, lead(moment) OVER (ORDER BY moment) AS nxt FROM pulse_moments
            WHERE moment BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-22 00:00:00'))
    WHERE "end" IS NOT NULL AND start < "end"))
GROUP BY isl""",
    "wk": """SELECT DISTINCT week, week_start + INTERVAL 24 HOUR AS w_start,
  least(week_end, TIMESTAMP '2024-01-31 00:00:00') AS w_end FROM assign""",
    "obsw": """SELECT week, greatest(c.start, w_start) AS start, least(c."end", w_end) AS "end"
FROM cov c JOIN wk ON c.start < w_end AND c."end" > w_start""",
    "oh": f"""SELECT week, {HRS} AS h_observed FROM obsw GROUP BY week""",
    "si": f"""SELECT * FROM (SELECT sku, sellable, reason, greatest(desde, {XSTART}) AS start,
  least(coalesce(hasta, visto_hasta), {XEND}) AS "end" FROM st WHERE sku IS NOT NULL) WHERE start < "end" """,
    "pc": """SELECT s.sku, o.week, greatest(s.start, o.start) AS start, least(s."end", o."end") AS "end", s.sellable,
  s.reason = 'out_of_stock' AS oos FROM si s JOIN obsw o ON s.start < o."end" AND s."end" > o.start""",
    "vv": _islands('SELECT sku, week, start, "end" FROM pc WHERE sellable', "sku, week"),
    "qq": _subtract('SELECT sku, week, start, "end" FROM pc WHERE oos', 'SELECT sku, week, start, "end" FROM vv',
                    "sku, week"),
    "vh": f"SELECT sku, week, {HRS} AS h_sellable FROM vv GROUP BY ALL",
    "qh": f"SELECT sku, week, {HRS} AS h_out_of_stock FROM qq GROUP BY ALL",
    "hr": "SELECT DISTINCT sku, week, true AS has FROM pc WHERE start < \"end\"",
    "exposure": f"""SELECT a.sku, a.week, a.grp, a.band, w.w_start, w.w_end,
  date_diff('microsecond', w.w_start, w.w_end) / 3600000000.0 AS h_window,
  {SR6('coalesce(vh.h_sellable, 0.0)')} AS h_sellable, {SR6('coalesce(qh.h_out_of_stock, 0.0)')} AS h_out_of_stock,
  {SR6("CASE WHEN coalesce(hr.has, false) THEN coalesce(oh.h_observed, 0.0) - coalesce(vh.h_sellable, 0.0) - coalesce(qh.h_out_of_stock, 0.0) ELSE 0.0 END")} AS h_other,
  {SR6("date_diff('microsecond', w.w_start, w.w_end) / 3600000000.0 - coalesce(oh.h_observed, 0.0)")} AS h_no_data,
  {SR6("CASE WHEN coalesce(hr.has, false) THEN 0.0 ELSE coalesce(oh.h_observed, 0.0) END")} AS h_unattributed
FROM assign a JOIN wk w ON a.week = w.week AND w.w_end > w.w_start LEFT JOIN oh ON a.week = oh.week
LEFT JOIN vh ON a.sku = vh.sku AND a.week = vh.week LEFT JOIN qh ON a.sku = qh.sku AND a.week = qh.week
LEFT JOIN hr ON a.sku = hr.sku AND a.week = hr.week""",
}


EXPOSURE["pp"] = f"""SELECT * FROM (SELECT sku, price, desde AS start, least(coalesce(hasta, visto_hasta), {XEND}) AS "end"
  FROM ph WHERE sku IS NOT NULL AND price IS NOT NULL) WHERE start < {XEND} AND "end" > {XSTART}"""
EXPOSURE["twp"] = f"""SELECT sku, week,
  {sround('sum(price * us) / sum(us)', 4)}
  AS published_price FROM (
  SELECT p.sku, v.week, p.price,
    date_diff('microsecond', greatest(p.start, v.start), least(p."end", v."end")) AS us
  FROM pp p JOIN vv v ON p.sku = v.sku AND p.start < v."end" AND p."end" > v.start) WHERE us > 0 GROUP BY sku, week"""
EXPOSURE["bbw"] = f"""SELECT * FROM (SELECT c.sku, b.desde AS start, least(coalesce(b.hasta, b.visto_hasta), {XEND}) AS "end"
  FROM bb b JOIN cat c ON b.item_id = c.item_id WHERE b.winning) WHERE start < {XEND} AND "end" > {XSTART}"""
EXPOSURE["vweeks"] = "SELECT DISTINCT sku, week FROM vv"
EXPOSURE["bbi"] = _subtract('SELECT w.sku, w.week, b.start, b."end" FROM bbw b JOIN vweeks w ON b.sku = w.sku',
                            'SELECT sku, week, start, "end" FROM vv', "sku, week", "ca > 0 AND cb > 0")
EXPOSURE["bbh"] = f"""SELECT w.sku, w.week,
  {sround('coalesce(h.h, 0.0)', 6)} AS h_buybox FROM vweeks w
  JOIN (SELECT DISTINCT sku FROM bbw) p ON w.sku = p.sku
  LEFT JOIN (SELECT sku, week, {HRS} AS h FROM bbi GROUP BY ALL) h
    ON w.sku = h.sku AND w.week = h.week"""


EXPOSURE["twp_raw"] = """SELECT sku, week,
  sum(price * us) / sum(us) AS pp FROM (
  SELECT p.sku, v.week, p.price,
    date_diff('microsecond', greatest(p.start, v.start), least(p."end", v."end")) AS us
  FROM pp p JOIN vv v ON p.sku = v.sku AND p.start < v."end" AND p."end" > v.start) WHERE us > 0 GROUP BY sku, week"""
_XS = "CAST(sum(CAST({} AS DECIMAL(38,6))) AS DOUBLE)"
EXPOSURE["xs"] = """SELECT event_id AS order_id, sku, CAST(ts AS DATE) AS date, CAST(available_quantity % 5 + 1 AS DOUBLE) AS q,
  price FROM listing_observations WHERE len(sub_status) = 0 AND status = 'active'"""
EXPOSURE["sd"] = f"""SELECT sku, date, {_XS.format('q')} AS units, count(DISTINCT order_id) AS orders,
  {_XS.format('price * q')} AS revenue, {_XS.format('(price * 0.55) * q')} AS cost,
  {_XS.format('(price * 0.10) * q')} AS commission, {_XS.format('0.5')} AS freight,
  {_XS.format('(price / 1.21) * q')} AS net FROM xs GROUP BY sku, date"""
EXPOSURE["sw"] = f"""SELECT d.sku, a.week, {_XS.format('d.units')} AS units, CAST(sum(d.orders) AS BIGINT) AS orders,
  {_XS.format('d.revenue')} AS revenue, {_XS.format('d.cost')} AS cost, {_XS.format('d.commission')} AS commission,
  {_XS.format('d.freight')} AS freight, {_XS.format('d.net')} AS net
FROM sd d JOIN (SELECT a.sku, a.week, CAST(w.w_start AS DATE) AS d0, CAST(w.w_end AS DATE) AS d1
                FROM assign a JOIN wk w ON a.week = w.week AND w.w_end > w.w_start) a
  ON d.sku = a.sku AND d.date >= a.d0 AND d.date < a.d1 GROUP BY d.sku, a.week"""
EXPOSURE["lc"] = """SELECT sku, arg_max(price * 0.55, (date, order_id)) AS unit_cost, 21.0 AS tax_pct FROM xs
WHERE price * 0.55 > 0 GROUP BY sku"""
_U = "coalesce(s.units, 0.0)"
_M = "(coalesce(s.revenue, 0.0) - coalesce(s.cost, 0.0) - coalesce(s.commission, 0.0) - coalesce(s.freight, 0.0))"
_MN = "(coalesce(s.net, 0.0) - coalesce(s.cost, 0.0) - coalesce(s.commission, 0.0) - coalesce(s.freight, 0.0))"
_OK = "(t.pp IS NOT NULL AND e.h_sellable > 0)"
EXPOSURE["consolidated"] = f"""SELECT e.sku, e.week, e.grp, e.band, e.h_window, e.h_sellable, e.h_out_of_stock, e.h_other,
  e.h_no_data, e.h_unattributed, b.h_buybox, {sround(_U, 4)} AS units, coalesce(s.orders, 0) AS orders,
  {sround('coalesce(s.revenue, 0.0)', 4)} AS revenue, {sround(_M, 4)} AS margin_gross_basis,
  {sround(_MN, 4)} AS margin_net, {sround(f'CASE WHEN {_U} > 0 THEN {_M} / {_U} END', 4)} AS margin_per_unit,
  {sround(f'CASE WHEN {_U} > 0 THEN coalesce(s.revenue, 0.0) / {_U} END', 4)} AS avg_price,
  {sround(f'CASE WHEN {_OK} THEN t.pp END', 4)} AS published_price,
  {sround(f'CASE WHEN {_OK} AND c.unit_cost > 0 THEN (t.pp / (1.0 + coalesce(c.tax_pct, 0.0) / 100.0)) / c.unit_cost - 1 END', 6)}
    AS markup,
  {sround(f'CASE WHEN e.h_sellable > 0 THEN {_U} / (e.h_sellable / 24.0) END', 6)} AS units_per_sellable_day
FROM exposure e LEFT JOIN twp_raw t ON e.sku = t.sku AND e.week = t.week
LEFT JOIN bbh b ON e.sku = b.sku AND e.week = b.week LEFT JOIN sw s ON e.sku = s.sku AND e.week = s.week
LEFT JOIN lc c ON e.sku = c.sku"""


def exposure_sql(body: str) -> str:
    ctes = dict(EXP, obs=_obs_state(), st=scd2_sql(*STATE), ph=scd2_sql(*PRICE), bb=scd2_sql(*BB))
    ctes.update(EXPOSURE)
    return with_roles(body, "listing_observations", "pulse_moments", extra=ctes)


ORACLE["exposure_split"] = exposure_sql("SELECT * FROM exposure")

ORACLE["time_weighted_price"] = exposure_sql("SELECT * FROM twp")
ORACLE["buybox_hours"] = exposure_sql("SELECT * FROM bbh")
ORACLE["experiment_consolidate"] = exposure_sql("SELECT * FROM consolidated")
ORACLE["exposure_rate"] = exposure_sql("SELECT sku, week, units, h_sellable, units_per_sellable_day FROM consolidated")

_D = "CASE WHEN {d} <> 0 THEN {n} / {d} END"
ORACLE["band_summary"] = exposure_sql(f"""SELECT band, {sround('days', 4)} AS days,
  {sround(_D.format(n='margin', d='days'), 4)} AS margin_per_day,
  {sround(_D.format(n='margin', d='units'), 4)} AS margin_per_unit,
  {sround(_D.format(n='units', d='days'), 4)} AS units_per_day,
  {sround('mean_markup', 6)} AS mean_markup, sku_weeks FROM (
  SELECT band, CAST(sum(CAST(h_sellable AS DECIMAL(38,6))) AS DOUBLE) / 24.0 AS days,
    CAST(sum(CAST(margin_gross_basis AS DECIMAL(38,6))) AS DOUBLE) AS margin,
    CAST(sum(CAST(units AS DECIMAL(38,6))) AS DOUBLE) AS units,
    CAST(sum(CAST(markup AS DECIMAL(38,6))) AS DOUBLE) / count(markup) AS mean_markup, count(*) AS sku_weeks
  FROM consolidated WHERE h_sellable > 0 GROUP BY band)""")

_G = "(CASE WHEN quantity <> 0 THEN line_total / quantity END)"
_FPU = "(CASE WHEN quantity <> 0 THEN coalesce(freight, 0.0) / quantity END)"
_PCT = (f"((({_G} - coalesce({_G} - net_price, 0.0)) - unit_cost - coalesce(commission, 0.0) - coalesce({_FPU}, 0.0))"
        f" / (CASE WHEN {_G} <> 0 THEN {_G} END) * 100.0)")
ORACLE["elasticity_by_band"] = fact_sql(f"""WITH banded AS (SELECT *,
  CASE WHEN p IS NULL THEN NULL WHEN p < 10.0 THEN '<10' WHEN p < 18.0 THEN '10-18'
  WHEN p < 25.0 THEN '18-25' WHEN p < 35.0 THEN '25-35' ELSE '>35' END AS band,
  (net_price - unit_cost - commission) * quantity - coalesce(freight, 0.0) AS m FROM (SELECT *, {_PCT} AS p FROM fact_sales)),
per AS (SELECT sku, band, CAST(sum(CAST(m AS DECIMAL(38,6))) AS DOUBLE) AS margin, CAST(sum(CAST(quantity AS DECIMAL(38,6))) AS DOUBLE) AS units
  FROM banded WHERE band IS NOT NULL GROUP BY sku, band),
r AS (SELECT *, CASE WHEN units <> 0 THEN margin / units END AS mpu,
  list_position(['<10', '10-18', '18-25', '25-35', '>35'], band) AS band_rank,
  count(*) OVER (PARTITION BY sku) AS bands FROM per),
b AS (SELECT *, max(mpu) OVER (PARTITION BY sku) AS best FROM r WHERE bands >= 2),
w AS (SELECT sku, arg_max(band, band_rank) AS band, arg_max(units, band_rank) AS units FROM b WHERE mpu >= best - abs(best) * 0.1 GROUP BY sku),
t AS (SELECT band, CAST(sum(CAST(m AS DECIMAL(38,6))) AS DOUBLE) AS margin, CAST(sum(CAST(quantity AS DECIMAL(38,6))) AS DOUBLE) AS units
  FROM banded WHERE band IS NOT NULL GROUP BY band)
SELECT t.band, {sround('t.margin', 2)} AS margin, {sround('t.units', 2)} AS units, (SELECT count(*) FROM w WHERE w.band = t.band) AS skus_won,
  (SELECT count(*) FROM w WHERE w.band = t.band AND w.units >= 15) AS won_with_volume FROM t""", "fact_sales")

ORACLE["late_data_stream"] = """WITH e AS (SELECT event_id, ts, value, least(CAST(floor(date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) / 5.0) AS BIGINT)
    + CASE WHEN event_id % 97 = 0 THEN 3 WHEN event_id % 31 = 0 THEN 1 ELSE 0 END, 5) AS b FROM events),
f AS (SELECT * FROM e UNION ALL SELECT event_id, ts, value, least(b + 1, 5) FROM e WHERE event_id % 53 = 0),
hw AS (SELECT b, max(max(ts)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM f GROUP BY b),
j AS (SELECT f.*, coalesce(ts <= date_trunc('millisecond', high) - INTERVAL 7 DAY, false) AS late FROM f JOIN hw USING (b)),
o AS (SELECT date_trunc('hour', ts) AS hour, round(CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE), 2) AS revenue, count(*) AS events
      FROM (SELECT DISTINCT event_id, ts, value FROM j WHERE NOT late) GROUP BY 1),
l AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS late_events FROM j WHERE late GROUP BY 1)
SELECT hour, revenue, coalesce(events, 0) AS events, coalesce(late_events, 0) AS late_events FROM o FULL JOIN l USING (hour)"""
