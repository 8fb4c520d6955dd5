"""Registered queries: key → ``(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (through the role views), runs over
them whole, and returns a lazy DataFrame.  Keys follow SURVEY §2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marginflow.plans import fact as FCT
from marginflow.sources import roles as R

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        return fn
    return deco


def fact_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Sources of all channels over one reading of the lines; a single channel's
    fact reads its own lines and the sold months instead, and writes nothing."""
    landed = R.landed_lines(spark, sf)
    of_lines = {n: getattr(R, n)(spark, sf, landed=landed) for n in ("erp_sales", "web_order_items", "market_order_items")}
    others = {n: getattr(R, n)(spark, sf) for n in ("erp_articles", "market_orders", "market_shipments")}
    return of_lines | others | sheets(spark, sf, landed)


def sheets(spark: SparkSession, sf: str, landed: DataFrame | None = None) -> dict[str, DataFrame]:
    """Cost and offer sheets over the sold months, of ``landed`` lines if given."""
    cost = R.cost_sheet(spark, sf, landed)
    return {"cost_sheet": cost, "offer_sheet": R.offer_sheet(spark, sf, cost)}


def costs(spark, sf):
    s = sheets(spark, sf)
    return FCT.cost_history(s["cost_sheet"], s["offer_sheet"])


# --- §2.10 composite: the fact -------------------------------------------------

@query("cost_history")
def q_cost_history(spark, sf):
    return costs(spark, sf)


@query("fact_wholesale")
def q_fact_wholesale(spark, sf):
    return FCT.fact_wholesale(R.erp_sales(spark, sf), R.erp_articles(spark, sf), costs(spark, sf))


@query("fact_webstore")
def q_fact_webstore(spark, sf):
    return FCT.fact_webstore(R.web_order_items(spark, sf), R.erp_articles(spark, sf), costs(spark, sf))


@query("fact_marketplace")
def q_fact_marketplace(spark, sf):
    return FCT.fact_marketplace(R.market_orders(spark, sf), R.market_order_items(spark, sf),
                                R.market_shipments(spark, sf), R.erp_articles(spark, sf), costs(spark, sf))


@query("fact_sales")
def q_fact_sales(spark, sf):
    return FCT.fact_sales(fact_sources(spark, sf))


@query("package_join")
def q_package_join(spark, sf):
    return FCT.package_orders(R.market_shipments(spark, sf), R.market_orders(spark, sf))


@query("package_totals")
def q_package_totals(spark, sf):
    return FCT.package_totals(q_package_join(spark, sf))


@query("order_to_package")
def q_order_to_package(spark, sf):
    return FCT.order_to_package(q_package_join(spark, sf))


# --- §2.10 composite: freight allocation, customer segments ---------------------

from marginflow.plans import freight as FR  # noqa: E402
from marginflow.plans import segments as SEG  # noqa: E402
from marginflow.functions import scalars as S  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def wholesale_fact_with_ids(spark, sf):
    return FCT.fact_wholesale(R.erp_sales(spark, sf), R.erp_articles(spark, sf), costs(spark, sf),
                              with_line_id=True)


def freight_inputs(spark, sf):
    return (wholesale_fact_with_ids(spark, sf), R.preparations(spark, sf), R.erp_articles(spark, sf),
            R.freight_invoices(spark, sf))


@query("freight_allocation")
def q_freight_allocation(spark, sf):
    return FR.freight_allocation(*freight_inputs(spark, sf))


@query("fanout_safe_join")
def q_fanout_safe_join(spark, sf):
    fact = wholesale_fact_with_ids(spark, sf)
    lines = fact.where(F.col("unit").isin(S.UNIT_A, S.UNIT_B) & F.col("order_id").isNotNull())
    return FR.fanout_safe_join(lines.select("line_id", "order_id", "sku"), R.preparations(spark, sf))


@query("freight_key")
def q_freight_key(spark, sf):
    return FR.freight_lines(*freight_inputs(spark, sf)).select(
        "line_id", "preparacion_id", "transporte", "unit", "freight_key")


@query("all_or_nothing_regroup")
def q_all_or_nothing_regroup(spark, sf):
    fl = FR.freight_lines(*freight_inputs(spark, sf)).withColumn(
        "_fb", S.nz("net_price") * S.nz("quantity") * FR.ESTIMATE_RATE)
    out = FR.all_or_nothing_regroup(fl, ["order_id", "sku"], "line_id", "is_real", "real_part",
                                    "_fb", "freight_key")
    return out.withColumn("value", F.round("value", 2))


@query("daily_ticket")
def q_daily_ticket(spark, sf):
    return SEG.daily_ticket(R.erp_sales(spark, sf))


@query("company_flags")
def q_company_flags(spark, sf):
    return SEG.company_flags(R.erp_sales(spark, sf))


@query("customer_segments")
def q_customer_segments(spark, sf):
    return SEG.customer_segments(R.erp_customers(spark, sf), R.erp_sales(spark, sf))


@query("segment_join")
def q_segment_join(spark, sf):
    """ERP sales lines with the tier of their customer (none: null)."""
    seg = q_customer_segments(spark, sf).select(F.col("customer_id").alias("_c"), "tier")
    s = R.erp_sales(spark, sf).select("linea_id", "cliente_id")
    return s.join(seg, F.col("cliente_id") == F.col("_c"), "left").select("linea_id", "cliente_id", "tier")


@query("customer_tier")
def q_customer_tier(spark, sf):
    return q_customer_segments(spark, sf).select("customer_id", "tier")


@query("tier_distribution")
def q_tier_distribution(spark, sf):
    return SEG.tier_distribution(q_customer_segments(spark, sf))


# --- remaining sections live in their own modules; importing registers them --

def _load_all():
    from marginflow import queries_intervals, queries_ops, queries_sources, queries_stream  # noqa: F401


_load_all()
