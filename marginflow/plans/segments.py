"""Customer segmentation from wholesale tickets.

Two chained aggregations (per customer and day, then per customer), one
flag aggregation, and two left joins onto the customer table so every
customer is kept.  All three aggregates group by the customer key, so
Spark plans them on one hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.functions import scalars as S
from marginflow.operators.aggregates import exact_avg, exact_sum

SEGMENT_COMPANIES = ("0001", "0003")


def _tickets_base(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("empresa").isin(*SEGMENT_COMPANIES) & F.col("cliente_id").isNotNull())


def daily_ticket(sales: DataFrame, price: Column | None = None) -> DataFrame:
    """Σ price·qty per (customer, day), then avg / sum (rounded 2) / count per
    customer.  The default price is the undiscounted list price, as in the
    original classification (kept on purpose, see README D10)."""
    price = price if price is not None else F.col("precio_lista")
    s = _tickets_base(sales)
    per_day = (s.groupBy("cliente_id", F.to_date("fecha").alias("dia"))
                .agg(exact_sum(price * F.col("cantidad")).alias("ticket_dia")))
    return per_day.groupBy("cliente_id").agg(
        F.round(exact_avg("ticket_dia"), 2).alias("avg_ticket"),
        F.round(exact_sum("ticket_dia"), 2).alias("total_amount"),
        F.count(F.lit(1)).alias("ticket_count"))


def company_flags(sales: DataFrame) -> DataFrame:
    """``bool_or`` per customer: bought from company 0001 / 0003."""
    s = _tickets_base(sales)
    return s.groupBy("cliente_id").agg(
        F.bool_or(F.col("empresa") == "0001").alias("buys_0001"),
        F.bool_or(F.col("empresa") == "0003").alias("buys_0003"))


def customer_segments(customers: DataFrame, sales: DataFrame) -> DataFrame:
    flags = company_flags(sales).withColumn("_has", F.lit(True))
    tick = daily_ticket(sales)
    c = customers.select(F.col("id").alias("customer_id"), F.col("nombre").alias("name"),
                         F.col("rubro").alias("segment"), F.col("provincia").alias("province"))
    j = (c.join(flags, c.customer_id == flags.cliente_id, "left").drop("cliente_id")
          .join(tick, c.customer_id == tick.cliente_id, "left").drop("cliente_id"))
    has = F.coalesce(F.col("_has"), F.lit(False))
    return j.select(
        "customer_id", "name", "segment", "province",
        S.nz("avg_ticket").alias("avg_ticket"),
        S.nz("total_amount").alias("total_amount"),
        F.coalesce(F.col("ticket_count"), F.lit(0)).alias("ticket_count"),
        F.coalesce(F.col("buys_0001"), F.lit(False)).alias("buys_0001"),
        F.coalesce(F.col("buys_0003"), F.lit(False)).alias("buys_0003"),
        S.customer_tier(has, F.coalesce(F.col("buys_0001"), F.lit(False)),
                        F.coalesce(F.col("buys_0003"), F.lit(False)), F.col("avg_ticket")).alias("tier"),
    )


def tier_distribution(segments: DataFrame) -> DataFrame:
    return segments.groupBy("tier").agg(F.count(F.lit(1)).alias("customers"))
