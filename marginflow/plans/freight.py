"""Freight allocation for wholesale lines.

Carrier invoices are recorded per *freight key* (a preparation, or a
preparation and business unit for carriers that split invoices).  Each key's
invoice is shared among the lines shipped under it by volume (litres·qty,
falling back to qty); an (order, sku) whose lines are not all covered by a
real invoice gets an estimate of 5 % of its net sale instead.

Plan: lines ⟕ preparations (shuffle on order), key volume totals
(``groupBy(key)`` + join back: partial sums, skew-safe), invoice lookup on the
same key, then a two-level regroup (per line, then per (order, sku)) so a
line that went out in two preparations is counted once in the estimate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions import scalars as S
from marginflow.operators.aggregates import exact_sum
from marginflow.operators.allocate import share, with_group_total
from marginflow.operators.dedupe import keep_one_per_key

# Share of the net sale used when no real invoice covers the line (fixed value).
ESTIMATE_RATE = 0.05


def fanout_safe_join(lines: DataFrame, preps: DataFrame) -> DataFrame:
    """Lines ⟕ preparations on the order code; a line may legitimately go out
    in several preparations, but a repeated (line, preparation) pair is one.

    A line carries one order, so a repeated (line, preparation) pair can only
    come from a repeated (order, preparation) row: the dedupe runs on the
    (small) preparations table before the join instead of on every joined
    line after it — same rows, one large aggregate less."""
    p = keep_one_per_key(preps.select(F.col("pedido_codigo").alias("_order"), "preparacion_id", "transporte"),
                         ["_order", "preparacion_id"], [])
    return lines.join(p, lines.order_id == p._order, "left").drop("_order")


def line_volume(litres, qty):
    """litres·qty, or qty when litres are unknown or 0 (documented intent)."""
    return F.when(litres.isNotNull() & (litres != 0), litres * S.nz(qty)).otherwise(S.nz(qty))


def freight_lines(fact: DataFrame, preps: DataFrame, articles: DataFrame,
                  invoices: DataFrame) -> DataFrame:
    """Per (line, preparation): freight key, volume, key totals, real part."""
    lines = fact.where((F.col("channel") == "wholesale") & F.col("unit").isin(S.UNIT_A, S.UNIT_B)
                       & F.col("order_id").isNotNull()) \
                .select("line_id", "order_id", "sku", "unit", "quantity", "net_price")
    m = fanout_safe_join(lines, preps)
    lit = keep_one_per_key(articles.select(F.col("id").alias("_sku"), F.col("litros")), ["_sku"], [])
    m = m.join(lit, m.sku == lit._sku, "left").drop("_sku")
    m = (m.withColumn("freight_key", S.freight_key("preparacion_id", "transporte", "unit"))
          .withColumn("volume", line_volume(F.col("litros"), F.col("quantity"))))
    # lines without a key would all meet in one task: each gets a key of its own for the joins
    m = m.withColumn("_key", F.coalesce("freight_key", F.concat(F.lit("~"), "line_id")))
    m = with_group_total(m, ["_key"], "volume", out="key_volume")
    m = m.withColumn("key_volume", F.when(F.col("freight_key").isNotNull(), F.col("key_volume")))
    inv = keep_one_per_key(invoices.where(F.col("neto_cobrado_transporte").isNotNull())
                           .select(F.col("clave_fila").alias("_key"),
                                   F.col("neto_cobrado_transporte").alias("key_freight")),
                           ["_key"], [])
    m = m.join(inv, "_key", "left").drop("_key")
    real = (F.col("freight_key").isNotNull() & F.col("key_freight").isNotNull()
            & F.coalesce(F.col("key_volume") > 0, F.lit(False)))
    return (m.withColumn("is_real", real)
             .withColumn("real_part", F.when(real, share(F.col("key_freight"), F.col("volume"),
                                                         F.col("key_volume")))))


def freight_allocation(fact: DataFrame, preps: DataFrame, articles: DataFrame,
                       invoices: DataFrame, estimate_rate: float = ESTIMATE_RATE) -> DataFrame:
    fl = freight_lines(fact, preps, articles, invoices)
    per_line = fl.groupBy("order_id", "sku", "line_id").agg(
        F.bool_and("is_real").alias("all_real"),
        exact_sum("real_part").alias("real_sum"),
        F.first(S.nz("net_price") * S.nz("quantity")).alias("net_sale"),
        F.collect_set("freight_key").alias("keys"),
    )
    g = per_line.groupBy("order_id", "sku").agg(
        F.bool_and("all_real").alias("has_real_freight"),
        exact_sum("real_sum").alias("real_sum"),
        exact_sum("net_sale").alias("net_sale"),
        F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"),
    )
    amount = F.when(F.col("has_real_freight"), F.col("real_sum")).otherwise(F.col("net_sale") * estimate_rate)
    return g.select(
        "order_id", "sku",
        F.when(F.size("keys") > 0, F.array_join(F.array_sort("keys"), ", ")).alias("freight_keys"),
        F.round(amount, 2).alias("allocated_freight"),
        "has_real_freight",
    )


def all_or_nothing_regroup(lines: DataFrame, group: list[str], line: str, flag: str,
                           real_value: str, fallback_value: str, label: str) -> DataFrame:
    """Generic regroup: Σ real values when every row of the group is real,
    else Σ fallback over distinct lines; distinct labels sorted, ', '-joined."""
    per_line = lines.groupBy(*group, line).agg(
        F.bool_and(flag).alias("_all"), exact_sum(real_value).alias("_real"),
        F.first(fallback_value).alias("_fb"), F.collect_set(label).alias("_lab"))
    g = per_line.groupBy(*group).agg(
        F.bool_and("_all").alias("all_real"), exact_sum("_real").alias("_real"),
        exact_sum("_fb").alias("_fb"), F.array_distinct(F.flatten(F.collect_list("_lab"))).alias("_lab"))
    return g.select(*group, "all_real",
                    F.when(F.col("all_real"), F.col("_real")).otherwise(F.col("_fb")).alias("value"),
                    F.when(F.size("_lab") > 0, F.array_join(F.array_sort("_lab"), ", ")).alias("labels"))
