"""Elasticity by margin band: band each sales line by its margin %, total
margin and units per (sku, band), and pick a winning band per SKU among
SKUs sold in at least two bands.

Winner rule (documented choice, the original leaves the denominator open):
the band with the best margin per unit wins; a *higher* band whose margin
per unit is within ``NEAR_TIE`` (10 %) of the best wins instead (prefer the
higher price when the difference is noise).  "With volume" = at least
``MIN_UNITS`` units in the winning band.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginflow.functions import scalars as S
from marginflow.operators.aggregates import exact_parts, exact_total, exact_value

NEAR_TIE = 0.10
MIN_UNITS = 15


def line_margin_pct(df: DataFrame) -> DataFrame:
    q = F.col("quantity")
    gross = F.try_divide(F.col("line_total"), F.when(q != 0, q))
    pct = S.margin_pct(gross, gross - F.col("net_price"), F.col("unit_cost"), F.col("commission"),
                       F.try_divide(S.nz("freight"), F.when(q != 0, q)))
    return df.withColumn("margin_pct", pct).withColumn("band", S.margin_band("margin_pct"))


def sku_bands(sales: DataFrame) -> DataFrame:
    """Per (sku, band): margin and units, and whether the band wins its SKU.
    The lines are read once; all else runs on these rows."""
    q = F.col("quantity")
    lines = line_margin_pct(sales).where(F.col("margin_pct").isNotNull())
    margin = (F.col("net_price") - F.col("unit_cost") - F.col("commission")) * q - S.nz("freight")
    per = lines.groupBy("sku", "band").agg(*exact_parts(margin, "margin"), *exact_parts(q, "units"))
    units = exact_value("units")
    per = per.withColumn("margin_per_unit", F.try_divide(exact_value("margin"), F.when(units != 0, units)))
    per = per.withColumn("band_rank", F.array_position(F.array(*[F.lit(b[0]) for b in S.MARGIN_BANDS]), F.col("band")))
    w = Window.partitionBy("sku")
    per = per.withColumn("bands", F.count(F.lit(1)).over(w)).withColumn("best", F.max("margin_per_unit").over(w))
    near = F.col("margin_per_unit") >= F.col("best") - F.abs(F.col("best")) * NEAR_TIE
    per = per.withColumn("_ok", F.when((F.col("bands") >= 2) & near, F.col("band_rank")))
    return per.withColumn("wins", F.coalesce(F.col("_ok") == F.max("_ok").over(w), F.lit(False)))


def elasticity_by_band(sales: DataFrame) -> DataFrame:
    units = exact_value("units")
    return sku_bands(sales).where("wins").select(
        "sku", F.col("band").alias("winner_band"), F.round("margin_per_unit", 4).alias("margin_per_unit"),
        F.round(units, 4).alias("units"), (units >= MIN_UNITS).alias("with_volume"))


def band_scores(sales: DataFrame) -> DataFrame:
    """Per band: margin and units of all its lines, and the number of SKUs it
    wins (also counting only winners with volume).  Five rows at most."""
    volume = F.col("wins") & (exact_value("units") >= MIN_UNITS)
    return sku_bands(sales).groupBy("band").agg(
        F.round(exact_total("margin"), 2).alias("margin"), F.round(exact_total("units"), 2).alias("units"),
        F.count_if("wins").alias("skus_won"), F.count_if(volume).alias("won_with_volume"))
