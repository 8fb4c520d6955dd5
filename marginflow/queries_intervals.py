"""Registered queries for interval algebra, SCD2 histories and the
elasticity experiment (SURVEY §2.8–2.10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marginflow.functions import scalars as S
from marginflow.operators import intervals as IV
from marginflow.operators.aggregates import exact_sum
from marginflow.plans import experiment as EX
from marginflow.registry import QUERIES, query
from marginflow.session import stored
from marginflow.sources import roles as R
from marginflow.streaming.scd2 import clip_end


def _state_intervals(spark, sf):
    """Per item: sellable / out-of-stock validity intervals from the log."""
    h = EX.state_history(spark, sf)
    return stored(h.select("item_id", "sku", "sellable", "reason", F.col("desde").alias("start"),
                           clip_end().alias("end")), "state-intervals")


def _sets(spark, sf):
    si = _state_intervals(spark, sf)
    a = si.where("sellable").select(F.col("sku").alias("key"), "start", "end")
    b = si.where(F.col("reason") == S.REASON_OUT_OF_STOCK).select(F.col("sku").alias("key"), "start", "end")
    return a, b


@query("scd2_from_log")
def q_scd2_from_log(spark, sf):
    return EX.state_history(spark, sf)


@query("scd2_state")
def q_scd2_state(spark, sf):
    return EX.state_history(spark, sf)


@query("scd2_price")
def q_scd2_price(spark, sf):
    return EX.price_history(spark, sf)


@query("scd2_buybox")
def q_scd2_buybox(spark, sf):
    return EX.buybox_history(spark, sf)


@query("null_safe_change_join")
def q_null_safe_change_join(spark, sf):
    """Open buy-box intervals whose state differs (IS DISTINCT FROM) from the
    last but one observation of the same item."""
    from pyspark.sql import Window

    h = EX.buybox_history(spark, sf)
    open_ = h.where(F.col("hasta").isNull()).select("item_id", F.col("winning").alias("open_winning"))
    by = Window.partitionBy("item_id").orderBy(F.desc("ts"), F.desc("event_id"))
    before = EX.observations(spark, sf).select("item_id", "winning", F.row_number().over(by).alias("n")).where("n <= 2").where("n = 2")
    j = open_.join(before, "item_id")
    return j.where(~F.col("open_winning").eqNullSafe(F.col("winning"))).select("item_id", "open_winning", "winning")


@query("interval_union")
def q_interval_union(spark, sf):
    a, _ = _sets(spark, sf)
    return IV.interval_union(a, ["key"], skew_safe=True)


@query("interval_subtract")
def q_interval_subtract(spark, sf):
    a, b = _sets(spark, sf)
    return IV.interval_subtract(b, a, ["key"], skew_safe=True)


@query("interval_intersect")
def q_interval_intersect(spark, sf):
    si = _state_intervals(spark, sf)
    a = si.where("sellable").select(F.col("sku").alias("key"), "start", "end")
    b = si.where(F.col("item_id").cast("bigint") % 2 == 0).select(F.col("sku").alias("key"), "start", "end")
    return IV.interval_intersect(a, b, ["key"], skew_safe=True)


@query("interval_hours")
def q_interval_hours(spark, sf):
    a, _ = _sets(spark, sf)
    return IV.interval_hours(IV.interval_union(a, ["key"], skew_safe=True), ["key"]).withColumn("hours", F.round("hours", 6))


@query("interval_overlap_join")
def q_interval_overlap_join(spark, sf):
    """Price intervals overlapping the sellable intervals of the same item."""
    si = _state_intervals(spark, sf).where("sellable").select("item_id", "start", "end")
    p = EX.price_history(spark, sf).select("item_id", "price", F.col("desde").alias("start"),
                                          clip_end().alias("end"))
    j = IV.overlap_join(p, si, ["item_id"])
    return j.select("item_id", "a_price", "start", "end")


@query("observation_coverage")
def q_observation_coverage(spark, sf):
    return EX.coverage(spark, sf)


@query("coverage_sessions")
def q_coverage_sessions(spark, sf):
    """Session windows with a 2 h gap over pulse moments (approximation of
    coverage: every session end is extended by the gap)."""
    m = R.pulse_moments(spark, sf)
    s = m.groupBy(F.session_window("moment", "2 hours").alias("s")).agg(F.count(F.lit(1)).alias("pulses"))
    return s.select(F.col("s.start").alias("start"), F.col("s.end").alias("end"), "pulses")


@query("exposure_split")
def q_exposure_split(spark, sf):
    exp, _ = EX.exposure_split(spark, sf)
    return exp


@query("time_weighted_price")
def q_time_weighted_price(spark, sf):
    windows = EX.measure_windows(EX.assignment(spark, sf))
    _, v = EX.exposure_split(spark, sf, windows)
    return EX.time_weighted_price(spark, sf, v).withColumn("published_price", F.round("published_price", 4))


@query("buybox_hours")
def q_buybox_hours(spark, sf):
    windows = EX.measure_windows(EX.assignment(spark, sf))
    _, v = EX.exposure_split(spark, sf, windows)
    return EX.buybox_hours(spark, sf, v).withColumn("h_buybox", F.round("h_buybox", 6))


@query("exposure_rate")
def q_exposure_rate(spark, sf):
    return EX.experiment_consolidate(spark, sf).select("sku", "week", "units", "h_sellable", "units_per_sellable_day")


@query("broken_days")
def q_broken_days(spark, sf):
    """A (sku, day) with at least one pulse is broken when no listing of the
    SKU was sellable the whole day."""
    si = _state_intervals(spark, sf).where("sellable")
    days = R.pulse_moments(spark, sf).select(F.to_date("moment").alias("day")).distinct()
    skus = si.select("sku").distinct()
    # per listing interval, the whole days it covers: [day, day+1) ⊆ [start, end)
    first = F.to_date(F.col("start") + F.expr("INTERVAL 86399999999 MICROSECONDS"))
    last = F.date_sub(F.to_date("end"), 1)
    full = si.select("sku", F.explode(F.when(first <= last, F.sequence(first, last))
                                      .otherwise(F.array().cast("array<date>"))).alias("day")).distinct()
    obs = EX.observations(spark, sf).select("sku", F.to_date("ts").alias("day")).distinct()
    obs = obs.join(days, "day", "left_semi")
    return obs.join(full, ["sku", "day"], "left_anti").select("sku", "day")


@query("latin_square_assign")
def q_latin_square_assign(spark, sf):
    return EX.assignment(spark, sf).select("sku", "grp", "week", "band", "week_start", "week_end")


@query("group_balance")
def q_group_balance(spark, sf):
    skus = EX.experiment_skus(spark, sf)
    from marginflow.operators import windows as WN

    g = WN.serpentine_groups(skus, [F.desc("any_active"), F.desc("units"), F.asc("sku")], EX.GROUPS, "grp")
    return g.groupBy("grp").agg(F.count(F.lit(1)).alias("skus"), F.round(exact_sum("units"), 4).alias("units"))


@query("listing_sales_join")
def q_listing_sales_join(spark, sf):
    return EX.experiment_skus(spark, sf)


@query("buybox_to_sku")
def q_buybox_to_sku(spark, sf):
    b = EX.buybox_history(spark, sf).where(F.col("winning") == F.lit(True))
    cat = EX.item_catalog(spark, sf).select("item_id", "sku")
    return b.join(cat, "item_id").select("sku", "item_id", "desde", clip_end().alias("end"))


@query("active_membership")
def q_active_membership(spark, sf):
    """Distinct items whose SKU has an assignment covering ``now``."""
    now = dt.datetime(2024, 1, 10, 12)
    a = EX.assignment(spark, sf).where((F.col("week_start") <= F.lit(now)) & (F.col("week_end") >= F.lit(now)))
    cat = EX.item_catalog(spark, sf).select("item_id", "sku")
    return cat.join(a.select("sku"), "sku", "left_semi").select("item_id").distinct()


@query("experiment_consolidate")
def q_experiment_consolidate(spark, sf):
    return EX.experiment_consolidate(spark, sf)


@query("band_summary")
def q_band_summary(spark, sf):
    return EX.band_summary(EX.experiment_consolidate(spark, sf))


@query("elasticity_by_band")
def q_elasticity_by_band(spark, sf):
    """Totals and SKUs won per margin band over the sales fact."""
    from marginflow.plans.elasticity import band_scores

    f = QUERIES["fact_sales"](spark, sf)
    return band_scores(f.select("sku", "quantity", "line_total", "net_price", "unit_cost", "commission", "freight"))


@query("late_data_policy")
def q_late_data_policy(spark, sf):
    """Fact rebuilt from a 7-day window before ``as_of`` on (here with whole
    margins, to tell the rebuilt rows) over a frozen history: rows older than
    the window never change."""
    from marginflow.plans import fact as FCT
    from marginflow.registry import costs
    from marginflow.sinks import writers as W

    as_of = dt.date(1998, 8, 2)
    start = FCT.window_start(as_of, 7)
    frozen = FCT.fact_wholesale(R.erp_sales(spark, sf), R.erp_articles(spark, sf), costs(spark, sf), with_line_id=True)
    inc = FCT.fact_wholesale(R.erp_sales(spark, sf, since=start), R.erp_articles(spark, sf), costs(spark, sf), start,
                             with_line_id=True).withColumn("margin", F.round("margin", 0))
    return W.replace_window(frozen, inc, "date", start).select("line_id", "date", "margin")


@query("sales_per_hour")
def q_sales_per_hour(spark, sf):
    s = R.listing_observations(spark, sf).where(F.size("sub_status") == 0)
    g = s.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.round(exact_sum("price"), 2).alias("revenue"),
                                                           F.count(F.lit(1)).alias("events"))
    return g.select(F.col("w.start").alias("hour"), "revenue", "events")


