"""Price-elasticity experiment: assignment (serpentine groups, Latin square
of margin bands × weeks) and consolidation (exposure hours per SKU-week from
interval algebra, published price, buy-box hours, sales, margin).

Data roles: listing observations (events) give the SCD2 state / price /
buy-box histories; purchase events are the experiment's marketplace sales;
observation moments give the pulse coverage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.functions import scalars as S
from marginflow.operators import intervals as IV
from marginflow.operators import windows as WN
from marginflow.operators.aggregates import exact_avg, exact_sum
from marginflow.operators.dedupe import latest_per_key
from marginflow.session import stored
from marginflow.sources import roles as R
from marginflow.streaming.scd2 import clip_end, scd2_from_log

GROUPS = 3
# Margin bands tested, in Latin-square order (label, min %, max %).
BANDS = (("10-18", 10.0, 18.0), ("18-25", 18.0, 25.0), ("25-35", 25.0, 35.0))


@dataclass(frozen=True)
class ExperimentSpec:
    """Calendar of one experiment; every step takes it as an argument."""

    start: dt.datetime
    weeks: int
    now: dt.datetime                # nothing after this moment has been observed
    washout_hours: int = 24         # first hours of each week are not measured
    sales_lookback_days: int = 60

    @property
    def end(self) -> dt.datetime:
        return min(self.start + dt.timedelta(weeks=self.weeks), self.now)


#: The experiment that the registered queries evaluate.
JANUARY = ExperimentSpec(start=dt.datetime(2024, 1, 1), weeks=3, now=dt.datetime(2024, 1, 31))


# ---------------------------------------------------------------------------
# histories
# ---------------------------------------------------------------------------

def observations(spark: SparkSession, sf: str) -> DataFrame:
    return observed_states(R.listing_observations(spark, sf))


def observed_states(o: DataFrame) -> DataFrame:
    """Listing observations with their derived state (also on a stream)."""
    reason = S.listing_reason("status", "sub_status", "available_quantity")
    return o.select("event_id", "item_id", "ts", "sku", "inventory_id", "status", "price",
                    S.canonical_list_text("sub_status").alias("sub_status"),
                    reason.alias("reason"), (reason == S.REASON_OK).alias("sellable"),
                    F.col("available_quantity").alias("units"),
                    # three-valued: purchase → winning, view → losing, others unknown
                    F.when(F.size("sub_status") == 2, F.lit(False))
                     .when((F.col("status") == "active") & (F.size("sub_status") == 0)
                           & (F.col("available_quantity") > 0), F.lit(True)).alias("winning"),
                    (F.col("price") * 0.97).alias("winner_price"))


STATE_COLS = ("sellable", "status", "sub_status", "reason")
STATE_EXTRAS = ("sku", "inventory_id", "units")


def state_history(spark, sf) -> DataFrame:
    return scd2_from_log(observations(spark, sf), "item_id", "ts", STATE_COLS, STATE_EXTRAS, ["event_id"])


def price_history(spark, sf) -> DataFrame:
    return scd2_from_log(observations(spark, sf), "item_id", "ts", ("price",), ("sku",), ["event_id"])


def buybox_history(spark, sf) -> DataFrame:
    return scd2_from_log(observations(spark, sf), "item_id", "ts", ("winning", "status"), ("winner_price",),
                         ["event_id"])


def item_catalog(spark, sf) -> DataFrame:
    """item → sku (latest observation), the bridge from item to SKU level."""
    o = R.listing_observations(spark, sf).select("item_id", "ts", "event_id", "sku", "status", "catalog_listing")
    return latest_per_key(o, ["item_id"], F.struct("ts", "event_id"))


# ---------------------------------------------------------------------------
# sales
# ---------------------------------------------------------------------------

def experiment_sales(spark, sf) -> DataFrame:
    """Purchase events as marketplace sales lines (date, sku, units, money)."""
    e = R.listing_observations(spark, sf).where(F.size("sub_status") == 0).where(F.col("status") == "active")
    qty = (F.col("available_quantity") % 5 + 1).cast("double")
    return e.select(F.col("event_id").alias("order_id"), "sku", F.to_date("ts").alias("date"),
                    qty.alias("quantity"), (F.col("price") * qty).alias("line_total"),
                    (F.col("price") * 0.55).alias("unit_cost"), (F.col("price") * 0.10).alias("commission"),
                    F.lit(0.5).alias("freight"), (F.col("price") / 1.21).alias("net_price"),
                    F.lit(21.0).alias("tax_pct"))


def sales_by_sku_day(sales: DataFrame) -> DataFrame:
    q = F.col("quantity")
    return sales.groupBy("sku", "date").agg(
        exact_sum(q).alias("units"), F.countDistinct("order_id").alias("orders"),
        exact_sum("line_total").alias("revenue"), exact_sum(F.col("unit_cost") * q).alias("cost"),
        exact_sum(F.col("commission") * q).alias("commission"), exact_sum("freight").alias("freight"),
        exact_sum(F.col("net_price") * q).alias("net"))


# ---------------------------------------------------------------------------
# assignment
# ---------------------------------------------------------------------------

def experiment_skus(spark, sf, spec: ExperimentSpec = JANUARY, catalog: DataFrame | None = None) -> DataFrame:
    """Universe: every SKU with a listing; flags from its listings' latest
    state (``catalog``, where it is at hand); units sold in the look-back
    window (0 when none)."""
    cat = catalog if catalog is not None else item_catalog(spark, sf)
    pub = cat.groupBy("sku").agg(F.bool_or(F.col("status") == "active").alias("any_active"),
                                 F.bool_or("catalog_listing").alias("any_catalog"))
    since = (spec.now - dt.timedelta(days=spec.sales_lookback_days)).date()
    s = experiment_sales(spark, sf).where(F.col("date") >= F.lit(since))
    v = s.groupBy("sku").agg(exact_sum("quantity").alias("units"), F.countDistinct("order_id").alias("orders"))
    j = pub.join(v, "sku", "left").where(F.col("sku").isNotNull())
    return j.select("sku", "any_active", "any_catalog", S.nz("units").alias("units"),
                    F.coalesce("orders", F.lit(0)).alias("orders"))


def latin_square_assign(groups: DataFrame, spec: ExperimentSpec = JANUARY) -> DataFrame:
    """Group G in week S gets band ``(G−1+S−1) mod 3``; one row per
    (sku, week) via ``explode`` of the week numbers (no join)."""
    labels = F.array(*[F.lit(b[0]) for b in BANDS])
    lo = F.array(*[F.lit(b[1]) for b in BANDS])
    hi = F.array(*[F.lit(b[2]) for b in BANDS])
    d = groups.select("sku", "grp", F.explode(F.sequence(F.lit(1), F.lit(spec.weeks))).alias("week"))
    idx = ((F.col("grp") - 1 + F.col("week") - 1) % len(BANDS)).cast("int")
    ws = F.lit(spec.start) + F.make_dt_interval(days=(F.col("week") - 1) * 7)
    return d.select("sku", "grp", "week", F.get(labels, idx).alias("band"), F.get(lo, idx).alias("band_min"),
                    F.get(hi, idx).alias("band_max"), ws.alias("week_start"),
                    (ws + F.make_dt_interval(days=F.lit(7))).alias("week_end"))


def assignment(spark, sf, spec: ExperimentSpec = JANUARY, catalog: DataFrame | None = None) -> DataFrame:
    skus = experiment_skus(spark, sf, spec, catalog)
    g = WN.serpentine_groups(skus, [F.desc("any_active"), F.desc("units"), F.asc("sku")], GROUPS, "grp")
    return latin_square_assign(g, spec)


# ---------------------------------------------------------------------------
# consolidation
# ---------------------------------------------------------------------------

def coverage(spark, sf, spec: ExperimentSpec = JANUARY) -> DataFrame:
    """Pulse coverage over the experiment window (bounded: ≤ one segment per
    observation moment in three weeks)."""
    m = R.pulse_moments(spark, sf).where(F.col("moment").between(F.lit(spec.start), F.lit(spec.end)))
    return IV.coverage_segments(m, "moment", spec.end)


def measure_windows(assign: DataFrame, spec: ExperimentSpec = JANUARY) -> DataFrame:
    """W = [week_start + washout, min(week_end, now)); empty windows skipped."""
    ws = F.col("week_start") + F.make_dt_interval(hours=F.lit(spec.washout_hours))
    we = F.least(F.col("week_end"), F.lit(spec.now))
    return assign.select("*", ws.alias("w_start"), we.alias("w_end")).where(F.col("w_end") > F.col("w_start"))


def _week_of(ts, spec: ExperimentSpec):
    return (F.floor(IV.duration_micros(F.lit(spec.start), ts) / float(7 * 24 * IV.MICROS_PER_HOUR)) + 1).cast("int")


def _observed_by_week(spark, sf, windows: DataFrame, spec: ExperimentSpec) -> DataFrame:
    """O = W ∩ coverage per week.  Each coverage segment is tagged with the
    week(s) it touches and equi-joined on the week (W depends only on the
    week), then clipped to W."""
    weeks = windows.select("week", "w_start", "w_end").distinct()
    cov = coverage(spark, sf, spec)
    last = F.col("end") - F.expr("INTERVAL 1 MICROSECOND")
    cw = cov.select("start", "end", F.explode(F.sequence(_week_of(F.col("start"), spec), _week_of(last, spec))).alias("week"))
    j = cw.join(F.broadcast(weeks), "week").where((F.col("start") < F.col("w_end")) & (F.col("end") > F.col("w_start")))
    return j.select("week", F.greatest("start", "w_start").alias("start"), F.least("end", "w_end").alias("end"))


def _sku_state_pieces(spark, sf, observed: DataFrame, spec: ExperimentSpec) -> DataFrame:
    """State intervals at SKU level clipped to the observed spans of each
    week: (sku, week, start, end, sellable, out_of_stock).

    Both sides are cut into calendar-day buckets and equi-joined on the day
    (AQE broadcasts the observed side where it measures it small); pieces are
    clipped to the day as well, so no span is counted twice."""
    end = spec.end
    h = state_history(spark, sf).where(F.col("sku").isNotNull())
    h = h.select("sku", "sellable", "reason", F.greatest(F.col("desde"), F.lit(spec.start)).alias("start"),
                 clip_end(window_end=end).alias("end")).where(F.col("start") < F.col("end"))
    last = F.col("end") - F.expr("INTERVAL 1 MICROSECOND")
    hd = h.select("*", F.explode(F.sequence(F.to_date("start"), F.to_date(last))).alias("day"))
    od = observed.select(F.col("week").alias("o_week"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
                         F.explode(F.sequence(F.to_date(F.col("start")),
                                              F.to_date(F.col("end") - F.expr("INTERVAL 1 MICROSECOND")))).alias("day"))
    j = hd.join(od, "day").where((F.col("start") < F.col("o_end")) & (F.col("end") > F.col("o_start")))
    day_start = F.col("day").cast("timestamp_ntz")
    day_end = day_start + F.expr("INTERVAL 1 DAY")
    p = j.select("sku", F.col("o_week").alias("week"),
                 F.greatest("start", "o_start", day_start).alias("start"),
                 F.least("end", "o_end", day_end).alias("end"), "sellable",
                 (F.col("reason") == S.REASON_OUT_OF_STOCK).alias("out_of_stock"))
    return p.where(F.col("start") < F.col("end"))


def exposure_split(spark, sf, windows: DataFrame | None = None, spec: ExperimentSpec = JANUARY) -> tuple[DataFrame, DataFrame]:
    """Per (sku, week): hours sellable (V), out of stock and not sellable (Q),
    other observed (O − V − Q), no data (|W| − |O|), and unattributed hours for
    SKUs without any state row (so the parts always sum to the window)."""
    windows = windows if windows is not None else measure_windows(assignment(spark, sf, spec), spec)
    observed = stored(_observed_by_week(spark, sf, windows, spec), "observed")
    obs_h = observed.groupBy("week").agg(IV.total_hours("start", "end").alias("h_observed"))
    pieces = stored(_sku_state_pieces(spark, sf, observed, spec), "state-pieces")
    keys = ["sku", "week"]
    v = stored(IV.interval_union(pieces.where("sellable"), keys), "sellable")
    q = IV.interval_subtract(pieces.where("out_of_stock"), v, keys)
    vh = v.groupBy(*keys).agg(IV.total_hours("start", "end").alias("h_sellable"))
    qh = q.groupBy(*keys).agg(IV.total_hours("start", "end").alias("h_out_of_stock"))
    has_rows = pieces.select(*keys).distinct().withColumn("_has", F.lit(True))
    base = windows.select("sku", "week", "grp", "band", "w_start", "w_end",
                          IV.hours("w_start", "w_end").alias("h_window"))
    j = (base.join(obs_h, "week", "left").join(vh, keys, "left").join(qh, keys, "left")
             .join(has_rows, keys, "left"))
    ho, hv, hq = S.nz("h_observed"), S.nz("h_sellable"), S.nz("h_out_of_stock")
    has = F.coalesce("_has", F.lit(False))
    return j.select(*keys, "grp", "band", "w_start", "w_end", "h_window",
                    F.round(hv, 6).alias("h_sellable"), F.round(hq, 6).alias("h_out_of_stock"),
                    F.round(F.when(has, ho - hv - hq).otherwise(F.lit(0.0)), 6).alias("h_other"),
                    F.round(F.col("h_window") - ho, 6).alias("h_no_data"),
                    F.round(F.when(has, F.lit(0.0)).otherwise(ho), 6).alias("h_unattributed"),
                    ), v


def time_weighted_price(spark, sf, sellable: DataFrame, spec: ExperimentSpec = JANUARY) -> DataFrame:
    """Σ price·|price interval ∩ V| / Σ|…| per (sku, week); overlapping
    listings each add weight (not unioned)."""
    end = spec.end
    p = price_history(spark, sf).where(F.col("sku").isNotNull() & F.col("price").isNotNull())
    p = p.select("sku", "price", F.greatest(F.col("desde"), F.lit(spec.start)).alias("start"), clip_end(window_end=end).alias("end")) \
         .where(F.col("start") < F.col("end"))
    j = IV.overlap_join(p, sellable.select("sku", "week", "start", "end"), ["sku"])
    j = j.select("sku", F.col("b_week").alias("week"), F.col("a_price").alias("price"), IV.duration_micros("start", "end").alias("_us"))
    weight = F.sum((F.col("price") * 100).cast("decimal(28,4)") * F.col("_us")).cast("double") / 100.0
    return j.groupBy("sku", "week").agg(F.try_divide(weight, F.sum("_us").cast("double")).alias("published_price"))


def buybox_hours(spark, sf, sellable: DataFrame, spec: ExperimentSpec = JANUARY, catalog: DataFrame | None = None) -> DataFrame:
    """Winning ∩ sellable hours per (sku, week); SKUs without winning rows in
    the window are absent (→ null, not 0)."""
    end = spec.end
    b = buybox_history(spark, sf).where(F.col("winning") == F.lit(True))
    cat = (catalog if catalog is not None else item_catalog(spark, sf)).select("item_id", "sku")
    b = b.join(cat, "item_id").select("sku", F.col("desde").alias("start"), clip_end(window_end=end).alias("end")) \
         .where((F.col("start") < F.lit(end)) & (F.col("end") > F.lit(spec.start)))
    weeks = sellable.select("sku", "week").distinct()
    won = IV.overlap_join(b.where(F.col("start") < F.col("end")), sellable.select("sku", "week", "start", "end"), ["sku"])
    won = won.select("sku", F.col("b_week").alias("week"), "start", "end")
    inter = IV.interval_union(won, ["sku", "week"])
    h = inter.groupBy("sku", "week").agg(IV.total_hours("start", "end").alias("h_buybox"))
    present = b.select("sku").distinct()
    return weeks.join(present, "sku").join(h, ["sku", "week"], "left").select(
        "sku", "week", S.nz("h_buybox").alias("h_buybox"))


def last_cost(spark, sf) -> DataFrame:
    """Latest known positive unit cost and tax per SKU (DISTINCT ON sku ORDER
    BY date DESC)."""
    s = experiment_sales(spark, sf).where(F.col("unit_cost") > 0)
    return latest_per_key(s.select("sku", "date", "order_id", "unit_cost", "tax_pct"), ["sku"],
                          F.struct("date", "order_id")).select("sku", "unit_cost", "tax_pct")


def experiment_consolidate(spark, sf, spec: ExperimentSpec = JANUARY) -> DataFrame:
    catalog = stored(item_catalog(spark, sf), "catalog")
    windows = stored(measure_windows(assignment(spark, sf, spec, catalog), spec), "windows")
    exp, v = exposure_split(spark, sf, windows, spec)
    price = time_weighted_price(spark, sf, v, spec)
    bb = buybox_hours(spark, sf, v, spec, catalog)
    sd = sales_by_sku_day(experiment_sales(spark, sf))
    w = windows.select("sku", "week", F.to_date("w_start").alias("d0"), F.to_date("w_end").alias("d1"))
    sw = sd.join(w, (sd.sku == w.sku) & (sd.date >= w.d0) & (sd.date < w.d1)).drop(w.sku)
    sales = sw.groupBy("sku", "week").agg(
        exact_sum("units").alias("units"), F.sum("orders").alias("orders"), exact_sum("revenue").alias("revenue"),
        exact_sum("cost").alias("cost"), exact_sum("commission").alias("commission"),
        exact_sum("freight").alias("freight"), exact_sum("net").alias("net"))
    c = last_cost(spark, sf)
    j = (exp.join(price, ["sku", "week"], "left").join(bb, ["sku", "week"], "left")
            .join(sales, ["sku", "week"], "left").join(c, "sku", "left"))
    units = S.nz("units")
    margin = S.nz("revenue") - S.nz("cost") - S.nz("commission") - S.nz("freight")
    margin_net = S.nz("net") - S.nz("cost") - S.nz("commission") - S.nz("freight")
    sellable = F.col("h_sellable")
    price_ok = F.col("published_price").isNotNull() & (sellable > 0)
    markup = F.when(price_ok & (F.col("unit_cost") > 0),
                    S.tax_net("published_price", S.nz("tax_pct")) / F.col("unit_cost") - 1)
    return j.select(
        "sku", "week", "grp", "band", "h_window", "h_sellable", "h_out_of_stock", "h_other", "h_no_data",
        "h_unattributed", F.round("h_buybox", 6).alias("h_buybox"),
        F.round(units, 4).alias("units"), F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
        F.round(S.nz("revenue"), 4).alias("revenue"), F.round(margin, 4).alias("margin_gross_basis"),
        F.round(margin_net, 4).alias("margin_net"),
        F.round(F.when(units > 0, margin / units), 4).alias("margin_per_unit"),
        F.round(F.when(units > 0, S.nz("revenue") / units), 4).alias("avg_price"),
        F.round(F.when(price_ok, F.col("published_price")), 4).alias("published_price"),
        F.round(markup, 6).alias("markup"),
        F.round(F.when(sellable > 0, units / (sellable / 24.0)), 6).alias("units_per_sellable_day"))


def band_summary(consolidated: DataFrame) -> DataFrame:
    """Per band over SKU-weeks with exposure: sellable days, margin/day,
    margin/unit, units/day, mean markup, count."""
    m = consolidated.where(F.col("h_sellable") > 0)
    days = exact_sum("h_sellable") / 24.0
    g = m.groupBy("band").agg(days.alias("days"), exact_sum("margin_gross_basis").alias("margin"),
                              exact_sum("units").alias("units"), exact_avg("markup").alias("mean_markup"),
                              F.count(F.lit(1)).alias("sku_weeks"))
    return g.select("band", F.round("days", 4).alias("days"),
                    F.round(F.try_divide(F.col("margin"), F.when(F.col("days") != 0, F.col("days"))), 4).alias("margin_per_day"),
                    F.round(F.try_divide(F.col("margin"), F.when(F.col("units") != 0, F.col("units"))), 4).alias("margin_per_unit"),
                    F.round(F.try_divide(F.col("units"), F.when(F.col("days") != 0, F.col("days"))), 4).alias("units_per_day"),
                    F.round("mean_markup", 6).alias("mean_markup"), "sku_weeks")
