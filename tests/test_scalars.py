"""Edge rows for the scalar functions (FIXTURES §3)."""

import datetime as dt

from pyspark.sql import functions as F

from marginflow.functions import scalars as S
from marginflow.functions.time import commercial_month, local_date


def _col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_local_date_formats(spark):
    got = _col(spark, ["2026-08-19", "2026-08-19T23:30:00.000-04:00", "2026-06-11T02:52:39+0000", "garbage", None],
               "string", local_date)
    assert got == [dt.date(2026, 8, 19), dt.date(2026, 8, 20), dt.date(2026, 6, 10), None, None]


def test_local_date_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = _col(spark, ["2026-08-19T21:30:00-03:00"], "string", local_date)
        assert got == [dt.date(2026, 8, 19)]      # 21:00–24:00 local stays on its day
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_commercial_month_edges(spark):
    got = _col(spark, [dt.date(2026, 1, 5), dt.date(2026, 1, 6), dt.date(2026, 3, 31), None], "date", commercial_month)
    assert got == ["2025-12", "2026-01", "2026-03", None]


def test_parse_percent(spark):
    got = _col(spark, ["50,00%", "0.5", "50", "1", "", "nan", None, "x"], "string", S.parse_percent)
    assert got == [50.0, 0.5, 50.0, 1.0, 0.0, 0.0, 0.0, 0.0]
    num = _col(spark, [0.5, 50.0, 1.0, None, float("nan")], "double", lambda c: S.parse_percent(c, numeric_input=True))
    assert num == [50.0, 50.0, 100.0, 0.0, 0.0]


def test_parse_decimal_comma(spark):
    got = _col(spark, ["2.460,85", "2460.85", "", "x", None, "nan"], "string", S.parse_decimal_comma)
    assert got == [2460.85, 2460.85, None, None, None, None]


def test_listing_reason_priority(spark):
    rows = [("active", ["out_of_stock", "paused_by_seller"], 5), ("active", [], 0), ("active", [], None),
            ("under_review", [], 3), ("closed", ["paused_by_seller"], 3), ("paused", [], 3), ("active", None, 2)]
    df = spark.createDataFrame(rows, "status string, sub array<string>, q int")
    got = [r[0] for r in df.select(S.listing_reason("status", "sub", "q")).collect()]
    assert got == ["out_of_stock", "out_of_stock", "out_of_stock", "under_review", "closed", "paused", "ok"]


def test_freight_key(spark):
    rows = [(10, None, "A"), (10, "sebastian cargas", "A"), (10, "SEBASTIAN X", "B"), (None, "SEBASTIAN", "A"),
            (11, "OTHER", "A")]
    df = spark.createDataFrame(rows, "p bigint, c string, u string")
    got = [r[0] for r in df.select(S.freight_key("p", "c", "u")).collect()]
    assert got == ["10", "10-A", "10-B", None, "11"]


def test_customer_tier_thresholds(spark):
    rows = [(True, True, False, 900_000.0), (True, True, False, 900_000.01), (True, False, True, 300_000.0),
            (True, False, True, 300_000.5), (True, True, True, 1.0), (False, False, False, None)]
    df = spark.createDataFrame(rows, "h boolean, a boolean, b boolean, t double")
    got = [r[0] for r in df.select(S.customer_tier("h", "a", "b", "t")).collect()]
    assert got == ["B1", "A", "C", "B2", "B1", "C"]


def test_margin_band_bounds(spark):
    got = _col(spark, [9.99, 10.0, 18.0, 25.0, 35.0, 35.01, None], "double", S.margin_band)
    assert got == ["<10", "10-18", "18-25", "25-35", ">35", ">35", None]


def test_label_codes_unknown_keeps_raw(spark):
    df = spark.createDataFrame([(" 001",), ("099 ",), (None,)], "c string")
    labels = spark.createDataFrame([("001", "North")], "code string, label string")
    got = {r.c: r.seller for r in S.label_codes(df, "c", labels, "Seller", "seller").collect()}
    assert got == {" 001": "North", "099 ": "Seller 099 ", None: None}
