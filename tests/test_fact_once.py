"""The fact of all channels reads the sales lines once."""

import datetime as dt

from pyspark.sql import functions as F

from marginflow.functions.time import commercial_month
from marginflow.plans import fact as FCT
from marginflow.registry import fact_sources, sheets
from marginflow.sources import roles as R

SF = "/root/testdata/sf0.001"


def test_lines_are_read_once_and_the_fact_is_that_of_separate_sources(spark, monkeypatch):
    read, seen = R.read_table, []
    monkeypatch.setattr(R, "read_table", lambda s, d, name: seen.append(name) or read(s, d, name))
    once = FCT.fact_sales(fact_sources(spark, SF))
    assert seen.count("lineitem") == 1
    assert "lineitem.parquet" not in once._jdf.queryExecution().executedPlan().toString()
    names = ["erp_sales", "erp_articles", "web_order_items", "market_orders", "market_order_items", "market_shipments"]
    apart = FCT.fact_sales({n: getattr(R, n)(spark, SF) for n in names} | sheets(spark, SF))
    assert once.count() == apart.count() > 0
    assert once.exceptAll(apart).isEmpty() and apart.exceptAll(once).isEmpty()


def test_landed_lines_keep_orders_of_every_priority(spark):
    landed = R.landed_lines(spark, SF)
    n = R.read_table(spark, SF, "lineitem").count()
    assert landed.count() == n
    by = {r["channel"]: r["count"] for r in landed.groupBy("channel").count().collect()}
    assert set(by) <= {"wholesale", "webstore", "marketplace", "other"}


def test_sold_months_at_the_border_of_two(spark):
    days = [dt.date(2019, 12, 31) + dt.timedelta(days=i) for i in range(400)]
    rows = [(i, dt.datetime.combine(d, dt.time(12))) for i, d in enumerate(days)]
    landed = spark.createDataFrame(rows + rows, "l_partkey long, o_orderdate timestamp_ntz")
    got = {tuple(r) for r in R.sold_sku_months(spark, SF, landed).collect()}
    near = spark.createDataFrame([(i, d + dt.timedelta(days=k)) for i, d in enumerate(days) for k in (-1, 0, 1)], "p long, d date")
    want = {tuple(r) for r in near.select("p", commercial_month("d")).distinct().collect()}
    assert got == want
    assert R.sold_sku_months(spark, SF, landed).count() == len(want)
    assert R.sold_sku_months(spark, SF, landed.where(F.lit(False))).count() == 0
