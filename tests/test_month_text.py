import datetime as dt

from pyspark.sql import functions as F

from marginflow.functions.time import commercial_month, month_text


def test_commercial_months_of_any_year_equal_the_formatter(spark):
    days = [dt.date(y, m, d) for y in (1, 999, 1000, 1999, 2024, 9999) for m in (1, 2, 9, 10, 12) for d in (5, 6, 28)] + [None]
    df = spark.createDataFrame([(d,) for d in days if d is None or d > dt.date(1, 1, 6)], "d date")
    shift = F.when(F.dayofmonth("d") >= 6, 0).otherwise(-1)
    got = df.select(commercial_month("d").alias("a"), F.date_format(F.add_months("d", shift), "yyyy-MM").alias("b")).collect()
    assert all(r.a == r.b for r in got) and got[-1].a is None


def test_month_text_of_numbers_equals_format_string(spark):
    df = spark.createDataFrame([(y, m) for y in (None, -3, 0, 7, 1000, 1995, 9999, 12345) for m in (1, 9, 10, 12, None)], "y int, m int")
    old = F.format_string("%04d-%02d", "y", "m")
    for r in df.where("m is not null").select(month_text(F.col("y"), F.col("m"), old).alias("a"), old.alias("b")).collect():
        assert r.a == r.b


def test_the_formatter_is_not_run_on_four_digit_years(spark):
    boom = F.raise_error(F.lit("formatter")).cast("string")
    assert spark.range(1).select(month_text(F.lit(1998), F.lit(3), boom).alias("a")).first().a == "1998-03"
