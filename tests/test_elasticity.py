import math

from marginflow.operators.aggregates import exact_sum
from marginflow.plans.elasticity import band_scores, elasticity_by_band

COLS = "sku string, quantity double, line_total double, net_price double, unit_cost double, commission double, freight double"


def sales(spark):
    rows = [(str(i % 7) if i % 9 else None, float(i % 4), 12.1 * (i % 4), 10.0, 5.0 + i % 5 if i % 11 else None, 0.5 * (i % 2), None) for i in range(300)]
    return spark.createDataFrame([*rows, ("nan", 1.0, float("nan"), 10.0, 5.0, 0.0, 0.0)], COLS)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")


def test_lines_are_read_once_and_no_lambda_is_interpreted(spark):
    df = band_scores(sales(spark))
    assert scans(df) == 1
    assert "lambdafunction" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_scores_agree_with_the_winners(spark):
    got = {r.band: r for r in band_scores(sales(spark)).collect()}
    won = elasticity_by_band(sales(spark)).collect()
    assert len(won) == len({r.sku for r in won}) > 0
    for band, r in got.items():
        mine = [x for x in won if x.winner_band == band]
        assert (r.skus_won, r.won_with_volume) == (len(mine), sum(x.with_volume for x in mine))
    assert sum(r.units for r in got.values()) == sales(spark).where("quantity <> 0 and unit_cost is not null").agg(exact_sum("quantity")).first()[0]
    assert not any(math.isnan(r.margin) for r in got.values())
