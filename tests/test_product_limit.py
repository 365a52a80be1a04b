"""The product-limit estimate against a plain count, and on rows cut by a known rule."""

import math
import random

from pyspark.sql import functions as F

from shelfline.operators import forecast as fc

ROW = "store_id int, product_id int, hour_of_day int, is_weekend boolean, sold double, cut boolean"


def by_hand(group, v):
    """Value expected above v: survival at each distinct value, and the area beyond."""
    values = sorted({x for x, _ in group})
    height, curve = 1.0, {}
    for x in values:
        at_risk = sum(y >= x for y, _ in group)
        height *= 1 - sum(y == x and not c for y, c in group) / at_risk
        curve[x] = height
    area = sum(curve[a] * (b - a) for a, b in zip(values, values[1:]) if a >= v)
    return v + area / curve[v] if curve[v] else v


def estimates(spark, rows, **settings):
    out = fc.above_cut(spark.createDataFrame(rows, ROW), "sold", F.col("cut"), **settings).collect()
    return {(r.store_id, r.product_id, r.hour_of_day, r.is_weekend, r.sold, r.cut): r.expected_above for r in out}


def test_equal_to_a_plain_count_with_ties(spark):
    draw = random.Random(3)
    rows = [(1, 1, draw.choice((8, 9)), draw.random() < 0.3, float(draw.randint(0, 6)), draw.random() < 0.4) for _ in range(120)]
    found = estimates(spark, rows, least=12)
    levels = [4, 3, 2]
    for row in rows:
        for n in levels:
            group = [(r[4], r[5]) for r in rows if r[:n] == row[:n]]
            ends = sum(not c for _, c in group)
            if ends >= (1 if n == 2 else 12):
                assert math.isclose(found[row], by_hand(group, row[4]), rel_tol=1e-9)
                break


def test_nulls_and_series_without_an_end(spark):
    found = estimates(spark, [(1, 1, 8, False, None, False), (1, 1, 8, False, 2.0, None), (1, 1, 8, False, 1.0, True), (1, 1, 9, False, 3.0, False),
                              (2, 1, 8, False, 5.0, True), (None, 1, 8, None, 1.0, True), (None, 1, 9, None, 4.0, False)])
    assert found[1, 1, 8, False, None, False] is None and found[1, 1, 8, False, 2.0, None] is None
    assert found[1, 1, 8, False, 1.0, True] == 3.0  # the row without a known cut is not at risk
    assert found[2, 1, 8, False, 5.0, True] is None
    assert found[None, 1, 8, None, 1.0, True] == 4.0
    assert estimates(spark, []) == {}


def test_unbiased_where_the_mean_is_not(spark):
    draw = random.Random(11)
    rows = []
    for i in range(6000):
        truth, stock = draw.expovariate(1 / 30), draw.uniform(0, 120)
        rows.append((1 + i % 3, 1, 8, False, min(truth, stock), stock < truth, truth))
    df = spark.createDataFrame(rows, ROW + ", truth double")
    got = {r.method: r for r in fc.cut_backtest(df).collect()}
    assert abs(got["product_limit"].bias) < 5 and got["mean"].bias < -15
    assert got["product_limit"].rmse < got["mean"].rmse and got["product_limit"].mae < got["mean"].mae


def test_backtest_on_the_given_hours(spark, sf):
    from shelfline.plans.cleaning import hourly

    got = {r.method: r for r in fc.cut_backtest(fc.hidden_cuts(hourly(spark, sf, True))).collect()}
    assert got["product_limit"].n == got["mean"].n > 0
    assert got["product_limit"].rmse < got["mean"].rmse and abs(got["product_limit"].bias) < abs(got["mean"].bias)


def test_one_exchange_for_all_levels(spark):
    df = spark.createDataFrame([(1, 1, 8, False, 1.0, True)], ROW)
    plan = fc.above_cut(df, "sold", F.col("cut"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
