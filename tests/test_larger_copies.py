"""Queries whose answers changed only on larger tables, on copies small enough for a test."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.operators import attribution, forecast, incremental, orders
from shelfline.operators.ranks import bounded_quantiles, exact_quantiles, value_counts_by
from shelfline.plans import load_all
from shelfline.session import materialize
from shelfline.sources import tables
from tests.compare import connect, difference

QUERIES, ORACLE = load_all()


@pytest.fixture()
def copies(tmp_path, sf):
    """A folder with the given tables as (number of copies, replaced columns; k is the number of the copy)."""
    def make(**tables):
        con = duckdb.connect()
        for name, (n, replaced) in tables.items():
            con.execute(f"COPY (SELECT * REPLACE ({replaced}) FROM '{sf}/{name}.parquet', (SELECT unnest(range({n})) AS k)) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        for file in os.listdir(sf):
            if not os.path.exists(tmp_path / file):
                os.symlink(f"{sf}/{file}", tmp_path / file)
        return str(tmp_path)
    return make


def same(spark, path, name):
    bad = difference(QUERIES[name](spark, path), connect(path), ORACLE[name])
    assert bad is None, bad


def test_store_numbers_past_the_contract_are_warnings(spark, copies):
    same(spark, copies(events=(1, "user_id + 9000 AS user_id")), "q_d3_contract_violations")


def test_ks_is_exact_for_more_than_a_thousand_values(spark, copies):
    same(spark, copies(customer=(200, "c_custkey + 150 * k AS c_custkey, c_acctbal + k AS c_acctbal")), "dr3_exact_small_samples")


def test_bounded_quantiles_have_the_last_digit_of_the_sql(spark):
    """Values that lie on a quantile are compared with it, so the last digit counts."""
    rows = [(g, round(((g * 7919 + i * 104729) % 9973) / 97, 2)) for g in range(2000) for i in range(2 + g % 21)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (g INTEGER, v DOUBLE)")
    con.execute("INSERT INTO t SELECT unnest(?), unnest(?)", [[r[0] for r in rows], [r[1] for r in rows]])
    expected = dict(con.execute("SELECT g, quantile_cont(v, [0.1, 0.25, 0.5, 0.75, 0.9]) FROM t GROUP BY g").fetchall())
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    assert {r["g"]: r["q"] for r in bounded_quantiles(df, ["g"], "v", probs, "q").collect()} == expected
    assert {r["g"]: r["quantiles"] for r in exact_quantiles(value_counts_by(df.where("g < 25"), ["g"], "v"), ["g"], "v", probs).collect()} == {g: q for g, q in expected.items() if g < 25}


def test_bounded_quantiles_of_odd_groups(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (2, None), (3, 1.0), (3, 1.0)], "g int, v double")
    found = {r["g"]: r["quantiles"] for r in bounded_quantiles(df, ["g"], "v", [0.0, 0.9, 1.0]).collect()}
    assert found == {1: None, 2: [5.0] * 3, 3: [1.0] * 3}


def test_a_mean_that_equals_a_sale_is_that_sale(spark):
    """The sum of these values over five is 80.01 only to the last digit, which depends on their order."""
    sold = [9.32, 109.14, 75.99, 125.59, 80.01]
    days = [(f"2024-01-{d:02d}", v) for d, v in zip((1, 3, 19, 23, 24), sold)] + [("2024-01-25", None)]
    hours = spark.createDataFrame([(1, 1, 7, False, int(v is None), v or 0.0) for _, v in days], "store_id int, product_id int, hour_of_day int, is_weekend boolean, stockout_flag int, observed_sales double")
    for order in ("observed_sales", "-observed_sales", "hash(observed_sales)"):
        rows = hours.orderBy(F.expr(order)).coalesce(1)
        assert [r[0] for r in forecast.recover_demand(rows).where("stockout_flag = 1").select("recovered_demand").collect()] == [80.01]
    slots = lambda x: "array(" + ", ".join(str(x if h == 7 else 0.0) + "D" for h in range(24)) + ")"
    daily = spark.sql(" UNION ALL ".join(f"SELECT 1 AS store_id, 1 AS product_id, '{d}' AS dt, {slots(v or 0.0)} AS hours_sale, array_repeat({int(v is None)}, 24) AS hours_stock_status" for d, v in days))
    assert [r[0] for r in forecast.recover_daily(daily).where("dt = '2024-01-25'").selectExpr("hours_recovered[1]").collect()] == [80.01]


def test_stored_keys_are_never_broadcast(spark):
    """Stored facts are small as files (their columns repeat) and large as rows."""
    keys = ["store_id", "product_id"]
    rows = spark.range(50).selectExpr("int(id % 5) AS store_id", "1 AS product_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, int(id DIV 5)) AS ts", "20240101 AS day")
    held = materialize(rows.where("hour(ts) <> 3"), "held")
    new = incremental.arrivals(rows, held, incremental.high_water(held, "ts"), "ts", "day", keys)
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=merge)" in next(line for line in plan.splitlines() if "LeftAnti" in line and "ts#" in line)
    assert sorted(r["store_id"] for r in new.collect()) == [0, 1, 2, 3, 4]


def test_conditions_shared_by_leaves_are_tried_once(monkeypatch):
    """Many leaves with the same few conditions: the answers stay those of the definition, over more than one slice, and each condition is tried once a slice."""
    calls, isin = [], np.isin
    monkeypatch.setattr(attribution.np, "isin", lambda *args: calls.append(1) or isin(*args))
    rng = np.random.default_rng(5)
    conditions = [(0, -np.inf, 0.4, None), (0, 0.4, np.inf, None), (1, 0.2, 0.9, None), (2, -np.inf, np.inf, frozenset({1.0, 3.0}))]
    leaves = []
    for i in range(60):
        own = [conditions[i % 2], conditions[2], conditions[3]]
        leaf = attribution.Leaf([c[0] for c in own], [c[1] for c in own], [c[2] for c in own], [c[3] for c in own], [0.5, 0.7, 0.3], float(rng.normal()))
        leaf.table = attribution.pattern_table(leaf)
        leaves.append(leaf)
    x = np.column_stack([rng.uniform(0, 1, 5000), rng.uniform(0, 1, 5000), rng.integers(0, 4, 5000)])
    expected = np.zeros((5000, 3))
    for leaf in leaves:
        for r, row in enumerate(x):
            if r % 50 == 0:
                code = sum((lo < row[f] <= hi and (kinds is None or row[f] in kinds)) << j for j, (f, lo, hi, kinds) in enumerate(zip(leaf.features, leaf.low, leaf.high, leaf.categories)))
                expected[r, leaf.features] += leaf.table[code]
    found = attribution.Attributor(leaves, 0.0, 3).attribute(x)
    assert np.abs(found[::50] - expected[::50]).max() < 1e-12
    assert len(calls) == 2


def test_order_lines_are_dealt_in_bounded_shares(spark, sf, monkeypatch):
    """The tasks grow with the lines, and one exchange serves the demand of a day and its statistics; no task gathers lines before it."""
    monkeypatch.setattr(tables, "TASK_LINES", 250)
    demand = tables.order_demand(spark, sf)
    lines = tables.table(spark, sf, "lineitem").count()
    shares = demand.groupBy(F.spark_partition_id()).agg(F.sum("n_lines").alias("n")).collect()
    assert sum(r["n"] for r in shares) == lines and max(r["n"] for r in shares) < 2 * 250
    plan = orders.demand_stats(demand)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert plan.count("Exchange") == 1 and "Aggregate" not in before
    same(spark, sf, "nv1_demand_stats")


def test_product_limit_tasks_sort_bounded_shares(spark, sf, monkeypatch):
    """The tasks that sort grow with the hours, not the hours of a task."""
    from shelfline.plans.cleaning import hourly

    hours = hourly(spark, sf, True)
    monkeypatch.setattr(forecast, "TASK_HOURS", 100)
    shared = forecast.recover_censored(hours)
    assert shared.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < hours.count() / 8
    same(spark, sf, "fc1_product_limit")
