"""Loads in steps give the result of one load, whatever arrives late or is skipped."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from shelfline.operators import gold, incremental, islands
from shelfline.session import materialize, scratch_path
from shelfline.sources import tables

DAY = "date_key"


@pytest.fixture(scope="module")
def daily(spark, sf):
    return materialize(tables.daily(spark, sf), "daily")


def files(path, pattern="*"):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path.removeprefix('file:')}/{DAY}={pattern}/part-*")}


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# conditions on the daily rows of each delivery; the last one delivers everything
PLANS = {
    "late days of some series": ["to_date(dt) < '2024-01-12' AND (day(to_date(dt)) + product_id) % 5 <> 0", "true"],
    "a series that skips the boundary": ["to_date(dt) < '2024-01-16' AND NOT (store_id = 2 AND product_id = 704 AND to_date(dt) = '2024-01-14')", "to_date(dt) < '2024-01-16'", "true"],
    "a new store with old days": ["store_id <> 1 AND to_date(dt) < '2024-01-20'", "true"],
    "the first days last": ["to_date(dt) >= '2024-01-10'", "true"],
    "day after day": [f"to_date(dt) <= '2024-01-{d:02d}'" for d in (13, 14, 15, 16, 17)] + ["true"],
}


@pytest.mark.parametrize("plan", PLANS)
def test_incidents_of_steps_are_those_of_one_load(daily, plan):
    have = daily.where(PLANS[plan][0])
    found = islands.incidents_from_daily(have)
    for step in PLANS[plan][1:]:
        now = daily.where(step)
        found = materialize(incremental.reload_incidents(found, now, now.join(have, ["store_id", "product_id", "dt"], "left_anti")), "incidents")
        have = now
    keys = ["store_id", "product_id", "incident_start", "incident_end", "duration_hours"]
    assert rows_of(found.select(*keys)) == rows_of(islands.incidents_from_daily(daily).select(*keys))


@pytest.mark.parametrize("plan", ["late days of some series", "a new store with old days", "the first days last"])
def test_facts_of_steps_are_those_of_one_load(spark, daily, plan):
    stores, products = gold.dim_store(daily, gold.dim_city(daily)), gold.dim_product(daily)
    path = scratch_path(spark, "facts")
    for step in PLANS[plan]:
        incremental.load(gold.sales_from_daily(daily.where(step), stores, products, "b"), path, "event_timestamp", DAY)
    whole = gold.sales_from_daily(daily, stores, products, "b")
    assert rows_of(spark.read.parquet(path).select(*whole.columns)) == rows_of(whole)
    # a load without anything new touches nothing
    before = files(path)
    assert incremental.load(whole, path, "event_timestamp", DAY).count() == 0 and files(path) == before
    marks = rows_of(spark.read.parquet(f"{path}-marks").select("store_id", "product_id", "mark"))
    assert marks == rows_of(whole.groupBy("store_id", "product_id").agg(F.max("event_timestamp")))


def test_untouched_partitions_keep_their_files(spark, daily):
    stores, products = gold.dim_store(daily, gold.dim_city(daily)), gold.dim_product(daily)
    fact = gold.sales_from_daily(daily, stores, products, "b")
    path = scratch_path(spark, "facts")
    one = "date_key = 20240105 AND store_id = 1"
    incremental.load(fact.where(f"NOT ({one}) AND date_key < 20240120"), path, "event_timestamp", DAY)
    before = files(path)
    late = incremental.load(fact.where("date_key < 20240120"), path, "event_timestamp", DAY)
    assert 0 < late.count() == fact.where(one).count()
    after = files(path)
    assert set(files(path, "20240105")).isdisjoint(before)
    assert {f: t for f, t in before.items() if "20240105" not in f} == {f: t for f, t in after.items() if "20240105" not in f}


def test_late_rows_are_looked_up_only_where_keys_differ(spark):
    schema = "store_id int, product_id int, ts int, day int"
    target = spark.createDataFrame([(1, 1, 10, 1), (1, 1, 20, 2), (2, 1, 30, 3)], schema)
    src = spark.createDataFrame([(1, 1, 10, 1), (1, 1, 20, 2), (2, 1, 30, 3), (2, 1, 5, 1), (1, 1, 25, 3), (3, 1, 1, 1)], schema)
    new = incremental.arrivals(src, target, incremental.high_water(target, "ts"), "ts", "day")
    assert rows_of(new) == [(1, 1, 25, 3), (2, 1, 5, 1), (3, 1, 1, 1)]
    assert incremental.arrivals(src, None, None, "ts", "day").count() == 6
    assert incremental.arrivals(src.limit(0), target, incremental.high_water(target, "ts"), "ts", "day").count() == 0
