"""Forecast and risk by horizon on small frames."""

import datetime
import random
from math import prod

import pytest
from pyspark.sql import functions as F

from shelfline.operators import horizon
from shelfline.operators.forecast import HORIZONS, QUANTILES
from shelfline.plans import load_all

QUERIES = load_all()[0]
START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def forecasts(spark, sf):
    return QUERIES["fc2_horizon_forecast"](spark, sf).toPandas()


def test_quantiles_do_not_cross_and_depend_on_the_horizon(forecasts):
    names = list(QUANTILES)
    assert (forecasts[names].diff(axis=1).iloc[:, 1:] >= 0).all().all() and (forecasts[names] >= 0).all().all()
    one = forecasts[(forecasts.store_id == forecasts.store_id.min()) & (forecasts.product_id == forecasts.product_id.min())]
    by = one.pivot(index="event_timestamp", columns="horizon_hours", values="forecast_median")
    assert set(by.columns) == set(HORIZONS) and (by[1] != by[24]).any()


def test_loss_is_below_that_of_the_cells(spark):
    rows = QUERIES["fc2_horizon_pinball"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(HORIZONS) and all(r.better for r in rows)


def series(spark, values, flags=None, first=START, product=1):
    rows = [(1, product, first + datetime.timedelta(days=i // 16, hours=6 + i % 16), float(v), int(flags[i]) if flags else 0) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "store_id int, product_id int, event_timestamp timestamp_ntz, recovered_demand double, stockout_flag int")
    return df.withColumns({"event_date": F.to_date("event_timestamp"), "hour_of_day": F.hour("event_timestamp"), "is_weekend": F.weekday("event_timestamp") >= 5})


def test_origins_see_nothing_later(spark):
    df = series(spark, range(32))
    got = {(r.event_timestamp, r.horizon_hours): r for r in horizon.at_origins(df, "recovered_demand").collect()}
    at = lambda day, hour: START + datetime.timedelta(days=day, hours=hour)
    assert got[at(0, 6), 1].last is None and got[at(0, 7), 1].last == 0.0 and got[at(0, 7), 4].last is None
    # at night the last trading hour is known; a day back is the same hour
    assert got[at(1, 6), 1].last == 15.0 and got[at(1, 6), 24].last == 0.0 and got[at(1, 9), 4].last == 15.0
    assert got[at(1, 6), 1].day == sum(range(16)) / 16 and got[at(1, 7), 24].day == 0.5


def test_fit_finds_the_quantiles_of_shifted_noise(spark):
    """Cells say nothing, the last hour tells the level: the regression learns to follow it."""
    rnd = random.Random(2)
    rows = [(h, 50.0 + level + rnd.uniform(-1, 1), [50.0] * 5, [50.0] * 5, float(level), 0.0) for h in (1, 24) for level in range(-20, 21) for _ in range(40)]
    df = spark.createDataFrame(rows, "horizon_hours int, y double, cell array<double>, series array<double>, d1 double, d2 double")
    model = horizon.fit_horizons(df, "y", steps=200)
    for h in (1, 24):
        for q, p in enumerate(QUANTILES.values()):
            b = model.coefficients[h, q]
            assert abs(b[2] - 1) < 0.05 and abs(b[0] * model.scale - (2 * p - 1)) < 1.1
    out = model.forecast(df).filter("d1 = 20 AND horizon_hours = 1").first()
    assert 65 < out.forecast_q10 < out.forecast_median < out.forecast_q90 < 76


def test_risk_is_one_minus_the_product_of_survivals(spark):
    rnd = random.Random(3)
    flags = [rnd.random() < 0.3 for _ in range(16 * 12)]
    df = series(spark, flags, flags).select("store_id", "product_id", "event_date", "event_timestamp", "hour_of_day", "stockout_flag")
    cut = F.lit("2024-01-09").cast("date")
    train = [(i % 16, flags[i]) for i in range(1, 16 * 8) if not flags[i - 1]]
    n = horizon.PRIOR
    overall = {h: sum(f for k, f in train if k == h) / max(1, sum(k == h for k, _ in train)) for h in range(16)}
    count = {h: (sum(f for k, f in train if k == h), sum(k == h for k, _ in train)) for h in range(16)}
    middle = {h: (e + n * overall[h]) / (m + n) for h, (e, m) in count.items()}
    rate = {h + 6: (count[h][0] + n * middle[h]) / (count[h][1] + n) for h in range(16)}
    found = horizon.stockout_within(df, cut).collect()
    assert {r.horizon_hours for r in found} == {4, 8, 12, 24}
    for r in found:
        hour = r.event_timestamp.hour
        assert abs(r.stockout_risk - (1 - prod(1 - rate.get((hour + k) % 24, 0.0) for k in range(1, r.horizon_hours + 1)))) < 1e-12
        i = (r.event_timestamp - START).days * 16 + hour - 6
        ahead = [flags[j] for j in range(i + 1, len(flags)) if (j // 16 * 24 + j % 16) - (i // 16 * 24 + i % 16) <= r.horizon_hours]
        assert not flags[i] and r.occurred == max(ahead)


def test_risk_rises_with_the_horizon(spark, sf):
    p = QUERIES["rk1_hazard_risk"](spark, sf).toPandas().pivot_table(index=["store_id", "product_id", "event_timestamp"], columns="horizon_hours", values="stockout_risk")
    assert len(p) and (p.diff(axis=1).iloc[:, 1:].fillna(0) >= 0).all().all()


def test_nothing_to_fit(spark):
    df = series(spark, range(16)).withColumn("observed_sales", F.lit(0.0))
    late = F.lit("2024-02-01").cast("date")
    assert horizon.horizon_forecasts(df, late, late).count() == 0
    assert horizon.stockout_within(df.drop("recovered_demand"), late).count() == 0


def test_a_step_reads_one_row_for_each_hour_and_horizon(spark, monkeypatch):
    """All quantiles of an hour are fitted from one stored row, and the windows are stored before the hours are repeated."""
    stored, keep = {}, horizon.materialize

    def counted(df, name):
        out = keep(df, name)
        stored[name] = out.count()
        return out

    monkeypatch.setattr(horizon, "materialize", counted)
    df = series(spark, [i % 7 for i in range(16 * 12)])
    middle, cut = (F.lit(d).cast("date") for d in ("2024-01-05", "2024-01-09"))
    assert horizon.horizon_forecasts(df, middle, cut).count() == 4 * 16 * len(HORIZONS)
    assert stored == {"origins": 8 * 16, "horizon-rows": 4 * 16 * len(HORIZONS)}
