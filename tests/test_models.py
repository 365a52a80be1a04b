"""Normal functions, quantiles, ordering, drift, risk and boosted trees."""

import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.functions import normal
from shelfline.operators import aggregates, attribution, drift, economics, forecast, joins, kpi, models, orders, ranks, risk
from shelfline.plans import load_all

load_all()


def test_normal_functions(spark):
    nd = NormalDist()
    xs = [i / 10 for i in range(-80, 81)]
    ps = [0.001, 0.02, 0.075, 0.3, 0.5, 0.62, 0.925, 0.99, 0.9999, 1e-13]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", normal.norm_cdf(F.col("x")), normal.norm_pdf(F.col("x"))).collect()
    for x, c, d in got:
        assert abs(c - nd.cdf(x)) < 1e-14 and abs(d - nd.pdf(x)) < 1e-15
    for p, q in spark.createDataFrame([(p,) for p in ps], "p double").select("p", normal.norm_ppf(F.col("p"))).collect():
        assert abs(q - nd.inv_cdf(p)) < 1e-9


@pytest.mark.parametrize("life,want", [
    (3, (100, 0, 0.5, 7.98, 7.98, 288.30, 3.99, 50.0)), (1, (100, 0, 0.5, 7.98, 7.98, 288.30, 3.99, 50.0)),
    (7, (107, 7, 0.6207, 4.96, 11.96, 295.52, 7.12, 36.32))])
def test_newsvendor_goldens(spark, life, want):
    df = spark.createDataFrame([(100.0, 20.0, life)], "mean_demand double, std_demand double, shelf_life_days int")
    r = orders.optimal_order(df).first()
    got = (r.optimal_order_qty, r.safety_stock, round(r.critical_fractile, 4), round(r.expected_stockout_units, 2), round(r.expected_waste_units, 2),
           round(r.expected_net_profit, 2), round(r.spoilage_risk_score, 2), round(r.stockout_risk_score, 2))
    assert got == want


def test_newsvendor_defaults_and_bounds(spark):
    df = spark.createDataFrame([(0.0, None), (100.0, 0.0)], "mean_demand double, std_demand double")
    rows = orders.optimal_order(df).collect()
    assert [(r.mean_demand, r.std_demand) for r in rows] == [(0.1, 1.0), (100.0, 20.0)]
    assert all(0.5 <= r.critical_fractile <= 0.99 and 0 <= r.spoilage_risk_score <= 100 for r in rows)


def test_exact_quantiles_with_hot_values(spark):
    """Half of the rows hold one value; the result equals the built-in exact percentile."""
    rnd = random.Random(1)
    values = [("a", 7.0)] * 3000 + [("a", rnd.gauss(0, 50)) for _ in range(3000)] + [("b", float(i)) for i in range(101)] + [("b", None)]
    df = spark.createDataFrame(values, "k string, v double").repartition(8)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = dict(ranks.exact_quantiles(ranks.value_counts_by(df, ["k"], "v"), ["k"], "v", probs, buckets=16).collect())
    want = dict(df.groupBy("k").agg(F.percentile("v", probs)).collect())
    for k in want:
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[k], want[k]))


def test_running_totals(spark):
    df = spark.createDataFrame([(v % 2, float(v * 37 % 1009), v % 5 + 1) for v in range(1009)], "k int, v double, n int")
    got = ranks.running_totals(df, ["k"], "v", ["n"], buckets=8).collect()
    for k in (0, 1):
        rows = sorted((r.v, r.n, r.cum_n, r.total_n) for r in got if r.k == k)
        total = 0
        for _v, n, cum, all_n in rows:
            total += n
            assert cum == total
        assert rows[-1][3] == total


def test_drift_verdicts(spark):
    rnd = random.Random(42)
    base = spark.createDataFrame([(rnd.gauss(100, 15),) for _ in range(1000)], "x double")
    moved = spark.createDataFrame([(rnd.gauss(180, 25),) for _ in range(1000)], "x double")
    same = drift.dataset_drift(base, base, ["x"]).first()
    assert (same.psi, same.ks, same.p_value, same.drift_status) == (0.0, 0.0, 1.0, "NO_DRIFT")
    far = drift.dataset_drift(base, moved, ["x"]).first()
    assert far.drift_status == "CRITICAL_DRIFT" and far.retrain_recommended and far.psi > 0.2


def test_drift_codes_line_up(spark):
    """A category missing on one side does not shift the codes of the others."""
    base = spark.createDataFrame([("b",)] * 50 + [("c",)] * 50 + [("a",)], "c string")
    cur = spark.createDataFrame([("b",)] * 50 + [("c",)] * 50, "c string")
    codes = {(r.value, r.nb, r.nc) for r in drift.counted_values(base, cur, (), ["c"]).collect()}
    assert codes == {(0.0, 1, 0), (1.0, 50, 50), (2.0, 50, 50)}


def test_ks_pvalue_against_the_limit(spark):
    got = spark.range(1).select(drift.ks_pvalue(F.lit(0.1), F.lit(500), F.lit(500))).first()[0]
    lam = 0.1 * math.sqrt(250)
    want = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50))
    assert abs(got - want) < 1e-12


def test_metrics_with_empty_denominators(spark):
    m = forecast.forecast_metrics(spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y double, f double"), "y", "f").first()
    assert (m.wape, m.bias, m.r2, m.mae) == (0.0, 0.0, 0.0, 1.5)


def test_pr_auc_is_one_for_a_perfect_score(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)], "y int, p double")
    assert kpi.kpi_pr_auc(df, "y", "p").first().pr_auc == 1.0


def test_best_markdown_prefers_the_smaller_on_ties(spark):
    r = orders.best_markdown(spark.createDataFrame([(10, 5.0, 5.0)], "s bigint, p double, c double"), "s", "p", "c").first()
    assert (r.best_markdown_pct, r.units_cleared, r.net_recovery) == (0, 10, 0.0)


def test_economics_repeat_and_stay_in_range(spark):
    ids = spark.range(1, 866).select(F.col("id").cast("int").alias("product_id"))
    e = economics.product_economics(ids)
    assert e.filter("unit_margin <= 0 OR shelf_life_hours NOT BETWEEN 24 AND 336 OR category IS NULL").count() == 0
    assert e.exceptAll(economics.product_economics(ids)).count() == 0


def test_recovery_is_never_below_observed(spark, sf):
    from shelfline.plans.kpis import recovered

    assert recovered(spark, sf).filter("recovered_demand < observed_sales OR recovered_demand IS NULL").count() == 0


def test_boosted_trees_beat_the_mean(spark, sf):
    from shelfline.plans.modelling import split_features

    train, test = split_features(spark, sf)
    model = models.train(train, trees=3)
    out = models.score(model, test)
    assert out.count() == test.count() and out.filter("forecasted_demand < 0").count() == 0
    base = test.withColumn("m", F.lit(train.agg(F.avg("observed_sales")).first()[0]))
    rmse = forecast.forecast_metrics(out, "observed_sales", "forecasted_demand").first().rmse
    assert rmse <= forecast.forecast_metrics(base, "observed_sales", "m").first().rmse * 1.1
    assert abs(models.feature_importance(model, spark).agg(F.sum("importance")).first()[0] - 1.0) < 1e-9
    assert models.permutation_importance(model, test, ["hour"]).count() == 1


def test_calibration_is_monotone(spark):
    df = spark.createDataFrame([(int(i % 7 < i % 3), i % 100 / 100) for i in range(2000)], "stockout_flag int, stockout_probability double")
    model = risk.calibrate(df)
    points = model.transform(df.select(F.col("stockout_probability").alias("features")).distinct()).orderBy("features").collect()
    values = [p.prediction for p in points]
    assert values == sorted(values)


def test_ranking_counts_better_rows(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 3.0), ("d", 2.0), ("e", None)], "k string, v double")
    assert dict(aggregates.ranking(df, "v", descending=True).select("k", "place").collect()) == {"a": 1, "c": 1, "d": 3, "b": 4, "e": None}
    assert dict(aggregates.ranking(df, "v").select("k", "place").collect()) == {"b": 1, "d": 2, "a": 3, "c": 3, "e": None}


def test_text_ranks_with_a_common_beginning(spark):
    texts = [f"Customer#{i:09d}" for i in range(500)]
    df = spark.createDataFrame([("f", t, 1) for t in texts] + [("g", "x", 1)], "feature string, value string, n int").repartition(5)
    got = {(r.feature, r.value): r["rank"] for r in ranks.text_ranks(df, ["feature"], "value").collect()}
    assert all(got["f", t] == i for i, t in enumerate(texts)) and got["g", "x"] == 0


def test_drift_of_a_feature_without_a_baseline(spark):
    base = spark.createDataFrame([(None, float(i), None) for i in range(50)], "a double, b double, c string")
    cur = spark.createDataFrame([(float(i), float(i), None) for i in range(50)], "a double, b double, c string")
    got = {r.feature: r for r in drift.dataset_drift(base, cur, ["a", "b"], ["c"]).collect()}
    assert set(got) == {"a", "b", "c"}
    assert all((r.psi, r.ks, r.drift_status) == (0.0, 0.0, "NO_DRIFT") for r in got.values())


HOUR_COLUMNS = "store_id int, product_id int, event_date date, event_timestamp timestamp_ntz, hour_of_day int, is_weekend boolean, discount double, stockout_flag int, recovered_demand double"


def hours(spark, rows):
    """(store, product, day of January, hour, flag) rows."""
    from datetime import date, datetime

    return spark.createDataFrame([(s, p, date(2024, 1, d), datetime(2024, 1, d, h), h, False, 0.0, f, float(d)) for s, p, d, h, f in rows], HOUR_COLUMNS)


def test_a_series_that_starts_after_the_cut_is_scored(spark):
    rows = hours(spark, [(1, 1, d, 8, d % 2) for d in range(1, 11)] + [(2, 1, 10, 8, 1), (3, 9, 10, 8, 0), (3, 9, 10, 9, 0)])
    cut = F.lit("2024-01-08").cast("date")
    days = rows.groupBy("store_id", "product_id", F.col("event_date").cast("string").alias("dt")).agg(
        *[F.max(F.when(F.col("hour_of_day") == h, F.col("stockout_flag"))).alias(f"h{h}") for h in range(24)])
    daily = days.select("store_id", "product_id", "dt", F.lit(0.0).alias("discount"), F.array_repeat(F.lit(0.0), 24).alias("hours_sale"), F.array(*[F.col(f"h{h}") for h in range(24)]).alias("hours_stock_status"))
    scored = risk.score_by_rate(daily, cut).filter("event_date = '2024-01-10' AND stockout_flag IS NOT NULL")
    got = {(r.store_id, r.hour_of_day): r.stockout_probability for r in scored.collect()}
    # own rate, the product's rate, the hour's rate, none
    assert got == {(1, 8): 0.5714, (2, 8): 0.5714, (3, 8): 0.5714, (3, 9): None}
    out = forecast.with_forecast(rows.where(F.col("event_date") >= cut), rows.where(F.col("event_date") < cut))
    assert {r.store_id: r.forecast_median for r in out.filter("event_date = '2024-01-10'").collect()} == {1: 4.0, 2: None, 3: None}


def test_risk_lags_look_at_the_clock(spark):
    rows = hours(spark, [(1, 1, 1, 8, 1), (1, 1, 3, 8, 0), (1, 1, 4, 8, 0), (1, 1, 4, 9, 0), (1, 1, 4, 11, 0)])
    got = {(r.event_timestamp.day, r.hour_of_day): (r.prev_out, r.day_out) for r in risk.risk_features(rows, F.lit("2024-01-04").cast("date")).collect()}
    assert got[3, 8] == (0.0, 0.0)  # the day before is missing
    assert got[4, 9] == (0.0, 0.0) and got[4, 8] == (0.0, 0.0) and got[1, 8] == (0.0, 0.0)
    later = hours(spark, [(1, 1, 1, 8, 1), (1, 1, 1, 9, 0), (1, 1, 2, 8, 0)])
    got = {(r.event_timestamp.day, r.hour_of_day): (r.prev_out, r.day_out) for r in risk.risk_features(later, F.lit("2024-01-02").cast("date")).collect()}
    assert got[1, 9] == (1.0, 0.0) and got[2, 8] == (0.0, 1.0)


def test_band_table_join(spark):
    rows = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 4.9, 5.0, 12.0, 99.0)] + [(None,)], "v double")
    bands = spark.createDataFrame([(0.0, 5.0, "low"), (5.0, 20.0, "mid"), (10.0, 15.0, "extra")], "lo double, hi double, band string")
    got = sorted((str(r.v), str(r.band)) for r in joins.band_table_join(rows, "v", bands, 3.0).collect())
    assert got == sorted([("-1.0", "None"), ("0.0", "low"), ("4.9", "low"), ("5.0", "mid"), ("12.0", "mid"), ("12.0", "extra"), ("99.0", "None"), ("None", "None")])


def feature_table(spark, n=3000):
    """Rows of few distinct features, so that most share their bins; sales that depend on them and differ from row to row."""
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        store, product, day, hour, off = rnd.randrange(4), rnd.randrange(2), 1 + rnd.randrange(3), rnd.randrange(2), rnd.choice([0.7, 0.9])
        rows.append((20240100 + day, hour, store, product, store * 3.0 + hour * (1 - product) + 5 * off + day + rnd.random(), off, f"Cluster {rnd.randrange(3)}", "High", 2024, 1, day, hour))
    return spark.createDataFrame(rows, "date_key int, time_key int, store_id int, product_id int, observed_sales double, discount_factor double, store_cluster string, volume_band string, year int, month int, day int, hour int")


def test_trees_over_combinations_of_bins_are_those_of_all_rows(spark, monkeypatch):
    """The trainer gets a row for each combination; cuts, leaf values, gains and the rows of each node stay."""
    df, seen = feature_table(spark), {}
    fit, stored = models.GBTRegressor.fit, models.materialize
    monkeypatch.setattr(models.GBTRegressor, "fit", lambda self, rows: seen.update(trained=rows.count()) or fit(self, rows))
    monkeypatch.setattr(models, "materialize", lambda rows, name: seen.update({name: stored(rows, name)}) or seen[name])
    model = models.train(df, trees=4)
    assert 64 <= seen["trained"] < df.count() / 2
    whole = fit(models.GBTRegressor(labelCol="observed_sales", maxIter=4, stepSize=models.RATE, maxDepth=models.DEPTH, seed=models.SEED, maxBins=64), seen["features"])
    # splits that part the rows of a node alike have equal gains, and either may be taken; the rows of each leaf stay
    assert np.abs(model.trees.featureImportances.toArray() - whole.featureImportances.toArray()).max() < 1e-3
    predicted = [np.array([r[0] for r in t.transform(seen["features"].coalesce(1)).select("prediction").collect()]) for t in (model.trees, whole)]
    assert len(predicted[0]) == df.count() and np.abs(predicted[0] - predicted[1]).max() < 1e-9
    got, want = (sorted((round(leaf.value, 9), round(math.prod(leaf.shares), 9)) for leaf in attribution.attributor(t, spark, 9).leaves) for t in (model.trees, whole))
    assert np.abs(np.array(got) - np.array(want)).max() < 2e-9


def test_rows_that_share_no_bins_are_trained_as_they_are(spark, monkeypatch):
    df, seen = feature_table(spark).withColumn("discount_factor", F.rand(5)).where("store_id < 3").limit(40), []
    fit = models.GBTRegressor.fit
    monkeypatch.setattr(models.GBTRegressor, "fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    assert models.score(models.train(df, trees=2), df).count() == 40 and seen == [40]


def test_encodings_from_totals_are_those_of_the_rows(spark):
    df = feature_table(spark, 400).withColumn("_fold", F.pmod("hour", F.lit(models.FOLDS)).cast("int"))
    totals = models.fold_totals(df, "observed_sales")
    encoded = models.encode(df, {c: models.mean_encoding(totals, c) for c in models.IDS}, models.overall_mean(totals)).collect()
    rows = df.collect()
    for r in encoded[:60]:
        for c in models.IDS:
            others = [x.observed_sales for x in rows if x[c] == r[c] and x._fold != r._fold]
            assert abs(r[f"{c}_mean"] - sum(others) / len(others)) < 1e-9
    mean = sum(x.observed_sales for x in rows) / len(rows)
    assert abs(models.overall_mean(totals).first()[0] - mean) < 1e-9
    new = models.encode(df.drop("_fold").limit(1).withColumn("store_id", F.lit(99)), {"store_id": models.mean_encoding(totals, "store_id")}, models.overall_mean(totals)).first()
    assert abs(new.store_id_mean - mean) < 1e-9
    counts = [r[0] for r in df.groupBy("store_cluster").count().orderBy(F.desc("count"), "store_cluster").collect()]
    assert [list(m.labels) for m in models.band_index(totals)] == [counts, ["High"]]


def test_permuted_rows_are_ordered_once(spark, monkeypatch):
    """All features are exchanged in one stored table, with the values of an order for each feature alone."""
    df, seen = feature_table(spark, 600), []
    model, score = models.train(df, trees=2), models.score
    monkeypatch.setattr(models, "score", lambda m, rows: seen.append(rows) or score(m, rows))
    found = {r["feature"]: r["rmse_increase"] for r in models.permutation_importance(model, df, ["hour", "store_id"]).collect()}
    assert len(seen) == 3 and all("Window" not in rows._jdf.queryExecution().optimizedPlan().toString() for rows in seen)
    w = Window.partitionBy(F.pmod(F.xxhash64(*df.columns), F.lit(8))).orderBy(F.xxhash64(F.lit(models.SEED), *df.columns))
    rmse = lambda rows: forecast.forecast_metrics(score(model, rows), "observed_sales", "forecasted_demand").first()["rmse"]
    for f in ("hour", "store_id"):
        alone = df.withColumn("_v", F.coalesce(F.lead(f).over(w), F.col(f))).withColumn(f, F.col("_v")).drop("_v")
        assert abs(found[f] - (rmse(alone) - rmse(df))) < 1e-9
