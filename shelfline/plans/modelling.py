"""Feature, model, forecast, risk and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.operators import attribution, drift, features, gold, joins, kpi
from shelfline.operators import forecast as fc
from shelfline.operators import models, risk
from shelfline.plans.catalog import HOURLY, ORDER_DEMAND, query, rounded
from shelfline.plans.cleaning import hourly
from shelfline.plans.ingestion import UNIFORM
from shelfline.plans.kpis import EVALUATED, FVA, RECOVERED, SCORED, cut, evaluated, recovered, scored, with_baseline
from shelfline.session import materialize, shuffle_width
from shelfline.sources import tables


def feature_rows(spark, sf):
    """Hourly facts with the store attributes and date parts."""
    d = tables.daily(spark, sf)
    stores = gold.dim_store(d, gold.dim_city(d))
    h = hourly(spark, sf).withColumn("ingestion_batch_id", F.lit("b1"))
    fact = gold.fact_sales_hourly(h, stores, gold.dim_product(d))
    return features.demand_features(joins.feature_extract(fact, stores))


@query("ml1_features", ctes=HOURLY, sql="""SELECT CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour_of_day AS SMALLINT) AS time_key, store_id, product_id, observed_sales,
discount AS discount_factor, 'Cluster A' AS store_cluster, 'High' AS volume_band, CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month,
CAST(day(event_date) AS INTEGER) AS day, hour_of_day AS hour FROM hourly""")
def _(spark, sf):
    return feature_rows(spark, sf)


@query("ml2_random_split", sql=f"""SELECT event_id, CASE WHEN {UNIFORM.format("'42:' || event_id")} < 0.2 THEN 'test' ELSE 'train' END AS split FROM events""")
def _(spark, sf):
    return features.random_split(tables.table(spark, sf, "events").select("event_id"), ["event_id"])


@query("ml3_temporal_split", ctes=ORDER_DEMAND + """, dates AS (SELECT dt, row_number() OVER (ORDER BY dt) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT dt FROM demand))""",
       sql="""SELECT store_id, product_id, dt, CASE WHEN i <= ceil(n * 0.7::DOUBLE) THEN 'train' WHEN i <= ceil(n * 0.7::DOUBLE) + 1 THEN 'embargo' WHEN i <= ceil(n * 0.85::DOUBLE) THEN 'validation'
WHEN i <= ceil(n * 0.85::DOUBLE) + 1 THEN 'embargo' ELSE 'test' END AS split FROM demand JOIN dates USING (dt)""")
def _(spark, sf):
    return features.temporal_split(tables.order_demand(spark, sf).select("store_id", "product_id", "dt"), "dt")


def split_features(spark, sf):
    keys = ["store_id", "product_id", "date_key", "time_key"]
    marked = features.random_split(feature_rows(spark, sf), keys)
    return marked.filter("split = 'train'").drop("split"), marked.filter("split = 'test'").drop("split")


def demand_model(spark, sf):
    """The fitted model and the held-out rows."""
    train, test = split_features(spark, sf)
    return models.train(train), test


@query("ml4_boosted_trees")
def _(spark, sf):
    """Metrics of the boosted trees on the held-out rows."""
    model, test = demand_model(spark, sf)
    return fc.forecast_metrics(models.score(model, test), "observed_sales", "forecasted_demand")


@query("ml5_forecast_metrics", ctes=EVALUATED, sql="""SELECT product_id, count(*) AS n, round(avg(abs(q50 - actual)), 6) AS mae, round(sqrt(avg((q50 - actual) ** 2)), 6) AS rmse,
round(1 - sum((q50 - actual) ** 2) / (var_pop(actual) * count(*)), 6) AS r2, round(sum(abs(q50 - actual)) / sum(abs(actual)) * 100, 6) AS wape, round(sum(q50 - actual) / sum(actual) * 100, 6) AS bias
FROM evaluated GROUP BY ALL""")
def _(spark, sf):
    return rounded(fc.forecast_metrics(evaluated(spark, sf), "actual", "forecast_median", ["product_id"]))


@query("ml6_best_run", ctes=FVA, sql="""SELECT run_id, round(rmse, 6) AS rmse FROM (SELECT 'median' AS run_id, sqrt(avg((q50 - actual) ** 2)) AS rmse FROM naive
UNION ALL SELECT 'seasonal_naive', sqrt(avg((naive_forecast - actual) ** 2)) FROM naive UNION ALL SELECT 'q75', sqrt(avg((q75 - actual) ** 2)) FROM naive) ORDER BY rmse LIMIT 1""")
def _(spark, sf):
    """The best of three candidate forecasts by RMSE."""
    rows = with_baseline(spark, sf).filter("naive_forecast IS NOT NULL")
    pairs = F.array(*[F.struct(F.lit(n).alias("run_id"), F.col(c).alias("forecast")) for n, c in
                      (("median", "forecast_median"), ("seasonal_naive", "naive_forecast"), ("q75", "forecast_q75"))])
    m = fc.forecast_metrics(rows.select("actual", F.inline(pairs)), "actual", "forecast", ["run_id"])
    return rounded(fc.best_run(m.select("run_id", "rmse")))


@query("ml7_batch_scores")
def _(spark, sf):
    """Every row scored, written as CSV and read back."""
    from shelfline.session import scratch_path
    from shelfline.sources import files

    model, _test = demand_model(spark, sf)
    out = models.score(model, feature_rows(spark, sf)).select("date_key", "time_key", "store_id", "product_id", "forecasted_demand")
    path = scratch_path(spark, "scores")
    files.write_scores(out, path)
    return files.read_scores(spark, path, out.schema)


@query("ml8_feature_importance")
def _(spark, sf):
    """Tree importances with the loss of accuracy when a feature is permuted."""
    model, test = demand_model(spark, sf)
    names = ["store_id", "product_id", "discount_factor", "day", "hour"]
    perm = models.permutation_importance(model, test, names)
    return models.feature_importance(model, spark).join(perm, "feature", "left")


SPLIT = HOURLY + f""", tested AS (SELECT * FROM hourly WHERE {UNIFORM.format("'42:' || store_id || ':' || product_id || ':' || strftime(event_date, '%Y%m%d') || ':' || hour_of_day")} < 0.2)"""


def attributed(spark, sf):
    """The held-out rows with the attributions of their predictions."""
    model, test = demand_model(spark, sf)
    return attribution.attributions(model, test)


@query("ml8_attributions")
def _(spark, sf):
    return attributed(spark, sf)


@query("ml8_global_attribution")
def _(spark, sf):
    """Mean absolute attribution of each feature over the held-out rows."""
    return attribution.global_importance(attributed(spark, sf))


@query("ml8_attribution_checks", ctes=SPLIT, sql="SELECT count(*) AS n, round(sum(observed_sales), 3) AS sales, count(*) AS adds_up FROM tested")
def _(spark, sf):
    """Rows for which base value and attributions add up to the prediction, among all held-out rows."""
    total = sum((F.col(f"attribution_{f}") for f in attribution.FEATURES), F.col("base_value"))
    return attributed(spark, sf).agg(F.count("*").alias("n"), F.round(F.sum("observed_sales"), 3).alias("sales"), F.count_if(F.abs(total - F.col("prediction")) < 1e-9).alias("adds_up"))


@query("fc1_recover_demand", ctes=RECOVERED, sql="SELECT store_id, product_id, event_timestamp, stockout_flag, round(observed_sales, 6) AS observed_sales, round(recovered_demand, 6) AS recovered_demand FROM recovered")
def _(spark, sf):
    rec = fc.recover_demand(hourly(spark, sf, True))
    return rounded(rec.select("store_id", "product_id", "event_timestamp", "stockout_flag", "observed_sales", "recovered_demand"))


@query("fc1_recover_demand_from_arrays", ctes=RECOVERED, sql="SELECT store_id, product_id, event_timestamp, stockout_flag, round(observed_sales, 6) AS observed_sales, round(recovered_demand, 6) AS recovered_demand FROM recovered")
def _(spark, sf):
    """The same recovery on the daily arrays."""
    return rounded(recovered(spark, sf).select("store_id", "product_id", "event_timestamp", "stockout_flag", "observed_sales", "recovered_demand"))


@query("fc2_forecast_quantiles", ctes=EVALUATED, sql="""SELECT store_id, product_id, hour_of_day, is_weekend, horizon_hours, round(q[1], 6) AS forecast_q10, round(q[2], 6) AS forecast_q25, round(q[3], 6) AS forecast_median,
round(q[4], 6) AS forecast_q75, round(q[5], 6) AS forecast_q90 FROM qcells CROSS JOIN (SELECT unnest([1, 4, 8, 12, 24]) AS horizon_hours)""")
def _(spark, sf):
    rec = recovered(spark, sf)
    return rounded(fc.forecast_quantiles(rec.where(F.col("event_date") < cut(spark, sf))))


@query("fc3_forecast_errors", ctes=EVALUATED, sql="""SELECT store_id, product_id, event_timestamp, round(abs(actual - q50), 6) AS absolute_error, round((actual - q50) ** 2, 6) AS squared_error,
round(greatest(0.1 * (actual - q10), -0.9 * (actual - q10)), 6) AS pinball_loss_forecast_q10, round(greatest(0.9 * (actual - q90), -0.1 * (actual - q90)), 6) AS pinball_loss_forecast_q90 FROM evaluated""")
def _(spark, sf):
    e = fc.with_errors(evaluated(spark, sf), "actual", "forecast_median")
    e = fc.pinball_losses(e, "actual", forecast_q10=0.10, forecast_q90=0.90)
    return rounded(e.select("store_id", "product_id", "event_timestamp", "absolute_error", "squared_error", "pinball_loss_forecast_q10", "pinball_loss_forecast_q90"))


@query("fc4_metrics_by_censoring", ctes=EVALUATED, sql="""SELECT CASE WHEN stockout_flag = 1 THEN 'censored' ELSE 'uncensored' END AS segment, count(*) AS n, round(avg(abs(q50 - actual)), 6) AS mae,
round(sum(abs(q50 - actual)) / sum(abs(actual)) * 100, 6) AS wape FROM evaluated GROUP BY ALL""")
def _(spark, sf):
    m = fc.metrics_by_censoring(evaluated(spark, sf), "actual", "forecast_median")
    return rounded(m.select("segment", "n", "mae", "wape"))


BACK = HOURLY + f""", m AS (SELECT *, stockout_flag = 0 AND {UNIFORM.format("'42:' || store_id || ':' || product_id || ':' || strftime(event_timestamp, '%Y-%m-%d %H:%M:%S')")} < 0.2 AS hidden FROM ops
), k AS (SELECT * FROM m WHERE stockout_flag = 0 AND NOT hidden
), b0 AS (SELECT store_id, product_id, hour_of_day, is_weekend, avg(observed_sales) AS v FROM k GROUP BY ALL), b1 AS (SELECT store_id, product_id, hour_of_day, avg(observed_sales) AS v FROM k GROUP BY ALL
), b2 AS (SELECT product_id, hour_of_day, avg(observed_sales) AS v FROM k GROUP BY ALL
), t AS (SELECT m.observed_sales AS y, coalesce(b0.v, b1.v, b2.v) AS f FROM m LEFT JOIN b0 USING (store_id, product_id, hour_of_day, is_weekend) LEFT JOIN b1 USING (store_id, product_id, hour_of_day)
  LEFT JOIN b2 USING (product_id, hour_of_day) WHERE hidden AND coalesce(b0.v, b1.v, b2.v) IS NOT NULL)"""


@query("fc5_recovery_backtest", ctes=BACK, sql="SELECT count(*) AS n, round(avg(abs(f - y)), 6) AS mae, round(sqrt(avg((f - y) ** 2)), 6) AS rmse, round(sum(abs(f - y)) / sum(abs(y)) * 100, 6) AS wape FROM t")
def _(spark, sf):
    return rounded(fc.recovery_backtest(hourly(spark, sf, True)).select("n", "mae", "rmse", "wape"))


def limits_sql(source: str, value: str, cut: str) -> str:
    """The product-limit estimates of ``above_cut`` from the distinct values of each level, joined back to the rows (``limits``)."""
    parts = []
    for i, keys in enumerate(("store_id, product_id, hour_of_day, is_weekend", "store_id, product_id, hour_of_day", "store_id, product_id")):
        parts.append(f"""n{i} AS (SELECT {keys}, {value} AS v, count(*) AS n, count(*) FILTER (WHERE NOT {cut}) AS d FROM {source} GROUP BY ALL
), r{i} AS (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY v DESC) AS risk, lead(v) OVER (PARTITION BY {keys} ORDER BY v) AS nxt, sum(d) OVER (PARTITION BY {keys}) AS ends FROM n{i}
), s{i} AS (SELECT *, exp(sum(CASE WHEN d < risk THEN ln(1 - d / risk) ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY v)) AS s FROM r{i}
), a{i} AS (SELECT *, v + coalesce(sum(s * (nxt - v)) OVER (PARTITION BY {keys} ORDER BY v DESC), 0) / s AS e FROM s{i})""")
    joins = " ".join(f"JOIN a{i} ON a{i}.v = x.{value} AND " + " AND ".join(f"a{i}.{k} = x.{k}" for k in fc.CELL[:n]) for i, n in enumerate((4, 3, 2)))
    return ", ".join(parts) + f""", limits AS (SELECT x.*, coalesce(CASE WHEN a0.ends >= 20 THEN a0.e END, CASE WHEN a1.ends >= 20 THEN a1.e END, CASE WHEN a2.ends >= 1 THEN a2.e END) AS above
  FROM {source} x {joins})"""


# means of few values with four digits often end in the middle of two rounded ones, where engines that add in a different order part
OFF_MIDDLE = 0.0000000314

CUT_SHORT = HOURLY + """, x AS (SELECT *, stockout_flag = 1 OR coalesce(lead(stockout_flag) OVER (PARTITION BY store_id, product_id, event_date ORDER BY event_timestamp) = 1, false) AS cut_short FROM ops), """ + limits_sql("x", "observed_sales", "cut_short")


@query("fc1_product_limit", ctes=CUT_SHORT, sql=f"""SELECT store_id, product_id, event_timestamp, cut_short, round(observed_sales, 6) AS observed_sales,
round(CASE WHEN cut_short THEN coalesce(above, observed_sales) ELSE observed_sales END + {OFF_MIDDLE}::DOUBLE, 6) AS recovered_demand FROM limits""")
def _(spark, sf):
    """Demand of the hours that a stockout cut short, by the survival curve of their cell."""
    hours = hourly(spark, sf, True).select(*fc.CELL, "event_date", "event_timestamp", "stockout_flag", "observed_sales")
    rec = fc.recover_censored(hours).withColumn("recovered_demand", F.col("recovered_demand") + OFF_MIDDLE)
    return rounded(rec.select("store_id", "product_id", "event_timestamp", "cut_short", "observed_sales", "recovered_demand"))


STOCK_KEY = "store_id || ':' || product_id || ':' || strftime(event_timestamp, '%Y-%m-%d %H:%M:%S')"
CUTS = HOURLY + f""", k AS (SELECT *, CASE WHEN {UNIFORM.format("'42:' || " + STOCK_KEY)} < 0.5 THEN {UNIFORM.format("'43:' || " + STOCK_KEY)} * max(observed_sales) OVER (PARTITION BY store_id, product_id) END AS stock FROM ops WHERE stockout_flag = 0
), x AS (SELECT *, observed_sales AS truth, least(observed_sales, stock) AS sold, coalesce(stock < observed_sales, false) AS cut FROM k), """ + limits_sql("x", "sold", "cut") + """
, b0 AS (SELECT store_id, product_id, hour_of_day, is_weekend, avg(sold) FILTER (WHERE NOT cut) AS v FROM x GROUP BY ALL), b1 AS (SELECT store_id, product_id, hour_of_day, avg(sold) FILTER (WHERE NOT cut) AS v FROM x GROUP BY ALL
), b2 AS (SELECT product_id, hour_of_day, avg(sold) FILTER (WHERE NOT cut) AS v FROM x GROUP BY ALL
), t AS (SELECT truth, sold, above, coalesce(b0.v, b1.v, b2.v) AS m FROM limits JOIN b0 USING (store_id, product_id, hour_of_day, is_weekend) JOIN b1 USING (store_id, product_id, hour_of_day) JOIN b2 USING (product_id, hour_of_day)
  WHERE cut AND above IS NOT NULL AND coalesce(b0.v, b1.v, b2.v) IS NOT NULL
), e AS (SELECT 'mean' AS method, truth, greatest(sold, m) AS f FROM t UNION ALL SELECT 'product_limit', truth, above FROM t)"""


@query("fc5_product_limit_backtest", ctes=CUTS, sql="""SELECT method, count(*) AS n, round(avg(abs(f - truth)), 6) AS mae, round(sqrt(avg((f - truth) ** 2)), 6) AS rmse,
round(sum(f - truth) / sum(truth) * 100, 6) AS bias FROM e GROUP BY method""")
def _(spark, sf):
    """Both recoveries on known hours that were cut by a known rule."""
    return rounded(fc.cut_backtest(fc.hidden_cuts(hourly(spark, sf, True))).select("method", "n", "mae", "rmse", "bias"))


@query("fc6_label_audit", ctes=HOURLY + """, a AS (SELECT *, avg(1 - stockout_flag) OVER (PARTITION BY store_id, product_id) AS share,
  coalesce(lag(stockout_flag) OVER w, 1) = 1 AND coalesce(lead(stockout_flag) OVER w, 1) = 1 AS quiet FROM ops WINDOW w AS (PARTITION BY store_id, product_id ORDER BY event_timestamp))""",
       sql="""SELECT store_id, product_id, label, count(*) AS n FROM (SELECT *, CASE WHEN stockout_flag = 0 THEN 'in_stock' WHEN quiet AND share <= 0.25 THEN 'suspect' ELSE 'confirmed' END AS label FROM a) GROUP BY ALL""")
def _(spark, sf):
    return fc.label_audit(hourly(spark, sf, True)).groupBy("store_id", "product_id", F.col("label_check").alias("label")).agg(F.count("*").alias("n"))


@query("rk1_stockout_rate", ctes=SCORED, sql="SELECT store_id, product_id, event_timestamp, p AS stockout_probability FROM scored")
def _(spark, sf):
    return scored(spark, sf).select("store_id", "product_id", "event_timestamp", "stockout_probability")


def logistic_scores(spark, sf):
    ops = materialize(hourly(spark, sf, True), "risk-hours")
    rows = risk.risk_features(ops, features.cut_day(ops, "event_date"))
    return risk.risk_model(rows.filter("training")).score(rows.filter("NOT training"))


@query("rk1_logistic_risk")
def _(spark, sf):
    return logistic_scores(spark, sf).select("store_id", "product_id", "event_timestamp", "stockout_flag", "stockout_probability")


@query("rk1_logistic_checks", ctes=SCORED, sql="SELECT count(*) AS hours, count(*) AS within, avg(stockout_flag) < 1 AS better_than_rate FROM scored")
def _(spark, sf):
    """What holds for the logistic scores: every hour has one between 0 and 1, and they rank better than the base rate."""
    rows = logistic_scores(spark, sf)
    p = F.col("stockout_probability")
    totals = rows.agg(F.count("*").alias("hours"), F.count_if((p >= 0) & (p <= 1)).alias("within"), F.avg("stockout_flag").alias("base"))
    auc = kpi.kpi_pr_auc(rows, "stockout_flag", "stockout_probability")
    return totals.join(F.broadcast(auc)).select("hours", "within", (F.col("pr_auc") > F.col("base")).alias("better_than_rate"))  # one row each


@query("rk2_risk_tier", ctes=SCORED, sql="""SELECT CASE WHEN p < 0.25 THEN 'low' WHEN p < 0.5 THEN 'medium' WHEN p < 0.75 THEN 'high' ELSE 'critical' END AS risk_tier, p >= 0.5 AS is_alert, count(*) AS n FROM scored GROUP BY ALL""")
def _(spark, sf):
    return gold.fact_stockout_risk(scored(spark, sf), "r").groupBy("risk_tier", "is_alert").agg(F.count("*").alias("n"))


@query("rk3_calibration", ctes=SCORED + """, points AS (SELECT p, row_number() OVER (ORDER BY p) AS i, count(*) AS n, sum(stockout_flag) AS pos FROM scored GROUP BY p
), sums AS (SELECT *, sum(n) OVER (ORDER BY i) AS upto_n, sum(pos) OVER (ORDER BY i) AS upto_pos FROM points
), means AS (SELECT a.i, b.i AS j, min((b.upto_pos - a.upto_pos + a.pos) / (b.upto_n - a.upto_n + a.n)::DOUBLE) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS least FROM sums a JOIN sums b ON b.i >= a.i
), fitted AS (SELECT j AS i, max(least) AS v FROM means GROUP BY j)""",
       sql="SELECT p AS stockout_probability, n, round(pos / n::DOUBLE, 6) AS observed_rate, round(v, 6) AS calibrated FROM points JOIN fitted USING (i)")
def _(spark, sf):
    """Calibrated probability of each raw score: in SQL, the greatest over starts of the least over ends of the mean between them."""
    s = materialize(scored(spark, sf).select("stockout_probability", "stockout_flag"), "scored")
    model = risk.calibrate(s)
    points = s.groupBy("stockout_probability").agg(F.count("*").alias("n"), F.avg("stockout_flag").alias("observed_rate"))
    return rounded(model.transform(points.withColumn("features", F.col("stockout_probability"))).select("stockout_probability", "n", "observed_rate", F.col("prediction").alias("calibrated")))


@query("rk3_reliability", ctes=SCORED, sql="SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_score, round(avg(stockout_flag), 6) AS observed_rate FROM scored GROUP BY ALL")
def _(spark, sf):
    return rounded(risk.reliability(scored(spark, sf)))


# baseline: order lines shipped before 1998; current: the rest, with one column shifted
DRIFT_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
FRAMES = """base_long AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS feature, unnest([l_quantity, l_extendedprice, l_discount]) AS value FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
), cur_long AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS feature, unnest([l_quantity * 1.3, l_extendedprice, l_discount]) AS value FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')"""
CATS = FRAMES + """, cat_base AS (SELECT 'l_returnflag' AS feature, l_returnflag AS v, 1 AS nb, 0 AS nc FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
), cat_cur AS (SELECT 'l_returnflag' AS feature, CASE WHEN l_linestatus = 'F' THEN 'N' ELSE l_returnflag END AS v, 0 AS nb, 1 AS nc FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'
), cat_codes AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT v FROM cat_base UNION SELECT v FROM cat_cur)
), base_all AS (SELECT feature, value FROM base_long UNION ALL SELECT feature, code::DOUBLE FROM cat_base JOIN cat_codes USING (v)
), cur_all AS (SELECT feature, value FROM cur_long UNION ALL SELECT feature, code::DOUBLE FROM cat_cur JOIN cat_codes USING (v))"""


def drift_sql(base: str, cur: str) -> str:
    """CTEs psi and ks over two (feature, value) tables."""
    return f""", edges AS (SELECT feature, list_transform(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]), lambda e, i: CASE WHEN i = 1 THEN e - 1e-5 WHEN i = 11 THEN e + 1e-5 ELSE e END) AS e FROM {base} GROUP BY feature
), marked AS (SELECT feature, value, 1 AS b, 0 AS c FROM {base} UNION ALL SELECT feature, value, 0, 1 FROM {cur}
), binned AS (SELECT feature, b, c, CASE WHEN value >= e[1] AND value <= e[11] THEN len(list_filter(e[2:10], lambda x: x <= value)) END AS bin FROM marked JOIN edges USING (feature)
), shares AS (SELECT feature, bin, sum(b) / any_value(tb)::DOUBLE AS sb, sum(c) / any_value(tc)::DOUBLE AS sc FROM binned JOIN (SELECT feature, sum(b) AS tb, sum(c) AS tc FROM marked GROUP BY ALL) USING (feature) GROUP BY feature, bin
), floored AS (SELECT feature, CASE WHEN sb = 0 THEN 1e-4 ELSE sb END AS sb, CASE WHEN sc = 0 THEN 1e-4 ELSE sc END AS sc FROM shares WHERE bin IS NOT NULL
), psi AS (SELECT feature, round(sum((sc - sb) * ln(sc / sb)), 4) AS psi FROM floored GROUP BY feature
), per_value AS (SELECT feature, value, sum(b)::DOUBLE AS b, sum(c)::DOUBLE AS c FROM marked GROUP BY ALL
), cum AS (SELECT feature, sum(b) OVER w / sum(b) OVER t AS fb, sum(c) OVER w / sum(c) OVER t AS fc, sum(b) OVER t AS n_base, sum(c) OVER t AS n_cur FROM per_value
  WINDOW w AS (PARTITION BY feature ORDER BY value), t AS (PARTITION BY feature)
), ks AS (SELECT feature, max(abs(fb - fc)) AS ks, CAST(max(n_base) AS BIGINT) AS n_base, CAST(max(n_cur) AS BIGINT) AS n_cur FROM cum GROUP BY feature
), pv AS (SELECT *, CASE WHEN ks * ks * (n_base * n_cur::DOUBLE / (n_base + n_cur)) < 0.04 THEN 1.0 ELSE least(1.0, greatest(0.0, (SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * ks * ks * (n_base * n_cur::DOUBLE / (n_base + n_cur)))) FROM (SELECT unnest(range(1, 101)) AS k)))) END AS p FROM ks)"""


def drift_frames(spark, sf):
    li = tables.table(spark, sf, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    cols = [*DRIFT_COLS, "l_returnflag"]
    base = li.filter(F.col("l_shipdate") < cut).select(*cols)
    cur = li.filter(F.col("l_shipdate") >= cut).withColumns({
        "l_quantity": F.col("l_quantity") * 1.3, "l_returnflag": F.when(F.col("l_linestatus") == "F", "N").otherwise(F.col("l_returnflag"))}).select(*cols)
    return base, cur


@query("dr1_psi", ctes=FRAMES + drift_sql("base_long", "cur_long"), sql="SELECT feature, psi FROM psi")
def _(spark, sf):
    return drift.psi(drift.counted_values(*drift_frames(spark, sf), DRIFT_COLS))


@query("dr2_ks", ctes=FRAMES + drift_sql("base_long", "cur_long"), sql="SELECT feature, round(ks, 6) AS ks, n_base, n_cur FROM ks")
def _(spark, sf):
    return rounded(drift.ks2(drift.counted_values(*drift_frames(spark, sf), DRIFT_COLS)))


@query("dr3_ks_pvalue", ctes=FRAMES + drift_sql("base_long", "cur_long"), sql="SELECT feature, round(p::DOUBLE, 6) AS p_value FROM pv")
def _(spark, sf):
    ks = drift.ks2(drift.counted_values(*drift_frames(spark, sf), DRIFT_COLS))
    return rounded(ks.select("feature", drift.ks_pvalue(F.col("ks"), F.col("n_base"), F.col("n_cur")).alias("p_value")))


BALANCES = """marked AS (SELECT c_nationkey AS nation, c_acctbal AS value, 1 AS b, 0 AS c FROM customer UNION ALL SELECT s_nationkey, s_acctbal, 0, 1 FROM supplier
), cum AS (SELECT nation, sum(sum(b)) OVER w / sum(sum(b)) OVER t AS fb, sum(sum(c)) OVER w / sum(sum(c)) OVER t AS fc, sum(sum(b)) OVER t AS n, sum(sum(c)) OVER t AS m FROM marked GROUP BY nation, value
  WINDOW w AS (PARTITION BY nation ORDER BY value), t AS (PARTITION BY nation)
), stat AS (SELECT nation, max(abs(fb - fc)) AS ks, CAST(max(n) AS BIGINT) AS n, CAST(max(m) AS BIGINT) AS m FROM cum GROUP BY nation HAVING max(n) > 0 AND max(m) > 0
), col AS (
  SELECT nation, n, m, CAST(round(ks * n * m) AS BIGINT) AS edge, 0::BIGINT AS i,
         list_transform(range(0, m + 1), lambda j: CASE WHEN j * n < CAST(round(ks * n * m) AS BIGINT) THEN 1.0::DOUBLE ELSE 0.0 END) AS paths,
         list_transform(range(0, m + 1), lambda j: 1.0::DOUBLE) AS free FROM stat
  UNION ALL
  SELECT nation, n, m, edge, i + 1,
         list_transform(range(0, m + 1), lambda j: CASE WHEN abs((i + 1) * m - j * n) >= edge THEN 0.0 ELSE list_sum(list_transform(range(0, j + 1), lambda k: CASE WHEN (i + 1) * m - k * n < edge THEN paths[k + 1] ELSE 0.0 END)) END),
         list_transform(range(0, m + 1), lambda j: list_sum(free[1:j + 1]))
  FROM col WHERE i < n
)"""


@query("dr3_exact_small_samples", ctes="RECURSIVE " + BALANCES, sql="""SELECT c.nation::VARCHAR AS feature, round(s.ks, 6) AS ks, c.n AS n_base, c.m AS n_cur,
round(CASE WHEN edge <= 0 THEN 1 ELSE 1 - paths[c.m + 1] / free[c.m + 1] END, 6) AS p_value FROM col c JOIN stat s USING (nation) WHERE c.i = c.n""")
def _(spark, sf):
    """Balances of the customers of each nation against those of its suppliers, with the exact p-value at any size.

    The nations are dealt to tasks, as each exact p-value is a loop over its two samples.
    """
    both = [tables.table(spark, sf, t).select(F.col(f"{c}_nationkey").cast("string").alias("feature"), F.col(f"{c}_acctbal").alias("value"), F.lit(i).alias("side"))
            for i, (t, c) in enumerate((("customer", "c"), ("supplier", "s")))]
    counted = both[0].unionByName(both[1]).groupBy("feature", "value").agg(F.count_if(F.col("side") == 0).alias("nb"), F.count_if(F.col("side") == 1).alias("nc"))
    ks = drift.ks2(counted).repartition(shuffle_width(spark), "feature")
    return rounded(drift.ks_pvalue_by_size(ks, exact=None).select("feature", "ks", "n_base", "n_cur", "p_value"))


STATUS_SQL = """CASE WHEN psi >= 0.2 OR round(p::DOUBLE, 4) < 0.01 THEN 'CRITICAL_DRIFT' WHEN psi >= 0.1 THEN 'MODERATE_DRIFT' ELSE 'NO_DRIFT' END AS drift_status,
psi >= 0.2 OR round(p::DOUBLE, 4) < 0.01 AS retrain_recommended"""


@query("dr4_drift_status", ctes=FRAMES + drift_sql("base_long", "cur_long"), sql=f"SELECT feature, {STATUS_SQL} FROM pv JOIN psi USING (feature)")
def _(spark, sf):
    base, cur = drift_frames(spark, sf)
    return drift.dataset_drift(base, cur, DRIFT_COLS).select("feature", "drift_status", "retrain_recommended")


@query("dr5_dataset_drift", ctes=CATS + drift_sql("base_all", "cur_all"), sql=f"SELECT feature, round(ks, 4) AS ks, round(p::DOUBLE, 4) AS p_value, psi, {STATUS_SQL} FROM pv JOIN psi USING (feature)")
def _(spark, sf):
    base, cur = drift_frames(spark, sf)
    return drift.dataset_drift(base, cur, DRIFT_COLS, ["l_returnflag"])
