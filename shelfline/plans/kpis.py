"""KPI queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import features, forecast as fc, islands, kpi
from shelfline.plans.catalog import HOURLY, INCIDENTS, query, rounded
from shelfline.plans.cleaning import hourly
from shelfline.session import materialize
from shelfline.sources import tables

RECOVERED = HOURLY + """, l0 AS (SELECT store_id, product_id, hour_of_day, is_weekend, avg(observed_sales) AS m FROM ops WHERE stockout_flag = 0 GROUP BY ALL
), l1 AS (SELECT store_id, product_id, hour_of_day, avg(observed_sales) AS m FROM ops WHERE stockout_flag = 0 GROUP BY ALL
), l2 AS (SELECT product_id, hour_of_day, avg(observed_sales) AS m FROM ops WHERE stockout_flag = 0 GROUP BY ALL
), recovered AS (SELECT o.*, CASE WHEN stockout_flag = 1 THEN greatest(observed_sales, coalesce(l0.m, l1.m, l2.m, observed_sales)) ELSE observed_sales END AS recovered_demand
  FROM ops o LEFT JOIN l0 USING (store_id, product_id, hour_of_day, is_weekend) LEFT JOIN l1 USING (store_id, product_id, hour_of_day) LEFT JOIN l2 USING (product_id, hour_of_day))"""
def _cells(name: str, keys: str) -> str:
    return f"""{name} AS (SELECT {keys}, quantile_cont(recovered_demand, [0.1, 0.25, 0.5, 0.75, 0.9]) AS q FROM recovered WHERE event_date < (SELECT cut FROM cutd) GROUP BY ALL)"""


EVALUATED = f"""{RECOVERED}, {_cells("qcells", "store_id, product_id, hour_of_day, is_weekend")}, {_cells("qhours", "store_id, product_id, hour_of_day")}, {_cells("qseries", "store_id, product_id")}
, forecasts AS (SELECT r.*, r.recovered_demand AS actual, coalesce(c.q, h.q, s.q) AS q FROM recovered r LEFT JOIN qcells c USING (store_id, product_id, hour_of_day, is_weekend)
  LEFT JOIN qhours h USING (store_id, product_id, hour_of_day) LEFT JOIN qseries s USING (store_id, product_id)
), evaluated AS (SELECT *, q[1] AS q10, q[2] AS q25, q[3] AS q50, q[4] AS q75, q[5] AS q90 FROM forecasts WHERE event_date >= (SELECT cut FROM cutd) AND q IS NOT NULL)"""
WEEK = "CAST(date_trunc('week', event_date) AS DATE)"


def recovered(spark, sf):
    """Trading hours with recovered demand."""
    return fc.explode_recovered(fc.recover_daily(tables.daily(spark, sf)))


def stored_recovered(spark, sf):
    """The same, stored: for queries that read it as training and as evaluation rows."""
    cols = ["store_id", "product_id", "event_date", "event_timestamp", "hour_of_day", "is_weekend", "stockout_flag", "observed_sales", "recovered_demand"]
    return materialize(recovered(spark, sf).select(*cols), "recovered")


def cut(spark, sf):
    """The first day of the evaluation window: after 70 % of the days."""
    return features.cut_day(tables.pos(spark, sf), "timestamp")


def evaluated(spark, sf):
    """Hours of the evaluation window with the quantile forecast from the hours before it."""
    rec = stored_recovered(spark, sf)
    rows = rec.where(F.col("event_date") >= cut(spark, sf)).withColumn("actual", F.col("recovered_demand"))
    return fc.with_forecast(rows, rec.where(F.col("event_date") < cut(spark, sf))).filter("forecast_median IS NOT NULL")


def per_horizon(df):
    """The forecast is the same for every horizon, so horizons are attached to the finished figures."""
    return df.withColumn("horizon_hours", F.explode(F.array(*[F.lit(h) for h in fc.HORIZONS])))


G = ["store_id", "product_id", "event_date"]


@query("kp1_availability", ctes=HOURLY, sql="SELECT store_id, product_id, event_date, round((count(*) - sum(stockout_flag)) / count(*)::DOUBLE * 100, 6) AS availability_pct FROM ops GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_availability(hourly(spark, sf, True), G))


@query("kp2_stockout_hours", ctes=HOURLY, sql="SELECT store_id, product_id, event_date, CAST(sum(stockout_flag) AS BIGINT) AS stockout_hours FROM ops GROUP BY ALL")
def _(spark, sf):
    return kpi.kpi_stockout_hours(hourly(spark, sf, True), G)


@query("kp3_incident_count", ctes=INCIDENTS, sql="SELECT store_id, product_id, event_date AS start_date, count(*) AS incident_count FROM incidents_day GROUP BY ALL")
def _(spark, sf):
    return kpi.kpi_incident_count(islands.incidents_from_daily(tables.daily(spark, sf), span_days=False))


@query("kp4_incident_duration", ctes=INCIDENTS, sql="SELECT store_id, product_id, event_date AS start_date, round(avg(duration_hours), 6) AS avg_duration_hours FROM incidents_day GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_incident_duration(islands.incidents_from_daily(tables.daily(spark, sf), span_days=False)))


@query("kp5_observed_demand", ctes=HOURLY, sql="SELECT store_id, product_id, event_timestamp, round(sum(observed_sales), 6) AS observed_demand FROM hourly GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_observed_demand(hourly(spark, sf), ["store_id", "product_id", "event_timestamp"]))


@query("kp6_recovered_demand", ctes=RECOVERED, sql="SELECT store_id, product_id, event_date, round(coalesce(sum(recovered_demand) FILTER (WHERE stockout_flag = 1), 0), 6) AS recovered_demand FROM recovered GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_recovered_demand(recovered(spark, sf), G))


@query("kp7_lost_demand", ctes=RECOVERED, sql="SELECT store_id, product_id, event_date, round(coalesce(sum(recovered_demand - observed_sales) FILTER (WHERE stockout_flag = 1), 0), 6) AS lost_demand FROM recovered GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_lost_demand(recovered(spark, sf), G))


@query("kp10_service_level", ctes=HOURLY, sql="SELECT store_id, product_id, event_date, round(count(*) FILTER (WHERE stockout_flag = 0) / count(*)::DOUBLE * 100, 6) AS service_level_pct FROM ops GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_service_level(hourly(spark, sf, True), G))


@query("kp11_fill_rate", ctes=RECOVERED, sql="SELECT store_id, product_id, event_date, round(sum(observed_sales) / nullif(sum(recovered_demand), 0) * 100, 6) AS fill_rate_pct FROM recovered GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_fill_rate(recovered(spark, sf), G))


H = ["store_id", "product_id"]
HZ = "CROSS JOIN (SELECT unnest([1, 4, 8, 12, 24]) AS horizon_hours)"


@query("kp12_wape", ctes=EVALUATED, sql=f"SELECT store_id, product_id, horizon_hours, round(coalesce(sum(abs(actual - q50)) / nullif(sum(abs(actual)), 0) * 100, 0), 6) AS wape FROM evaluated {HZ} GROUP BY ALL")
def _(spark, sf):
    return rounded(per_horizon(kpi.kpi_wape(evaluated(spark, sf), "actual", "forecast_median", H)))


@query("kp13_bias", ctes=EVALUATED, sql=f"SELECT store_id, product_id, horizon_hours, round(coalesce(sum(q50 - actual) / nullif(sum(actual), 0) * 100, 0), 6) + 0.0 AS bias FROM evaluated {HZ} GROUP BY ALL")
def _(spark, sf):
    return rounded(per_horizon(kpi.kpi_bias(evaluated(spark, sf), "actual", "forecast_median", H)))


@query("kp14_p90_coverage", ctes=EVALUATED, sql=f"SELECT store_id, product_id, horizon_hours, round(avg((actual <= q90)::INT) * 100, 6) AS p90_coverage_pct FROM evaluated {HZ} GROUP BY ALL")
def _(spark, sf):
    return rounded(per_horizon(kpi.kpi_p90_coverage(evaluated(spark, sf), "actual", "forecast_q90", H)))


@query("kp14_unscored_hours", ctes=EVALUATED, sql="SELECT count(*) AS hours, count(*) FILTER (WHERE q IS NULL) AS unscored_hours FROM forecasts WHERE event_date >= (SELECT cut FROM cutd)")
def _(spark, sf):
    """Hours of the evaluation window, and those of series without any history, which no forecast KPI counts."""
    rec = stored_recovered(spark, sf)
    rows = fc.with_forecast(rec.where(F.col("event_date") >= cut(spark, sf)), rec.where(F.col("event_date") < cut(spark, sf)))
    return rows.agg(F.count("*").alias("hours"), F.count_if(F.col("forecast_median").isNull()).alias("unscored_hours"))


FVA = EVALUATED + """, naive AS (SELECT e.*, p.recovered_demand AS naive_forecast FROM evaluated e JOIN recovered p
  ON p.store_id = e.store_id AND p.product_id = e.product_id AND p.event_timestamp = e.event_timestamp - INTERVAL 7 DAY
), wapes AS (SELECT product_id, sum(abs(actual - naive_forecast)) / sum(abs(actual)) * 100 AS wape_baseline, sum(abs(actual - q50)) / sum(abs(actual)) * 100 AS wape_model FROM naive GROUP BY ALL)"""


def with_baseline(spark, sf):
    """Forecast and seasonal-naive value of each evaluated hour."""
    rec = stored_recovered(spark, sf)
    based = features.naive_forecast(rec, 7, "recovered_demand", ["store_id", "product_id", "hour_of_day"], "event_date")
    rows = based.where(F.col("event_date") >= cut(spark, sf)).withColumn("actual", F.col("recovered_demand"))
    return fc.with_forecast(rows, rec.where(F.col("event_date") < cut(spark, sf))).filter("forecast_median IS NOT NULL")


@query("kp15_fva", ctes=FVA, sql="SELECT product_id, round(wape_baseline, 6) AS wape_baseline, round(wape_model, 6) AS wape_model, round((wape_baseline - wape_model) / wape_baseline * 100, 6) AS fva_pct FROM wapes")
def _(spark, sf):
    return rounded(kpi.kpi_fva(with_baseline(spark, sf), "actual", "forecast_median", "naive_forecast", ["product_id"]))


SCORED = HOURLY + """, rate0 AS (SELECT store_id, product_id, hour_of_day, sum(stockout_flag) AS s, count(*) AS n FROM ops WHERE event_date < (SELECT cut FROM cutd) GROUP BY ALL
), rate1 AS (SELECT product_id, hour_of_day, sum(s) AS s, sum(n) AS n FROM rate0 GROUP BY ALL), rate2 AS (SELECT hour_of_day, sum(s) AS s, sum(n) AS n FROM rate1 GROUP BY ALL
), scored AS (SELECT o.*, coalesce(round(a.s / a.n::DOUBLE, 4), round(b.s / b.n::DOUBLE, 4), round(c.s / c.n::DOUBLE, 4)) AS p FROM ops o LEFT JOIN rate0 a USING (store_id, product_id, hour_of_day)
  LEFT JOIN rate1 b USING (product_id, hour_of_day) LEFT JOIN rate2 c USING (hour_of_day) WHERE o.event_date >= (SELECT cut FROM cutd))"""


def scored(spark, sf):
    from shelfline.operators.risk import score_by_rate

    daily = materialize(tables.daily(spark, sf), "daily")
    return score_by_rate(daily, features.cut_day(daily, "dt"))


@query("kp16_pr_auc", ctes=SCORED, sql="""SELECT round(sum(pos / total * cum_pos / cum_n), 6) AS pr_auc FROM (
SELECT pos, sum(pos) OVER () AS total, sum(pos) OVER (ORDER BY p DESC) AS cum_pos, sum(n) OVER (ORDER BY p DESC) AS cum_n
FROM (SELECT p, count(*)::DOUBLE AS n, sum(stockout_flag)::DOUBLE AS pos FROM scored GROUP BY p))""")
def _(spark, sf):
    return rounded(kpi.kpi_pr_auc(scored(spark, sf), "stockout_flag", "stockout_probability"))


@query("kp17_alert_precision", ctes=SCORED, sql="""SELECT product_id, count(*) FILTER (WHERE p >= 0.8) AS alerts, round(count(*) FILTER (WHERE p >= 0.8 AND stockout_flag = 1) / nullif(count(*) FILTER (WHERE p >= 0.8), 0)::DOUBLE * 100, 6) AS precision_pct,
round(count(*) FILTER (WHERE p >= 0.8 AND stockout_flag = 1) / nullif(sum(stockout_flag), 0)::DOUBLE * 100, 6) AS recall_pct FROM scored GROUP BY ALL""")
def _(spark, sf):
    return rounded(kpi.kpi_alert_precision(scored(spark, sf), "stockout_flag", "stockout_probability", 0.8, ["product_id"]))


RUNS = """runs AS (SELECT o_orderkey AS run_id, CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status, o_orderdate + to_hours(CAST(o_custkey % 24 AS INTEGER)) AS ended_at,
  o_totalprice AS source_rows, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 0.01 ELSE 0 END AS rejected_rows FROM orders)"""


def runs(spark, sf):
    """Orders read as runs: status, end time, row counts."""
    o = tables.table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 24).cast("int"))).alias("ended_at"),
        F.col("o_totalprice").alias("source_rows"), F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") * F.lit(0.01)).otherwise(0.0).alias("rejected_rows"))


@query("kp22_freshness", ctes=RUNS, sql="""SELECT max(ended_at) AS last_success, round(date_diff('second', max(ended_at), TIMESTAMP '2003-01-01') / 3600.0, 6) AS freshness_hours FROM runs WHERE status = 'SUCCESS'""")
def _(spark, sf):
    return rounded(kpi.kpi_freshness(runs(spark, sf), F.lit("2003-01-01").cast("timestamp_ntz")))


@query("kp23_rejection_rate", ctes=RUNS, sql="SELECT status, round(sum(rejected_rows) / sum(source_rows) * 100, 6) AS rejection_rate_pct FROM runs GROUP BY status")
def _(spark, sf):
    return rounded(kpi.kpi_rejection_rate(runs(spark, sf), ["status"]))


DRIFT = EVALUATED + """, per_day AS (SELECT event_date, sum(abs(actual - q50)) AS a, sum(q50 - actual) AS m, sum(actual) AS y FROM evaluated GROUP BY ALL
), roll AS (SELECT event_date, sum(a) OVER w / sum(y) OVER w * 100 AS current_wape, sum(m) OVER w / sum(y) OVER w * 100 AS current_bias FROM per_day
  WINDOW w AS (ORDER BY event_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
), trained AS (SELECT sum(abs(recovered_demand - q[3])) / sum(abs(recovered_demand)) * 100 AS training_wape FROM forecasts WHERE event_date < (SELECT cut FROM cutd))"""


def drift_windows(spark, sf):
    """Rolling seven-day WAPE and bias of the evaluation window beside the WAPE of the training window."""
    rec = stored_recovered(spark, sf)
    train = rec.where(F.col("event_date") < cut(spark, sf))
    rows = fc.with_forecast(rec, train).filter("forecast_median IS NOT NULL")
    y, f = F.col("recovered_demand"), F.col("forecast_median")
    errors = rows.where(F.col("event_date") >= cut(spark, sf)).withColumns({"_abs": F.abs(y - f), "_miss": f - y, "_y": y})
    trained = kpi.kpi_wape(rows.where(F.col("event_date") < cut(spark, sf)), "recovered_demand", "forecast_median").withColumnRenamed("wape", "training_wape")
    return kpi.rolling_metrics(errors, "event_date").join(F.broadcast(trained))  # one row


@query("kp24_drift_status", ctes=DRIFT, sql="""SELECT event_date, round(current_wape, 6) AS current_wape, round(current_bias, 6) AS current_bias, round(training_wape, 6) AS training_wape,
CASE WHEN current_wape > training_wape * 1.2 OR current_bias NOT BETWEEN -10 AND 10 THEN 'DRIFTED' ELSE 'STABLE' END AS drift_status FROM roll CROSS JOIN trained""")
def _(spark, sf):
    return rounded(kpi.kpi_drift_status(drift_windows(spark, sf)))
