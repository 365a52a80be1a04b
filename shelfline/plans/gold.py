"""Star-schema queries. Incremental builds load a first part, then the rest, and compare with the whole."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from shelfline.operators import forecast as fc
from shelfline.operators import gold, incremental, islands, rules
from shelfline.plans.catalog import BRONZE, GRID, HOURLY, INCIDENTS, query, rounded
from shelfline.plans.cleaning import checked, hourly
from shelfline.plans.kpis import EVALUATED, SCORED, evaluated, scored
from shelfline.session import materialize, scratch_path
from shelfline.sources import runlog, tables

SPLIT_TS = "2024-01-16"
#: days that the first delivery lacks, by product
LATE = "(day(to_date(dt)) + product_id) % 7 = 3"


@query("gd1_dim_city", ctes=GRID, sql="""SELECT DISTINCT city_id, 'City ' || city_id AS city_label, 'Region Unknown' AS region_label FROM base""")
def _(spark, sf):
    """First the cities of the first stores, then the new ones."""
    d = tables.daily(spark, sf)
    first = gold.dim_city(d.filter("store_id <= 5"))
    return first.unionByName(gold.dim_city(d, first))


@query("gd2_dim_store", ctes=GRID, sql="""SELECT DISTINCT store_id, city_id, 'Store ' || store_id AS store_label, 'Cluster A' AS store_cluster, 'High' AS volume_band FROM base""")
def _(spark, sf):
    d = tables.daily(spark, sf)
    cities = gold.dim_city(d)
    first = gold.dim_store(d.filter("store_id <= 5"), cities)
    return first.unionByName(gold.dim_store(d, cities, first))


@query("gd3_dim_product", ctes=GRID, sql="""SELECT DISTINCT product_id, management_group_id, first_category_id, second_category_id, third_category_id,
'Product ' || product_id AS product_label, 'A' AS abc_class, 'X' AS xyz_class, 'High' AS perishability_class FROM base""")
def _(spark, sf):
    return gold.dim_product(tables.daily(spark, sf))


FACT_SQL = """SELECT CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour_of_day AS SMALLINT) AS time_key, store_id, product_id,
event_timestamp, observed_sales, stockout_flag, discount AS discount_factor, activity_flag, holiday_flag, 0.0::DOUBLE AS recovered_demand, 'b1' AS source_batch_id FROM hourly"""


def _fact_cols(df):
    return df.select("date_key", "time_key", "store_id", "product_id", "event_timestamp", "observed_sales", "stockout_flag",
                     "discount_factor", "activity_flag", "holiday_flag", "recovered_demand", "source_batch_id")


def sales_deliveries(spark, sf):
    """The fact rows of two deliveries: the first lacks the later days and some earlier ones of some series."""
    d = materialize(tables.daily(spark, sf), "daily")
    stores, products = materialize(gold.dim_store(d, gold.dim_city(d)), "stores"), materialize(gold.dim_product(d), "products")
    return [gold.sales_from_daily(x, stores, products, "b1") for x in (d.where(f"to_date(dt) < date'{SPLIT_TS}' AND NOT {LATE}"), d)]


@query("gd4_fact_sales_hourly", ctes=HOURLY, sql=FACT_SQL)
def _(spark, sf):
    """A first load, then the rows that it lacks by the marks of its series."""
    first, whole = sales_deliveries(spark, sf)
    loaded = materialize(first, "fact-sales")
    return _fact_cols(loaded.unionByName(incremental.arrivals(whole, loaded, incremental.high_water(loaded, "event_timestamp"), "event_timestamp", "date_key")))


@query("gd4_partitioned_load", ctes=HOURLY, sql=FACT_SQL)
def _(spark, sf):
    """The same deliveries, loaded into a stored table with a partition for each day."""
    path = scratch_path(spark, "fact-sales")
    for delivered in sales_deliveries(spark, sf):
        incremental.load(delivered, path, "event_timestamp", "date_key")
    return _fact_cols(spark.read.parquet(path))


@query("gd5_fact_stockout_incident", ctes=INCIDENTS, sql="""SELECT store_id, product_id, incident_start AS start_timestamp, incident_end AS end_timestamp, duration_hours,
CAST(NULL AS DOUBLE) AS severity_score, CAST(NULL AS VARCHAR) AS incident_class FROM incidents""")
def _(spark, sf):
    d = tables.daily(spark, sf)
    inc = islands.incidents_from_daily(d)
    return gold.fact_stockout_incident(inc, gold.dim_store(d, gold.dim_city(d)), gold.dim_product(d)).select(
        "store_id", "product_id", "start_timestamp", "end_timestamp", "duration_hours", "severity_score", "incident_class")


@query("gd5_incremental", ctes=INCIDENTS, sql="SELECT store_id, product_id, incident_start AS start_timestamp, incident_end AS end_timestamp, duration_hours FROM incidents")
def _(spark, sf):
    """Loaded in two steps, the first ending inside incidents and without some days of some series; the result is that of one load."""
    d = materialize(tables.daily(spark, sf), "daily")
    first = F.expr(f"to_date(dt) < date'{SPLIT_TS}' AND NOT {LATE}")
    found = incremental.reload_incidents(islands.incidents_from_daily(d.where(first)), d, d.where(~first))
    stores, products = gold.dim_store(d, gold.dim_city(d)), gold.dim_product(d)
    return gold.fact_stockout_incident(found, stores, products).select("store_id", "product_id", "start_timestamp", "end_timestamp", "duration_hours")


@query("gd6_dim_time", ctes=HOURLY, sql="""SELECT CAST(hour_of_day AS SMALLINT) AS time_key, hour_of_day, lpad(hour_of_day::VARCHAR, 2, '0') || ':00' AS hour_label, part_of_day,
is_operational_hour, round(sum(observed_sales), 4) AS sold FROM hourly GROUP BY ALL""")
def _(spark, sf):
    """The hour dimension joined to the sales it describes."""
    sold = hourly(spark, sf).groupBy("hour_of_day").agg(F.sum("observed_sales").alias("sold"))
    return rounded(gold.dim_time(spark).join(sold, "hour_of_day"), 4)


@query("gd7_dim_date", sql="""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date, CAST(day(d) AS INTEGER) AS day_number, dayname(d) AS day_name,
CAST(weekofyear(d) AS INTEGER) AS week_number, CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend, false AS is_holiday
FROM (SELECT unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))""")
def _(spark, sf):
    return gold.dim_date(tables.table(spark, sf, "orders"), "o_orderdate")


REASONS = ", ".join(f"({i + 1}, '{code}', '{group}')" for i, (code, group, *_) in enumerate(gold.REASON_CODES))


@query("gd8_dim_reason_code", sql=f"""SELECT r.reason_key, r.reason_code, r.reason_group, coalesce(o.n, 0) AS n FROM (VALUES {REASONS}) AS r(reason_key, reason_code, reason_group) LEFT JOIN (
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'EMERGENCY_REPLENISH' WHEN o_orderpriority = '2-HIGH' THEN 'HIGH_STOCKOUT_RISK' ELSE 'MONITOR_ONLY' END AS reason_code, count(*) AS n FROM orders GROUP BY ALL) o USING (reason_code)""")
def _(spark, sf):
    """All reason codes with the orders they would explain."""
    p = F.col("o_orderpriority")
    code = F.when(p == "1-URGENT", "EMERGENCY_REPLENISH").when(p == "2-HIGH", "HIGH_STOCKOUT_RISK").otherwise("MONITOR_ONLY")
    n = tables.table(spark, sf, "orders").groupBy(code.alias("reason_code")).agg(F.count("*").alias("n"))
    return gold.dim_reason_code(spark).join(n, "reason_code", "left").select("reason_key", "reason_code", "reason_group", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query("gd9_dim_weather_band", ctes=GRID, sql="""SELECT CASE WHEN avg_temperature < 5 THEN 'cold' WHEN avg_temperature < 15 THEN 'mild' WHEN avg_temperature < 25 THEN 'warm' ELSE 'hot' END AS temperature_band,
CASE WHEN avg_humidity < 40 THEN 'dry' WHEN avg_humidity < 70 THEN 'moderate' ELSE 'humid' END AS humidity_band FROM base GROUP BY ALL""")
def _(spark, sf):
    return gold.dim_weather_band(tables.daily(spark, sf)).drop("weather_band_key")


@query("gd10_dim_policy", ctes=GRID, sql="""SELECT policy_name, target_service_level, quantile_used, round(CASE policy_name WHEN 'lean_90' THEN q[1] WHEN 'conservative_95' THEN q[2]
WHEN 'balanced_97' THEN q[3] ELSE q[4] END, 6) AS order_qty FROM (SELECT quantile_cont(sale_amount, [0.75, 0.9, 0.95, 0.99]) AS q FROM base)
CROSS JOIN (SELECT unnest(['conservative_95', 'balanced_97', 'aggressive_99', 'lean_90']) AS policy_name, unnest([0.95::DOUBLE, 0.97, 0.99, 0.90]) AS target_service_level,
unnest([0.90::DOUBLE, 0.95, 0.99, 0.75]) AS quantile_used)""")
def _(spark, sf):
    """Each policy with the network-wide demand quantile it orders."""
    from shelfline.operators.ranks import exact_quantiles, value_counts_by

    probs = [0.75, 0.90, 0.95, 0.99]
    q = exact_quantiles(value_counts_by(tables.daily(spark, sf), [], "sale_amount"), [], "sale_amount", probs)
    pairs = F.array(*[F.struct(F.lit(p).alias("quantile_used"), F.get("quantiles", F.lit(i)).alias("order_qty")) for i, p in enumerate(probs)])
    return rounded(gold.dim_policy(spark).join(q.select(F.inline(pairs)), "quantile_used").select(
        "policy_name", "target_service_level", "quantile_used", "order_qty"))


@query("gd11_fact_forecast", ctes=EVALUATED, sql="""SELECT store_id, product_id, event_timestamp, 24 AS horizon_hours, round(q10, 6) AS forecast_p10, round(q50, 6) AS forecast_p50, round(q90, 6) AS forecast_p90,
round(actual, 6) AS actual, round(abs(actual - q50), 6) AS absolute_error, round((actual - q50) * (actual - q50), 6) AS squared_error,
round(greatest(0.1 * (actual - q10), -0.9 * (actual - q10)), 6) AS pinball_loss_p10, round(greatest(0.5 * (actual - q50), -0.5 * (actual - q50)), 6) AS pinball_loss_p50,
round(greatest(0.9 * (actual - q90), -0.1 * (actual - q90)), 6) AS pinball_loss_p90 FROM evaluated""")
def _(spark, sf):
    e = evaluated(spark, sf).withColumn("horizon_hours", F.lit(24))
    keys = ["store_id", "product_id", "event_timestamp", "horizon_hours"]
    f = e.select(*keys, F.col("forecast_q10").alias("forecast_p10"), F.col("forecast_median").alias("forecast_p50"), F.col("forecast_q90").alias("forecast_p90"), "actual")
    return rounded(gold.fact_forecast(f.drop("actual"), f.select(*keys, "actual"), keys))


@query("gd12_fact_stockout_risk", ctes=SCORED, sql="""SELECT store_id, product_id, event_timestamp, p AS stockout_probability, stockout_flag AS actual_stockout, 'r1' AS risk_run_id,
CASE WHEN p < 0.25 THEN 'low' WHEN p < 0.5 THEN 'medium' WHEN p < 0.75 THEN 'high' ELSE 'critical' END AS risk_tier, p >= 0.5 AS is_alert FROM scored""")
def _(spark, sf):
    return gold.fact_stockout_risk(scored(spark, sf).select("store_id", "product_id", "event_timestamp", "stockout_probability", F.col("stockout_flag").alias("actual_stockout")), "r1")


@query("gd14_fact_model_monitoring", ctes=EVALUATED, sql="""SELECT 'm1' AS monitoring_run_id, 'product' AS segment_type, product_id::VARCHAR AS segment_value, 'hourly_wape' AS metric_name,
round(wape, 6) AS metric_value, 0.45::DOUBLE AS threshold, CASE WHEN wape <= 0.45 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT product_id, sum(abs(actual - q50)) / sum(abs(actual)) AS wape FROM evaluated GROUP BY ALL)""")
def _(spark, sf):
    m = fc.forecast_metrics(evaluated(spark, sf), "actual", "forecast_median", ["product_id"])
    rows = m.select(F.lit("product").alias("segment_type"), F.col("product_id").cast("string").alias("segment_value"),
                    F.lit("hourly_wape").alias("metric"), (F.col("wape") / 100).alias("value"))
    return rounded(gold.fact_model_monitoring(rules.gate(rows, rules.QUALITY_GATES), "m1"))


@query("gd15_fact_run_log", ctes=BRONZE, sql="""SELECT 'run-' || source_split AS pipeline_run_id, 'SUCCESS' AS status, count(*) AS source_rows, count(*) FILTER (WHERE is_valid) AS accepted_rows,
count(*) FILTER (WHERE NOT is_valid) AS rejected_rows, 120.0::DOUBLE AS duration_seconds FROM checked GROUP BY source_split""")
def _(spark, sf):
    """One run per split; the counts are observed by the write of that run."""
    t0 = datetime.datetime(2024, 2, 1)
    logs = []
    for split in ("train", "eval"):
        part, seen = runlog.observed(checked(spark, sf).filter(F.col("source_split") == split), split, F.col("is_valid"))
        part.write.parquet(scratch_path(spark, "run"))
        logs.append(runlog.run_row(spark, f"run-{split}", "silver", t0, t0 + datetime.timedelta(minutes=2), seen.get))
    return fc.union_by_name(logs).select("pipeline_run_id", "status", "source_rows", "accepted_rows", "rejected_rows", "duration_seconds")


@query("gd16_append_by_key", sql="SELECT event_id, ts, value FROM events")
def _(spark, sf):
    """Late rows: half the events are loaded by hash; the key mode adds exactly the rest."""
    ev = tables.table(spark, sf, "events").select("event_id", "ts", "value")
    loaded = ev.filter(F.xxhash64("event_id") > 0)
    return loaded.unionByName(gold.append_new(ev, loaded, "keys", ["event_id"]))


@query("gd16_append_by_watermark", sql="""SELECT event_id, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_type <> 'view'
UNION ALL SELECT event_id, ts, value FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_type <> 'view')""")
def _(spark, sf):
    ev = tables.table(spark, sf, "events")
    loaded = ev.filter("ts < timestamp_ntz'2024-01-10' AND event_type <> 'view'")
    return loaded.unionByName(gold.append_new(ev, loaded, "watermark", ts="ts")).select("event_id", "ts", "value")


@query("gd16_append_by_series", sql="SELECT event_id, user_id, ts, value FROM events")
def _(spark, sf):
    """Every user has a mark: users that the first load lacks for days, and rows behind the mark of theirs, are added once."""
    ev = tables.table(spark, sf, "events").select("event_id", "user_id", "ts", "value", F.to_date("ts").alias("day"))
    loaded = materialize(ev.filter("ts < timestamp_ntz'2024-01-15' AND (day(ts) + user_id) % 4 <> 0"), "loaded")
    new = incremental.arrivals(ev, loaded, incremental.high_water(loaded, "ts", ["user_id"]), "ts", "day", ["user_id"])
    return loaded.unionByName(new).drop("day")
