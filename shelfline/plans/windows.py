"""Window and island queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import clean, features, islands
from shelfline.plans.catalog import BRONZE, GRID, INCIDENTS, ORDER_DEMAND, query, rounded
from shelfline.plans.cleaning import hourly
from shelfline.sources import tables


@query("w1_prev_state", ctes=INCIDENTS, sql="SELECT store_id, product_id, event_timestamp, prev AS prev_stockout FROM marked")
def _(spark, sf):
    return islands.prev_state(hourly(spark, sf, True)).select("store_id", "product_id", "event_timestamp", "prev_stockout")


@query("w2_run_starts", ctes=INCIDENTS, sql="""SELECT store_id, product_id, event_timestamp,
CAST(stockout_flag = 1 AND prev = 0 AS INTEGER) AS is_new_incident FROM marked""")
def _(spark, sf):
    return islands.run_ids(hourly(spark, sf, True)).select("store_id", "product_id", "event_timestamp", "is_new_incident")


@query("w3_run_ids", ctes=INCIDENTS, sql="SELECT store_id, product_id, event_timestamp, CAST(run AS BIGINT) AS incident_group FROM runs")
def _(spark, sf):
    return islands.run_ids(hourly(spark, sf, True)).select("store_id", "product_id", "event_timestamp", "incident_group")


SPAN_SQL = """SELECT * REPLACE (round(avg_discount_during, 6) AS avg_discount_during), md5(store_id || '|' || product_id || '|' || strftime(incident_start, '%Y-%m-%d %H:%M:%S')) AS incident_id
FROM incidents"""
DAY_SQL = """SELECT store_id, product_id, incident_start, incident_end, duration_hours, event_date AS start_date FROM incidents_day"""


@query("w4_incidents", ctes=INCIDENTS, sql=SPAN_SQL)
def _(spark, sf):
    return rounded(islands.stockout_incidents(hourly(spark, sf)))


@query("w4_incidents_per_day", ctes=INCIDENTS, sql=DAY_SQL)
def _(spark, sf):
    return islands.stockout_incidents(hourly(spark, sf), span_days=False).select(
        "store_id", "product_id", "incident_start", "incident_end", "duration_hours", "start_date")


@query("w4_incidents_from_arrays", ctes=INCIDENTS, sql=SPAN_SQL)
def _(spark, sf):
    """The same incidents from the daily arrays."""
    return rounded(islands.incidents_from_daily(tables.daily(spark, sf)))


@query("w4_incidents_per_day_from_arrays", ctes=INCIDENTS, sql=DAY_SQL)
def _(spark, sf):
    return islands.incidents_from_daily(tables.daily(spark, sf), span_days=False).select(
        "store_id", "product_id", "incident_start", "incident_end", "duration_hours", "start_date")


@query("w5_latest_rank", ctes=BRONZE, sql="""SELECT store_id, product_id, dt, source_file,
CAST(row_number() OVER (PARTITION BY store_id, product_id, dt ORDER BY ingested_at DESC, source_file_hash DESC) AS INTEGER) AS rn FROM bronze""")
def _(spark, sf):
    """All ranks, not only the first."""
    from pyspark.sql import Window

    w = Window.partitionBy(*clean.NATURAL_KEY).orderBy(F.desc("ingested_at"), F.desc("source_file_hash"))
    return tables.bronze(spark, sf).select(*clean.NATURAL_KEY, "source_file", F.row_number().over(w).alias("rn"))


CURVE = """curve AS (SELECT p_partkey AS product_id, h AS hour_of_day, CAST(floor(p_retailprice * 0.12) AS INTEGER) AS order_qty,
  greatest(2, CAST(floor(p_retailprice * 0.1 * (0.04 + 0.08 * sin((h - 8) / 13.0 * pi()))) AS INTEGER)) AS purchases
  FROM part, (SELECT unnest(range(8, 22))::INTEGER AS h))"""


@query("w6_depletion_curve", ctes=CURVE, sql="""SELECT product_id, hour_of_day, purchases, CAST(greatest(0, order_qty -
sum(purchases) OVER (PARTITION BY product_id ORDER BY hour_of_day)) AS INTEGER) AS shelf_stock FROM curve""")
def _(spark, sf):
    p = tables.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), (F.col("p_retailprice") * 0.1).alias("mu"),
                                               F.floor(F.col("p_retailprice") * 0.12).alias("order_qty"))
    return features.depletion_curve(features.purchase_curve(p, "mu"), "order_qty").drop("mu", "order_qty")


@query("w7_purchase_curve", ctes=CURVE, sql="SELECT product_id, hour_of_day, purchases FROM curve")
def _(spark, sf):
    p = tables.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), (F.col("p_retailprice") * 0.1).alias("mu"))
    return features.purchase_curve(p, "mu").select("product_id", F.posexplode("purchases").alias("i", "purchases")).select(
        "product_id", (F.col("i") + 8).alias("hour_of_day"), "purchases")


LAG_SQL = """, x AS (SELECT store_id, product_id, dt, sale_amount, """ + ", ".join(
    f"max(sale_amount) OVER (PARTITION BY store_id, product_id ORDER BY dt RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND INTERVAL {n} DAY PRECEDING) AS lag_{n}"
    for n in features.LAGS) + " FROM {src}), y AS (SELECT *, list_filter([lag_1, lag_2, lag_3, lag_7, lag_14], lambda v: v IS NOT NULL) AS l FROM x)"
LAG_OUT = """SELECT store_id, product_id, dt, sale_amount, lag_1, lag_2, lag_3, lag_7, lag_14,
round(list_aggregate(l, 'avg'), 6) AS lag_mean, round(CASE WHEN len(l) > 1 THEN list_aggregate(l, 'stddev_samp') END, 6) AS lag_std,
list_min(l) AS lag_min, list_max(l) AS lag_max FROM y"""
DAY_TS = ", series AS (SELECT store_id, product_id, d AS dt, sale_amount FROM base)"


@query("w8_lag_features", ctes=GRID + DAY_TS + LAG_SQL.format(src="series"), sql=LAG_OUT)
def _(spark, sf):
    df = tables.daily(spark, sf).select("store_id", "product_id", F.to_date("dt").alias("dt"), "sale_amount")
    return rounded(features.lag_features(df))


@query("w8_lag_features_orders", ctes=ORDER_DEMAND + LAG_SQL.format(src="demand"), sql=LAG_OUT)
def _(spark, sf):
    df = tables.order_demand(spark, sf).select("store_id", "product_id", "dt", "sale_amount")
    return rounded(features.lag_features(df))


ROLL = ", ".join(
    f"round(avg(sale_amount) OVER w{n}, 6) AS roll_mean_{n}, round(stddev_samp(sale_amount) OVER w{n}, 6) AS roll_std_{n}" for n in features.SPANS)
ROLL_W = ", ".join(f"w{n} AS (PARTITION BY store_id, product_id ORDER BY dt RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)" for n in features.SPANS)


@query("w9_rolling_features", ctes=GRID + DAY_TS, sql=f"SELECT store_id, product_id, dt, sale_amount, {ROLL} FROM series WINDOW {ROLL_W}")
def _(spark, sf):
    df = tables.daily(spark, sf).select("store_id", "product_id", F.to_date("dt").alias("dt"), "sale_amount")
    return rounded(features.rolling_features(df))


@query("w10_naive_forecast", ctes=GRID, sql="""SELECT b.store_id, b.product_id, CAST(b.d AS DATE) AS dt, b.sale_amount, p.sale_amount AS naive_forecast
FROM base b LEFT JOIN base p ON p.store_id = b.store_id AND p.product_id = b.product_id AND p.d = b.d - 7""")
def _(spark, sf):
    df = tables.daily(spark, sf).select("store_id", "product_id", F.to_date("dt").alias("dt"), "sale_amount")
    return features.naive_forecast(df)


@query("w11_period_delta", ctes=ORDER_DEMAND, sql="""SELECT week, round(sold, 6) AS sold, round(prev, 6) AS previous, round(sold - prev, 6) AS delta,
round((sold - prev) / nullif(prev, 0) * 100.0, 6) AS delta_pct
FROM (SELECT *, lag(sold) OVER (ORDER BY week) AS prev FROM (SELECT CAST(date_trunc('week', dt) AS DATE) AS week, sum(sale_amount) AS sold FROM demand GROUP BY ALL))""")
def _(spark, sf):
    weekly = tables.order_demand(spark, sf).groupBy(F.trunc("dt", "week").alias("week")).agg(F.sum("sale_amount").alias("sold"))
    return rounded(features.period_delta(weekly, "sold", "week"))


SCD2 = """changes AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS effective_from, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY ALL
), scd AS (SELECT o_custkey, o_orderpriority, effective_from,
  coalesce(lead(effective_from) OVER (PARTITION BY o_custkey ORDER BY effective_from), DATE '9999-12-31') AS effective_to FROM changes)"""


def scd2_priority(spark, sf):
    return features.scd2_build(tables.table(spark, sf, "orders"), "o_custkey", ["o_orderpriority"], "o_orderdate", "o_orderkey")


@query("w12_scd2", ctes=SCD2, sql="SELECT *, effective_to = DATE '9999-12-31' AS is_current FROM scd")
def _(spark, sf):
    """Order priority as a slowly changing attribute of a customer."""
    return scd2_priority(spark, sf)
