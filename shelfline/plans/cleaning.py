"""Cleaning, projection and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.functions import scores
from shelfline.functions.arrays import slot
from shelfline.operators import clean, reshape
from shelfline.plans.catalog import BRONZE, DAILY, GRID, HOURLY, query, rounded
from shelfline.sources import tables


def hourly(spark, sf, operational=False):
    return reshape.explode_hourly(tables.daily(spark, sf), operational)


def checked(spark, sf):
    return clean.flag_valid(clean.dedup_latest(tables.bronze(spark, sf)))


@query("cl1_dedup_latest", ctes=BRONZE, sql="""SELECT store_id, product_id, dt, sale_amount, ingested_at, source_file FROM latest""")
def _(spark, sf):
    return clean.dedup_latest(tables.bronze(spark, sf)).select("store_id", "product_id", "dt", "sale_amount", "ingested_at", "source_file")


@query("cl1_dedup_lineitem", sql="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""")
def _(spark, sf):
    return clean.dedup_latest(
        tables.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


@query("cl2_flag_valid", ctes=BRONZE, sql="SELECT store_id, product_id, dt, is_valid FROM checked")
def _(spark, sf):
    return checked(spark, sf).select("store_id", "product_id", "dt", "is_valid")


@query("cl3_split_valid", ctes=BRONZE, sql="""SELECT CASE WHEN is_valid THEN 'clean' ELSE 'quarantine' END AS half, store_id, count(*) AS n
FROM checked GROUP BY ALL""")
def _(spark, sf):
    good, bad = clean.split_valid(checked(spark, sf))
    return good.select(F.lit("clean").alias("half"), "store_id").unionByName(
        bad.select(F.lit("quarantine").alias("half"), "store_id")).groupBy("half", "store_id").agg(F.count("*").alias("n"))


@query("cl4_quarantine", ctes=BRONZE, sql="""SELECT 'VALIDATION_FAILED' AS error_code, 'Array length != 24 or negative sales' AS error_message,
ingestion_batch_id AS batch_id, record_hash AS doc_hash, dt AS doc_dt, store_id AS doc_store FROM checked WHERE NOT is_valid""")
def _(spark, sf):
    _good, bad = clean.split_valid(checked(spark, sf))
    q = clean.to_quarantine(bad)
    field = lambda name: F.get_json_object("source_record", f"$.{name}")
    return q.select("error_code", "error_message", "batch_id", field("record_hash").alias("doc_hash"),
                    field("dt").alias("doc_dt"), field("store_id").cast("int").alias("doc_store"))


@query("cl5_cast_daily", ctes=GRID, sql="""SELECT CASE WHEN n <> 9 THEN store_id END AS store_id, product_id,
CASE WHEN n <> 3 THEN CAST(d AS DATE) END AS dt, sale_amount FROM base""")
def _(spark, sf):
    """Text that is no date or no number becomes NULL."""
    n = F.dayofmonth(F.to_date("dt"))
    raw = tables.daily(spark, sf).select(
        F.when(n == 9, "n/a").otherwise(F.col("store_id").cast("string")).alias("store_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.when(n == 3, F.concat(F.lit("bad "), F.col("dt"))).otherwise(F.col("dt")).alias("dt"), "sale_amount")
    return clean.cast_daily(raw)


@query("cl6_load_stats", ctes=BRONZE, sql="""SELECT source_split, count(*) AS initial_rows, count(*) FILTER (WHERE is_valid) AS clean_rows,
count(*) FILTER (WHERE NOT is_valid) AS quarantined_rows,
round(count(*) FILTER (WHERE NOT is_valid) / count(*)::DOUBLE * 100.0, 6) AS rejection_rate_pct FROM checked GROUP BY source_split""")
def _(spark, sf):
    return rounded(clean.load_stats(checked(spark, sf), ["source_split"]))


@query("cl7_operational_only", ctes=HOURLY, sql="""SELECT store_id, product_id, event_timestamp, observed_sales, stockout_flag FROM ops""")
def _(spark, sf):
    return clean.operational_only(hourly(spark, sf)).select("store_id", "product_id", "event_timestamp", "observed_sales", "stockout_flag")


@query("cl8_staging", ctes=HOURLY, sql="""SELECT * EXCLUDE (iso_dow0) REPLACE (round(discount_depth, 6) AS discount_depth,
round(precpt, 6) AS precpt), 'b1' AS ingestion_batch_id, '2024-02-01' AS ingested_at FROM hourly""")
def _(spark, sf):
    df = hourly(spark, sf).withColumns({"ingestion_batch_id": F.lit("b1"), "ingested_at": F.lit("2024-02-01")})
    return rounded(clean.stg_hourly_sales(df))


@query("cl9_default_attrs", sql="""SELECT s_suppkey AS store_id, coalesce(CASE WHEN s_acctbal >= 0 THEN 'Cluster ' || s_nationkey END, 'Cluster A') AS store_cluster,
coalesce(CASE WHEN s_acctbal >= 5000 THEN 'Low' END, 'High') AS volume_band FROM supplier""")
def _(spark, sf):
    s = tables.table(spark, sf, "supplier")
    raw = s.select(F.col("s_suppkey").alias("store_id"),
                   F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("Cluster "), F.col("s_nationkey").cast("string"))).alias("store_cluster"),
                   F.when(F.col("s_acctbal") >= 5000, "Low").alias("volume_band"))
    return clean.default_attrs(raw, {"store_cluster": "Cluster A", "volume_band": "High"})


@query("rs1_explode_hourly", ctes=HOURLY, sql="""SELECT * REPLACE (round(discount_depth, 6) AS discount_depth, round(precpt, 6) AS precpt),
FROM hourly""")
def _(spark, sf):
    h = hourly(spark, sf)
    return rounded(h.select(*[c for c in h.columns if not c.endswith(("category_id", "group_id")) and c not in ("sale_amount", "stock_hour6_22_cnt")]))


@query("rs2_aligned_slot", ctes=DAILY, sql="""SELECT store_id, product_id, dt, unnest(range(25))::INTEGER AS hour_of_day,
unnest(list_append(hours_stock_status, NULL))::INTEGER AS flag FROM daily""")
def _(spark, sf):
    """Looking one slot past the end gives NULL."""
    return tables.daily(spark, sf).select(
        "store_id", "product_id", "dt", "hours_stock_status", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("hour_of_day")
    ).select("store_id", "product_id", "dt", "hour_of_day", slot(F.col("hours_stock_status"), F.col("hour_of_day")).alias("flag"))


@query("rs3_event_ts", sql="""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(CAST(o_custkey % 24 AS INTEGER)) AS event_timestamp FROM orders""")
def _(spark, sf):
    return tables.table(spark, sf, "orders").select("o_orderkey", cal.event_ts(F.col("o_orderdate"), F.col("o_custkey") % 24).alias("event_timestamp"))


@query("rs4_operational_flag", sql="""SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, hour(ts) >= 6 AND hour(ts) < 22 AS operational,
hour(ts) >= 8 AND hour(ts) < 20 AS short_day, count(*) AS n FROM events GROUP BY ALL""")
def _(spark, sf):
    h = F.hour("ts")
    return tables.table(spark, sf, "events").groupBy(
        h.alias("hour_of_day"), cal.is_operational(h).alias("operational"), cal.is_operational(h, 8, 20).alias("short_day")
    ).agg(F.count("*").alias("n"))


@query("rs5_calendar_cols", sql="""SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
CAST(isodow(o_orderdate) - 1 AS INTEGER) AS iso_dow0, isodow(o_orderdate) >= 6 AS is_weekend,
CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""")
def _(spark, sf):
    d = tables.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.withColumns(cal.calendar_cols(F.col("d")))


@query("rs6_part_of_day", sql="""SELECT CAST(hour(ts) AS INTEGER) AS h, CASE WHEN hour(ts) < 6 THEN 'Night' WHEN hour(ts) < 12 THEN 'Morning'
WHEN hour(ts) < 18 THEN 'Afternoon' WHEN hour(ts) < 22 THEN 'Evening' ELSE 'Night' END AS part_of_day, count(*) AS n FROM events GROUP BY ALL""")
def _(spark, sf):
    h = F.hour("ts")
    return tables.table(spark, sf, "events").groupBy(h.alias("h"), cal.part_of_day(h).alias("part_of_day")).agg(F.count("*").alias("n"))


@query("rs7_discount_depth", sql="""SELECT l_orderkey, l_linenumber, l_partkey, round(1.0 - (1.0 - l_discount), 6) AS depth FROM lineitem""")
def _(spark, sf):
    mult = F.lit(1.0) - F.col("l_discount")
    return rounded(tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", scores.discount_depth(mult).alias("depth")))


@query("rs8_daily_stockout", ctes=HOURLY, sql="""SELECT store_id, product_id, strftime(event_date, '%Y-%m-%d') AS dt,
CAST(sum(stockout_flag) AS INTEGER) AS daily_stockout_hours, sum(stockout_flag) > 0 AS has_any_stockout FROM ops GROUP BY ALL""")
def _(spark, sf):
    return reshape.daily_stockout(tables.daily(spark, sf)).select("store_id", "product_id", "dt", "daily_stockout_hours", "has_any_stockout")


@query("rs9_cyclical", ctes=HOURLY, sql="""SELECT DISTINCT hour_of_day, iso_dow0, round(sin(2 * pi() * hour_of_day / 24), 6) + 0.0 AS hour_sin,
round(cos(2 * pi() * hour_of_day / 24), 6) + 0.0 AS hour_cos, round(sin(2 * pi() * iso_dow0 / 7), 6) + 0.0 AS dow_sin,
round(cos(2 * pi() * iso_dow0 / 7), 6) + 0.0 AS dow_cos FROM hourly""")
def _(spark, sf):
    h = hourly(spark, sf).select("hour_of_day", "iso_dow0").distinct()
    hs, hc = cal.cyclical(F.col("hour_of_day"), 24)
    ds, dc = cal.cyclical(F.col("iso_dow0"), 7)
    return rounded(h.withColumns({"hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc}))


@query("rs10_parts_from_key", ctes=HOURLY, sql="""SELECT DISTINCT CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(event_date) AS INTEGER) AS year,
CAST(month(event_date) AS INTEGER) AS month, CAST(day(event_date) AS INTEGER) AS day, hour_of_day AS hour FROM hourly""")
def _(spark, sf):
    keys = hourly(spark, sf).select(cal.date_key(F.col("event_date")).alias("date_key"), F.col("hour_of_day").alias("time_key")).distinct()
    return keys.withColumns(cal.parts_from_key(F.col("date_key"), F.col("time_key"))).drop("time_key")


@query("rs11_date_key", sql="""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders""")
def _(spark, sf):
    return tables.table(spark, sf, "orders").select("o_orderkey", cal.date_key(F.to_date("o_orderdate")).alias("date_key"))
