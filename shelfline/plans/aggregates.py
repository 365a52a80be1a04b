"""Aggregates, listings and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import aggregates as ag
from shelfline.plans.catalog import GRID, HOURLY, query, rounded
from shelfline.plans.cleaning import hourly
from shelfline.plans.contracts import RISK, risks
from shelfline.sources import tables


@query("ag1_agg_by", sql="""SELECT l_returnflag, l_linestatus, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(*) AS n, round(avg(l_discount), 6) AS mean_discount
FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    return rounded(ag.agg_by(tables.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], first_ship=F.min("l_shipdate"),
                             last_ship=F.max("l_shipdate"), n=F.count("*"), mean_discount=F.avg("l_discount")))


@query("ag2_n_unique", sql="""SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_l_suppkey, count(DISTINCT l_partkey) AS n_l_partkey FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    return ag.n_unique(tables.table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"], ["l_returnflag"])


@query("ag3_quantiles", sql="""SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
round(quantile_cont(l_extendedprice, 0.75), 6) AS q75 FROM lineitem""")
def _(spark, sf):
    """Whole-table quantiles, exact, without holding the column in one task."""
    q = ag.quantiles(tables.table(spark, sf, "lineitem"), "l_extendedprice", (0.25, 0.5, 0.75))
    return rounded(q.select(*[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))]))


@query("ag3_quantiles_by_flag", sql="""SELECT l_returnflag, round(quantile_cont(l_quantity, 0.1), 6) AS q10, round(quantile_cont(l_quantity, 0.9), 6) AS q90 FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    q = ag.quantiles(tables.table(spark, sf, "lineitem"), "l_quantity", (0.1, 0.9), ["l_returnflag"])
    return rounded(q.select("l_returnflag", F.get("quantiles", F.lit(0)).alias("q10"), F.get("quantiles", F.lit(1)).alias("q90")))


@query("ag4_value_counts", sql="SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY ALL ORDER BY n DESC, l_partkey LIMIT 20")
def _(spark, sf):
    """Top 20 by frequency."""
    return ag.value_counts(tables.table(spark, sf, "lineitem"), "l_partkey", 20)


@query("ag5_cond_counts", sql="""SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal < 0) AS n_negative, count(*) FILTER (WHERE c_acctbal = 0) AS n_zeros,
count(*) FILTER (WHERE c_acctbal > 5000) AS n_large FROM customer GROUP BY ALL""")
def _(spark, sf):
    b = F.col("c_acctbal")
    return ag.cond_counts(tables.table(spark, sf, "customer"), ["c_mktsegment"], n_negative=b < 0, n_zeros=b == 0, n_large=b > 5000)


@query("ag6_distinct", sql="SELECT DISTINCT p_brand, p_type FROM part")
def _(spark, sf):
    return ag.distinct_of(tables.table(spark, sf, "part"), ["p_brand", "p_type"])


@query("ag7_kpi_rollup", ctes=HOURLY, sql="""SELECT city_id, store_id, round(sum(avail * demand) / nullif(sum(demand), 0), 6) AS availability, round(sum(demand), 6) AS demand FROM (
SELECT city_id, store_id, product_id, event_date, (1 - avg(stockout_flag)) * 100.0 AS avail, sum(observed_sales) AS demand FROM ops GROUP BY ALL)
GROUP BY ROLLUP (city_id, store_id)""")
def _(spark, sf):
    from shelfline.operators import kpi

    daily = kpi.daily_kpis(hourly(spark, sf, True)).select("city_id", "store_id", F.col("availability_pct").alias("availability"), F.col("observed_demand").alias("demand"))
    return rounded(ag.kpi_rollup(daily, "availability", "demand", ["city_id", "store_id"]))


@query("so1_latest_n", ctes=HOURLY, sql="""SELECT CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key, hour_of_day AS time_key, store_id, product_id, observed_sales
FROM hourly ORDER BY date_key DESC, time_key DESC, store_id, product_id LIMIT 5000""")
def _(spark, sf):
    """The latest 5000 rows."""
    from shelfline.functions.calendar import date_key

    h = hourly(spark, sf).select(date_key(F.col("event_date")).alias("date_key"), F.col("hour_of_day").alias("time_key"), "store_id", "product_id", "observed_sales")
    return ag.latest_n(h, 5000, tie=["store_id", "product_id"])


@query("so2_listing", sql="SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 800")
def _(spark, sf):
    """The first 800 products in order."""
    return ag.listing(tables.table(spark, sf, "part").select("p_partkey", "p_name"), ["p_partkey"], 800)


@query("so3_action_queue", ctes=RISK, sql="""SELECT store_id, round(p, 6) AS urgency_score, action_type, 'OPEN' AS recommendation_status
FROM risk WHERE action_type <> 'monitor'""")
def _(spark, sf):
    status = F.when(F.col("action_type") == "monitor", "DONE").otherwise("OPEN")
    r = risks(spark, sf).select("store_id", F.col("p").alias("urgency_score"), "action_type", status.alias("recommendation_status"))
    return rounded(ag.action_queue(r, ["store_id"]))


@query("so4_top_duplicates", sql="SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 10")
def _(spark, sf):
    """The ten most repeated keys."""
    return ag.top_duplicates(tables.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("se1_union_all", sql="""SELECT 'customer' AS src, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY ALL
UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY ALL""")
def _(spark, sf):
    c = tables.table(spark, sf, "customer").select(F.lit("customer").alias("src"), F.col("c_nationkey").alias("nation"))
    s = tables.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("src"))
    return ag.union_all([c, s]).groupBy("src", "nation").agg(F.count("*").alias("n"))


@query("se2_set_diff", sql="SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    c = tables.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return ag.set_diff(c, tables.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")))


@query("se3_common_columns", ctes=GRID, sql="""SELECT unnest(['store_id', 'product_id']) AS column_name, unnest([count(DISTINCT store_id), count(DISTINCT product_id)]) AS n_values FROM base""")
def _(spark, sf):
    """Distinct values of the columns that the daily and the sale rows share."""
    from shelfline.operators.profile import profile_text_columns

    d = tables.daily(spark, sf).drop("dt")
    return profile_text_columns(d, ag.common_columns(d, tables.pos(spark, sf))).select("column_name", F.col("n_unique").alias("n_values"))
