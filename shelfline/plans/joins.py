"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import gold, joins
from shelfline.plans.catalog import GRID, HOURLY, query, rounded
from shelfline.plans.cleaning import hourly
from shelfline.plans.windows import SCD2, scd2_priority
from shelfline.sources import tables


@query("j1_star_join", sql="""SELECT s_nationkey, p_type, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def _(spark, sf):
    t = lambda n: tables.table(spark, sf, n)
    fact = t("lineitem").select("l_suppkey", "l_partkey", "l_extendedprice")
    joined = joins.star_join(fact, l_suppkey=t("supplier").withColumnRenamed("s_suppkey", "l_suppkey"),
                             l_partkey=t("part").withColumnRenamed("p_partkey", "l_partkey"))
    return rounded(joined.groupBy("s_nationkey", "p_type").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("revenue")), 2)


@query("j2_attach_city", sql="""SELECT s_suppkey AS store_id, s_nationkey AS city_id, n_name AS city_label
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON s_nationkey = n_nationkey""")
def _(spark, sf):
    """Stores keep their row when their city is unknown."""
    stores = tables.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("city_id"))
    cities = tables.table(spark, sf, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_label"))
    return joins.attach_city(stores, cities)


@query("j3_new_members", sql="""SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (
SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate < TIMESTAMP '1996-01-01')""")
def _(spark, sf):
    """A NULL key among the existing members hides nobody."""
    old = tables.table(spark, sf, "orders").filter("o_orderdate < timestamp_ntz'1996-01-01'")
    existing = old.select(F.when(F.col("o_orderkey") != 0, F.col("o_custkey")).alias("c_custkey"))
    existing = existing.unionByName(existing.select(F.lit(None).cast("bigint").alias("c_custkey")).limit(1))
    return joins.new_members(tables.table(spark, sf, "customer"), existing, "c_custkey").select("c_custkey", "c_mktsegment")


@query("j4_after_watermark", sql="""SELECT event_id, ts, value FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15')""")
def _(spark, sf):
    ev = tables.table(spark, sf, "events")
    loaded = ev.filter("event_type = 'signup' AND ts < timestamp_ntz'2024-01-15'")
    return joins.after_watermark(ev, loaded, "ts").select("event_id", "ts", "value")


@query("j5_keep_series", sql="""SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity FROM lineitem
SEMI JOIN (SELECT l_suppkey, l_partkey FROM lineitem GROUP BY ALL HAVING count(*) >= 2) k USING (l_suppkey, l_partkey)""")
def _(spark, sf):
    li = tables.table(spark, sf, "lineitem")
    keys = li.groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n")).filter("n >= 2").drop("n")
    return joins.keep_series(li, keys).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")


@query("j6_feature_extract", ctes=HOURLY, sql="""SELECT CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour_of_day AS SMALLINT) AS time_key,
store_id, product_id, observed_sales, discount AS discount_factor, 'Cluster A' AS store_cluster, 'High' AS volume_band FROM hourly""")
def _(spark, sf):
    h = hourly(spark, sf)
    stores = gold.dim_store(h, gold.dim_city(h))
    fact = gold.fact_sales_hourly(h.withColumn("ingestion_batch_id", F.lit("b1")), stores, gold.dim_product(tables.daily(spark, sf)))
    return joins.feature_extract(fact, stores)


ASOF_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, o.o_custkey, s.o_orderpriority AS priority_then
FROM lineitem JOIN orders o ON l_orderkey = o.o_orderkey
LEFT JOIN scd s ON s.o_custkey = o.o_custkey AND CAST(l_shipdate AS DATE) >= s.effective_from AND CAST(l_shipdate AS DATE) < s.effective_to"""


def lines_and_versions(spark, sf):
    """Order lines with their customer, and the versions of the customers' priority."""
    lines = tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("d"))
    o = tables.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(o, "l_orderkey"), scd2_priority(spark, sf).withColumnRenamed("o_orderpriority", "priority_then")


@query("j7_asof_dim", ctes=SCD2, sql=ASOF_SQL)
def _(spark, sf):
    """The customer's priority at ship time."""
    fact, dim = lines_and_versions(spark, sf)
    return joins.asof_dim(fact, dim, "o_custkey", fact["d"]).select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "priority_then")


@query("j7_asof_window", ctes=SCD2, sql=ASOF_SQL)
def _(spark, sf):
    """The same, with the latest version carried forward instead of a range join."""
    fact, dim = lines_and_versions(spark, sf)
    return joins.asof_window(fact, dim, "o_custkey", F.col("d")).select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "priority_then")


@query("j8_cross_grid", sql="""SELECT p_partkey, markdown, policy, round(p_retailprice * (1 - markdown / 100.0), 4) AS price FROM part
CROSS JOIN (SELECT unnest([0, 25, 50]) AS markdown) CROSS JOIN (SELECT unnest(['lean_90', 'balanced_97']) AS policy)""")
def _(spark, sf):
    grid = joins.cross_grid(tables.table(spark, sf, "part").select("p_partkey", "p_retailprice"), markdown=[0, 25, 50], policy=["lean_90", "balanced_97"])
    return rounded(grid.select("p_partkey", "markdown", "policy", (F.col("p_retailprice") * (1 - F.col("markdown") / 100.0)).alias("price")), 4)


@query("j9_band_join", sql="""SELECT CASE WHEN p_size < 10 THEN 'short' WHEN p_size < 30 THEN 'middle' ELSE 'long' END AS band, count(*) AS n,
CAST(min(p_size) AS INTEGER) AS lo, CAST(max(p_size) AS INTEGER) AS hi FROM part GROUP BY ALL""")
def _(spark, sf):
    b = joins.band_join(tables.table(spark, sf, "part"), "p_size", (10, 30), ("short", "middle", "long"))
    return b.groupBy("band").agg(F.count("*").alias("n"), F.min("p_size").alias("lo"), F.max("p_size").alias("hi"))


@query("j9_band_table", sql="""WITH bands AS (SELECT DISTINCT p_size // 7 * 7 AS lo, p_size // 7 * 7 + 7 AS hi, 'size-' || (p_size // 7) AS band FROM part)
SELECT band, count(*) AS n, sum(l_extendedprice)::DECIMAL(18, 2)::DOUBLE AS total FROM lineitem LEFT JOIN bands ON l_quantity >= lo AND l_quantity < hi GROUP BY ALL""")
def _(spark, sf):
    """Order lines by the size bands that occur among the parts; the bands are a table."""
    k = F.floor(F.col("p_size") / 7)
    bands = tables.table(spark, sf, "part").select((k * 7).alias("lo"), (k * 7 + 7).alias("hi"), F.concat(F.lit("size-"), k.cast("string")).alias("band")).distinct()
    b = joins.band_table_join(tables.table(spark, sf, "lineitem"), "l_quantity", bands, 7.0)
    return b.groupBy("band").agg(F.count("*").alias("n"), F.sum("l_extendedprice").cast("decimal(18,2)").cast("double").alias("total"))


@query("j10_missing_keys", ctes=GRID, sql="""SELECT e.store_id, e.product_id, CAST(e.d AS DATE) AS dt
FROM (SELECT store_id, product_id, unnest(range(lo::TIMESTAMP, hi::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d
      FROM (SELECT store_id, product_id, min(d) AS lo, max(d) AS hi FROM base GROUP BY store_id, product_id)) e
ANTI JOIN base b ON b.store_id = e.store_id AND b.product_id = e.product_id AND b.d = e.d""")
def _(spark, sf):
    return joins.missing_keys(tables.daily(spark, sf), ["store_id", "product_id"])
