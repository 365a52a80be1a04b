"""Scalar function families over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import arrays, calendar as cal, catalogue, normal, scores, text
from shelfline.plans.catalog import DAILY, query, rounded
from shelfline.sources import tables


def sql_poly(coeffs, x: str) -> str:
    out = f"{float(coeffs[0])!r}::DOUBLE"
    for c in coeffs[1:]:
        out = f"({out}) * {x} + {float(c)!r}::DOUBLE"
    return f"({out})"


def sql_cdf(x: str) -> str:
    """The distribution function in SQL; |x| stays below 7 in our uses."""
    up = f"(exp(-({x}) * ({x}) / 2.0) * {sql_poly(normal.CDF_NUM, f'abs({x})')} / {sql_poly(normal.CDF_DEN, f'abs({x})')})"
    return f"CASE WHEN ({x}) > 0 THEN 1.0 - {up} ELSE {up} END"


def sql_pdf(x: str) -> str:
    return f"(exp(-({x}) * ({x}) / 2.0) / sqrt(2 * pi()))"


def sql_ppf(p: str) -> str:
    q, r = f"(({p}) - 0.5)", f"(0.180625 - (({p}) - 0.5) * (({p}) - 0.5))"
    s = f"(sqrt(-ln(least({p}, 1.0 - ({p})))) - 1.6)"
    near = f"({sql_poly(normal.PPF_NEAR_NUM, s)} / {sql_poly(normal.PPF_NEAR_DEN, s)})"
    return (f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {sql_poly(normal.PPF_MID_NUM, r)} / {sql_poly(normal.PPF_MID_DEN, r)} "
            f"WHEN {q} < 0 THEN -{near} ELSE {near} END")


@query("sf1_labels", sql="""SELECT s_suppkey AS store_id, 'Store ' || s_suppkey AS store_label, lower(s_name) AS name_lower, contains(lower(s_name), '9') AS has_nine,
split_part(s_name, '#', 2) AS number FROM supplier""")
def _(spark, sf):
    s = tables.table(spark, sf, "supplier")
    return s.select(F.col("s_suppkey").alias("store_id"), text.label("Store", F.col("s_suppkey")).alias("store_label"), F.lower("s_name").alias("name_lower"),
                    F.lower("s_name").contains("9").alias("has_nine"), F.get(F.split("s_name", "#"), F.lit(1)).alias("number"))


CAT_SQL = "cat AS (SELECT unnest(range(20)) AS slot, unnest([{}]) AS product_name, unnest([{}]) AS category, unnest([{}])::INTEGER AS shelf_life_days, unnest([{}])::DOUBLE AS unit_cost, unnest([{}])::DOUBLE AS retail_price)".format(
    ", ".join(f"'{r[0]}'" for r in catalogue.PRODUCT_CATALOG), ", ".join(f"'{r[1]}'" for r in catalogue.PRODUCT_CATALOG),
    *[", ".join(str(r[i]) for r in catalogue.PRODUCT_CATALOG) for i in (2, 3, 4)])


@query("sf2_catalog_lookup", ctes=CAT_SQL, sql="""SELECT p_partkey AS product_id, product_name, category, shelf_life_days, unit_cost, retail_price,
'SKU-' || p_partkey || ' | ' || product_name AS display_name FROM part JOIN cat ON p_partkey % 20 = slot""")
def _(spark, sf):
    return catalogue.catalog_lookup(tables.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id")), "product_id")


@query("sf2_store_names", sql="SELECT s_suppkey AS store_id, list_extract([{}], CAST(s_suppkey % 10 + 1 AS INTEGER)) AS store_name FROM supplier".format(
    ", ".join(f"'{n}'" for n in catalogue.STORE_NAMES)))
def _(spark, sf):
    return tables.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("store_id"), catalogue.store_name(F.col("s_suppkey")).alias("store_name"))


@query("sf3_hashes", sql="SELECT o_orderkey, md5(o_orderkey || '|' || o_custkey) AS m, sha256(o_orderpriority) AS s FROM orders")
def _(spark, sf):
    return tables.table(spark, sf, "orders").select("o_orderkey", text.record_hash(F.col("o_orderkey"), F.col("o_custkey")).alias("m"), F.sha2("o_orderpriority", 256).alias("s"))


@query("sf4_date_parts", sql="""SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(weekofyear(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month,
strftime(ts, '%Y%m%d') AS ymd, date_trunc('hour', ts)::TIMESTAMP AS hour_start FROM events""")
def _(spark, sf):
    d = F.to_date("ts")
    return tables.table(spark, sf, "events").select("event_id", F.dayofweek("ts").alias("dow"), F.weekofyear("ts").alias("week"), F.month("ts").alias("month"),
                                                    F.date_format("ts", "yyyyMMdd").alias("ymd"), cal.event_ts(d, F.hour("ts")).alias("hour_start"))


@query("sf5_math", sql="""SELECT l_orderkey, l_linenumber, l_partkey, CAST(ceil(l_quantity * 1.5) AS BIGINT) AS up, greatest(0.02, least(0.08, l_discount)) AS clipped,
round(sqrt(l_quantity), 6) AS root, round(ln(l_quantity + 1), 6) AS log1, round(sin(l_quantity), 6) AS s FROM lineitem""")
def _(spark, sf):
    q = F.col("l_quantity")
    return rounded(tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.ceil(q * 1.5).alias("up"),
                                                              scores.clip(F.col("l_discount"), 0.02, 0.08).alias("clipped"), F.sqrt(q).alias("root"), F.ln(q + 1).alias("log1"), F.sin(q).alias("s")))


@query("sf6_normal", sql=f"""SELECT event_id, round({sql_cdf('z')}, 9) AS cdf, round({sql_pdf('z')}, 9) AS pdf, round({sql_ppf('p')}, 9) AS ppf
FROM (SELECT event_id, value / 100.0 - 2.0 AS z, 0.001 + (event_id % 997) / 1000.0 AS p FROM events)""")
def _(spark, sf):
    e = tables.table(spark, sf, "events").select("event_id", (F.col("value") / 100.0 - 2.0).alias("z"), (F.lit(0.001) + F.col("event_id") % 997 / F.lit(1000.0)).alias("p"))
    return rounded(e.select("event_id", normal.norm_cdf(F.col("z")).alias("cdf"), normal.norm_pdf(F.col("z")).alias("pdf"), normal.norm_ppf(F.col("p")).alias("ppf")), 9)


@query("sf7_arrays", ctes=DAILY, sql="""SELECT store_id, product_id, dt, CAST(len(hours_sale) AS INTEGER) AS n, round(list_sum(hours_sale), 6) AS total, round(hours_sale[9], 6) AS ninth,
round(list_sum(hours_sale[7:22]), 6) AS open_total, len(list_filter(hours_sale, lambda x: x > 100)) > 0 AS any_large,
len(list_filter(hours_stock_status, lambda x: x = 0)) = 0 AS all_out FROM daily""")
def _(spark, sf):
    a = F.col("hours_sale")
    return rounded(tables.daily(spark, sf).select(
        "store_id", "product_id", "dt", arrays.array_len(a).alias("n"), arrays.array_sum(a).alias("total"), arrays.slot(a, F.lit(8)).alias("ninth"),
        arrays.array_sum(arrays.open_slots(a)).alias("open_total"), F.exists(a, lambda x: x > 100).alias("any_large"),
        F.forall("hours_stock_status", lambda x: x == 1).alias("all_out")))


@query("sf8_json", sql="""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS doc FROM events""")
def _(spark, sf):
    e = tables.table(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"), F.to_json(F.struct("event_id", "event_type")).alias("doc"))


@query("sf9_conditional", sql="""SELECT CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'medium' WHEN o_totalprice IS NOT NULL THEN 'large' END AS size_band,
coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'none') AS status, count(*) AS n FROM orders GROUP BY ALL""")
def _(spark, sf):
    o = tables.table(spark, sf, "orders")
    status = F.coalesce(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.lit("none"))
    return o.groupBy(scores.band(F.col("o_totalprice"), (50000.0, 200000.0), ("small", "medium", "large")).alias("size_band"), status.alias("status")).agg(F.count("*").alias("n"))
