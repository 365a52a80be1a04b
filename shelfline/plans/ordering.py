"""Ordering, economics, policy and recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import catalogue
from shelfline.operators import economics as ec
from shelfline.operators import gold, islands, kpi, orders, recommend
from shelfline.plans.catalog import GRID, HOURLY, INCIDENTS, ORDER_DEMAND, query, rounded
from shelfline.plans.ingestion import UNIFORM
from shelfline.plans.kpis import RECOVERED, SCORED, recovered, scored
from shelfline.plans.scalars import CAT_SQL, sql_cdf, sql_pdf, sql_ppf
from shelfline.session import materialize
from shelfline.sources import tables

STATS = ORDER_DEMAND + ", stats AS (SELECT store_id, product_id, avg(sale_amount) AS mean_demand, stddev_samp(sale_amount) AS std_demand, count(*) AS n_days FROM demand GROUP BY ALL)"


def stats(spark, sf):
    return orders.demand_stats(tables.order_demand(spark, sf))


@query("nv1_demand_stats", ctes=STATS, sql="SELECT store_id, product_id, round(mean_demand, 6) AS mean_demand, round(std_demand, 6) AS std_demand, n_days FROM stats")
def _(spark, sf):
    return rounded(stats(spark, sf))


FIXED = STATS + """, fixed AS (SELECT store_id, product_id, greatest(0.1::DOUBLE, mean_demand) AS mean_demand,
  CASE WHEN std_demand > 0 THEN std_demand ELSE greatest(1.0::DOUBLE, greatest(0.1::DOUBLE, mean_demand) * 0.2) END AS std_demand FROM stats)"""


@query("nv2_demand_defaults", ctes=FIXED, sql="SELECT store_id, product_id, round(mean_demand, 6) AS mean_demand, round(std_demand, 6) AS std_demand FROM fixed")
def _(spark, sf):
    return rounded(orders.with_demand_defaults(stats(spark, sf)).select("store_id", "product_id", "mean_demand", "std_demand"))


PRICED = FIXED + ", " + CAT_SQL + """, priced AS (SELECT f.*, c.category, c.retail_price AS unit_price, c.unit_cost, c.shelf_life_days,
  greatest(0.1::DOUBLE, c.retail_price - c.unit_cost + 5.0::DOUBLE) AS cu,
  greatest(0.1::DOUBLE, (c.unit_cost + 0.5::DOUBLE - 1.0::DOUBLE) * greatest(1.0::DOUBLE, 7.0::DOUBLE / greatest(1, c.shelf_life_days))) AS co FROM fixed f JOIN cat c ON f.product_id % 20 = c.slot
), cf AS (SELECT *, least(0.99::DOUBLE, greatest(0.5::DOUBLE, cu / (cu + co))) AS p FROM priced
), zs AS (SELECT *, """ + sql_ppf("p") + """ * std_demand AS zs FROM cf
), qs AS (SELECT *, CAST(ceil(zs) AS BIGINT) AS safety_stock, greatest(0, CAST(ceil(mean_demand + zs) AS BIGINT)) AS q FROM zs
), zo AS (SELECT *, (q - mean_demand) / std_demand AS z FROM qs
), loss AS (SELECT *, """ + sql_cdf("z") + " AS c, " + sql_pdf("z") + """ AS d FROM zo
), nv AS (SELECT *, std_demand * (z * c + d) AS waste, std_demand * (-z * (1 - c) + d) AS short FROM loss)"""


def priced(spark, sf):
    """Demand statistics with the catalogue economics of the product."""
    return catalogue.catalog_lookup(stats(spark, sf), "product_id").withColumnRenamed("retail_price", "unit_price")


@query("nv3_optimal_order", ctes=PRICED, sql="""SELECT store_id, product_id, round(p, 4) AS critical_fractile, safety_stock, q AS optimal_order_qty, round(waste, 4) AS expected_waste_units,
round(short, 4) AS expected_stockout_units, round((mean_demand - short) * unit_price + waste * 1.0 - (q * unit_cost + short * 5.0), 4) AS expected_net_profit,
round(least(100, greatest(0, c * waste / greatest(1, q) * 100)), 4) AS spoilage_risk_score, round(least(100, greatest(0, (1 - c) * 100)), 4) AS stockout_risk_score FROM nv""")
def _(spark, sf):
    out = orders.optimal_order(priced(spark, sf))
    return rounded(out.select("store_id", "product_id", "critical_fractile", "safety_stock", "optimal_order_qty", "expected_waste_units", "expected_stockout_units",
                              "expected_net_profit", "spoilage_risk_score", "stockout_risk_score"), 4)


CV_SQL = "CASE category " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in catalogue.CATEGORY_CV.items()) + " ELSE 0.22::DOUBLE END"


@query("nv4_category_cv", ctes=PRICED, sql=f"SELECT store_id, product_id, category, {CV_SQL} AS cv, round(mean_demand * {CV_SQL}, 6) AS std_demand FROM priced")
def _(spark, sf):
    return rounded(orders.demand_by_category(priced(spark, sf)).select("store_id", "product_id", "category", "cv", "std_demand"))


@query("nv5_legacy_compare", ctes=PRICED, sql="""SELECT store_id, product_id, CAST(floor(mean_demand * 1.65) AS BIGINT) AS legacy_order, CAST(floor(mean_demand * 0.65) AS BIGINT) AS legacy_safety,
round(mean_demand * unit_price - floor(mean_demand * 1.65) * unit_cost, 4) AS legacy_profit, q - CAST(floor(mean_demand * 1.65) AS BIGINT) AS order_delta FROM nv""")
def _(spark, sf):
    out = orders.legacy_compare(orders.optimal_order(priced(spark, sf)))
    return rounded(out.select("store_id", "product_id", "legacy_order", "legacy_safety", "legacy_profit", "order_delta"), 4)


MARKDOWN = CAT_SQL + """, items AS (SELECT p_partkey AS product_id, CAST(40 + p_size * 3 AS BIGINT) AS stock, retail_price, unit_cost FROM part JOIN cat ON p_partkey % 20 = slot
), options AS (SELECT *, least(stock, CAST(floor(80 * (1.0::DOUBLE + m / 100.0::DOUBLE * 2.2)) AS BIGINT)) AS cleared FROM items CROSS JOIN (SELECT unnest(range(0, 55, 5))::INTEGER AS m)
), nets AS (SELECT *, cleared * (retail_price * (1.0::DOUBLE - m / 100.0::DOUBLE)) - cleared * unit_cost AS net FROM options)"""


@query("nv6_best_markdown", ctes=MARKDOWN, sql="""SELECT product_id, m AS best_markdown_pct, round(net, 4) AS net_recovery, cleared AS units_cleared FROM nets
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY net DESC, m) = 1""")
def _(spark, sf):
    items = catalogue.catalog_lookup(tables.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), (40 + F.col("p_size") * 3).cast("bigint").alias("stock")), "product_id")
    return rounded(orders.best_markdown(items, "stock", "retail_price", "unit_cost").select("product_id", "best_markdown_pct", "net_recovery", "units_cleared"), 4)


@query("nv7_savings_rollup", ctes=PRICED, sql="""SELECT round(s, 4) AS savings_per_day, n AS n_stores, CAST(floor(s * n * 90) AS BIGINT) AS dollars_saved, CAST(floor(s * n * 90 * 0.28) AS BIGINT) AS lbs_rescued,
CAST(floor(n * 90 * 0.06) AS BIGINT) AS stockouts_prevented, CAST(floor(floor(s * n * 90 * 0.28) * 2.48) AS BIGINT) AS meals_saved FROM (
SELECT greatest(0, avg((mean_demand - short) * unit_price + waste - (q * unit_cost + short * 5.0))) AS s, count(DISTINCT store_id) AS n FROM nv)""")
def _(spark, sf):
    return rounded(orders.savings_rollup(orders.optimal_order(priced(spark, sf)), F.countDistinct("store_id")), 4)


def _case(field, index=None):
    pick = lambda c: c[field] if index is None else c[field][index]
    return "CASE category " + " ".join(f"WHEN '{n}' THEN {float(pick(c))}::DOUBLE" for n, c in ec.CATEGORIES.items()) + " END"


def _draw_sql(field):
    u = UNIFORM.format(f"'42:{field}:' || product_id")
    return f"({_case(field, 0)} + {u} * ({_case(field, 1)} - {_case(field, 0)}))"


def economics_sql(source: str) -> str:
    """CTEs cats, econ and lead over a table with a product_id column."""
    return f"""cats AS (SELECT DISTINCT product_id, CASE WHEN product_id BETWEEN 1 AND 289 THEN 'highly_perishable' WHEN product_id BETWEEN 290 AND 577 THEN 'moderately_perishable'
  WHEN product_id BETWEEN 578 AND 865 THEN 'longer_life' END AS category FROM {source}
), econ0 AS (SELECT *, round({_draw_sql('price')}, 2) AS unit_price, {_draw_sql('ratio')} AS ratio, CAST(floor({_draw_sql('shelf')}) AS INTEGER) AS shelf_life_hours FROM cats
), econ1 AS (SELECT *, round(unit_price * ratio, 2) AS unit_cost FROM econ0
), econ AS (SELECT product_id, category, unit_price, unit_cost, unit_price - unit_cost AS unit_margin, shelf_life_hours, unit_cost * {_case('spoilage')} AS spoilage_cost,
  unit_cost * {_case('holding')} AS holding_cost_day FROM econ1
), lead AS (SELECT product_id, category, CAST(floor({_draw_sql('lead')}) AS INTEGER) AS lead_time_hours FROM cats)"""


SKU = "sku AS (SELECT p_partkey, CAST(p_partkey % 865 + 1 AS INTEGER) AS product_id, p_size FROM part)"


def skus(spark, sf):
    """Parts mapped to the id range of the product contract."""
    return tables.table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 865 + 1).cast("int").alias("product_id"), "p_size")


@query("ec1_product_economics", ctes=SKU + ", " + economics_sql("sku"), sql="""SELECT p_partkey, product_id, category, unit_price, unit_cost, round(unit_margin, 6) AS unit_margin, shelf_life_hours,
round(spoilage_cost, 6) AS spoilage_cost, round(holding_cost_day, 6) AS holding_cost_day FROM sku JOIN econ USING (product_id)""")
def _(spark, sf):
    return rounded(ec.product_economics(skus(spark, sf)).drop("p_size"))


@query("ec2_lead_time", ctes=SKU + ", " + economics_sql("sku"), sql="SELECT p_partkey, product_id, category, lead_time_hours FROM sku JOIN lead USING (product_id)")
def _(spark, sf):
    return ec.lead_time(skus(spark, sf)).drop("p_size")


@query("ec3_next_delivery", sql="""SELECT event_id, category, CAST((SELECT min(d) FROM (SELECT unnest(range(CAST(CAST(ts AS DATE) AS TIMESTAMP), CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 9 DAY, INTERVAL 1 DAY)) AS d)
 WHERE d + INTERVAL 5 HOUR >= ts + INTERVAL 12 HOUR AND (category = 'highly_perishable' OR (category = 'moderately_perishable' AND isodow(d) IN (1, 3, 5)) OR (category = 'longer_life' AND isodow(d) IN (1, 4)))) AS DATE) AS next_delivery
FROM (SELECT event_id, ts, CASE event_type WHEN 'click' THEN 'highly_perishable' WHEN 'view' THEN 'highly_perishable' WHEN 'error' THEN 'longer_life' ELSE 'moderately_perishable' END AS category FROM events)""")
def _(spark, sf):
    p = tables.pos(spark, sf).select(F.col("transaction_id").alias("event_id"), "timestamp", ec.category_of(F.col("product_id")).alias("category"))
    return ec.with_next_delivery(p, "timestamp").select("event_id", "category", "next_delivery")


@query("ec4_constrain_order", ctes=SKU + ", " + economics_sql("sku"), sql=f"""SELECT p_partkey, CASE WHEN p_size * 4.3 - 9 > 0 THEN least(greatest(ceil(p_size * 4.3 - 9)::DOUBLE, {_case('order', 0)}), {_case('order', 1)}) ELSE 0 END AS order_qty
FROM sku JOIN cats USING (product_id)""")
def _(spark, sf):
    df = skus(spark, sf).select("p_partkey", ec.category_of(F.col("product_id")).alias("category"), (F.col("p_size") * F.lit(4.3) - 9).alias("need"))
    return ec.constrain_order(df, "need").select("p_partkey", "order_qty")


DEMAND = GRID + ", demand AS (SELECT store_id, product_id, CAST(d AS DATE) AS dt, sale_amount FROM base), " + economics_sql("demand")


def demand(spark, sf):
    return tables.daily(spark, sf).select("store_id", "product_id", F.to_date("dt").alias("dt"), "sale_amount")


def products(spark, sf):
    return tables.pos(spark, sf).select("product_id").distinct()


@query("ec5_policy_order", ctes=DEMAND + """, qs AS (SELECT store_id, product_id, quantile_cont(sale_amount, [0.5, 0.9, 0.95, 0.99, 0.75]) AS q FROM demand GROUP BY ALL)""",
       sql="""SELECT store_id, product_id, policy_name, round(q[i] * lead_time_hours / 24.0, 8) AS order_up_to, round(q[i] - q[1], 8) AS safety_stock
FROM qs JOIN lead USING (product_id) CROSS JOIN (SELECT unnest(['conservative_95', 'balanced_97', 'aggressive_99', 'lean_90']) AS policy_name, unnest([2, 3, 4, 5]) AS i)""")
def _(spark, sf):
    out = ec.policy_order(demand(spark, sf), ec.lead_time(products(spark, sf)))
    return rounded(out.select("store_id", "product_id", "policy_name", "order_up_to", "safety_stock"), 8)


@query("ec6_emergency_cost", ctes=INCIDENTS, sql="SELECT store_id, event_date AS start_date, least(count(*), 3) * 50.0::DOUBLE AS emergency_cost FROM incidents_day GROUP BY ALL")
def _(spark, sf):
    return ec.emergency_cost(kpi.kpi_incident_count(islands.incidents_from_daily(tables.daily(spark, sf), span_days=False)))


def cycles_sql(options) -> str:
    probs = ", ".join(str(o[1]) for o in options)
    names = ", ".join(f"'{o[0]}'" for o in options)
    return DEMAND + f""", qs AS (SELECT store_id, product_id, quantile_cont(sale_amount, [{probs}]) AS q FROM demand GROUP BY ALL
), opt AS (SELECT unnest([{names}]) AS policy_name, unnest(range(1, {len(options) + 1})) AS i
), cyc AS (SELECT policy_name, store_id, product_id, dt, sale_amount AS demand, greatest(sale_amount - q[i], 0) AS lost, greatest(q[i] - sale_amount, 0) AS lft, econ.* EXCLUDE (product_id)
  FROM demand JOIN qs USING (store_id, product_id) JOIN econ USING (product_id) CROSS JOIN opt
), cyc2 AS (SELECT *, CASE WHEN shelf_life_hours <= 72 THEN lft ELSE 0 END AS expired FROM cyc
), cyc3 AS (SELECT *, lost * unit_margin AS lost_cost, CASE WHEN shelf_life_hours < 336 THEN expired * (unit_cost + spoilage_cost) ELSE 0 END AS waste_cost, lft * holding_cost_day AS holding_cost FROM cyc2
), per_store AS (SELECT policy_name, store_id, dt, sum(lost_cost) AS lost_cost, sum(waste_cost) AS waste_cost, sum(holding_cost) AS holding_cost, sum(demand) AS demand, sum(lost) AS lost,
  sum(expired) AS expired, least(count(*) FILTER (WHERE lost > 0), 3) * 50.0 AS em FROM cyc3 GROUP BY ALL)"""


COMPARE_SQL = """SELECT policy_name, round(sum(lost_cost), 2) AS lost_cost, round(sum(waste_cost), 2) AS waste_cost, round(sum(holding_cost), 2) AS holding_cost, sum(em)::DOUBLE AS emergency_cost,
round(sum(expired), 2) AS expired_units, round((1 - sum(lost) / sum(demand)) * 100, 2) AS service_level_pct, round(sum(lost_cost) + sum(waste_cost) + sum(holding_cost) + sum(em), 2) AS total_cost FROM per_store GROUP BY ALL"""
POLICY_CYCLES = cycles_sql(ec.policy_options())


def policy_cycles(spark, sf, options=None):
    return ec.cycle_costs(demand(spark, sf), options or ec.policy_options())


@query("ec7_policy_compare", ctes=POLICY_CYCLES, sql=COMPARE_SQL)
def _(spark, sf):
    return rounded(ec.policy_compare(policy_cycles(spark, sf)), 2)


@query("ec8_tradeoff_curve", ctes=cycles_sql(ec.tradeoff_options()), sql=COMPARE_SQL)
def _(spark, sf):
    return rounded(ec.policy_compare(policy_cycles(spark, sf, ec.tradeoff_options())), 2)


@query("kp8_lost_sales_cost", ctes=RECOVERED + ", " + economics_sql("ops"), sql="""SELECT store_id, product_id, event_date, round(sum(CASE WHEN stockout_flag = 1 THEN recovered_demand - observed_sales ELSE 0 END * unit_margin), 8) AS lost_sales_cost
FROM recovered JOIN econ USING (product_id) GROUP BY ALL""")
def _(spark, sf):
    return rounded(kpi.kpi_lost_sales_cost(recovered(spark, sf), ["store_id", "product_id", "event_date"]), 8)


@query("kp9_waste_cost", ctes=POLICY_CYCLES, sql="SELECT policy_name, store_id, product_id, dt, round(sum(waste_cost), 8) AS waste_cost FROM cyc3 GROUP BY ALL")
def _(spark, sf):
    return rounded(policy_cycles(spark, sf).groupBy("policy_name", "store_id", "product_id", "dt").agg(F.sum("waste_cost").alias("waste_cost")), 8)


@query("kp20_expired_qty", ctes=POLICY_CYCLES, sql="SELECT policy_name, store_id, product_id, round(sum(expired), 6) AS expired_units FROM cyc3 GROUP BY ALL")
def _(spark, sf):
    return rounded(policy_cycles(spark, sf).groupBy("policy_name", "store_id", "product_id").agg(F.sum("expired_units").alias("expired_units")))


@query("kp21_total_cost", ctes=POLICY_CYCLES, sql="SELECT policy_name, store_id, dt, round(lost_cost + waste_cost + holding_cost + em, 4) AS total_cost FROM per_store")
def _(spark, sf):
    c = policy_cycles(spark, sf)
    per = c.groupBy("policy_name", "store_id", "dt").agg((F.sum("lost_cost") + F.sum("waste_cost") + F.sum("holding_cost")).alias("cost"), F.count_if(F.col("lost_units") > 0).alias("short"))
    em = F.least(F.col("short"), F.lit(ec.EMERGENCY_CAP)) * F.lit(ec.EMERGENCY_COST)
    return rounded(per.select("policy_name", "store_id", "dt", (F.col("cost") + em).alias("total_cost")), 4)


# recommendation inputs per store, product and day: rate of the day's stockout hours as probability,
# series demand quantiles, hours to expiry from the shelf life and the day
RECS = INCIDENTS + ", " + economics_sql("base") + """, rec0 AS (
  SELECT o.store_id, o.product_id, o.event_date AS dt, round(avg(o.stockout_flag), 4) AS p FROM ops o GROUP BY ALL
), fq AS (SELECT store_id, product_id, quantile_cont(sale_amount, 0.5) AS med, quantile_cont(sale_amount, 0.9) AS q90 FROM base GROUP BY ALL
), inc_day AS (SELECT store_id, product_id, event_date, count(*) AS n FROM incidents_day GROUP BY ALL
), inc7 AS (SELECT store_id, product_id, event_date AS dt, CAST(sum(n) OVER (PARTITION BY store_id, product_id ORDER BY event_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS recent FROM inc_day
), rec1 AS (SELECT r.*, med, q90, coalesce(recent, 0) AS recent, category, shelf_life_hours - (day(dt) * 5) % 60 AS left_hours,
  shelf_life_hours - (day(dt) * 5) % 60 < CASE category WHEN 'highly_perishable' THEN 12 WHEN 'moderately_perishable' THEN 24 ELSE 48 END AS due
  FROM rec0 r JOIN fq USING (store_id, product_id) JOIN econ USING (product_id) LEFT JOIN inc7 USING (store_id, product_id, dt)
), rec2 AS (SELECT *, CASE WHEN p >= 0.75 THEN 'escalate' WHEN p >= 0.5 THEN 'replenish' WHEN due THEN 'markdown' ELSE 'monitor' END AS action_type,
  CASE WHEN p < 0.4 THEN 'routine' WHEN p < 0.7 THEN 'elevated' ELSE 'urgent' END AS urgency,
  CASE WHEN p >= 0.5 AND recent >= 5 THEN 'chronic_stockout' WHEN p >= 0.75 THEN 'stockout_high_risk' WHEN p >= 0.5 THEN 'stockout_moderate_risk' WHEN due THEN 'approaching_expiry'
       WHEN q90 > med * 2 THEN 'demand_spike_predicted' ELSE 'excess_inventory' END AS reason_code FROM rec1)"""


def recommendation_inputs(spark, sf):
    """The daily rows are folded once and stored; rates, quantiles and incidents all start from them."""
    d = materialize(tables.daily(spark, sf), "daily")
    day = d.select("store_id", "product_id", F.to_date("dt").alias("dt"), F.round(F.col("stock_hour6_22_cnt") / 16.0, 4).alias("stockout_probability"))
    q = ec.demand_quantiles(d, [0.5, 0.9]).select("store_id", "product_id", F.get("_q", F.lit(0)).alias("forecast_median"), F.get("_q", F.lit(1)).alias("forecast_q90"))
    q = ec.product_economics(q).select("store_id", "product_id", "forecast_median", "forecast_q90", "category", "shelf_life_hours")
    recent = recommend.recent_incidents(islands.incidents_from_daily(d, span_days=False))
    left = F.col("shelf_life_hours") - (F.dayofmonth("dt") * 5) % 60
    joined = day.join(q, ["store_id", "product_id"]).join(recent, ["store_id", "product_id", "dt"], "left")
    return recommend.markdown_due(joined.withColumn("hours_to_expiry", left), "hours_to_expiry")


def recommendations(spark, sf):
    return recommend.recommend(recommendation_inputs(spark, sf))


@query("rc1_actions", ctes=RECS, sql="SELECT store_id, product_id, dt, action_type, CASE WHEN action_type = 'replenish' THEN ceil(q90)::DOUBLE END AS suggested_order_qty, CASE WHEN action_type = 'markdown' THEN 0.2::DOUBLE END AS suggested_markdown_pct FROM rec2")
def _(spark, sf):
    return recommendations(spark, sf).select("store_id", "product_id", "dt", "action_type", "suggested_order_qty", "suggested_markdown_pct")


@query("rc2_urgency", ctes=RECS, sql="SELECT store_id, product_id, dt, p AS stockout_probability, urgency FROM rec2")
def _(spark, sf):
    return recommendations(spark, sf).select("store_id", "product_id", "dt", "stockout_probability", "urgency")


@query("rc3_reason_code", ctes=RECS, sql="SELECT store_id, product_id, dt, recent AS recent_incidents, reason_code FROM rec2")
def _(spark, sf):
    return recommendations(spark, sf).select("store_id", "product_id", "dt", F.coalesce("recent_incidents", F.lit(0)).cast("bigint").alias("recent_incidents"), "reason_code")


@query("rc4_markdown_due", ctes=RECS, sql="SELECT store_id, product_id, dt, category, due AS markdown_due FROM rec2")
def _(spark, sf):
    return recommendation_inputs(spark, sf).select("store_id", "product_id", "dt", "category", "markdown_due")


@query("gd13_fact_recommendation", ctes=RECS, sql="""SELECT store_id, product_id, dt, action_type AS recommended_action, round(p, 3) AS urgency_score, p AS stockout_probability, reason_code,
CASE WHEN action_type = 'monitor' THEN 'DONE' ELSE 'OPEN' END AS recommendation_status, policy_name FROM rec2 CROSS JOIN (SELECT 'conservative_95' AS policy_name)""")
def _(spark, sf):
    r = recommendations(spark, sf)
    return r.select("store_id", "product_id", "dt", F.col("action_type").alias("recommended_action"), "urgency_score", "stockout_probability", "reason_code", "recommendation_status",
                    F.lit(gold.POLICIES[0][0]).alias("policy_name"))


@query("kp18_rec_coverage", ctes=RECS + SCORED[len(HOURLY):], sql="""SELECT s.event_date, s.store_id, round(count(r.dt) / count(*)::DOUBLE * 100, 6) AS coverage_pct FROM (
SELECT DISTINCT event_date, store_id, product_id FROM scored WHERE p >= 0.5) s LEFT JOIN rec2 r ON r.store_id = s.store_id AND r.product_id = s.product_id AND r.dt = s.event_date GROUP BY ALL""")
def _(spark, sf):
    """Share of the products that the classifier puts at risk for which the engine gave a recommendation."""
    risky = scored(spark, sf).filter("stockout_probability >= 0.5")
    recs = recommendations(spark, sf).withColumnRenamed("dt", "event_date")
    return rounded(kpi.kpi_rec_coverage(risky, recs, ["event_date", "store_id", "product_id"], ["event_date", "store_id"]))


@query("kp19_urgent_count", ctes=RECS, sql="SELECT dt AS event_date, store_id, count(*) FILTER (WHERE urgency = 'urgent') AS urgent_count FROM rec2 GROUP BY ALL")
def _(spark, sf):
    """Urgent recommendations per day and store."""
    return kpi.kpi_urgent_count(recommendations(spark, sf).withColumnRenamed("dt", "event_date"), ["event_date", "store_id"])
