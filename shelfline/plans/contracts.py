"""Data-contract rules. Forecast, risk and recommendation rows are derived from order lines and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.functions import scores
from shelfline.operators import clean, rules
from shelfline.plans.catalog import BRONZE, HOURLY, query, rounded
from shelfline.plans.cleaning import checked, hourly
from shelfline.sources import tables


def report(sql_rows: list[tuple[str, str, str, str]], source: str) -> str:
    """SQL for a rule report from (rule, severity, violation predicate or count, allowed rate)."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{sev}' AS severity, count(*) FILTER (WHERE coalesce({pred}, false)) AS violations, "
        f"count(*) AS checked, count(*) FILTER (WHERE coalesce({pred}, false)) <= {rate} * count(*) AS passed FROM {source}"
        for rule, sev, pred, rate in sql_rows)


def group_report(rule, severity, keys, bad, source):
    return (f"SELECT '{rule}' AS rule, '{severity}' AS severity, count(*) FILTER (WHERE {bad}) AS violations, count(*) AS checked, "
            f"count(*) FILTER (WHERE {bad}) = 0 AS passed FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})")


@query("dq1_schema_report", ctes=BRONZE, sql="""SELECT unnest(['store_id', 'product_id', 'dt', 'weather_main', 'sale_amount', 'hours_sale']) AS column_name,
unnest(['expected', 'expected', 'expected', 'expected', 'unexpected', 'unexpected']) AS kind, unnest([true, true, true, false, true, true]) AS present,
unnest([count(store_id), count(product_id), count(dt), NULL, count(sale_amount), count(hours_sale)]) AS filled FROM bronze""")
def _(spark, sf):
    """Expected and unexpected columns with their filled rows."""
    df = tables.bronze(spark, sf).select("store_id", "product_id", "dt", "sale_amount", "hours_sale")
    return rules.schema_report(df, {c: "" for c in ("store_id", "product_id", "dt", "weather_main")})


@query("dq2_not_null", ctes=BRONZE, sql=report([
    ("not_null:store_id", "error", "store_id IS NULL", "0.0"),
    ("not_null:sale_amount", "error", "sale_amount IS NULL", "0.05"),
    ("not_null:hours_stock_status", "error", "hours_stock_status IS NULL", "0.05")], "bronze"))
def _(spark, sf):
    return rules.validate(tables.bronze(spark, sf), rules.not_null("store_id") + rules.not_null("sale_amount", "hours_stock_status", max_rate=0.05))


@query("dq3_unique_key", ctes=BRONZE, sql=group_report("unique_key:store_id,product_id,dt", "error", "store_id, product_id, dt", "n > 1", "bronze"))
def _(spark, sf):
    return rules.validate(tables.bronze(spark, sf), [rules.unique_key("store_id", "product_id", "dt")])


@query("dq3_duplicate_rows", ctes=BRONZE, sql="""SELECT store_id, product_id, dt, source_file FROM bronze
QUALIFY count(*) OVER (PARTITION BY store_id, product_id, dt) > 1""")
def _(spark, sf):
    bad = rules.violating_rows(tables.bronze(spark, sf), rules.unique_key("store_id", "product_id", "dt"))
    return bad.select("store_id", "product_id", "dt", "source_file")


@query("dq4_parseable_date", sql=report([("parseable_date:dt", "error", "try_strptime(dt, '%Y-%m-%d') IS NULL AND dt IS NOT NULL", "0.0")],
       "(SELECT CASE WHEN o_custkey % 7 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dt FROM orders)"))
def _(spark, sf):
    o = tables.table(spark, sf, "orders")
    text = F.when(F.col("o_custkey") % 7 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return rules.validate(o.select(text.alias("dt")), [rules.parseable_date("dt")])


@query("dq5_non_negative", sql=report([("non_negative:c_acctbal", "error", "c_acctbal < 0", "0.0")], "customer")
       + " UNION ALL " + report([("non_negative:a,b", "error", "coalesce(s_acctbal < 0, false) OR coalesce(s_acctbal - 100 < 0, false)", "0.0")], "supplier"))
def _(spark, sf):
    s = tables.table(spark, sf, "supplier").select(F.col("s_acctbal").alias("a"), (F.col("s_acctbal") - 100).alias("b"))
    return rules.validate(tables.table(spark, sf, "customer"), [rules.non_negative("c_acctbal")]).unionByName(
        rules.validate(s, [rules.non_negative("a", "b")]))


@query("dq6_array_length", ctes=BRONZE, sql=report([
    ("array_length:hours_sale", "error", "hours_sale IS NULL OR len(hours_sale) <> 24", "0.0"),
    ("array_length:status_text", "error", "hours_stock_status IS NULL OR len(hours_stock_status) <> 24 OR mix % 29 = 0", "0.0")],
    "(SELECT *, store_id + product_id + n AS mix FROM bronze)"))
def _(spark, sf):
    """A native array and a JSON text whose elements are sometimes of the wrong type."""
    mix = F.col("store_id") + F.col("product_id") + F.dayofmonth(F.to_date("dt"))
    text = F.when(mix % 29 == 0, F.lit('["a","b"]')).otherwise(F.to_json("hours_stock_status"))
    df = tables.bronze(spark, sf).withColumn("status_text", text)
    return rules.validate(df, [rules.array_length("hours_sale"), rules.array_length("status_text", elem="int")])


@query("dq7_array_range", ctes=BRONZE, sql=report([
    ("array_range:hours_sale", "error", "len(list_filter(hours_sale, lambda x: x < 0.0 OR x > 30.0)) > 0", "0.0"),
    ("array_range:shifted", "error", "len(list_filter(hours_sale, lambda x: x - 1 < 0.0)) > 0", "0.0")], "bronze"))
def _(spark, sf):
    df = tables.bronze(spark, sf).withColumn("shifted", F.transform("hours_sale", lambda x: x - 1))
    return rules.validate(df, [rules.array_range("hours_sale", 0.0, 30.0), rules.array_range("shifted", 0.0)])


@query("dq8_array_values", ctes=BRONZE, sql=report([
    ("array_values:hours_stock_status", "error", "len(list_filter(hours_stock_status, lambda x: x NOT IN (0, 1))) > 0", "0.0"),
    ("array_values:scaled", "error", "len(list_filter(hours_stock_status, lambda x: x * n NOT IN (0, 1))) > 0", "0.0")], "bronze"))
def _(spark, sf):
    n = F.dayofmonth(F.to_date("dt"))
    df = tables.bronze(spark, sf).withColumn("scaled", F.transform("hours_stock_status", lambda x: x * n))
    return rules.validate(df, [rules.array_values("hours_stock_status", (0, 1)), rules.array_values("scaled", (0, 1))])


@query("dq9_value_range", ctes=BRONZE, sql=report([
    ("value_range:avg_temperature", "warning", "avg_temperature NOT BETWEEN 0.0 AND 20.0", "0.0"),
    ("value_range:city_id", "warning", "city_id NOT BETWEEN 1 AND 18", "0.0"),
    ("value_range:sale_amount", "error", "sale_amount NOT BETWEEN 0 AND 100", "0.0")], "bronze"))
def _(spark, sf):
    return rules.validate(tables.bronze(spark, sf), [
        rules.value_range("avg_temperature", 0.0, 20.0, "warning"), rules.value_range("city_id", 1, 18, "warning"),
        rules.value_range("sale_amount", 0.0, 100.0)])


@query("dq10_accepted", sql=report([("accepted:o_orderstatus", "error", "o_orderstatus NOT IN ('O', 'F')", "0.0"),
       ("accepted:o_orderpriority", "warning", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')", "0.9")], "orders"))
def _(spark, sf):
    low = rules.accepted("o_orderpriority", ["1-URGENT", "2-HIGH"], "warning")
    return rules.validate(tables.table(spark, sf, "orders"), [
        rules.accepted("o_orderstatus", ["O", "F"]), rules.Rule(low.name, low.severity, low.violated, max_rate=0.9)])


@query("dq11_timestamp_match", ctes=HOURLY, sql=report([("timestamp_match:event_timestamp", "error",
       "event_timestamp + to_hours(CAST(hour_of_day = 23 AS INTEGER)) <> CAST(event_date AS TIMESTAMP) + to_hours(hour_of_day)", "0.0")], "hourly"))
def _(spark, sf):
    late = F.make_dt_interval(F.lit(0), (F.col("hour_of_day") == 23).cast("int"))
    df = hourly(spark, sf).withColumn("event_timestamp", F.col("event_timestamp") + late)
    return rules.validate(df, [rules.timestamp_match("event_date", "hour_of_day", "event_timestamp")])


@query("dq12_group_count", ctes=HOURLY, sql=group_report("group_count:store_id,product_id,event_date", "warning",
       "store_id, product_id, event_date", "n <> 16", "(SELECT * FROM ops WHERE NOT (stockout_flag = 0 AND hour_of_day = 9))"))
def _(spark, sf):
    df = hourly(spark, sf, True).filter("NOT (stockout_flag = 0 AND hour_of_day = 9)")
    return rules.validate(df, [rules.group_count(["store_id", "product_id", "event_date"], 16)])


# forecasts as the contract describes them, one per part, spread by price and size
FORECAST = """fc AS (SELECT p_partkey AS product_id, p_retailprice * 0.01 AS forecast_q10, p_retailprice * 0.01 + p_size * 0.1 AS forecast_q25,
  p_retailprice * 0.01 + 2.0 AS forecast_median, p_retailprice * 0.01 + 4.0 AS forecast_q75,
  p_retailprice * 0.01 + p_size * 3.0 AS forecast_q90 FROM part)"""


def forecasts(spark, sf):
    base = F.col("p_retailprice") * F.lit(0.01)
    size = F.col("p_size")
    return tables.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), base.alias("forecast_q10"), (base + size * F.lit(0.1)).alias("forecast_q25"),
        (base + 2.0).alias("forecast_median"), (base + 4.0).alias("forecast_q75"), (base + size * F.lit(3.0)).alias("forecast_q90"))


@query("dq13_quantile_order", ctes=FORECAST, sql=report([("quantile_order", "error",
       "NOT (forecast_q10 <= forecast_q25 AND forecast_q25 <= forecast_median AND forecast_median <= forecast_q75 AND forecast_q75 <= forecast_q90)", "0.0")], "fc"))
def _(spark, sf):
    return rules.validate(forecasts(spark, sf), [rules.quantile_order(
        ["forecast_q10", "forecast_q25", "forecast_median", "forecast_q75", "forecast_q90"])])


@query("dq14_interval_width", ctes=FORECAST, sql=report([("interval_width", "warning",
       "forecast_median > 0 AND forecast_q90 - forecast_q10 > forecast_median * 10.0", "0.0")], "fc"))
def _(spark, sf):
    return rules.validate(forecasts(spark, sf), [rules.interval_width("forecast_q10", "forecast_q90", "forecast_median")])


@query("dq15_fresh", sql=report([("fresh:ts", "warning", "ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR", "0.0")], "events"))
def _(spark, sf):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return rules.validate(tables.table(spark, sf, "events"), [rules.fresh("ts", 24, now)])


RISK = """risk AS (SELECT s_suppkey AS store_id, p, mismatch,
  CASE WHEN mismatch THEN 'low' WHEN p < 0.25 THEN 'low' WHEN p < 0.5 THEN 'medium' WHEN p < 0.75 THEN 'high' ELSE 'critical' END AS risk_tier,
  (p >= 0.5) <> mismatch AS is_alert,
  CASE WHEN mismatch THEN 'routine' WHEN p < 0.4 THEN 'routine' WHEN p < 0.7 THEN 'elevated' ELSE 'urgent' END AS urgency,
  CASE s_nationkey % 4 WHEN 0 THEN 'replenish' WHEN 1 THEN 'markdown' WHEN 2 THEN 'monitor' ELSE 'escalate' END AS action_type,
  CASE WHEN s_nationkey % 4 = 0 AND NOT mismatch THEN s_acctbal / 100 END AS suggested_order_qty,
  CASE WHEN s_nationkey % 4 = 1 THEN s_nationkey * 0.05 END AS suggested_markdown_pct
  FROM (SELECT *, (s_suppkey % 101) / 100.0::DOUBLE AS p, s_nationkey % 5 = 0 AS mismatch FROM supplier))"""


def risks(spark, sf):
    """Risk and recommendation rows per supplier; every fifth nation's rows contradict themselves."""
    n = F.col("s_nationkey")
    mismatch = n % 5 == 0
    p = F.col("s_suppkey") % 101 / F.lit(100.0)
    return tables.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("store_id"), p.alias("p"),
        F.when(mismatch, "low").otherwise(scores.risk_tier(p)).alias("risk_tier"),
        (scores.is_alert(p) != mismatch).alias("is_alert"),
        F.when(mismatch, "routine").otherwise(scores.urgency(p)).alias("urgency"),
        F.element_at(F.array(*[F.lit(a) for a in rules.ACTIONS]), (n % 4 + 1).cast("int")).alias("action_type"),
        F.when((n % 4 == 0) & ~mismatch, F.col("s_acctbal") / 100).alias("suggested_order_qty"),
        F.when(n % 4 == 1, n * F.lit(0.05)).alias("suggested_markdown_pct"))


@query("dq16_tier_match", ctes=RISK, sql=report([("tier_match", "error",
       "risk_tier <> CASE WHEN p < 0.25 THEN 'low' WHEN p < 0.5 THEN 'medium' WHEN p < 0.75 THEN 'high' ELSE 'critical' END", "0.0")], "risk"))
def _(spark, sf):
    return rules.validate(risks(spark, sf), [rules.tier_match("p", "risk_tier")])


@query("dq17_alert_match", ctes=RISK, sql=report([("alert_match", "error", "is_alert <> (p >= 0.5)", "0.0")], "risk"))
def _(spark, sf):
    return rules.validate(risks(spark, sf), [rules.alert_match("p", "is_alert")])


@query("dq18_conditional", ctes=RISK, sql=report([
    ("conditional:replenish_has_qty", "error", "action_type = 'replenish' AND suggested_order_qty IS NULL", "0.0"),
    ("conditional:qty_positive", "error", "suggested_order_qty IS NOT NULL AND NOT suggested_order_qty >= 0", "0.0"),
    ("conditional:markdown_range", "warning", "suggested_markdown_pct IS NOT NULL AND NOT suggested_markdown_pct BETWEEN 0.01 AND 0.90", "0.0")], "risk"))
def _(spark, sf):
    qty, pct = F.col("suggested_order_qty"), F.col("suggested_markdown_pct")
    return rules.validate(risks(spark, sf), [
        rules.conditional("replenish_has_qty", lambda: F.col("action_type") == "replenish", lambda: qty.isNotNull()),
        rules.conditional("qty_positive", lambda: qty.isNotNull(), lambda: qty >= 0),
        rules.conditional("markdown_range", lambda: pct.isNotNull(), lambda: pct.between(0.01, 0.90), "warning")])


@query("dq19_urgency_match", ctes=RISK, sql=report([("urgency_match", "warning",
       "(urgency = 'urgent' AND p < 0.7) OR (urgency = 'routine' AND p >= 0.4)", "0.0")], "risk"))
def _(spark, sf):
    return rules.validate(risks(spark, sf), [rules.urgency_match("p", "urgency")])


@query("dq20_max_per_group", sql=group_report("max_per_group:l_orderkey", "warning", "l_orderkey", "n > 2", "lineitem"))
def _(spark, sf):
    return rules.validate(tables.table(spark, sf, "lineitem"), [rules.max_per_group(["l_orderkey"], 2)])


@query("dq21_implies", ctes=RISK, sql=report([("implies:escalation_is_urgent", "warning",
       "action_type = 'escalate' AND urgency NOT IN ('urgent', 'elevated')", "0.0")], "risk"))
def _(spark, sf):
    return rules.validate(risks(spark, sf), [rules.implies(
        "escalation_is_urgent", lambda: F.col("action_type") == "escalate", lambda: F.col("urgency").isin("urgent", "elevated"))])


@query("dq22_sla", ctes=BRONZE, sql="""SELECT metric, round(value, 6) AS value, op, threshold, CASE WHEN (op = '<=' AND value <= threshold) OR (op = '>=' AND value >= threshold)
THEN 'PASS' ELSE 'FAIL' END AS status FROM (
SELECT unnest(['rejection_rate', 'row_amplification']) AS metric, unnest([rr, amp]) AS value, unnest(['<=', '>=']) AS op,
       unnest([0.001::DOUBLE, 16.0::DOUBLE]) AS threshold
FROM (SELECT avg((NOT is_valid)::INT) AS rr, avg(len(hours_sale)) AS amp FROM checked))""")
def _(spark, sf):
    stats = checked(spark, sf).agg(
        F.avg((~F.col("is_valid")).cast("int")).alias("rejection_rate"), F.avg(F.size("hours_sale")).alias("row_amplification"))
    return rounded(rules.sla(stats, {"rejection_rate": ("<=", 0.001), "row_amplification": (">=", 16.0)}))


@query("dq23_coverage", ctes=HOURLY, sql="""SELECT store_id, count(*) AS expected_keys, CAST(sum(stockout_flag) AS BIGINT) AS missing_keys,
round(sum(stockout_flag) / count(*)::DOUBLE, 6) AS missing_rate FROM ops GROUP BY store_id""")
def _(spark, sf):
    """Operational hours of each series day that hold no sale."""
    keys = ["store_id", "product_id", "event_timestamp"]
    sold = tables.pos(spark, sf).select("store_id", "product_id", F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("event_timestamp"))
    return rounded(rules.coverage(sold, hourly(spark, sf, True).select(*keys), keys, ["store_id"]))


@query("dq24_gate", ctes=BRONZE, sql="""SELECT metric, round(value, 6) AS value, op, threshold,
CASE WHEN (op = '<=' AND value <= threshold) OR (op = '>=' AND value >= threshold) THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT 'rejection_rate' AS metric, avg((NOT is_valid)::INT) AS value, '<=' AS op, 0.001::DOUBLE AS threshold FROM checked
UNION ALL SELECT 'null_rate_critical', avg((store_id IS NULL)::INT), '<=', 0.0 FROM checked
UNION ALL SELECT 'null_rate_optional', avg((sale_amount IS NULL)::INT), '<=', 0.05 FROM checked)""")
def _(spark, sf):
    stats = checked(spark, sf).agg(
        F.avg((~F.col("is_valid")).cast("int")).alias("rejection_rate"),
        F.avg(F.col("store_id").isNull().cast("int")).alias("null_rate_critical"),
        F.avg(F.col("sale_amount").isNull().cast("int")).alias("null_rate_optional"))
    names = ["rejection_rate", "null_rate_critical", "null_rate_optional"]
    rows = stats.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])))
    return rounded(rules.gate(rows, rules.QUALITY_GATES))


@query("dq_daily_contract", ctes=BRONZE, sql=report(
    [(f"not_null:{c}", "error", f"{c} IS NULL", "0.0") for c in (
        "city_id", "store_id", "product_id", "dt", "sale_amount", "hours_sale", "hours_stock_status", "avg_temperature", "avg_humidity", "avg_wind_level")]
    + [("parseable_date:dt", "error", "try_strptime(dt, '%Y-%m-%d') IS NULL", "0.0"),
       ("non_negative:sale_amount", "error", "sale_amount < 0", "0.0"),
       ("array_length:hours_sale", "error", "hours_sale IS NULL OR len(hours_sale) <> 24", "0.0"),
       ("array_length:hours_stock_status", "error", "hours_stock_status IS NULL OR len(hours_stock_status) <> 24", "0.0"),
       ("array_range:hours_sale", "error", "len(list_filter(hours_sale, lambda x: x < 0)) > 0", "0.0"),
       ("array_values:hours_stock_status", "error", "len(list_filter(hours_stock_status, lambda x: x NOT IN (0, 1))) > 0", "0.0"),
       ("value_range:discount", "error", "discount NOT BETWEEN 0 AND 1", "0.0"),
       ("value_range:city_id", "warning", "city_id NOT BETWEEN 1 AND 18", "0.0"),
       ("value_range:store_id", "warning", "store_id NOT BETWEEN 1 AND 898", "0.0"),
       ("value_range:product_id", "warning", "product_id NOT BETWEEN 1 AND 865", "0.0"),
       ("value_range:avg_temperature", "warning", "avg_temperature NOT BETWEEN -50 AND 60", "0.0"),
       ("value_range:avg_humidity", "warning", "avg_humidity NOT BETWEEN 0 AND 100", "0.0")], "bronze")
    + " UNION ALL " + group_report("unique_key:store_id,product_id,dt", "error", "store_id, product_id, dt", "n > 1", "bronze"))
def _(spark, sf):
    return rules.validate(tables.bronze(spark, sf), rules.daily_contract())


@query("dq_hourly_contract", ctes=HOURLY, sql=report(
    [("value_range:hour_of_day", "error", "hour_of_day NOT BETWEEN 6 AND 21", "0.0"),
     ("non_negative:observed_sales", "error", "observed_sales < 0", "0.0"),
     ("value_range:discount", "error", "discount NOT BETWEEN 0 AND 1", "0.0"),
     ("value_range:iso_dow0", "error", "iso_dow0 NOT BETWEEN 0 AND 6", "0.0"),
     ("value_range:hour_sin", "error", "false", "0.0"), ("value_range:hour_cos", "error", "false", "0.0"),
     ("timestamp_match:event_timestamp", "error", "event_timestamp <> CAST(event_date AS TIMESTAMP) + to_hours(hour_of_day)", "0.0")], "ops")
    + " UNION ALL " + group_report("unique_key:store_id,product_id,event_date,hour_of_day", "error", "store_id, product_id, event_date, hour_of_day", "n > 1", "ops")
    + " UNION ALL " + group_report("group_count:store_id,product_id,event_date", "warning", "store_id, product_id, event_date", "n <> 16", "ops"))
def _(spark, sf):
    sin, cos = cal.cyclical(F.col("hour_of_day"), 24)
    df = clean.operational_only(hourly(spark, sf)).withColumns({"hour_sin": sin, "hour_cos": cos})
    return rules.validate(df, rules.hourly_contract())
