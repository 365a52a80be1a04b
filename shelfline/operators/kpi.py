"""KPI layer. ``ops`` is the hourly table cut to trading hours; ``rec`` adds ``recovered_demand``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.scores import safe_ratio
from shelfline.operators.economics import product_economics
from shelfline.operators.ranks import running_totals, value_counts_by

GRAIN = ["city_id", "store_id", "product_id", "event_date"]


def daily_kpis(ops: DataFrame, by=GRAIN) -> DataFrame:
    """Hours, availability, service level and observed demand per store, product and day."""
    out = F.count_if(F.col("stockout_flag") == 1)
    base = ops.groupBy(*by).agg(
        F.count("*").alias("operational_hours"), out.alias("stockout_hours"), F.sum("observed_sales").alias("observed_demand"))
    ok = (F.col("operational_hours") - F.col("stockout_hours")) / F.nullif(F.col("operational_hours"), F.lit(0)) * 100.0
    return base.withColumn("availability_pct", ok)


def kpi_availability(ops: DataFrame, by=GRAIN) -> DataFrame:
    return daily_kpis(ops, by).select(*by, "availability_pct")


def kpi_stockout_hours(ops: DataFrame, by=GRAIN) -> DataFrame:
    return daily_kpis(ops, by).select(*by, "stockout_hours")


def kpi_service_level(ops: DataFrame, by=GRAIN) -> DataFrame:
    return daily_kpis(ops, by).select(*by, F.col("availability_pct").alias("service_level_pct"))


def kpi_incident_count(incidents: DataFrame, by=("store_id", "product_id", "start_date")) -> DataFrame:
    return incidents.groupBy(*by).agg(F.count("*").alias("incident_count"))


def kpi_incident_duration(incidents: DataFrame, by=("store_id", "product_id", "start_date")) -> DataFrame:
    return incidents.groupBy(*by).agg((F.sum("duration_hours") / F.count("*")).alias("avg_duration_hours"))


def kpi_observed_demand(ops: DataFrame, by) -> DataFrame:
    return ops.groupBy(*by).agg(F.sum("observed_sales").alias("observed_demand"))


def _in_stockout(col) -> Column:
    return F.coalesce(F.sum(F.when(F.col("stockout_flag") == 1, col)), F.lit(0.0))


def kpi_recovered_demand(rec: DataFrame, by) -> DataFrame:
    return rec.groupBy(*by).agg(_in_stockout(F.col("recovered_demand")).alias("recovered_demand"))


def lost() -> Column:
    return F.col("recovered_demand") - F.col("observed_sales")


def kpi_lost_demand(rec: DataFrame, by) -> DataFrame:
    return rec.groupBy(*by).agg(_in_stockout(lost()).alias("lost_demand"))


def kpi_lost_sales_cost(rec: DataFrame, by) -> DataFrame:
    """Lost demand is summed per key and product; the margin is a function of the product."""
    keys = list(dict.fromkeys([*by, "product_id"]))
    return (
        product_economics(kpi_lost_demand(rec, keys))
        .groupBy(*by).agg(F.sum(F.col("lost_demand") * F.col("unit_margin")).alias("lost_sales_cost"))
    )


def kpi_fill_rate(rec: DataFrame, by) -> DataFrame:
    return rec.groupBy(*by).agg(
        safe_ratio(F.sum("observed_sales"), F.sum("recovered_demand"), 100.0).alias("fill_rate_pct"))


def kpi_wape(df: DataFrame, actual: str, forecast: str, by=()) -> DataFrame:
    y, f = F.col(actual), F.col(forecast)
    return df.groupBy(*by).agg(safe_ratio(F.sum(F.abs(y - f)), F.sum(F.abs(y)), 100.0, 0.0).alias("wape"))


def kpi_bias(df: DataFrame, actual: str, forecast: str, by=()) -> DataFrame:
    y, f = F.col(actual), F.col(forecast)
    return df.groupBy(*by).agg(safe_ratio(F.sum(f - y), F.sum(y), 100.0, 0.0).alias("bias"))


def kpi_p90_coverage(df: DataFrame, actual: str, q90: str, by=()) -> DataFrame:
    return df.groupBy(*by).agg((F.avg((F.col(actual) <= F.col(q90)).cast("int")) * 100.0).alias("p90_coverage_pct"))


def kpi_fva(df: DataFrame, actual: str, forecast: str, baseline: str, by=()) -> DataFrame:
    """Both WAPE values come from one pass over rows that have both forecasts."""
    y = F.col(actual)
    wape = lambda c: safe_ratio(F.sum(F.abs(y - F.col(c))), F.sum(F.abs(y)), 100.0, 0.0)
    both = df.filter(F.col(baseline).isNotNull() & F.col(forecast).isNotNull())
    return both.groupBy(*by).agg(wape(baseline).alias("wape_baseline"), wape(forecast).alias("wape_model")).withColumn(
        "fva_pct", safe_ratio(F.col("wape_baseline") - F.col("wape_model"), F.col("wape_baseline"), 100.0))


def kpi_pr_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Average precision: the step sum over descending scores, equal scores taken together."""
    counted = value_counts_by(df.withColumn("_neg", -F.col(score)), [], "_neg", n=F.count("*"), pos=F.sum(F.col(label).cast("bigint")))
    run = running_totals(counted, [], "_neg", ["n", "pos"])
    step = F.col("pos") / F.nullif(F.col("total_pos"), F.lit(0)) * (F.col("cum_pos") / F.col("cum_n"))
    return run.agg(F.sum(step).alias("pr_auc"))


def kpi_alert_precision(df: DataFrame, label: str, score: str, cut: float = 0.5, by=()) -> DataFrame:
    alert = F.col(score) >= cut
    hit = F.count_if(alert & (F.col(label) == 1))
    return df.groupBy(*by).agg(
        F.count_if(alert).alias("alerts"), (hit / F.nullif(F.count_if(alert), F.lit(0)) * 100.0).alias("precision_pct"),
        (hit / F.nullif(F.count_if(F.col(label) == 1), F.lit(0)) * 100.0).alias("recall_pct"))


def kpi_rec_coverage(at_risk: DataFrame, recs: DataFrame, keys, by) -> DataFrame:
    """At-risk keys with a recommendation, as a share of the distinct at-risk keys."""
    risky = at_risk.select(*keys).distinct()
    done = recs.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return risky.join(done, list(keys), "left").groupBy(*by).agg(
        (F.count("_hit") / F.count("*") * 100.0).alias("coverage_pct"))


def kpi_urgent_count(recs: DataFrame, by) -> DataFrame:
    return recs.groupBy(*by).agg(F.count_if(F.col("urgency") == "urgent").alias("urgent_count"))


def kpi_freshness(runs: DataFrame, now: Column) -> DataFrame:
    done = F.max(F.when(F.col("status") == "SUCCESS", F.col("ended_at")))
    return runs.agg(done.alias("last_success")).withColumn(
        "freshness_hours", F.timestamp_diff("SECOND", F.col("last_success"), now) / 3600.0)


def kpi_rejection_rate(runs: DataFrame, by=()) -> DataFrame:
    return runs.groupBy(*by).agg(
        (F.sum("rejected_rows") / F.nullif(F.sum("source_rows"), F.lit(0)) * 100.0).alias("rejection_rate_pct"))


def kpi_drift_status(metrics: DataFrame, factor: float = 1.2, bias_limit: float = 10.0) -> DataFrame:
    """DRIFTED when the current WAPE exceeds the training WAPE by the factor or the bias leaves its band."""
    bad = (F.col("current_wape") > F.col("training_wape") * factor) | ~F.col("current_bias").between(-bias_limit, bias_limit)
    return metrics.withColumn("drift_status", F.when(bad, "DRIFTED").otherwise("STABLE"))


def rolling_metrics(errors: DataFrame, date_col: str, window_days: int = 7) -> DataFrame:
    """WAPE and bias over the last days up to each date.

    Rows are summed per date first, so the ordered window sees one row per calendar day.
    """
    from pyspark.sql import Window

    per_day = errors.groupBy(F.unix_date(date_col).alias("_d"), date_col).agg(
        F.sum("_abs").alias("_abs"), F.sum("_miss").alias("_miss"), F.sum("_y").alias("_y"))
    w = Window.orderBy("_d").rangeBetween(1 - window_days, 0)
    total = lambda c: F.sum(c).over(w)
    return per_day.select(
        date_col, safe_ratio(total("_abs"), total("_y"), 100.0, 0.0).alias("current_wape"),
        safe_ratio(total("_miss"), total("_y"), 100.0, 0.0).alias("current_bias"))
