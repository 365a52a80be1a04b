"""Recommendation rules. The contract bounds tiers and urgency; the rest is chosen here and named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.scores import urgency
from shelfline.operators.economics import by_category, category_of

# Chosen values: escalate and replenish thresholds, incidents within a week that count as chronic, spike factor.
ESCALATE, REPLENISH = 0.75, 0.50
CHRONIC_INCIDENTS, CHRONIC_DAYS = 5, 7
SPIKE = 2.0


def markdown_due(df: DataFrame, hours_to_expiry: str) -> DataFrame:
    """Hours to expiry below the limit of the product's category."""
    out = df if "category" in df.columns else df.withColumn("category", category_of(F.col("product_id")))
    return out.withColumn("markdown_due", F.coalesce(F.col(hours_to_expiry) < by_category("markdown"), F.lit(False)))


def action(p: Column, due: Column) -> Column:
    return F.when(p >= ESCALATE, "escalate").when(p >= REPLENISH, "replenish").when(due, "markdown").otherwise("monitor")


def recent_incidents(incidents: DataFrame, days: int = CHRONIC_DAYS) -> DataFrame:
    """Incidents of the last days per series and date. Incidents are counted per day first,
    so a window partition is bounded by the calendar."""
    per_day = incidents.groupBy("store_id", "product_id", F.col("start_date").alias("dt")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("store_id", "product_id").orderBy(F.unix_date("dt")).rangeBetween(1 - days, 0)
    return per_day.select("store_id", "product_id", "dt", F.sum("n").over(w).alias("recent_incidents"))


def reason_code(df: DataFrame) -> Column:
    """Chronic stockouts first, then the risk level, then expiry, demand spike, stock level."""
    p = F.col("stockout_probability")
    return (
        F.when((p >= REPLENISH) & (F.coalesce(F.col("recent_incidents"), F.lit(0)) >= CHRONIC_INCIDENTS), "chronic_stockout")
        .when(p >= ESCALATE, "stockout_high_risk")
        .when(p >= REPLENISH, "stockout_moderate_risk")
        .when(F.col("markdown_due"), "approaching_expiry")
        .when(F.col("forecast_q90") > F.col("forecast_median") * SPIKE, "demand_spike_predicted")
        .otherwise("excess_inventory")
    )


def recommend(df: DataFrame) -> DataFrame:
    """Action, urgency, reason, quantity and markdown per row.

    Needs ``stockout_probability``, ``markdown_due``, ``recent_incidents``,
    ``forecast_q90`` and ``forecast_median``. An escalation is at least elevated by
    its threshold; quantities are NULL for other actions.
    """
    p = F.col("stockout_probability")
    return df.withColumns({
        "action_type": action(p, F.col("markdown_due")), "urgency": urgency(p), "reason_code": reason_code(df)}).withColumns({
            "suggested_order_qty": F.when(F.col("action_type") == "replenish", F.ceil(F.col("forecast_q90")).cast("double")),
            "suggested_markdown_pct": F.when(F.col("action_type") == "markdown", 0.20),
            "recommendation_status": F.when(F.col("action_type") == "monitor", "DONE").otherwise("OPEN"),
            "urgency_score": F.round(p, 3)})
