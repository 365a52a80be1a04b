"""Simulated product economics, order constraints and policy comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.calendar import next_delivery
from shelfline.functions.text import hash_uniform
from shelfline.operators.gold import POLICIES
from shelfline.operators.ranks import bounded_quantiles

# Fixed values per category: product ids, shelf life in hours, price, cost ratio, spoilage and holding
# rates, hours before expiry that call for a markdown, lead time in hours, order limits, delivery weekdays.
CATEGORIES = {
    "highly_perishable": dict(ids=(1, 289), shelf=(24, 72), price=(2.0, 15.0), ratio=(0.55, 0.70), spoilage=0.10, holding=0.03,
                              markdown=12, lead=(4, 12), order=(1.0, 50.0), days=(0, 1, 2, 3, 4, 5, 6)),
    "moderately_perishable": dict(ids=(290, 577), shelf=(72, 168), price=(3.0, 20.0), ratio=(0.50, 0.65), spoilage=0.08, holding=0.02,
                                  markdown=24, lead=(12, 48), order=(2.0, 100.0), days=(0, 2, 4)),
    "longer_life": dict(ids=(578, 865), shelf=(168, 336), price=(1.5, 25.0), ratio=(0.45, 0.60), spoilage=0.05, holding=0.01,
                        markdown=48, lead=(24, 72), order=(5.0, 200.0), days=(0, 3)),
}
# Surcharge per emergency order and how many are charged per store and day.
EMERGENCY_COST, EMERGENCY_CAP = 50.0, 3
PERISHABLE_HOURS = 336


def category_of(product_id: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, c in CATEGORIES.items():
        out = F.when(product_id.between(*c["ids"]), name).otherwise(out)
    return out


def by_category(field, index: int | None = None, category: str = "category") -> Column:
    """A parameter of the row's category."""
    out = F.lit(None).cast("double")
    for name, c in CATEGORIES.items():
        value = c[field] if index is None else c[field][index]
        out = F.when(F.col(category) == name, F.lit(float(value))).otherwise(out)
    return out


def _draw(field: str, seed: int) -> Column:
    """A uniform draw from a category range, repeatable per product and field."""
    lo, hi = by_category(field, 0), by_category(field, 1)
    return lo + hash_uniform(seed, field, F.col("product_id")) * (hi - lo)


def product_economics(df: DataFrame, seed: int = 42) -> DataFrame:
    """Price, cost, margin, shelf life, spoilage and holding cost per product."""
    return (
        df.withColumn("category", category_of(F.col("product_id")))
        .withColumns({"unit_price": F.round(_draw("price", seed), 2), "_ratio": _draw("ratio", seed), "shelf_life_hours": F.floor(_draw("shelf", seed)).cast("int")})
        .withColumn("unit_cost", F.round(F.col("unit_price") * F.col("_ratio"), 2))
        .withColumns({"unit_margin": F.col("unit_price") - F.col("unit_cost"), "spoilage_cost": F.col("unit_cost") * by_category("spoilage"),
                      "holding_cost_day": F.col("unit_cost") * by_category("holding")})
        .drop("_ratio")
    )


def lead_time(df: DataFrame, seed: int = 42) -> DataFrame:
    return df.withColumn("category", category_of(F.col("product_id"))).withColumn("lead_time_hours", F.floor(_draw("lead", seed)).cast("int"))


def with_next_delivery(df: DataFrame, order_ts: str) -> DataFrame:
    """Next delivery by the category's weekdays with the twelve-hour cutoff."""
    out = F.lit(None).cast("date")
    for name, c in CATEGORIES.items():
        out = F.when(F.col("category") == name, next_delivery(F.col(order_ts), list(c["days"]))).otherwise(out)
    return df.withColumn("next_delivery", out)


def constrain_order(df: DataFrame, qty: str, increment: float = 1.0) -> DataFrame:
    """Round up to the increment, then keep within the category's order limits; nothing needed stays nothing."""
    stepped = F.ceil(F.col(qty) / increment) * F.lit(increment)
    limited = F.least(F.greatest(stepped, by_category("order", 0)), by_category("order", 1))
    return df.withColumn("order_qty", F.when(F.col(qty) > 0, limited).otherwise(F.lit(0.0)))


def demand_quantiles(demand: DataFrame, probs, value="sale_amount", keys=("store_id", "product_id")) -> DataFrame:
    """Demand quantiles per series. A series has one row per day, so its values are bounded."""
    return bounded_quantiles(demand, keys, value, probs, "_q")


def policy_order(demand: DataFrame, lead: DataFrame, value="sale_amount", keys=("store_id", "product_id")) -> DataFrame:
    """Order-up-to level and safety stock of each policy per series: level = quantile times
    lead-time days, safety = quantile - median."""
    probs = [0.5, *[p[2] for p in POLICIES]]
    q = demand_quantiles(demand, probs, value, keys)
    entries = F.array(*[F.struct(F.lit(p[0]).alias("policy_name"), F.get("_q", F.lit(i + 1)).alias("quantile_qty"), F.get("_q", F.lit(0)).alias("median_qty"))
                        for i, p in enumerate(POLICIES)])
    days = F.col("lead_time_hours") / 24.0
    return (
        q.select(*keys, F.inline(entries)).join(lead.select("product_id", "lead_time_hours"), "product_id")
        .withColumns({"order_up_to": F.col("quantile_qty") * days, "safety_stock": F.col("quantile_qty") - F.col("median_qty")})
    )


def emergency_cost(incidents_per_day: DataFrame, count: str = "incident_count", by=("store_id", "start_date")) -> DataFrame:
    return incidents_per_day.groupBy(*by).agg(
        (F.least(F.sum(count), F.lit(EMERGENCY_CAP)) * F.lit(EMERGENCY_COST)).alias("emergency_cost"))


def cycle_costs(demand: DataFrame, options, value="sale_amount", review_hours: int = 72, name: str = "policy_name") -> DataFrame:
    """Each demand row as one independent cycle under each option (name, quantile).

    The quantity is the option's demand quantile of the series. What is left expires
    when the shelf life ends within the review period. The options are unfolded from
    an array in the row. Economics are a function of the product id, so they are columns
    of the series quantiles, and the demand rows join once, on their series.
    """
    options = list(options)
    q = demand_quantiles(demand, [o[1] for o in options], value)
    entries = F.array(*[F.struct(F.lit(o[0]).alias(name), F.get("_q", F.lit(i)).alias("order_qty")) for i, o in enumerate(options)])
    econ = ["unit_margin", "unit_cost", "spoilage_cost", "holding_cost_day", "shelf_life_hours"]
    q = product_economics(q).select("store_id", "product_id", *econ, "_q")
    rows = demand.select("store_id", "product_id", "dt", F.col(value).alias("demand")).join(q, ["store_id", "product_id"])
    rows = rows.select("*", F.inline(entries)).drop("_q")
    lost = F.greatest(F.col("demand") - F.col("order_qty"), F.lit(0.0))
    left = F.greatest(F.col("order_qty") - F.col("demand"), F.lit(0.0))
    gone = F.when(F.col("shelf_life_hours") <= review_hours, F.col("left_units")).otherwise(0.0)
    return rows.withColumns({"lost_units": lost, "left_units": left}).withColumn("expired_units", gone).withColumns({
        "lost_cost": F.col("lost_units") * F.col("unit_margin"),
        "waste_cost": F.when(F.col("shelf_life_hours") < PERISHABLE_HOURS, F.col("expired_units") * (F.col("unit_cost") + F.col("spoilage_cost"))).otherwise(0.0),
        "holding_cost": F.col("left_units") * F.col("holding_cost_day")})


def policy_compare(cycles: DataFrame, name: str = "policy_name") -> DataFrame:
    """Costs and service level per option. Emergency orders are capped per store and day,
    so rows meet per (option, store, day) first and per option after that."""
    per_store = cycles.groupBy(name, "store_id", "dt").agg(
        *[F.sum(c).alias(c) for c in ("lost_cost", "waste_cost", "holding_cost", "demand", "lost_units", "expired_units")],
        F.count_if(F.col("lost_units") > 0).alias("_short"), F.count("*").alias("_n"))
    charged = per_store.withColumn("emergency_cost", F.least(F.col("_short"), F.lit(EMERGENCY_CAP)) * F.lit(EMERGENCY_COST))
    out = charged.groupBy(name).agg(
        *[F.sum(c).alias(c) for c in ("lost_cost", "waste_cost", "holding_cost", "emergency_cost", "expired_units")],
        ((1.0 - F.sum("lost_units") / F.nullif(F.sum("demand"), F.lit(0.0))) * 100.0).alias("service_level_pct"))
    return out.withColumn("total_cost", F.col("lost_cost") + F.col("waste_cost") + F.col("holding_cost") + F.col("emergency_cost"))


def policy_options():
    return [(p[0], p[2]) for p in POLICIES]


def tradeoff_options(step: int = 5):
    """Quantiles from 50 % to 95 %."""
    return [(f"q{p:02d}", p / 100.0) for p in range(50, 100, step)]
