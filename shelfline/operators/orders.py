"""Newsvendor ordering over whole tables, as expressions in one projection per step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.catalogue import category_cv
from shelfline.functions.normal import norm_cdf, norm_pdf, norm_ppf

# Default economics of an item and the bounds of the critical fractile.
DEFAULTS = {"unit_price": 10.0, "unit_cost": 6.0, "holding_cost": 0.5, "shelf_life_days": 3, "stockout_penalty": 5.0, "salvage_value": 1.0}
FRACTILE_BOUNDS = (0.50, 0.99)


def demand_stats(df: DataFrame, value="sale_amount", keys=("store_id", "product_id")) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("mean_demand"), F.stddev_samp(value).alias("std_demand"), F.count("*").alias("n_days"))


def with_demand_defaults(df: DataFrame) -> DataFrame:
    """Demand of at least 0.1; a missing or zero deviation becomes a fifth of it, at least 1."""
    mu = F.greatest(F.lit(0.1), F.col("mean_demand").cast("double"))
    std = F.col("std_demand").cast("double")
    return df.withColumns({"mean_demand": mu, "std_demand": F.when(std > 0, std).otherwise(F.greatest(F.lit(1.0), mu * 0.20))})


def optimal_order(df: DataFrame, fractile_bounds=FRACTILE_BOUNDS, **overrides: Column) -> DataFrame:
    """Order quantity, safety stock, expected waste, stockout and profit, risk scores.

    Needs ``mean_demand`` and ``std_demand``; an economic column that is absent takes
    its default. Each step is its own projection, so no expression is repeated.
    """
    have = {c: F.col(c).cast("double") for c in DEFAULTS if c in df.columns}
    e = {c: overrides.get(c, have.get(c, F.lit(float(v)))) for c, v in DEFAULTS.items()}
    lo, hi = fractile_bounds
    factor = F.greatest(F.lit(1.0), F.lit(7.0) / F.greatest(F.lit(1.0), e["shelf_life_days"]))
    cu = F.greatest(F.lit(0.1), e["unit_price"] - e["unit_cost"] + e["stockout_penalty"])
    co = F.greatest(F.lit(0.1), (e["unit_cost"] + e["holding_cost"] - e["salvage_value"]) * factor)
    mu, sd, q, z = F.col("mean_demand"), F.col("std_demand"), F.col("optimal_order_qty"), F.col("_z")
    percent = lambda c: F.least(F.greatest(c * 100.0, F.lit(0.0)), F.lit(100.0))
    return (
        with_demand_defaults(df)
        .withColumns({"_cu": cu, "_co": co})
        .withColumn("critical_fractile", F.least(F.greatest(F.col("_cu") / (F.col("_cu") + F.col("_co")), F.lit(lo)), F.lit(hi)))
        .withColumn("_zs", norm_ppf(F.col("critical_fractile")) * sd)
        .withColumns({"safety_stock": F.ceil("_zs"), "optimal_order_qty": F.greatest(F.lit(0).cast("bigint"), F.ceil(mu + F.col("_zs")))})
        .withColumn("_z", (q - mu) / sd)
        .withColumns({"_cdf": norm_cdf(z), "_pdf": norm_pdf(z)})
        .withColumns({
            "expected_waste_units": sd * (z * F.col("_cdf") + F.col("_pdf")),
            "expected_stockout_units": sd * (F.col("_pdf") - z * (1.0 - F.col("_cdf"))),
        })
        .withColumns({
            "expected_net_profit": (mu - F.col("expected_stockout_units")) * e["unit_price"] + F.col("expected_waste_units") * e["salvage_value"]
            - q * e["unit_cost"] - F.col("expected_stockout_units") * e["stockout_penalty"],
            "spoilage_risk_score": percent(F.col("_cdf") * F.col("expected_waste_units") / F.greatest(F.lit(1).cast("bigint"), q)),
            "stockout_risk_score": percent(1.0 - F.col("_cdf")),
        })
        .drop("_cu", "_co", "_zs", "_z", "_cdf", "_pdf")
    )


def demand_by_category(df: DataFrame, mean: str = "mean_demand", category: str = "category") -> DataFrame:
    """Deviation from the category's coefficient of variation."""
    return df.withColumn("cv", category_cv(F.col(category))).withColumn("std_demand", F.col(mean) * F.col("cv"))


def legacy_compare(df: DataFrame) -> DataFrame:
    """The fixed rule of 1.65 times demand beside the optimal order."""
    mu = F.col("mean_demand")
    return df.withColumns({
        "legacy_order": F.floor(mu * 1.65), "legacy_safety": F.floor(mu * 0.65)}).withColumns({
            "legacy_profit": mu * F.col("unit_price") - F.col("legacy_order") * F.col("unit_cost"),
            "order_delta": F.col("optimal_order_qty") - F.col("legacy_order")})


def markdown_options(stock: Column, price: Column, cost: Column) -> Column:
    """(net, percent) of each markdown from 0 to 50 % in steps of 5, as an array."""
    # 80 units at full price, 2.2 times faster per unit of markdown.
    def option(m):
        speed = 1.0 + m / 100.0 * 2.2
        cleared = F.least(stock, F.floor(speed * 80.0))
        return F.struct((cleared * (price * (1.0 - m / 100.0)) - cleared * cost).alias("net"), (-m).alias("neg_pct"), cleared.alias("cleared"))

    return F.transform(F.sequence(F.lit(0), F.lit(50), F.lit(5)), option)


def best_markdown(df: DataFrame, stock: str, price: str, cost: str) -> DataFrame:
    """The markdown with the best net recovery, the smallest on ties; decided inside the row."""
    best = F.array_max(markdown_options(F.col(stock), F.col(price), F.col(cost)))
    return df.withColumn("_best", best).withColumns({
        "best_markdown_pct": -F.col("_best.neg_pct"), "net_recovery": F.col("_best.net"), "units_cleared": F.col("_best.cleared")}).drop("_best")


def savings_rollup(df: DataFrame, n_stores: Column, days: int = 90) -> DataFrame:
    """Savings from mean profit per item-day, scaled to stores and days."""
    # 0.28 lbs per unit of money, 2.48 meals per lb, 6 % stockouts.
    per_day = F.greatest(F.lit(0.0), F.avg("expected_net_profit"))
    return df.agg(per_day.alias("savings_per_day"), n_stores.alias("n_stores")).withColumns({
        "dollars_saved": F.floor(F.col("savings_per_day") * F.col("n_stores") * days),
        "lbs_rescued": F.floor(F.col("savings_per_day") * F.col("n_stores") * days * 0.28),
        "stockouts_prevented": F.floor(F.col("n_stores") * days * 0.06)}).withColumn("meals_saved", F.floor(F.col("lbs_rescued") * 2.48))
