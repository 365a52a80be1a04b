"""Star-schema tables. Builders return the rows to append; ``existing`` makes them incremental."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.functions import scores
from shelfline.functions.text import label
from shelfline.operators.joins import after_watermark, attach_city, new_members
from shelfline.operators.reshape import explode_hourly

# Reason code, group, description.
REASON_CODES = [
    ("HIGH_STOCKOUT_RISK", "Replenish", "Stockout probability exceeds threshold; replenishment recommended"),
    ("LEAD_TIME_DEMAND", "Replenish", "Forecast lead-time demand exceeds available inventory"),
    ("SAFETY_STOCK_BREACH", "Replenish", "Inventory below safety stock level"),
    ("REPEATED_STOCKOUT", "Replenish", "Product experienced repeated stockouts within 7 days"),
    ("HIGH_WASTE_RISK", "Markdown", "Projected residual exceeds waste threshold before expiry"),
    ("APPROACHING_EXPIRY", "Markdown", "Significant inventory approaching shelf-life expiry"),
    ("LOW_DEMAND_FORECAST", "Markdown", "Forecasted demand too low to clear existing stock"),
    ("EXCESS_INVENTORY", "Markdown", "Inventory exceeds forecast demand by significant margin"),
    ("EMERGENCY_REPLENISH", "Emergency", "Critical stockout with high-demand product"),
    ("SEASONAL_ADJUSTMENT", "Adjust", "Seasonal pattern requires inventory level adjustment"),
    ("PROMOTION_PREPARATION", "Adjust", "Upcoming activity requires increased inventory"),
    ("WEATHER_SENSITIVE", "Adjust", "Weather forecast suggests demand change for this category"),
    ("NO_ACTION_NEEDED", "None", "Inventory levels adequate for forecasted demand"),
    ("MONITOR_ONLY", "Monitor", "Metrics near threshold; monitoring recommended"),
]
# Policy name, target service level, forecast quantile.
POLICIES = [
    ("conservative_95", 0.95, 0.90),
    ("balanced_97", 0.97, 0.95),
    ("aggressive_99", 0.99, 0.99),
    ("lean_90", 0.90, 0.75),
]
# Chosen values: the schema names the bands but no cut points.
TEMPERATURE_CUTS = (5.0, 15.0, 25.0)
HUMIDITY_CUTS = (40.0, 70.0)


def dim_city(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    cities = new_members(rows.select("city_id").distinct(), existing, "city_id")
    return cities.select("city_id", label("City", F.col("city_id")).alias("city_label"), F.lit("Region Unknown").alias("region_label"))


def dim_store(rows: DataFrame, cities: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    stores = new_members(rows.select("store_id", "city_id").distinct(), existing, "store_id")
    known = cities.select("city_id", F.col("city_id").alias("_known"))
    return attach_city(stores, known).select(
        "store_id", F.col("_known").alias("city_id"), label("Store", F.col("store_id")).alias("store_label"),
        F.lit("Cluster A").alias("store_cluster"), F.lit("High").alias("volume_band")).distinct()


def dim_product(daily: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    levels = ["product_id", "management_group_id", "first_category_id", "second_category_id", "third_category_id"]
    products = new_members(daily.select(*levels).distinct(), existing, "product_id")
    return products.select(
        *levels, label("Product", F.col("product_id")).alias("product_label"), F.lit("A").alias("abc_class"),
        F.lit("X").alias("xyz_class"), F.lit("High").alias("perishability_class"))


def surrogate_keys(dim: DataFrame, natural, key: str) -> DataFrame:
    """A repeatable 64-bit key from the natural key columns: the same on every run and in every task."""
    return dim.withColumn(key, F.xxhash64(*natural))


def fact_sales_hourly(hourly: DataFrame, stores: DataFrame, products: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    src = after_watermark(hourly, existing, "event_timestamp")
    return sales_columns(src.join(stores.select("store_id").distinct(), "store_id").join(products.select("product_id").distinct(), "product_id"))


def sales_from_daily(daily: DataFrame, stores: DataFrame, products: DataFrame, batch: str) -> DataFrame:
    """The rows of ``fact_sales_hourly`` from the daily arrays: members are looked up by day, and hours made last."""
    known = daily.join(stores, "store_id", "left_semi").join(products, "product_id", "left_semi")
    return sales_columns(explode_hourly(known).withColumn("ingestion_batch_id", F.lit(batch)))


def sales_columns(rows: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    return rows.select(
        cal.date_key(F.col("event_date")).alias("date_key"), F.col("hour_of_day").cast("smallint").alias("time_key"),
        "store_id", "product_id", F.lit(None).cast("int").alias("weather_band_key"), "event_timestamp",
        "observed_sales", "stockout_flag", F.col("discount").alias("discount_factor"), "activity_flag", "holiday_flag",
        zero.alias("estimated_hidden_demand"), zero.alias("recovered_demand"), zero.alias("estimated_lost_demand"),
        zero.alias("estimated_lost_revenue"), F.col("ingestion_batch_id").alias("source_batch_id"))


def fact_stockout_incident(incidents: DataFrame, stores: DataFrame, products: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    src = after_watermark(incidents, existing, "incident_start", "start_timestamp")
    empty = {c: F.lit(None).cast("double") for c in (
        "operational_duration_hours", "pre_incident_sales", "post_incident_sales", "estimated_lost_demand",
        "estimated_lost_revenue", "severity_score")}
    return (
        src.join(stores.select("store_id").distinct(), "store_id")
        .join(products.select("product_id").distinct(), "product_id")
        .select("store_id", "product_id", F.col("incident_start").alias("start_timestamp"),
                F.col("incident_end").alias("end_timestamp"), "duration_hours",
                *[c.alias(n) for n, c in empty.items()], F.lit(None).cast("string").alias("incident_class"))
    )


def dim_time(spark: SparkSession) -> DataFrame:
    h = F.col("id").cast("int")
    return spark.range(24).select(
        h.cast("smallint").alias("time_key"), h.alias("hour_of_day"), F.format_string("%02d:00", h).alias("hour_label"),
        cal.part_of_day(h).alias("part_of_day"), cal.is_operational(h).alias("is_operational_hour"))


def dim_date(df: DataFrame, date_col: str) -> DataFrame:
    """One row per calendar day from the first to the last date in the data."""
    days = df.agg(F.explode(F.sequence(F.to_date(F.min(date_col)), F.to_date(F.max(date_col)))).alias("calendar_date"))
    d = F.col("calendar_date")
    return days.select(
        cal.date_key(d).alias("date_key"), "calendar_date", F.dayofmonth(d).alias("day_number"),
        F.date_format(d, "EEEE").alias("day_name"), F.weekofyear(d).alias("week_number"), F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).alias("quarter"), F.year(d).alias("year"),
        (F.weekday(d) >= 5).alias("is_weekend"), F.lit(False).alias("is_holiday"))


def dim_reason_code(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, *r) for i, r in enumerate(REASON_CODES)]
    return spark.createDataFrame(rows, "reason_key int, reason_code string, reason_group string, business_description string")


def dim_policy(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, *p, "quantile_based") for i, p in enumerate(POLICIES)]
    return spark.createDataFrame(rows, "policy_key int, policy_name string, target_service_level double, quantile_used double, safety_stock_method string")


def weather_bands(temperature_cuts=TEMPERATURE_CUTS, humidity_cuts=HUMIDITY_CUTS) -> dict:
    return {
        "temperature_band": scores.band(F.col("avg_temperature"), temperature_cuts, ("cold", "mild", "warm", "hot")),
        "humidity_band": scores.band(F.col("avg_humidity"), humidity_cuts, ("dry", "moderate", "humid")),
    }


def dim_weather_band(daily: DataFrame, **cuts) -> DataFrame:
    bands = daily.select(*[c.alias(n) for n, c in weather_bands(**cuts).items()]).distinct()
    return surrogate_keys(bands, ["temperature_band", "humidity_band"], "weather_band_key")


def fact_forecast(forecasts: DataFrame, actuals: DataFrame, keys) -> DataFrame:
    """Forecast rows with the actual value, absolute and squared error and pinball losses."""
    a = F.col("actual")
    return forecasts.join(actuals, list(keys)).withColumns(
        {
            "absolute_error": F.abs(a - F.col("forecast_p50")),
            "squared_error": (a - F.col("forecast_p50")) * (a - F.col("forecast_p50")),
            "pinball_loss_p10": scores.pinball(a, F.col("forecast_p10"), 0.10),
            "pinball_loss_p50": scores.pinball(a, F.col("forecast_p50"), 0.50),
            "pinball_loss_p90": scores.pinball(a, F.col("forecast_p90"), 0.90),
        }
    )


def fact_stockout_risk(scored: DataFrame, run_id: str) -> DataFrame:
    p = F.col("stockout_probability")
    return scored.withColumns({"risk_run_id": F.lit(run_id), "risk_tier": scores.risk_tier(p), "is_alert": scores.is_alert(p)})


def fact_model_monitoring(gated: DataFrame, run_id: str) -> DataFrame:
    """Gate results as monitoring rows; keeps ``segment_type``/``segment_value`` when present."""
    out = gated.select(*[c for c in gated.columns if c in ("segment_type", "segment_value")],
                       F.col("metric").alias("metric_name"), F.col("value").alias("metric_value"), "threshold", "status")
    return out.withColumn("monitoring_run_id", F.lit(run_id))


def append_new(src: DataFrame, target: DataFrame | None, mode: str, keys=(), ts: str | None = None) -> DataFrame:
    """Rows of ``src`` to append: ``watermark`` takes what is later than the newest loaded
    row, ``keys`` takes every row whose key is not loaded, late ones included."""
    if target is None:
        return src
    if mode == "watermark":
        return after_watermark(src, target, ts)
    return src.join(target.select(*keys), list(keys), "left_anti")
