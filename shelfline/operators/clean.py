"""Cleaning: duplicates, validity, quarantine, staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.arrays import SLOTS, as_array

NATURAL_KEY = ["store_id", "product_id", "dt"]


def dedup_latest(df: DataFrame, keys=NATURAL_KEY, order=("ingested_at", "source_file_hash")) -> DataFrame:
    """Latest row per key, ties by the later order columns.

    The rank filter lets Spark keep one row per key in each map task before the
    shuffle (WindowGroupLimit), so a key with very many copies stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def flag_valid(df: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``is_valid`` is never NULL: a row that cannot be judged is not valid."""
    ok = (
        (F.size(as_array(df, "hours_sale")) == slots)
        & (F.size(as_array(df, "hours_stock_status", "int")) == slots)
        & (F.col("sale_amount") >= 0)
    )
    return df.withColumn("is_valid", F.coalesce(ok, F.lit(False)))


def split_valid(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean and quarantined rows; together they are the whole input."""
    return flagged.filter("is_valid").drop("is_valid"), flagged.filter("NOT is_valid").drop("is_valid")


def write_split(flagged: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """One pass over the input writes both halves, each into its own folder."""
    flagged.write.partitionBy("is_valid").parquet(path)
    stored = flagged.sparkSession.read.schema(flagged.schema).parquet(path)
    return split_valid(stored)


def to_quarantine(df: DataFrame, detected_at=None) -> DataFrame:
    # Error code and message.
    return df.select(
        F.to_json(F.struct("*")).alias("source_record"),
        F.lit("VALIDATION_FAILED").alias("error_code"),
        F.lit("Array length != 24 or negative sales").alias("error_message"),
        F.col("ingestion_batch_id").alias("batch_id"),
        (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at"),
    )


def cast_daily(df: DataFrame) -> DataFrame:
    """Typed identifiers and date; text that is no date becomes NULL instead of an error."""
    ids = [c for c in df.columns if c.endswith("_id") and c != "ingestion_batch_id"]
    return df.withColumns(
        {"dt": F.expr("try_to_date(dt, 'yyyy-MM-dd')"), **{c: F.col(c).try_cast("int") for c in ids}}
    )


def load_stats(flagged: DataFrame, by=()) -> DataFrame:
    """Initial, clean and quarantined counts and the rejection rate in one aggregate."""
    out = flagged.groupBy(*by).agg(
        F.count("*").alias("initial_rows"),
        F.count_if("is_valid").alias("clean_rows"),
        F.count_if(~F.col("is_valid")).alias("quarantined_rows"),
    )
    rate = F.col("quarantined_rows") / F.nullif(F.col("initial_rows"), F.lit(0)) * 100.0
    return out.withColumn("rejection_rate_pct", F.coalesce(rate, F.lit(0.0)))


def operational_only(hourly: DataFrame) -> DataFrame:
    return hourly.filter("is_operational_hour")


# The staged columns.
STAGED = """store_id product_id event_timestamp event_date hour_of_day city_id observed_sales stockout_flag
is_operational_hour day_of_week is_weekend week_of_year month part_of_day discount discount_depth holiday_flag
activity_flag precpt avg_temperature avg_humidity avg_wind_level ingestion_batch_id ingested_at""".split()


def stg_hourly_sales(hourly: DataFrame) -> DataFrame:
    return hourly.select(*STAGED)


def default_attrs(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
