"""Source profiling over all rows. Every profile is a few aggregates returned as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.arrays import SLOTS, array_sum, as_array
from shelfline.operators.ranks import exact_quantiles, melt, value_counts_by


def profile_columns(df: DataFrame, cols=None) -> DataFrame:
    """Per numeric column: counts, distinct, range, mean, deviation, quartiles, zeros, negatives.

    The distinct count and the quartiles share one (column, value) aggregate.
    """
    cols = cols or [f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "short", "double", "float")]
    rows = melt(df, cols, name="column_name")
    v = F.col("value")
    basic = rows.groupBy("column_name").agg(
        F.count("*").alias("row_count"),
        F.count(v).alias("non_null"),
        F.count_if(v.isNull()).alias("null_count"),
        (F.count_if(v.isNull()) / F.count("*") * 100.0).alias("null_pct"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.count_if(v == 0).alias("n_zeros"), F.count_if(v < 0).alias("n_negative"),
    )
    counted = value_counts_by(rows, ["column_name"], "value")
    distinct = counted.groupBy("column_name").agg(F.count("*").alias("n_unique"))
    quart = exact_quantiles(counted, ["column_name"], "value", (0.25, 0.5, 0.75)).select(
        "column_name", F.get("quantiles", F.lit(0)).alias("q25"),
        F.get("quantiles", F.lit(1)).alias("median"), F.get("quantiles", F.lit(2)).alias("q75"))
    return basic.join(distinct, "column_name", "left").join(quart, "column_name", "left").withColumn(
        "n_unique", F.coalesce("n_unique", F.lit(0)))


def profile_text_columns(df: DataFrame, cols) -> DataFrame:
    """Count, NULLs and distinct values of any columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    return (
        df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count("*").alias("n"))
        .groupBy("column_name").agg(
            F.sum("n").alias("row_count"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
            F.count("value").alias("n_unique"))
    )


def length_histogram(df: DataFrame, col: str, elem: str = "double") -> DataFrame:
    return df.groupBy(F.size(as_array(df, col, elem)).alias("length")).agg(F.count("*").alias("n"))


def profile_array(df: DataFrame, col: str, elem: str = "double", slots: int = SLOTS) -> DataFrame:
    """Length statistics from the length histogram; the mode is the shortest of the most frequent."""
    hist = length_histogram(df, col, elem)
    length, n = F.col("length"), F.col("n")
    real = F.when(length.isNotNull(), n).otherwise(0)
    return hist.agg(
        F.sum(real).alias("non_null"),
        F.sum(F.when(length.isNull(), n).otherwise(0)).alias("null_count"),
        F.min("length").alias("length_min"), F.max("length").alias("length_max"),
        (F.sum(length * n) / F.sum(real)).alias("length_mean"),
        F.max_by("length", F.struct(real, -length)).alias("length_mode"),
        (F.sum(F.when(length == slots, n).otherwise(0)) / F.sum(real) * 100.0).alias("pct_full"),
        F.sum(F.when(length != slots, n).otherwise(0)).alias("not_full"),
    )


def profile_elements(df: DataFrame, col: str, elem: str = "double") -> DataFrame:
    """Statistics of all array elements, computed inside each row before one small aggregate."""
    arr = as_array(df, col, elem)
    count_of = lambda test: F.size(F.filter(arr, test))
    per_row = df.select(
        F.array_min(arr).cast("double").alias("lo"), F.array_max(arr).cast("double").alias("hi"),
        F.aggregate(arr, F.lit(0.0), lambda a, x: a + F.coalesce(x.cast("double"), F.lit(0.0))).alias("total"),
        count_of(lambda x: x.isNotNull()).alias("n"), count_of(lambda x: x == 0).alias("zeros"),
        count_of(lambda x: x < 0).alias("negatives"))
    return per_row.agg(
        F.min("lo").alias("min"), F.max("hi").alias("max"), (F.sum("total") / F.sum("n")).alias("mean"),
        F.sum("zeros").alias("n_zeros"), F.sum("negatives").alias("n_negative"),
        (F.sum("zeros") / F.sum("n") * 100.0).alias("pct_zeros"))


def element_values(df: DataFrame, col: str, n: int = 20, elem: str = "double") -> DataFrame:
    """The first distinct element values in order (a top-n report)."""
    return df.select(F.explode(F.array_distinct(as_array(df, col, elem))).alias("value")).filter("value IS NOT NULL").distinct().orderBy("value").limit(n)


def profile_key(df: DataFrame, keys) -> DataFrame:
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    any_null = F.greatest(*[F.col(k).isNull().cast("int") for k in keys]) == 1
    return per_key.agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(any_null, F.col("n")).otherwise(0)).alias("null_in_keys"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate_rows"),
        F.count("*").alias("unique_combinations"),
    ).withColumn("is_unique", F.col("duplicate_rows") == 0)


def profile_dates(df: DataFrame, date_col: str = "dt", series=("store_id", "product_id")) -> DataFrame:
    """Range, distinct and missing dates, and days per series.

    One aggregate per date and one per series; the exact median of the days per
    series comes from their histogram, which has at most one row per day count.
    """
    d = F.to_date(date_col)
    span = df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"), F.countDistinct(d).alias("n_unique_dates"))
    days = df.select(*series, d.alias("d")).distinct().groupBy(*series).agg(F.count("*").alias("days"))
    hist = days.groupBy("days").agg(F.count("*").alias("n"))
    stats = hist.agg(
        F.sum("n").alias("total_series"), F.min("days").alias("min_days"), F.max("days").alias("max_days"),
        (F.sum(F.col("days") * F.col("n")) / F.sum("n")).alias("mean_days"),
        F.expr("percentile(days, 0.5, n)").alias("median_days"))
    both = span.join(F.broadcast(stats))  # one row each
    total = F.date_diff("max_date", "min_date") + 1
    return both.withColumn("date_range_days", total).withColumn("n_missing_dates", total - F.col("n_unique_dates"))


def missing_dates(df: DataFrame, date_col: str = "dt") -> DataFrame:
    """Calendar days between the first and the last date that have no row."""
    dates = df.select(F.to_date(date_col).alias("d")).distinct()
    expected = dates.agg(F.explode(F.sequence(F.min("d"), F.max("d"))).alias("d"))
    return expected.join(dates, "d", "left_anti")


def profile_consistency(df: DataFrame, amount: str = "sale_amount", arr: str = "hours_sale") -> DataFrame:
    """Daily amount against the sum of its slots."""
    diff = df.select(F.col(amount).alias("a"), F.abs(F.col(amount) - array_sum(as_array(df, arr))).alias("diff")).filter("diff IS NOT NULL")
    exact = F.col("diff") < 1e-6
    main = diff.agg(
        F.count("*").alias("n_compared"),
        F.count_if(exact).alias("exact_match"),
        F.count_if(F.col("diff") / (F.abs("a") + 1e-9) < 0.01).alias("close_match_1pct"),
        F.max("diff").alias("max_abs_diff"), F.avg("diff").alias("mean_abs_diff"),
        (F.count_if(exact) / F.count("*") * 100.0).alias("pct_exact_match"))
    med = exact_quantiles(value_counts_by(diff, [], "diff"), [], "diff", (0.5,)).select(
        F.get("quantiles", F.lit(0)).alias("median_abs_diff"))
    return main.join(F.broadcast(med))  # one row each


def profile_discount(df: DataFrame, col: str = "discount") -> DataFrame:
    c = F.col(col)
    return df.agg(
        F.countDistinct(c).alias("n_unique"), F.coalesce(F.bool_or(c > 1.0), F.lit(False)).alias("has_values_above_1"),
        (F.count_if(c == 1.0) / F.count("*") * 100.0).alias("pct_no_discount"))


def profile_status(df: DataFrame, col: str = "hours_stock_status") -> DataFrame:
    """Rows per flag value. Equal values are counted inside each row before they are exploded."""
    arr = as_array(df, col, "int")
    per_row = F.transform(F.array_distinct(arr), lambda v: F.struct(v.alias("value"), F.size(F.filter(arr, lambda x: x.eqNullSafe(v))).alias("n")))
    return df.select(F.inline(per_row)).groupBy("value").agg(F.sum("n").alias("n"))


HIERARCHY = ("city_id", "store_id", "management_group_id", "first_category_id", "second_category_id",
             "third_category_id", "product_id")


def profile_hierarchy(df: DataFrame, cols=HIERARCHY) -> DataFrame:
    return profile_text_columns(df, cols).select(F.col("column_name").alias("level"), "n_unique")


def profile_stockout(df: DataFrame, col: str = "stock_hour6_22_cnt") -> DataFrame:
    c = F.col(col)
    share = lambda test: F.count_if(test) / F.count("*") * 100.0
    return df.agg(
        F.avg(c).alias("mean_stockout_hours"), share(c == 0).alias("pct_zero_stockout"),
        share(c > 0).alias("pct_any_stockout"), share(c >= 16).alias("pct_full_stockout"))


def profile_scale(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("source_daily_rows"), (F.count("*") * 24).alias("exploded_hourly_rows"),
                  (F.count("*") * 16).alias("operational_hour_rows"))
