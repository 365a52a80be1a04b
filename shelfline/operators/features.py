"""Lag, rolling, baseline and split features.

A daily series holds at most one row per calendar day, so a window partition on the
series is bounded by the calendar. All frames are ranges in days, not row offsets:
a missing day gives NULL instead of a value from the wrong day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.functions.text import hash_uniform

SERIES = ["store_id", "product_id"]
# Lag days and rolling spans.
LAGS = (1, 2, 3, 7, 14)
SPANS = (3, 7, 14, 28)


def _by_day(keys, date_col):
    return Window.partitionBy(*keys).orderBy(F.unix_date(F.to_date(date_col)))


def value_days_ago(value: str, days: int, keys=SERIES, date_col="dt") -> Column:
    return F.max(value).over(_by_day(keys, date_col).rangeBetween(-days, -days))


def lag_features(df: DataFrame, value="sale_amount", lags=LAGS, keys=SERIES, date_col="dt") -> DataFrame:
    """``lag_<n>`` and mean, std, min and max over the lagged values that exist."""
    out = df.withColumns({f"lag_{n}": value_days_ago(value, n, keys, date_col) for n in lags})
    seen = F.filter(F.array(*[F.col(f"lag_{n}") for n in lags]), lambda x: x.isNotNull())
    out = out.withColumn("_seen", seen)
    n = F.nullif(F.size("_seen"), F.lit(0))
    mean = F.aggregate("_seen", F.lit(0.0), lambda a, x: a + x) / n
    out = out.withColumn("lag_mean", mean)
    spread = F.aggregate(F.transform("_seen", lambda x: (x - F.col("lag_mean")) * (x - F.col("lag_mean"))), F.lit(0.0), lambda a, x: a + x)
    return out.withColumns(
        {
            "lag_std": F.sqrt(spread / F.nullif(F.size("_seen") - 1, F.lit(0)) * F.when(F.size("_seen") > 1, 1.0)),
            "lag_min": F.array_min("_seen"),
            "lag_max": F.array_max("_seen"),
        }
    ).drop("_seen")


def rolling_features(df: DataFrame, value="sale_amount", spans=SPANS, keys=SERIES, date_col="dt") -> DataFrame:
    """Mean and deviation over the days before the current one; the day itself is left out."""
    w = _by_day(keys, date_col)
    cols = {}
    for n in spans:
        frame = w.rangeBetween(-n, -1)
        cols[f"roll_mean_{n}"] = F.avg(value).over(frame)
        cols[f"roll_std_{n}"] = F.stddev_samp(value).over(frame)
    return df.withColumns(cols)


def naive_forecast(df: DataFrame, season=7, value="sale_amount", keys=SERIES, date_col="dt") -> DataFrame:
    return df.withColumn("naive_forecast", value_days_ago(value, season, keys, date_col))


def period_delta(df: DataFrame, value: str, period: str, keys=()) -> DataFrame:
    """Change against the period before. ``df`` has one row per key and period, so the
    window sees the number of periods."""
    w = Window.partitionBy(*keys).orderBy(period)
    before = F.lag(value).over(w)
    return df.withColumn("previous", before).withColumn("delta", F.col(value) - F.col("previous")).withColumn(
        "delta_pct", F.col("delta") / F.nullif(F.col("previous"), F.lit(0.0)) * 100.0)


def scd2_build(changes: DataFrame, key: str, attrs, effective: str, tie: str) -> DataFrame:
    """Intervals of attribute versions: each ends where the next begins.

    Several changes on one day count as the last of them. That first step combines
    before the shuffle and leaves at most one row per key and day for the window.
    """
    latest = changes.groupBy(key, F.to_date(effective).alias("effective_from")).agg(
        F.max_by(F.struct(*attrs), tie).alias("_a"))
    w = Window.partitionBy(key).orderBy("effective_from")
    nxt = F.lead("effective_from").over(w)
    return latest.select(
        key, "_a.*", "effective_from",
        F.coalesce(nxt, F.lit("9999-12-31").cast("date")).alias("effective_to"),
        nxt.isNull().alias("is_current"))


def purchase_curve(df: DataFrame, mean_demand: str) -> DataFrame:
    """``purchases``: expected purchases in hours 8 to 21, kept as an array in the row."""
    mu = F.col(mean_demand)
    # 0.04 base share, 0.08 wave, at least 2 per hour, first hour 8, 13 hour steps.
    wave = lambda h: F.lit(0.04) + F.lit(0.08) * F.sin((h - 8) / F.lit(13.0) * F.lit(3.141592653589793))
    per_hour = F.transform(F.sequence(F.lit(8), F.lit(21)), lambda h: F.greatest(F.lit(2), F.floor(mu * wave(h)).cast("int")))
    return df.withColumn("purchases", per_hour)


def depletion_curve(df: DataFrame, order_qty: str) -> DataFrame:
    """One row per hour with the remaining shelf stock; the running sum stays inside the row."""
    left = F.transform(
        "purchases",
        lambda p, i: F.greatest(F.lit(0), F.col(order_qty).cast("int") - F.aggregate(F.slice("purchases", F.lit(1), i + 1), F.lit(0), lambda a, x: a + x)))
    keep = [c for c in df.columns if c != "purchases"]
    return df.select(*keep, F.posexplode(F.arrays_zip(F.col("purchases").alias("p"), left.alias("s"))).alias("i", "x")).select(
        *keep, (F.col("i") + 8).alias("hour_of_day"), F.col("x.p").alias("purchases"), F.col("x.s").alias("shelf_stock"))


def random_split(df: DataFrame, keys, test_fraction=0.2, seed=42) -> DataFrame:
    """``split``: a repeatable random train/test mark from the row key."""
    u = hash_uniform(seed, *[F.col(k) for k in keys])
    return df.withColumn("split", F.when(u < test_fraction, "test").otherwise("train"))


def temporal_split(df: DataFrame, date_col: str, train=0.70, validation=0.15, embargo_days=1) -> DataFrame:
    """``split`` by date order with a gap of ``embargo_days`` at each boundary.

    The distinct dates are few (one per calendar day); their ranks become the cut
    dates, and the marking itself is a projection over the rows.
    """
    d = F.to_date(date_col)
    dates = df.select(d.alias("_d")).distinct()
    ranked = dates.select("_d", F.row_number().over(Window.orderBy("_d")).alias("_i"), F.count("*").over(Window.partitionBy()).alias("_n"))
    n, i = F.col("_n"), F.col("_i")
    cut1, cut2 = F.ceil(n * train), F.ceil(n * (train + validation))
    mark = (
        F.when(i <= cut1, "train")
        .when(i <= cut1 + embargo_days, "embargo")
        .when(i <= cut2, "validation")
        .when(i <= cut2 + embargo_days, "embargo")
        .otherwise("test")
    )
    return df.withColumn("_d", d).join(ranked.select("_d", mark.alias("split")), "_d", "left").drop("_d")


def cut_day(rows: DataFrame, date_col: str, train=0.70) -> Column:
    """The first day after the first ``train`` share of the distinct days, as a scalar subquery."""
    days = rows.select(F.to_date(date_col).alias("_d")).distinct()
    ranked = days.select("_d", F.row_number().over(Window.orderBy("_d")).alias("_i"), F.count("*").over(Window.partitionBy()).alias("_n"))
    return ranked.filter(F.col("_i") > F.ceil(F.col("_n") * train)).agg(F.min("_d")).scalar()


def demand_features(fact: DataFrame) -> DataFrame:
    """Model columns: four categoricals, the discount, date parts and hour."""
    return fact.withColumns(cal.parts_from_key(F.col("date_key"), F.col("time_key")))
