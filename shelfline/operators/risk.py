"""Stockout risk: an empirical rate and a logistic regression, calibration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.functions.arrays import as_array, open_slots
from shelfline.operators.reshape import explode_hourly
from shelfline.session import materialize

RATE_KEYS = ["store_id", "product_id", "hour_of_day"]
SCORE_DIGITS = 4  # fixed value: probabilities are stored with four decimals


def score_by_rate(daily: DataFrame, cut: Column) -> DataFrame:
    """Trading hours from the day ``cut`` on, scored with the stockout rate of the days before it.

    Levels: (store, product, hour), (product, hour), hour. One aggregate folds the daily rows into arrays by hour for each
    series; the coarser levels are rolled up from it and filled in at that size. The days to be scored
    meet their series in one join, and hours are made last. An hour that no level knows keeps its row without a probability.
    """
    slots = range(cal.CLOSE_HOUR - cal.OPEN_HOUR)
    rows = daily.withColumns({"_o": open_slots(as_array(daily, "hours_stock_status", "int")), "_known": F.to_date("dt") < cut})

    def arrays(df, keys, s, n, level):
        return df.groupBy(*keys).agg(F.array(*[F.sum(s(i)) for i in slots]).alias(f"s{level}"), F.array(*[F.sum(n(i)) for i in slots]).alias(f"n{level}"))

    flag = lambda i: F.when(F.col("_known"), F.get("_o", F.lit(i)))
    own = arrays(rows, RATE_KEYS[:2], lambda i: F.coalesce(flag(i), F.lit(0)), lambda i: flag(i).isNotNull().cast("long"), 0)
    product = arrays(own, ["product_id"], lambda i: F.get("s0", F.lit(i)), lambda i: F.get("n0", F.lit(i)), 1)
    overall = arrays(product, [], lambda i: F.get("s1", F.lit(i)), lambda i: F.get("n1", F.lit(i)), 2)
    share = lambda k, i: F.round(F.get(f"s{k}", F.lit(i)) / F.nullif(F.get(f"n{k}", F.lit(i)), F.lit(0)), SCORE_DIGITS)
    rates = own.join(product, "product_id").join(F.broadcast(overall)).select(  # one row
        *RATE_KEYS[:2], F.array(*[F.coalesce(*[share(k, i) for k in range(3)]) for i in slots]).alias("_rates"))
    hours = explode_hourly(daily.where(F.to_date("dt") >= cut).join(rates, RATE_KEYS[:2]), operational=True)
    return hours.withColumn("stockout_probability", F.get("_rates", F.col("hour_of_day") - cal.OPEN_HOUR)).drop("_rates")


HOURS = list(range(cal.OPEN_HOUR, cal.CLOSE_HOUR))
PLAIN = ["weekend", "discount", "prev_out", "day_out", "product_rate"]


def risk_features(ops: DataFrame, cut: Column) -> DataFrame:
    """The state one hour and one day before, and the stockout rate of the product, stored once.

    States are looked up by time, so a missing hour or day gives 0 and not the state of another one. The rate of
    a product comes from the training days of the other parity for a training row, and from all of them after the cut,
    so no row knows its own label. Stores and products enter by such numbers: an index or a
    column for each would grow with the data.
    """
    w = Window.partitionBy("store_id", "product_id").orderBy(F.unix_seconds(F.col("event_timestamp").cast("timestamp")))
    ago = lambda s: F.coalesce(F.max("stockout_flag").over(w.rangeBetween(-s, -s)), F.lit(0)).cast("double")
    odd, known = F.unix_date("event_date") % 2, F.col("event_date") < cut
    series = ops.select("store_id", "product_id").distinct()
    rates = ops.where(known).groupBy("product_id").agg(
        *[F.avg(F.when(odd == i, F.col("stockout_flag").cast("double"))).alias(f"_r{1 - i}") for i in (0, 1)],
        F.avg(F.col("stockout_flag").cast("double")).alias("_r"))
    out = ops.withColumns({"prev_out": ago(3600), "day_out": ago(86400), "weekend": F.col("is_weekend").cast("double"),
                           "label": F.col("stockout_flag").cast("double"), "training": known})
    rate = F.when(F.col("training") & (odd == 0), F.col("_r0")).when(F.col("training"), F.col("_r1")).otherwise(F.col("_r"))
    # the rate is attached to the series, whose rows the window has brought together already
    out = out.join(series.join(rates, "product_id", "left"), ["store_id", "product_id"], "left").withColumn("product_rate", F.coalesce(rate, F.col("_r"), F.lit(0.5)))
    return materialize(out.drop("_r0", "_r1", "_r"), "risk-features")


@dataclass
class RiskModel:
    """A logistic regression as plain numbers."""

    intercept: float
    hours: list[float]
    plain: list[float]

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds ``stockout_probability`` in plain expressions; no model object goes to the tasks."""
        hour = F.coalesce(F.get(F.array(*[F.lit(x) for x in self.hours]), F.col("hour_of_day") - HOURS[0]), F.lit(0.0))
        odds = sum((F.col(c) * F.lit(x) for c, x in zip(PLAIN, self.plain)), F.lit(self.intercept) + hour)
        return rows.withColumn("stockout_probability", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)), SCORE_DIGITS))


def risk_model(train: DataFrame) -> RiskModel:
    """Logistic regression on the trading hour and the plain features."""
    slots = [(F.col("hour_of_day") == h).cast("double") for h in HOURS] + [F.col(c).cast("double") for c in PLAIN]
    rows = train.select("label", array_to_vector(F.array(*slots)).alias("features"))
    model = LogisticRegression(maxIter=25, regParam=0.001).fit(rows)
    values = [float(x) for x in model.coefficients.toArray()]
    return RiskModel(float(model.intercept), values[:len(HOURS)], values[len(HOURS):])


def calibrate(scored: DataFrame, label: str = "stockout_flag", score: str = "stockout_probability") -> IsotonicRegressionModel:
    """Isotonic calibration on score bins at the stored precision.

    Scores have four decimals, so at most 10,001 weighted points reach the fit however
    many rows were scored; weighting makes the fit equal to one on all rows.
    """
    points = scored.groupBy(F.round(score, SCORE_DIGITS).alias("features")).agg(
        F.avg(F.col(label).cast("double")).alias("label"), F.count("*").cast("double").alias("weight"))
    return IsotonicRegression(weightCol="weight").fit(points)


def reliability(scored: DataFrame, label: str = "stockout_flag", score: str = "stockout_probability", bins: int = 10) -> DataFrame:
    """Mean score and observed rate per score bin."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(b.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("observed_rate"))


def coefficients(model: RiskModel, spark) -> DataFrame:
    """Coefficient of each input of the logistic model."""
    rows = [(f"hour={h}", x) for h, x in zip(HOURS, model.hours)] + list(zip(PLAIN, model.plain))
    return spark.createDataFrame(rows, "feature string, coefficient double")
