"""Demand recovery, quantile forecasts, errors and label checks.

The method is left open by the specification in several places; each choice made here
is named in the docstring of its operator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.functions import scores
from shelfline.functions.arrays import as_array, open_slots
from shelfline.functions.text import hash_uniform
from shelfline.operators.ranks import bounded_quantiles
from shelfline.operators.reshape import explode_hourly
from shelfline.session import materialize, shuffle_width

CELL = ["store_id", "product_id", "hour_of_day", "is_weekend"]
# Forecast quantiles and horizons in hours.
QUANTILES = {"forecast_q10": 0.10, "forecast_q25": 0.25, "forecast_median": 0.50, "forecast_q75": 0.75, "forecast_q90": 0.90}
HORIZONS = (1, 4, 8, 12, 24)
#: decimal places of a mean: far more than sales have, and fewer than the order of a sum disturbs
MEAN_DIGITS = 10


def expected_sales(ops: DataFrame, known: Column) -> DataFrame:
    """Mean sales of known hours per cell, with fallbacks already filled in.

    Levels: (store, product, hour, weekend), (store, product, hour), (product, hour).
    Each coarser level is rolled up from the finer one, so the hourly table is
    aggregated once; the result has at most 48 rows per series, whatever the history.
    """
    one = F.when(known, F.col("observed_sales"))
    fine = ops.groupBy(*CELL).agg(F.sum(one).alias("s0"), F.count(one).alias("n0"))
    mid = fine.groupBy("store_id", "product_id", "hour_of_day").agg(F.sum("s0").alias("s1"), F.sum("n0").alias("n1"))
    coarse = mid.groupBy("product_id", "hour_of_day").agg(F.sum("s1").alias("s2"), F.sum("n1").alias("n2"))
    mean = lambda i: F.col(f"s{i}") / F.nullif(F.col(f"n{i}"), F.lit(0))
    return (
        fine.join(mid, ["store_id", "product_id", "hour_of_day"])
        .join(coarse, ["product_id", "hour_of_day"])
        # rounded, as a mean that equals a sale is compared with it and must not depend on the order of the sum
        .select(*CELL, F.round(F.coalesce(mean(0), mean(1), mean(2)), MEAN_DIGITS).alias("expected_sales"))
    )


def recover_demand(ops: DataFrame) -> DataFrame:
    """``recovered_demand``: observed outside stockouts, expected (never below observed) inside."""
    out = (F.col("stockout_flag") == 1)
    cells = expected_sales(ops, ~out)
    value = F.when(out, F.greatest(F.col("observed_sales"), F.coalesce("expected_sales", "observed_sales")))
    return ops.join(cells, CELL, "left").withColumn("recovered_demand", value.otherwise(F.col("observed_sales"))).drop("expected_sales")


#: hours that one task of the product-limit estimate sorts
TASK_HOURS = 250_000


def above_cut(rows: DataFrame, value: str, cut: Column, least: int = 20, levels=(CELL, CELL[:3], CELL[:2])) -> DataFrame:
    """``expected_above``: the mean of what a row would have been, given that it is above its cut value.

    ``cut`` marks rows whose ``value`` is only a lower bound. The survival curve of a level is the product-limit estimate: at each
    distinct value, the share of the rows still at risk that end there; rows cut at a value leave after it. The expected value above
    v is v plus the area under the curve beyond v, divided by its height at v; a largest value that is cut counts as an end.
    The finest level with ``least`` rows that are not cut decides, and else the last level; without any such row the result is null.
    Rows with a null value, or of a null ``cut``, take no part and get null; rows with equal values count each.

    All levels begin with the series, so there is one exchange and no join; a window holds the hours of a series, which the calendar
    bounds. The rows are stored first, so that their number tells how many tasks share the sorts. Sums over what follows run on the reversed order, as a frame that shrinks would be added up again for each row.
    """
    stored = materialize(rows.withColumns({"_v": F.when(cut.isNotNull(), F.col(value)), "_cut": cut}), "cut-rows")
    part = stored.repartition(max(shuffle_width(rows.sparkSession), -(-stored.count() // TASK_HOURS)), *levels[-1])
    estimates = []
    for i, keys in enumerate(levels):
        names = {n: f"_{n}{i}" for n in ("ends", "share", "next", "log", "step", "area")}
        col = {n: F.col(c) for n, c in names.items()}
        # rows without a value are apart, so that they are in no frame
        group = Window.partitionBy(*keys, F.col("_v").isNull())
        up, down = group.orderBy("_v"), group.orderBy(F.desc("_v"))
        peers, upto = up.rangeBetween(0, 0), up.rangeBetween(Window.unboundedPreceding, 0)
        ended = F.when(~F.col("_cut"), 1)
        at_risk = F.count("_v").over(group) - F.rank().over(up) + 1
        part = part.withColumns({
            names["ends"]: F.count(ended).over(group), names["share"]: 1 - F.count(ended).over(peers) / F.nullif(at_risk, F.lit(0)),
            names["next"]: F.lead("_v").over(up), "_first": F.rank().over(up) == F.row_number().over(up)})
        # the share is zero at the largest value only, where no area follows
        part = part.withColumn(names["log"], F.coalesce(F.sum(F.when(F.col("_first") & (col["share"] > 0), F.ln(col["share"]))).over(upto), F.lit(0.0)))
        part = part.withColumn(names["step"], F.coalesce(F.exp(col["log"]) * (col["next"] - F.col("_v")), F.lit(0.0)))
        part = part.withColumn(names["area"], F.sum(col["step"]).over(down.rangeBetween(Window.unboundedPreceding, 0)))
        enough = col["ends"] >= (least if i < len(levels) - 1 else 1)
        estimates.append(F.when(enough & F.col("_v").isNotNull(), F.col("_v") + col["area"] / F.exp(col["log"])))
    return part.select(*rows.columns, F.coalesce(*estimates).alias("expected_above"))


def recover_censored(ops: DataFrame, least: int = 20) -> DataFrame:
    """``cut_short`` and ``recovered_demand`` by the product-limit estimate, in place of the mean of hours in stock.

    Sales are a lower bound in a stockout hour and in the trading hour just before a stockout of the same day, in which the shelf ran empty.
    Such hours get the expected demand above what they sold; the others, and hours without an estimate, keep their sales.
    """
    day = Window.partitionBy("store_id", "product_id", "event_date").orderBy("event_timestamp")
    short = (F.col("stockout_flag") == 1) | F.coalesce(F.lead("stockout_flag").over(day) == 1, F.lit(False))
    marked = above_cut(ops.withColumn("cut_short", short), "observed_sales", F.col("cut_short"), least)
    value = F.when(F.col("cut_short"), F.coalesce("expected_above", "observed_sales")).otherwise(F.col("observed_sales"))
    return marked.withColumn("recovered_demand", value).drop("expected_above")


def hidden_cuts(ops: DataFrame, fraction: float = 0.5, seed: int = 42) -> DataFrame:
    """Known hours with ``truth``, ``sold`` and ``cut``: a hashed share runs out at a hashed part of the largest sale of its series.

    Where a row is cut does not depend on what it sold, so an estimate of the rows above their cut can be held against the truth.
    """
    key = [F.col(c) for c in ("store_id", "product_id", "event_timestamp")]
    most = F.max("observed_sales").over(Window.partitionBy("store_id", "product_id"))
    stock = F.when(hash_uniform(seed, *key) < fraction, hash_uniform(seed + 1, *key) * most)
    known = ops.filter("stockout_flag = 0").withColumns({"truth": F.col("observed_sales"), "stock": stock})
    return known.select(*CELL, "event_timestamp", "truth", F.least("truth", "stock").alias("sold"),
                        F.coalesce(F.col("stock") < F.col("truth"), F.lit(False)).alias("cut"))


def cut_backtest(cuts: DataFrame, least: int = 20) -> DataFrame:
    """Errors of both recoveries on the hours of ``hidden_cuts`` that were cut: ``method`` mean or product_limit, and their metrics.

    The mean is that of the uncut hours by the levels of ``expected_sales``, and never below what was sold.
    """
    limits = above_cut(cuts, "sold", F.col("cut"), least)
    means = expected_sales(cuts.withColumnRenamed("sold", "observed_sales"), ~F.col("cut"))
    both = limits.filter("cut AND expected_above IS NOT NULL").join(means, CELL).filter("expected_sales IS NOT NULL")
    forms = F.array(
        F.struct(F.lit("mean").alias("method"), F.greatest("sold", "expected_sales").alias("estimate")),
        F.struct(F.lit("product_limit").alias("method"), F.col("expected_above").alias("estimate")))
    return forecast_metrics(both.select("truth", F.explode(forms).alias("f")).select("truth", "f.*"), "truth", "estimate", ["method"])


def forecast_quantiles(train: DataFrame, target: str = "recovered_demand", horizons=HORIZONS) -> DataFrame:
    """Empirical quantiles per cell of the training window, repeated per horizon.

    A cell holds at most one row per calendar day, so its values are bounded.
    """
    cells = bounded_quantiles(train, CELL, target, QUANTILES.values(), "_q")
    return cells.select(
        *CELL, *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(QUANTILES)],
        F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon_hours"))


def with_forecast(rows: DataFrame, train: DataFrame, target: str = "recovered_demand") -> DataFrame:
    """``rows`` with the quantiles of their cell, or of (store, product, hour), or of the series.

    Rows of a series without any training row stay, without a forecast.
    """
    out, names = rows, list(QUANTILES)
    for i, keys in enumerate((CELL, CELL[:3], CELL[:2])):
        # a series holds at most 16 rows for each calendar day, which bounds its values
        out = out.join(bounded_quantiles(train, keys, target, QUANTILES.values(), f"_q{i}"), keys, "left")
    q = F.coalesce(*[F.col(f"_q{i}") for i in range(3)])
    return out.select(*rows.columns, *[F.get(q, F.lit(i)).alias(name) for i, name in enumerate(names)])


def with_errors(df: DataFrame, actual: str, forecast: str) -> DataFrame:
    miss = F.col(actual) - F.col(forecast)
    return df.withColumns({"absolute_error": F.abs(miss), "squared_error": miss * miss})


def pinball_losses(df: DataFrame, actual: str, **forecast_cols: float) -> DataFrame:
    """``pinball_loss_<name>`` for each forecast column and its quantile."""
    return df.withColumns({
        f"pinball_loss_{c}": scores.pinball(F.col(actual), F.col(c), q) for c, q in forecast_cols.items()})


def forecast_metrics(df: DataFrame, actual: str, forecast: str, by=()) -> DataFrame:
    """MAE, RMSE, R2, WAPE and bias in one aggregate, with 0 for an empty denominator.

    The total sum of squares uses the variance aggregate, which stays accurate for
    large means.
    """
    y, miss = F.col(actual), F.col(forecast) - F.col(actual)
    agg = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(F.abs(miss)).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.sum(miss * miss).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"),
        F.sum(F.abs(miss)).alias("_abs"), F.sum(miss).alias("_miss"), F.sum(F.abs(y)).alias("_absy"), F.sum(y).alias("_y"))
    return agg.withColumns(
        {
            "r2": F.when(F.col("_sst") > 0, 1.0 - F.col("_sse") / F.nullif(F.col("_sst"), F.lit(0.0))).otherwise(0.0),
            "wape": scores.safe_ratio(F.col("_abs"), F.col("_absy"), 100.0, 0.0),
            "bias": scores.safe_ratio(F.col("_miss"), F.col("_y"), 100.0, 0.0),
        }
    ).drop("_sse", "_sst", "_abs", "_miss", "_absy", "_y")


def best_run(metrics: DataFrame, n: int = 1) -> DataFrame:
    return metrics.orderBy("rmse", *[c for c in metrics.columns if c != "rmse"]).limit(n)


def metrics_by_censoring(df: DataFrame, actual: str, forecast: str) -> DataFrame:
    """Metrics of uncensored hours (the primary result) and of stockout hours apart."""
    segment = F.when(F.col("stockout_flag") == 1, "censored").otherwise("uncensored")
    return forecast_metrics(df.withColumn("segment", segment), actual, forecast, ["segment"])


def recovery_backtest(ops: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Recovery error on known hours that are hidden by a seeded hash of their key."""
    known = F.col("stockout_flag") == 0
    hidden = known & (hash_uniform(seed, F.col("store_id"), F.col("product_id"), F.col("event_timestamp")) < fraction)
    marked = ops.withColumn("_hidden", hidden)
    cells = expected_sales(marked, known & ~F.col("_hidden"))
    test = marked.filter("_hidden").join(cells, CELL, "left").filter("expected_sales IS NOT NULL")
    return forecast_metrics(test, "observed_sales", "expected_sales")


def label_audit(ops: DataFrame, slow_share: float = 0.25) -> DataFrame:
    """Stockout hours that may be slow sales: ``suspect`` when both neighbour hours are
    flagged too or missing and the product sells in at most ``slow_share`` of the
    series' hours; ``confirmed`` otherwise; ``in_stock`` for the rest.

    The share and the neighbours use one window spec on the series, which holds one row per hour.
    """
    series = Window.partitionBy("store_id", "product_id")
    ordered = series.orderBy("event_timestamp")
    flag = F.col("stockout_flag")
    share = F.avg((1 - flag).cast("double")).over(series)
    quiet = (F.coalesce(F.lag(flag).over(ordered), F.lit(1)) == 1) & (F.coalesce(F.lead(flag).over(ordered), F.lit(1)) == 1)
    return ops.withColumns({"_share": share, "_quiet": quiet}).withColumn(
        "label_check",
        F.when(flag == 0, "in_stock").when(F.col("_quiet") & (F.col("_share") <= slow_share), "suspect").otherwise("confirmed"),
    ).drop("_share", "_quiet")


def weekend_of(dt: Column) -> Column:
    return F.weekday(dt) >= 5


def union_by_name(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def recover_daily(daily: DataFrame) -> DataFrame:
    """Demand recovery on the daily arrays: adds ``hours_recovered`` for the trading hours.

    Same rule as ``recover_demand``, but each aggregate and the join see one row per
    day with its arrays instead of sixteen hourly rows. The profile has two rows per
    series (weekday, weekend), and its fallbacks are rolled up from it.
    """
    slots = range(cal.CLOSE_HOUR - cal.OPEN_HOUR)
    rows = daily.withColumn("_wk", weekend_of(F.to_date("dt"))).withColumns({
        "_s": open_slots(as_array(daily, "hours_sale")), "_o": open_slots(as_array(daily, "hours_stock_status", "int"))})
    known = [F.expr(f"sum(_s[{i}]) FILTER (WHERE _o[{i}] = 0) AS s{i}") for i in slots]
    counts = [F.expr(f"count_if(_o[{i}] = 0) AS n{i}") for i in slots]

    def roll_up(df, keys, sums, ns):
        return df.groupBy(*keys).agg(*[F.expr(f"sum({sums}[{i}]) AS s{i}") for i in slots], *[F.expr(f"sum({ns}[{i}]) AS n{i}") for i in slots])

    def as_arrays(df, keys, sums, ns):
        return df.selectExpr(*keys, f"array({', '.join(f's{i}' for i in slots)}) AS {sums}", f"array({', '.join(f'n{i}' for i in slots)}) AS {ns}")

    series = ["store_id", "product_id"]
    fine = as_arrays(rows.groupBy(*series, "_wk").agg(*known, *counts), [*series, "_wk"], "s0", "n0")
    mid = as_arrays(roll_up(fine, series, "s0", "n0"), series, "s1", "n1")
    coarse = as_arrays(roll_up(mid, ["product_id"], "s1", "n1"), ["product_id"], "s2", "n2")
    mean = lambda i: f"s{i}[j] / nullif(n{i}[j], 0)"
    profile = fine.join(mid, series).join(coarse, "product_id").selectExpr(
        *series, "_wk", f"transform(sequence(0, {len(slots) - 1}), j -> round(coalesce({mean(0)}, {mean(1)}, {mean(2)}), {MEAN_DIGITS})) AS _e")
    fill = "transform(_s, (x, j) -> IF(_o[j] = 1, greatest(x, coalesce(_e[j], x)), x))"
    return rows.join(profile, [*series, "_wk"], "left").withColumn("hours_recovered", F.expr(fill)).drop("_wk", "_s", "_o", "_e")


def explode_recovered(daily: DataFrame) -> DataFrame:
    """The hourly table of the trading hours with ``recovered_demand``, from ``recover_daily``."""
    hourly = explode_hourly(daily, operational=True)
    return hourly.withColumn("recovered_demand", F.get("hours_recovered", F.col("hour_of_day") - cal.OPEN_HOUR)).drop("hours_recovered")
