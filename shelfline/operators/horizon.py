"""Forecast and risk that depend on how many hours ahead they look.

The forecast is a quantile regression on what is known at the origin, ``horizon`` hours before the
target hour. The risk is that of a discrete-time hazard: one row for each hour at risk, and the
probability of a stockout within a horizon is one minus the product of the survivals on the way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.operators.forecast import CELL, HORIZONS, QUANTILES
from shelfline.operators.ranks import bounded_quantiles
from shelfline.session import materialize

SERIES = ["store_id", "product_id"]
PROBS = list(QUANTILES.values())
#: inputs of the regression beside the cell's own quantile: constant, pull to the series, last hour, last day
INPUTS = 4
#: gradient steps of the fit, and the width around zero in which the loss is rounded, in typical deviations
STEPS, WIDTH = 30, 0.1
# Risk horizons in hours.
RISK_HORIZONS = (4, 8, 12, 24)


def with_profile(rows: DataFrame, train: DataFrame, target: str) -> DataFrame:
    """``rows`` with ``cell`` and ``series``, the empirical quantiles of the training rows of their cell and of
    their series; a cell without any takes those of (store, product, hour), then of the series. Rows of series without history go."""
    out = rows
    for i, keys in enumerate((CELL, CELL[:3], SERIES)):
        # a series holds at most 16 rows for each calendar day, which bounds its values
        out = out.join(bounded_quantiles(train, keys, target, PROBS, f"_p{i}"), keys, "left" if i < 2 else "inner")
    return out.withColumns({"cell": F.coalesce("_p0", "_p1", "_p2"), "series": F.col("_p2")}).drop("_p0", "_p1", "_p2")


def origins(rows: DataFrame, target: str, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """``_ahead``: for each horizon ``last`` and ``day``, the latest value at or before the origin and the mean of the 24 hours up to it.

    Frames are in time, so a missing hour or day is not taken for another one. All horizons share one window on the series.
    """
    w = Window.partitionBy(*SERIES).orderBy(F.unix_seconds(F.col("event_timestamp").cast("timestamp")))
    ahead = [F.struct(
        F.lit(h).alias("horizon_hours"), F.last(target).over(w.rangeBetween(Window.unboundedPreceding, -h * 3600)).alias("last"),
        F.avg(target).over(w.rangeBetween(-(h + 23) * 3600, -h * 3600)).alias("day")) for h in horizons]
    return rows.withColumn("_ahead", F.array(*ahead))


def by_horizon(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.inline("_ahead")).drop("_ahead")


def at_origins(rows: DataFrame, target: str, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Rolling origins: each row once for each horizon, with ``last`` and ``day`` of ``origins``."""
    return by_horizon(origins(rows, target, horizons))


def inputs(rows: DataFrame) -> DataFrame:
    """``d1`` and ``d2``: how far the last hour and the last day lie from the median of the series; 0 without any."""
    median = F.get("series", F.lit(len(PROBS) // 2))
    return rows.withColumns({"d1": F.coalesce(F.col("last") - median, F.lit(0.0)), "d2": F.coalesce(F.col("day") - median, F.lit(0.0))})


@dataclass
class HorizonModel:
    """Coefficients of each (horizon, quantile) as plain numbers; the constant is in typical deviations, ``scale``."""

    scale: float
    coefficients: dict[tuple[int, int], list[float]]

    def forecast(self, rows: DataFrame) -> DataFrame:
        """Rows from ``inputs`` with a column for each quantile, sorted so that none cross, and never below zero."""
        by_horizon = sorted({h for h, _ in self.coefficients})
        values = [(h, [x for q in range(len(PROBS)) for x in self.coefficients[h, q]]) for h in by_horizon]
        table = ", ".join(f"({h}, array({', '.join(f'{x!r}D' for x in b)}))" for h, b in values)
        if not values:
            return rows.limit(0).withColumns({name: F.lit(0.0) for name in QUANTILES})
        known = rows.sparkSession.sql(f"SELECT * FROM VALUES {table} AS t(horizon_hours, b)")
        term = "cell[{q}] + b[{i}] * {scale!r}D + b[{i} + 1] * (series[{q}] - cell[{q}]) + b[{i} + 2] * d1 + b[{i} + 3] * d2"
        raw = ", ".join(f"greatest(0D, {term.format(q=q, i=q * INPUTS, scale=self.scale)})" for q in range(len(PROBS)))
        out = rows.join(F.broadcast(known), "horizon_hours").withColumn("_q", F.expr(f"array_sort(array({raw}))"))  # a row for each horizon
        return out.withColumns({name: F.get("_q", F.lit(i)) for i, name in enumerate(QUANTILES)}).drop("_q", "b")


def fit_horizons(rows: DataFrame, target: str, steps: int = STEPS) -> HorizonModel:
    """Quantile regression by pinball loss, all horizons and quantiles together.

    The loss is rounded within ``WIDTH`` typical deviations of zero, which bounds its curvature; each step is an accelerated
    gradient step scaled by the sums of squares of the inputs. One step is one aggregate with a row for each horizon, which adds
    up all quantiles of a stored row, combined in the map tasks; only those few sums and the coefficients pass the driver. It
    starts at the empirical quantiles of the cell (all coefficients zero).
    """
    spark, quantiles = rows.sparkSession, range(len(PROBS))
    away = F.abs(F.col(target) - F.get("series", F.lit(len(PROBS) // 2))).alias("away")
    each = [c for q in quantiles for c in (
        (F.col(target) - F.get("cell", F.lit(q))).alias(f"u{q}"), (F.get("series", F.lit(q)) - F.get("cell", F.lit(q))).alias(f"x{q}"))]
    stored = materialize(rows.select("horizon_hours", "d1", "d2", away, *each), "horizon-rows")
    totals = stored.groupBy("horizon_hours").agg(
        F.count("*").alias("n"), F.sum("away").alias("away"), *[F.expr(f"sum(x{q} * x{q})").alias(f"a{q}") for q in quantiles],
        F.expr("sum(d1 * d1)").alias("b"), F.expr("sum(d2 * d2)").alias("c")).collect()  # a row for each horizon
    scale = sum(t["away"] for t in totals) / max(1, sum(t["n"] for t in totals)) or 1.0
    width = WIDTH * scale
    size = {(t["horizon_hours"], q): (t["n"] * scale * scale, t[f"a{q}"], t["b"], t["c"]) for t in totals for q in quantiles}
    now = {k: [0.0] * INPUTS for k in size}
    before = now
    slope = "(least(1D, greatest(0D, ({width!r}D - (u{q} - v{q}_0 * {scale!r}D - v{q}_1 * x{q} - v{q}_2 * d1 - v{q}_3 * d2)) / {double!r}D)) - {p!r}D)"
    sums = [F.expr(f"sum({slope.format(q=q, p=p, width=width, scale=scale, double=2 * width)} * {x})").alias(f"g{q}_{j}")
            for q, p in enumerate(PROBS) for j, x in enumerate((f"{scale!r}D", f"x{q}", "d1", "d2"))]
    names = ", ".join(f"v{q}_{j}" for q in quantiles for j in range(INPUTS))
    for step in range(steps if size else 0):
        push = step / (step + 3.0)
        ahead = {k: [x + push * (x - y) for x, y in zip(now[k], before[k])] for k in now}
        table = ", ".join(f"({t['horizon_hours']}, {', '.join(f'{x!r}D' for q in quantiles for x in ahead[t['horizon_hours'], q])})" for t in totals)
        point = spark.sql(f"SELECT * FROM VALUES {table} AS t(horizon_hours, {names})")
        found = stored.join(F.broadcast(point), "horizon_hours").groupBy("horizon_hours").agg(*sums).collect()  # a row for each horizon
        slopes = {(g["horizon_hours"], q): [g[f"g{q}_{j}"] for j in range(INPUTS)] for g in found for q in quantiles}
        before, now = now, {k: [x - (2 * width / INPUTS * g / s if s else 0.0) for x, g, s in zip(ahead[k], slopes[k], size[k])] for k in now}
    return HorizonModel(scale, now)


def horizon_forecasts(hours: DataFrame, middle: Column, cut: Column, target: str = "recovered_demand", horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Forecast quantiles of every hour from the day ``cut`` on, for each horizon.

    The profiles that the regression is fitted with come from the days before ``middle`` and its rows from those between
    ``middle`` and ``cut``, so that no row is in its own profile; the forecast takes profiles of all days before ``cut``.
    Only hours in stock are fitted, as the demand of the others is an estimate made from the same cells.
    Rows carry ``empirical``, the quantiles of their cell alone, which do not depend on the horizon.
    """
    day, in_stock = F.col("event_date"), F.col("stockout_flag") == 0
    # stored once for both uses; the profiles do not depend on the horizon and are joined before the rows are repeated for each
    ahead = materialize(origins(hours, target, horizons).where((day >= cut) | ((day >= middle) & in_stock)), "origins")
    fitted = inputs(by_horizon(with_profile(ahead.where((day >= middle) & (day < cut) & in_stock), hours.where(day < middle), target)))
    rows = inputs(by_horizon(with_profile(ahead.where(day >= cut), hours.where(day < cut), target)))
    return fit_horizons(fitted, target).forecast(rows).withColumnRenamed("cell", "empirical").drop("series", "last", "day", "d1", "d2")


HOURS = range(cal.OPEN_HOUR, cal.CLOSE_HOUR)
#: hours of the coarser level that count as much as the series' own
PRIOR = 4


def periods_at_risk(ops: DataFrame) -> DataFrame:
    """Person-period rows: the trading hours whose trading hour before was in stock; ``stockout_flag`` says whether the run ended there.

    The hour before is looked up by time: one hour earlier, or the last hour of the day before for the first one.
    """
    w = Window.partitionBy(*SERIES).orderBy(F.unix_seconds(F.col("event_timestamp").cast("timestamp")))
    hour, night = 3600, (24 - (cal.CLOSE_HOUR - 1) + cal.OPEN_HOUR) * 3600
    ago = lambda s: F.max("stockout_flag").over(w.rangeBetween(-s, -s))
    before = F.when(F.col("hour_of_day") == cal.OPEN_HOUR, ago(night)).otherwise(ago(hour))
    return ops.withColumn("_before", before).where("_before = 0").drop("_before")


def hazards(periods: DataFrame, series: DataFrame) -> DataFrame:
    """``hazard`` of each series, an array by hour of the day: stockouts per hour at risk, pulled to the rate of (product, hour)
    and that to the hour's rate by ``PRIOR`` hours; 0 while closed, and 0 where no level has a row.

    One aggregate makes arrays by series; the coarser levels are rolled up from it, and joined at series size.
    """
    n = len(HOURS)
    own = periods.groupBy(*SERIES).agg(
        F.array(*[F.sum(F.when(F.col("hour_of_day") == h, F.col("stockout_flag")).otherwise(0)) for h in HOURS]).alias("e"),
        F.array(*[F.count_if(F.col("hour_of_day") == h) for h in HOURS]).alias("n"))
    added = lambda df, keys, e, m: df.groupBy(*keys).agg(
        F.array(*[F.sum(F.get(e, F.lit(i))) for i in range(n)]).alias(e + "1"), F.array(*[F.sum(F.get(m, F.lit(i))) for i in range(n)]).alias(m + "1"))
    products = added(own, ["product_id"], "e", "n")
    overall = added(products, [], "e1", "n1")
    nothing = F.array_repeat(F.lit(0).cast("long"), n)
    at = lambda name, i: f"{name}[{i}]"
    coarse = lambda i: f"coalesce({at('e11', i)} / nullif({at('n11', i)}, 0), 0D)"
    middle = lambda i: f"(({at('e1', i)} + {PRIOR} * {coarse(i)}) / ({at('n1', i)} + {PRIOR}))"
    fine = lambda i: f"(({at('e', i)} + {PRIOR} * {middle(i)}) / ({at('n', i)} + {PRIOR}))"
    rate = "array(" + ", ".join(fine(h - HOURS.start) if h in HOURS else "0D" for h in range(24)) + ")"
    filled = series.select(*SERIES).distinct().join(own, SERIES, "left").join(products, "product_id", "left").join(F.broadcast(overall))  # one row
    filled = filled.withColumns({c: F.coalesce(c, nothing) for c in ("e", "n", "e1", "n1", "e11", "n11")})
    return filled.select(*SERIES, F.expr(rate).alias("hazard"))


def risk_within(hazard: str, hour: str, horizon: str) -> Column:
    """One minus the product of the survivals of the next ``horizon`` hours after ``hour``."""
    return F.expr(f"1D - aggregate(sequence(1, {horizon}), 1D, (s, k) -> s * (1D - {hazard}[({hour} + k) % 24]))")


def stockout_within(ops: DataFrame, cut: Column, horizons: Sequence[int] = RISK_HORIZONS) -> DataFrame:
    """The risk at each hour in stock from the day ``cut`` on, for each horizon, and whether a stockout ``occurred``.

    Hazards come from the hours before ``cut``. Hours whose horizon reaches beyond the last hour of their series are left out, as are
    horizons without any trading hour in the data.
    """
    rates = materialize(hazards(periods_at_risk(ops).where(F.col("event_date") < cut), ops), "hazards")
    order = F.unix_seconds(F.col("event_timestamp").cast("timestamp"))
    w = Window.partitionBy(*SERIES).orderBy(order)
    seen = [F.struct(F.lit(h).alias("horizon_hours"), F.max("stockout_flag").over(w.rangeBetween(1, h * 3600)).alias("occurred")) for h in horizons]
    end = F.max(order).over(Window.partitionBy(*SERIES))
    rows = ops.withColumns({"_seen": F.array(*seen), "_left": end - order}).where((F.col("event_date") >= cut) & (F.col("stockout_flag") == 0))
    rows = rows.select(*SERIES, "event_timestamp", "hour_of_day", "_left", F.inline("_seen")).where("occurred IS NOT NULL AND _left >= horizon_hours * 3600")
    return rows.join(rates, SERIES).select(*SERIES, "event_timestamp", "horizon_hours", "occurred", risk_within("hazard", "hour_of_day", "horizon_hours").alias("stockout_risk"))
