"""Forecast and risk by horizon."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import scores
from shelfline.operators import features, horizon, kpi
from shelfline.operators.forecast import HORIZONS, QUANTILES, union_by_name
from shelfline.plans.catalog import HOURLY, query, rounded
from shelfline.plans.cleaning import hourly
from shelfline.plans.kpis import RECOVERED, cut, stored_recovered
from shelfline.session import materialize
from shelfline.sources import tables

PROBS = list(QUANTILES.values())


def _profile(name: str, day: str) -> str:
    """CTEs ``name`` (rows x horizon) with the quantiles of the cell and of the series from the days before ``day``."""
    cells = [("c", "store_id, product_id, hour_of_day, is_weekend"), ("h", "store_id, product_id, hour_of_day"), ("s", "store_id, product_id")]
    made = "".join(f", {name}_{x} AS (SELECT {keys}, quantile_cont(recovered_demand, {PROBS}) AS {x} FROM recovered WHERE event_date < {day} GROUP BY ALL)" for x, keys in cells)
    joins = f"LEFT JOIN {name}_c USING ({cells[0][1]}) LEFT JOIN {name}_h USING ({cells[1][1]}) JOIN {name}_s USING ({cells[2][1]})"
    return made + f""", {name} AS (SELECT *, coalesce(lv - s[3], 0) AS d1, coalesce(dv - s[3], 0) AS d2 FROM (SELECT a.*, coalesce(c, h, s) AS cell, s FROM ahead a {joins}))"""


_AHEAD = " UNION ALL ".join(
    f"""SELECT *, {h} AS hz, last_value(recovered_demand) OVER (PARTITION BY store_id, product_id ORDER BY event_timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL {h} HOUR PRECEDING) AS lv,
avg(recovered_demand) OVER (PARTITION BY store_id, product_id ORDER BY event_timestamp RANGE BETWEEN INTERVAL {h + 23} HOUR PRECEDING AND INTERVAL {h} HOUR PRECEDING) AS dv FROM recovered""" for h in HORIZONS)
_V = [f"(b{j} + it / (it + 3.0::DOUBLE) * (b{j} - p{j}))" for j in range(4)]
# the same thirty steps, in a recursive query
HORIZON = "RECURSIVE " + RECOVERED + f""", midd AS (SELECT min(d) AS mid FROM (SELECT d, row_number() OVER (ORDER BY d) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT d FROM base)) WHERE i > ceil(n * 0.5))
, ahead AS ({_AHEAD}){_profile("fitall", "(SELECT mid FROM midd)")}{_profile("evalall", "(SELECT cut FROM cutd)")}
, fits AS (SELECT * FROM fitall WHERE event_date >= (SELECT mid FROM midd) AND event_date < (SELECT cut FROM cutd) AND stockout_flag = 0
), scl AS (SELECT avg(abs(recovered_demand - s[3])) AS scale FROM fits
), long AS (SELECT hz, q, {PROBS}[q] AS p, recovered_demand - cell[q] AS u, s[q] - cell[q] AS x1, d1, d2 FROM fits, (SELECT unnest(range(1, 6)) AS q)
), sizes AS (SELECT hz, q, count(*) * any_value(scale) * any_value(scale) AS s0, sum(x1 * x1) AS s1, sum(d1 * d1) AS s2, sum(d2 * d2) AS s3 FROM long, scl GROUP BY ALL
), steps AS (
  SELECT hz, q, 0 AS it, {", ".join(f"0.0::DOUBLE AS b{j}" for j in range(4))}, {", ".join(f"0.0::DOUBLE AS p{j}" for j in range(4))} FROM sizes
  UNION ALL
  SELECT hz, q, it + 1, {", ".join(f"any_value(v{j}) - coalesce(0.2 * any_value(scale) / 4 * sum(g * x{j}) / nullif(any_value(s{j}), 0), 0)" for j in range(4))}, {", ".join(f"any_value(b{j})" for j in range(4))}
  FROM (SELECT t.*, scale, scale AS x0, l.x1, l.d1 AS x2, l.d2 AS x3, s0, s1, s2, s3,
               least(1, greatest(0, (0.1 * scale - (u - v0 * scale - v1 * l.x1 - v2 * l.d1 - v3 * l.d2)) / (0.2 * scale))) - p AS g
        FROM (SELECT *, {", ".join(f"{v} AS v{j}" for j, v in enumerate(_V))} FROM steps) t JOIN long l USING (hz, q) JOIN sizes USING (hz, q) CROSS JOIN scl) z
  WHERE it < 30 GROUP BY hz, q, it
), betas AS (SELECT hz, list([b0 * scale, b1, b2, b3] ORDER BY q) AS b FROM steps, scl WHERE it = 30 GROUP BY hz
), hzf AS (SELECT *, recovered_demand AS actual, list_sort(list_transform([1, 2, 3, 4, 5], lambda q: greatest(0, cell[q] + b[q][1] + b[q][2] * (s[q] - cell[q]) + b[q][3] * d1 + b[q][4] * d2))) AS f
  FROM evalall JOIN betas USING (hz) WHERE event_date >= (SELECT cut FROM cutd))"""


def forecasts(spark, sf):
    """Horizon forecasts of the evaluation window, stored."""
    hours = stored_recovered(spark, sf)
    # two dates, taken once: as subqueries each job would read the sales again for them
    days = [features.cut_day(tables.pos(spark, sf), "timestamp", 0.5), cut(spark, sf)]
    middle, end = (F.lit(d).cast("date") for d in spark.range(1).select(*days).first())
    return horizon.horizon_forecasts(hours, middle, end).withColumn("actual", F.col("recovered_demand"))


@query("fc2_horizon_forecast", ctes=HORIZON, sql="""SELECT store_id, product_id, event_timestamp, hz AS horizon_hours, round(f[1], 4) AS forecast_q10, round(f[2], 4) AS forecast_q25,
round(f[3], 4) AS forecast_median, round(f[4], 4) AS forecast_q75, round(f[5], 4) AS forecast_q90 FROM hzf""")
def _(spark, sf):
    return rounded(forecasts(spark, sf).select("store_id", "product_id", "event_timestamp", "horizon_hours", *QUANTILES), 4)


def _pinball_sql(values: str) -> str:
    return " + ".join(f"greatest({p} * (actual - {values}[{i + 1}]), ({p} - 1) * (actual - {values}[{i + 1}]))" for i, p in enumerate(PROBS))


@query("fc2_horizon_pinball", ctes=HORIZON, sql=f"""SELECT hz AS horizon_hours, count(*) AS n, round(avg({_pinball_sql('f')}), 4) AS pinball, round(avg({_pinball_sql('cell')}), 4) AS pinball_empirical,
avg({_pinball_sql('f')}) < avg({_pinball_sql('cell')}) AS better FROM hzf WHERE stockout_flag = 0 GROUP BY ALL""")
def _(spark, sf):
    """Pinball loss of the hours in stock, added over the five quantiles, beside that of the quantiles of the cell."""
    y = F.col("actual")
    loss = sum((scores.pinball(y, F.col(c), q) for c, q in QUANTILES.items()), F.lit(0.0))
    plain = sum((scores.pinball(y, F.get("empirical", F.lit(i)), q) for i, q in enumerate(PROBS)), F.lit(0.0))
    out = forecasts(spark, sf).where("stockout_flag = 0").groupBy("horizon_hours").agg(F.count("*").alias("n"), F.avg(loss).alias("pinball"), F.avg(plain).alias("pinball_empirical"))
    return rounded(out.withColumn("better", F.col("pinball") < F.col("pinball_empirical")), 4)


BY = ["product_id", "horizon_hours"]


@query("kp12_wape_by_horizon", ctes=HORIZON, sql="SELECT product_id, hz AS horizon_hours, round(coalesce(sum(abs(actual - f[3])) / nullif(sum(abs(actual)), 0) * 100, 0), 4) AS wape FROM hzf GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_wape(forecasts(spark, sf), "actual", "forecast_median", BY), 4)


@query("kp13_bias_by_horizon", ctes=HORIZON, sql="SELECT product_id, hz AS horizon_hours, round(coalesce(sum(f[3] - actual) / nullif(sum(actual), 0) * 100, 0), 4) + 0.0 AS bias FROM hzf GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_bias(forecasts(spark, sf), "actual", "forecast_median", BY), 4)


@query("kp14_coverage_by_horizon", ctes=HORIZON, sql="SELECT product_id, hz AS horizon_hours, round(avg((actual <= f[5])::INT) * 100, 4) AS p90_coverage_pct FROM hzf GROUP BY ALL")
def _(spark, sf):
    return rounded(kpi.kpi_p90_coverage(forecasts(spark, sf), "actual", "forecast_q90", BY), 4)


_N = horizon.PRIOR
HAZARD = HOURLY + f""", atrisk AS (SELECT a.* FROM ops a JOIN ops b ON b.store_id = a.store_id AND b.product_id = a.product_id AND b.stockout_flag = 0
    AND b.event_timestamp = a.event_timestamp - CASE WHEN a.hour_of_day = 6 THEN INTERVAL 9 HOUR ELSE INTERVAL 1 HOUR END
), hz0 AS (SELECT store_id, product_id, hour_of_day, sum(stockout_flag) AS e, count(*) AS n FROM atrisk WHERE event_date < (SELECT cut FROM cutd) GROUP BY ALL
), hz1 AS (SELECT product_id, hour_of_day, sum(e) AS e, sum(n) AS n FROM hz0 GROUP BY ALL), hz2 AS (SELECT hour_of_day, sum(e) / sum(n)::DOUBLE AS r FROM hz0 GROUP BY ALL
), stored AS (SELECT store_id, product_id, hour_of_day, (coalesce(hz0.e, 0) + {_N} * ((coalesce(hz1.e, 0) + {_N} * coalesce(r, 0)) / (coalesce(hz1.n, 0) + {_N}))) / (coalesce(hz0.n, 0) + {_N}) AS hazard
  FROM (SELECT DISTINCT store_id, product_id FROM ops) CROSS JOIN (SELECT unnest(range(6, 22))::INTEGER AS hour_of_day)
  LEFT JOIN hz0 USING (store_id, product_id, hour_of_day) LEFT JOIN hz1 USING (product_id, hour_of_day) LEFT JOIN hz2 USING (hour_of_day)
), ahead AS (SELECT store_id, product_id, event_timestamp, hour_of_day, horizon, max(event_timestamp) OVER (PARTITION BY store_id, product_id) AS ends, stockout_flag, event_date
  FROM ops CROSS JOIN (SELECT unnest([4, 8, 12, 24]) AS horizon)
), survived AS (SELECT a.store_id, a.product_id, a.event_timestamp, a.horizon, product(1 - s.hazard) AS stays FROM ahead a JOIN stored s USING (store_id, product_id)
  WHERE (s.hour_of_day - a.hour_of_day + 23) % 24 + 1 <= a.horizon GROUP BY ALL
), seen AS (SELECT a.store_id, a.product_id, a.event_timestamp, a.horizon, max(o.stockout_flag) AS occurred FROM ahead a JOIN ops o ON o.store_id = a.store_id AND o.product_id = a.product_id
  AND o.event_timestamp > a.event_timestamp AND o.event_timestamp <= a.event_timestamp + to_hours(a.horizon) GROUP BY ALL
), risks AS (SELECT store_id, product_id, event_timestamp, horizon, occurred, 1 - coalesce(stays, 1) AS risk FROM ahead JOIN seen USING (store_id, product_id, event_timestamp, horizon)
  LEFT JOIN survived USING (store_id, product_id, event_timestamp, horizon)
  WHERE event_date >= (SELECT cut FROM cutd) AND stockout_flag = 0 AND ends >= event_timestamp + to_hours(horizon))"""


def risks(spark, sf):
    ops = materialize(hourly(spark, sf, True).select("store_id", "product_id", "event_date", "event_timestamp", "hour_of_day", "stockout_flag"), "risk-hours")
    return horizon.stockout_within(ops, cut(spark, sf))


@query("rk1_hazard_risk", ctes=HAZARD, sql="SELECT store_id, product_id, event_timestamp, horizon AS horizon_hours, occurred, round(risk, 6) AS stockout_risk FROM risks")
def _(spark, sf):
    return rounded(risks(spark, sf))


@query("rk1_hazard_pr_auc", ctes=HAZARD, sql="""SELECT horizon AS horizon_hours, any_value(hours) AS hours, round(any_value(base), 6) AS base_rate, round(sum(pos / total * cum_pos / cum_n), 6) AS pr_auc,
sum(pos / total * cum_pos / cum_n) > any_value(base) AS above_base FROM (
SELECT horizon, pos, sum(pos) OVER t AS total, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n, CAST(sum(n) OVER t AS BIGINT) AS hours, sum(pos) OVER t / sum(n) OVER t AS base
FROM (SELECT horizon, round(risk, 6) AS p, count(*)::DOUBLE AS n, sum(occurred)::DOUBLE AS pos FROM risks GROUP BY ALL)
WINDOW w AS (PARTITION BY horizon ORDER BY p DESC), t AS (PARTITION BY horizon)) GROUP BY horizon""")
def _(spark, sf):
    """How well the risk ranks the hours of each horizon, beside the share of hours with a stockout."""
    rows = materialize(rounded(risks(spark, sf)), "risks")
    parts = []
    for h in horizon.RISK_HORIZONS:
        own = rows.where(F.col("horizon_hours") == h)
        base = own.agg(F.count("*").alias("hours"), F.avg("occurred").alias("base_rate"))
        parts.append(base.join(F.broadcast(kpi.kpi_pr_auc(own, "occurred", "stockout_risk"))).select(F.lit(h).alias("horizon_hours"), "*"))  # one row each
    return rounded(union_by_name(parts).withColumn("above_base", F.col("pr_auc") > F.col("base_rate")))
