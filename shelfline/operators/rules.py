"""Data-contract rules.

A row rule is one boolean Column that is true for a violation; all row rules of a
contract are counted in one aggregate pass. A group rule is a predicate on the
aggregate of a key. ``validate`` returns one row per rule, ``violating_rows`` the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.functions import scores
from shelfline.functions.arrays import as_array


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str = "error"
    violated: Callable[[DataFrame], Column] | None = None
    keys: tuple = field(default=())
    group_bad: Callable[[Column], Column] | None = None
    max_rate: float = 0.0


def _row(name, severity, fn, max_rate=0.0):
    return Rule(name, severity, lambda df: F.coalesce(fn(df), F.lit(False)), max_rate=max_rate)


def not_null(*cols, max_rate=0.0, severity="error") -> list[Rule]:
    return [_row(f"not_null:{c}", severity, lambda df, c=c: F.col(c).isNull(), max_rate) for c in cols]


def unique_key(*cols, severity="error") -> Rule:
    return Rule("unique_key:" + ",".join(cols), severity, keys=cols, group_bad=lambda n: n > 1)


def parseable_date(col, fmt="yyyy-MM-dd", severity="error") -> Rule:
    return _row(f"parseable_date:{col}", severity,
                lambda df: F.col(col).isNotNull() & F.expr(f"try_to_date({col}, '{fmt}')").isNull())


def non_negative(*cols, severity="error") -> Rule:
    return _row("non_negative:" + ",".join(cols), severity,
                lambda df: reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in cols]))


def array_length(col, n=24, elem="double", severity="error") -> Rule:
    """Text that does not parse to an array of the element type is a violation too."""
    def bad(df):
        arr = as_array(df, col, elem)
        return F.coalesce((F.size(arr) != n) | F.exists(arr, lambda x: x.isNull()), F.lit(True))
    return _row(f"array_length:{col}", severity, bad)


def array_range(col, lo=None, hi=None, severity="error") -> Rule:
    def out(x):
        low = F.lit(False) if lo is None else x < lo
        return low if hi is None else low | (x > hi)
    return _row(f"array_range:{col}", severity, lambda df: F.exists(as_array(df, col), out))


def array_values(col, allowed, elem="int", severity="error") -> Rule:
    return _row(f"array_values:{col}", severity,
                lambda df: ~F.forall(as_array(df, col, elem), lambda x: x.isin(*allowed)))


def value_range(col, lo, hi, severity="error") -> Rule:
    return _row(f"value_range:{col}", severity, lambda df: ~F.col(col).between(lo, hi))


def accepted(col, allowed, severity="error") -> Rule:
    return _row(f"accepted:{col}", severity, lambda df: ~F.col(col).isin(*allowed))


def timestamp_match(dt, hour, ts, severity="error") -> Rule:
    return _row(f"timestamp_match:{ts}", severity,
                lambda df: F.col(ts).cast("timestamp_ntz") != cal.event_ts(F.col(dt), F.col(hour)))


def group_count(keys, n, severity="warning") -> Rule:
    return Rule("group_count:" + ",".join(keys), severity, keys=tuple(keys), group_bad=lambda c: c != n)


def max_per_group(keys, n, severity="warning") -> Rule:
    return Rule("max_per_group:" + ",".join(keys), severity, keys=tuple(keys), group_bad=lambda c: c > n)


def quantile_order(cols, severity="error") -> Rule:
    return _row("quantile_order", severity,
                lambda df: ~reduce(lambda a, b: a & b, [F.col(x) <= F.col(y) for x, y in zip(cols, cols[1:])]))


def interval_width(lo, hi, mid, k=10.0, severity="warning") -> Rule:
    return _row("interval_width", severity, lambda df: (F.col(mid) > 0) & (F.col(hi) - F.col(lo) > F.col(mid) * k))


def fresh(col, max_hours, now: Column, severity="warning") -> Rule:
    return _row(f"fresh:{col}", severity,
                lambda df: F.col(col).cast("timestamp_ntz") < now - F.make_dt_interval(F.lit(0), F.lit(max_hours)))


def tier_match(p, tier, cuts=scores.TIER_CUTS, severity="error") -> Rule:
    return _row("tier_match", severity, lambda df: scores.risk_tier(F.col(p), cuts) != F.col(tier))


def alert_match(p, flag, cut=scores.ALERT_CUT, severity="error") -> Rule:
    return _row("alert_match", severity, lambda df: scores.is_alert(F.col(p), cut) != F.col(flag))


def conditional(name, when: Callable[[], Column], check: Callable[[], Column], severity="error") -> Rule:
    """Where ``when`` holds, ``check`` must hold; an unknown check counts as not held."""
    return _row(f"conditional:{name}", severity, lambda df: when() & ~F.coalesce(check(), F.lit(False)))


def urgency_match(p, urgency, severity="warning") -> Rule:
    return _row("urgency_match", severity, lambda df:
                ((F.col(urgency) == "urgent") & (F.col(p) < scores.URGENT_CUT))
                | ((F.col(urgency) == "routine") & (F.col(p) >= scores.ELEVATED_CUT)))


def implies(name, a: Callable[[], Column], b: Callable[[], Column], severity="warning") -> Rule:
    return _row(f"implies:{name}", severity, lambda df: a() & ~b())


def validate(df: DataFrame, rules) -> DataFrame:
    """(rule, severity, violations, checked, passed): row rules share a single scan."""
    row_rules = [r for r in rules if r.violated]
    parts = []
    if row_rules:
        counts = df.agg(
            F.count("*").alias("n"),
            F.array(*[F.count_if(r.violated(df)) for r in row_rules]).alias("v"),
        )
        entries = F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                     F.get("v", F.lit(i)).alias("violations"), F.col("n").alias("checked"),
                     F.lit(r.max_rate).alias("max_rate"))
            for i, r in enumerate(row_rules)
        ])
        parts.append(counts.select(F.inline(entries)))
    for r in rules:
        if r.group_bad:
            parts.append(
                df.groupBy(*r.keys).agg(F.count("*").alias("n"))
                .agg(F.count_if(r.group_bad(F.col("n"))).alias("violations"), F.count("*").alias("checked"))
                .select(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                        "violations", "checked", F.lit(r.max_rate).alias("max_rate"))
            )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("violations") <= F.col("max_rate") * F.col("checked")).drop("max_rate")


def violating_rows(df: DataFrame, rule: Rule) -> DataFrame:
    if rule.violated:
        return df.filter(rule.violated(df))
    bad = df.groupBy(*rule.keys).agg(F.count("*").alias("_n")).filter(rule.group_bad(F.col("_n"))).drop("_n")
    return df.join(bad, list(rule.keys), "left_semi")


def schema_match(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Expected columns with a present flag, then the unexpected ones; names only."""
    rows = [(c, "expected", c in df.columns) for c in expected]
    rows += [(c, "unexpected", True) for c in df.columns if c not in expected and not c.startswith("_")]
    return df.sparkSession.createDataFrame(rows, "column_name string, kind string, present boolean")


def schema_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """The columns of ``schema_match`` with the number of rows in which they are filled; NULL for a missing column."""
    names = [(c, "expected") for c in expected] + [(c, "unexpected") for c in df.columns if c not in expected and not c.startswith("_")]
    counted = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c, _ in names if c in df.columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"), F.lit(c in df.columns).alias("present"),
                     (F.col(c) if c in df.columns else F.lit(None).cast("bigint")).alias("filled")) for c, kind in names]
    return counted.select(F.inline(F.array(*rows)))


def coverage(actual: DataFrame, expected: DataFrame, keys, by=()) -> DataFrame:
    """Expected keys, the missing among them and the missing rate."""
    marked = expected.join(actual.select(*keys).distinct().withColumn("_hit", F.lit(1)), list(keys), "left")
    return marked.groupBy(*by).agg(
        F.count("*").alias("expected_keys"), F.count_if(F.col("_hit").isNull()).alias("missing_keys")
    ).withColumn("missing_rate", F.col("missing_keys") / F.col("expected_keys"))


COMPARE = {"<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, ">": lambda a, b: a > b}


def gate(metrics: DataFrame, thresholds) -> DataFrame:
    """Join (metric, value) rows with literal thresholds (metric, op, limit)."""
    limits = metrics.sparkSession.createDataFrame(list(thresholds), "metric string, op string, threshold double")
    verdict = F.lit(None).cast("boolean")
    for op, test in COMPARE.items():
        verdict = F.when(F.col("op") == op, test(F.col("value"), F.col("threshold"))).otherwise(verdict)
    return metrics.join(F.broadcast(limits), "metric").withColumn(
        "status", F.when(verdict, "PASS").otherwise("FAIL")
    )


def sla(stats: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """Columns of a one-row statistics frame against limits, one row per limit."""
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in limits])
    return gate(stats.select(F.inline(entries)), [(m, op, float(v)) for m, (op, v) in limits.items()])


# Quality thresholds.
QUALITY_GATES = (
    ("rejection_rate", "<=", 0.001), ("null_rate_critical", "<=", 0.0), ("null_rate_optional", "<=", 0.05),
    ("freshness_hours", "<=", 4.0), ("wape", "<=", 0.30), ("hourly_wape", "<=", 0.45), ("bias_abs", "<=", 0.05),
    ("p90_coverage_min", ">=", 0.85), ("p90_coverage_max", "<=", 0.95), ("fva", ">", 0.0), ("pr_auc", ">=", 0.35),
    ("precision_at_threshold", ">=", 0.55), ("recall_at_threshold", ">=", 0.40), ("rec_coverage", ">=", 0.95),
    ("false_alarm_rate", "<=", 0.40),
)
WEATHER = ("Clear", "Clouds", "Rain", "Snow", "Drizzle", "Mist", "Fog", "Haze", "Thunderstorm", "Smoke", "Dust", "Squall")
HORIZONS = (1, 2, 4, 8, 12, 24, 48, 168)
ACTIONS = ("replenish", "markdown", "monitor", "escalate")
URGENCIES = ("routine", "elevated", "urgent")
REASONS = ("stockout_high_risk", "stockout_moderate_risk", "approaching_expiry", "excess_inventory",
           "demand_spike_predicted", "chronic_stockout")


def daily_contract() -> list[Rule]:
    key = ("store_id", "product_id", "dt")
    return [
        *not_null("city_id", *key, "sale_amount", "hours_sale", "hours_stock_status", "avg_temperature",
                  "avg_humidity", "avg_wind_level"),
        unique_key(*key),
        parseable_date("dt"),
        non_negative("sale_amount"),
        array_length("hours_sale"),
        array_length("hours_stock_status", elem="int"),
        array_range("hours_sale", 0.0),
        array_values("hours_stock_status", (0, 1)),
        value_range("discount", 0.0, 1.0),
        value_range("city_id", 1, 18, "warning"),
        value_range("store_id", 1, 898, "warning"),
        value_range("product_id", 1, 865, "warning"),
        value_range("avg_temperature", -50.0, 60.0, "warning"),
        value_range("avg_humidity", 0.0, 100.0, "warning"),
    ]


def hourly_contract() -> list[Rule]:
    key = ("store_id", "product_id", "event_date", "hour_of_day")
    return [
        unique_key(*key),
        value_range("hour_of_day", 6, 21),
        non_negative("observed_sales"),
        value_range("discount", 0.0, 1.0),
        value_range("iso_dow0", 0, 6),
        value_range("hour_sin", -1.0, 1.0),
        value_range("hour_cos", -1.0, 1.0),
        timestamp_match("event_date", "hour_of_day", "event_timestamp"),
        group_count(key[:3], 16),
    ]
