"""Clipping, banding and the fixed tier rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of the tiers, the alert threshold, the urgency bounds.
TIER_CUTS = (0.25, 0.50, 0.75)
TIER_LABELS = ("low", "medium", "high", "critical")
ALERT_CUT = 0.50
URGENT_CUT = 0.70
ELEVATED_CUT = 0.40


def clip(x: Column, lo, hi) -> Column:
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))


def band(x: Column, cuts, labels) -> Column:
    """Label of the interval that holds ``x``; a cut belongs to the upper interval."""
    expr = F.when(x < cuts[0], labels[0])
    for cut, name in zip(cuts[1:], labels[1:]):
        expr = expr.when(x < cut, name)
    return expr.when(x.isNotNull(), labels[-1])


def risk_tier(p: Column, cuts=TIER_CUTS) -> Column:
    return band(p, cuts, TIER_LABELS)


def is_alert(p: Column, cut: float = ALERT_CUT) -> Column:
    return p >= cut


def urgency(p: Column) -> Column:
    return band(p, (ELEVATED_CUT, URGENT_CUT), ("routine", "elevated", "urgent"))


def discount_depth(multiplier: Column) -> Column:
    """A multiplier of 0.9 means 10 % off."""
    return F.lit(1.0) - multiplier


def safe_ratio(num: Column, den: Column, scale: float = 1.0, empty=None) -> Column:
    """``scale * num / den``, with ``empty`` where the denominator is zero or NULL."""
    return F.coalesce(F.lit(scale) * num / F.nullif(den, F.lit(0).cast("double")), F.lit(empty).cast("double"))


def pinball(actual: Column, forecast: Column, q: float) -> Column:
    miss = actual - forecast
    return F.when(miss >= 0, F.lit(q) * miss).otherwise(F.lit(q - 1.0) * miss)
