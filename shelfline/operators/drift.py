"""Distribution drift between two frames, all features in one job.

Both frames become (feature, value) rows and are counted per distinct value in one
aggregate. Quantile edges, bins and distribution functions all start from those counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.ranks import exact_quantiles, melt, running_totals, text_ranks, value_counts_by
from shelfline.session import materialize

# Bins, edge widening, floor of a share, thresholds.
BINS = 10
EDGE = 1e-5
FLOOR = 1e-4
WARN, CRITICAL, P_LIMIT = 0.10, 0.20, 0.01


def counted_values(base: DataFrame, cur: DataFrame, numeric=(), categorical=()) -> DataFrame:
    """(feature, value, nb, nc): how often each value occurs in the baseline and the current frame.

    NULL and NaN are left out. Categories get the rank of their text in the
    dictionary of both frames together, so codes mean the same on both sides.
    """
    parts = []
    if numeric:
        both = melt(base, numeric).withColumn("cur", F.lit(0)).unionByName(melt(cur, numeric).withColumn("cur", F.lit(1)))
        parts.append(value_counts_by(both.filter(~F.isnan("value")), ["feature"], "value", nb=F.count_if(F.col("cur") == 0), nc=F.count_if(F.col("cur") == 1)))
    if categorical:
        def texts(df, flag):
            pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in categorical])
            return df.select(F.inline(pairs)).withColumn("cur", F.lit(flag))

        counts = value_counts_by(texts(base, 0).unionByName(texts(cur, 1)), ["feature"], "value", nb=F.count_if(F.col("cur") == 0), nc=F.count_if(F.col("cur") == 1))
        codes = text_ranks(counts, ["feature"], "value").select("feature", F.col("rank").cast("double").alias("value"), "nb", "nc")
        parts.append(materialize(codes, "codes"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def psi(counted: DataFrame, bins: int = BINS) -> DataFrame:
    """Population stability index per feature.

    Bins follow the baseline quantiles; both end edges are widened, a value on an
    interior edge belongs to the upper bin, values outside count in the total only.
    A feature without any baseline value has no edges and PSI 0.
    """
    probs = [i / bins for i in range(bins + 1)]
    edges = exact_quantiles(counted.filter("nb > 0"), ["feature"], "value", probs, count="nb")
    v, e = F.col("value"), F.col("quantiles")
    low, high = F.get(e, F.lit(0)) - EDGE, F.get(e, F.lit(bins)) + EDGE
    # one comparison per inner edge stays in generated code
    index = sum((v >= F.get(e, F.lit(i))).cast("int") for i in range(1, bins))
    # one row of edges per feature: bounded by the number of columns
    binned = counted.join(F.broadcast(edges), "feature", "left").withColumn(
        "bin", F.when((v >= low) & (v <= high), index))
    per_bin = binned.groupBy("feature", "bin").agg(F.sum("nb").alias("nb"), F.sum("nc").alias("nc"))
    totals = per_bin.groupBy("feature").agg(F.sum("nb").alias("tb"), F.sum("nc").alias("tc"))

    def share(n, total):
        s = F.col(n) / F.nullif(F.col(total), F.lit(0))
        return F.when(s == 0, FLOOR).otherwise(s)

    b, c = share("nb", "tb"), share("nc", "tc")
    term = F.when(F.col("bin").isNotNull(), (c - b) * F.ln(c / b))
    return per_bin.join(F.broadcast(totals), "feature").groupBy("feature").agg(
        F.round(F.coalesce(F.sum(term), F.lit(0.0)), 4).alias("psi"))


def ks2(counted: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per feature, with both sample sizes."""
    run = running_totals(counted, ["feature"], "value", ["nb", "nc"])
    gap = F.abs(F.col("cum_nb") / F.col("total_nb") - F.col("cum_nc") / F.col("total_nc"))
    return run.filter("total_nb > 0 AND total_nc > 0").groupBy("feature").agg(
        F.max(gap).alias("ks"), F.max("total_nb").alias("n_base"), F.max("total_nc").alias("n_cur"))


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value: the alternating Kolmogorov series.

    Below 0.2 the limit distribution is 1 to more than ten digits and the series
    would need many terms, so that part is set to 1.
    """
    n, m = n.cast("double"), m.cast("double")
    lam2 = d * d * (n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(lam2 * k * k * -2.0))
    return F.when(lam2 < 0.04, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


#: samples up to this size each get the exact p-value
EXACT = 1000


def exceedance(d: float, n: int, m: int) -> float:
    """Probability that two samples of one distribution differ by ``d`` or more: exact, by counting lattice paths.

    Each order of the n + m values is a path of steps right (first sample) and up (second), all equally likely. The
    share of paths at each point of a diagonal follows from the diagonal before; what steps out of the band
    |i / n - j / m| < d is taken out and added up. Shares never overflow, and a small probability keeps its digits.

    Only the band is kept: some 2 d n m / (n + m) points of each of the n + m diagonals, so 2 d n m steps in all.
    """
    edge = round(d * n * m)
    if edge <= 0:
        return 1.0
    if m < n:  # the band is the same from both sides
        n, m = m, n
    low, share, out = 0, np.ones(1), 0.0
    for k in range(1, n + m + 1):
        # points i of this diagonal that are next to those of the one before: its first to one past its last
        i = np.arange(max(low, k - m), min(low + len(share), n, k) + 1)
        if not len(i):
            break
        left = n + m - k + 1
        # the share below a point (j one less) and the one beside it (i one less), none beyond the ends
        padded = np.concatenate(([0.0], share, [0.0]))
        at = i - low + 1
        step = (padded[at] * (m - (k - i) + 1) + padded[at - 1] * (n - i + 1)) / left
        gap = i * (n + m) - k * n  # i * m - j * n without products that grow with the diagonal
        inside = np.abs(gap) < edge
        out += float(step[~inside].sum())
        kept = np.flatnonzero(inside)
        if not len(kept):
            break
        # a band is one run of points
        low, share = int(i[kept[0]]), step[kept[0]:kept[-1] + 1]
    return min(1.0, out)


def ks_pvalue_by_size(ks: DataFrame, exact: int | None = EXACT) -> DataFrame:
    """``p_value`` beside the rows of ``ks2``: exact where both samples have at most ``exact`` values (None: always), else the asymptotic series.

    There is one row for each feature, so the exact part is a small function on few rows. Its steps grow with the
    statistic times the product of the sample sizes, and its memory with the smaller sample.
    """
    asymptotic = ks_pvalue(F.col("ks"), F.col("n_base"), F.col("n_cur"))

    @F.pandas_udf("double")
    def small(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([exceedance(x, int(a), int(b)) if exact is None or max(a, b) <= exact else None for x, a, b in zip(d, n, m)], dtype="float64")

    return ks.withColumn("p_value", F.coalesce(small("ks", "n_base", "n_cur"), asymptotic))


def drift_status(df: DataFrame) -> DataFrame:
    critical = (F.col("psi") >= CRITICAL) | (F.col("p_value") < P_LIMIT)
    return df.withColumn(
        "drift_status", F.when(critical, "CRITICAL_DRIFT").when(F.col("psi") >= WARN, "MODERATE_DRIFT").otherwise("NO_DRIFT")
    ).withColumn("retrain_recommended", F.coalesce(critical, F.lit(False)))


def dataset_drift(base: DataFrame, cur: DataFrame, numeric=(), categorical=()) -> DataFrame:
    """One row per feature with KS statistic, p-value, PSI, status and retrain flag.

    A feature that is wholly NULL on one side has nothing to compare: KS and PSI 0, p-value 1.
    """
    counted = counted_values(base, cur, numeric, categorical)
    ks = ks2(counted).withColumn("p_value", F.round(ks_pvalue(F.col("ks"), F.col("n_base"), F.col("n_cur")), 4))
    features = base.sparkSession.createDataFrame([(c,) for c in [*numeric, *categorical]], "feature string")
    value = lambda c, default: F.coalesce(F.col(c), F.lit(default)).alias(c)
    joined = features.join(ks, "feature", "left").join(psi(counted), "feature", "left").select(
        "feature", F.coalesce(F.round("ks", 4), F.lit(0.0)).alias("ks"), value("p_value", 1.0), value("psi", 0.0))
    return drift_status(joined)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "short", "double", "float")]
