"""Standard normal density, distribution and quantile as Column expressions.

Distribution: West (2005), "Better approximations to cumulative normal functions".
Quantile: Wichura (1988), algorithm AS 241. Both are published rational
approximations; the coefficients below are fixed values from the papers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

CDF_NUM = (
    0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
CDF_DEN = (
    0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)
PPF_MID_NUM = (
    2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
    13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608,
)
PPF_MID_DEN = (
    5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
    5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0,
)
PPF_NEAR_NUM = (
    7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
    3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734,
)
PPF_NEAR_DEN = (
    1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
    0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0,
)
PPF_FAR_NUM = (
    2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
    0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772,
)
PPF_FAR_DEN = (
    2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
    0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0,
)


def horner(coeffs, x: Column) -> Column:
    """Polynomial with the leading coefficient first."""
    total = F.lit(float(coeffs[0]))
    for c in coeffs[1:]:
        total = total * x + F.lit(float(c))
    return total


def norm_pdf(x: Column) -> Column:
    return F.exp(x * x * F.lit(-0.5)) * F.lit(1.0 / math.sqrt(2.0 * math.pi))


def norm_cdf(x: Column) -> Column:
    a = F.abs(x)
    e = F.exp(a * a * F.lit(-0.5))
    inner = e * horner(CDF_NUM, a) / horner(CDF_DEN, a)
    tail = a + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        tail = a + F.lit(k) / tail
    outer = e / tail / F.lit(2.506628274631)
    upper = F.when(a > 37.0, F.lit(0.0)).when(a < 7.07106781186547, inner).otherwise(outer)
    return F.when(x > 0, F.lit(1.0) - upper).otherwise(upper)


def norm_ppf(p: Column) -> Column:
    q = p - F.lit(0.5)
    mid_r = F.lit(0.180625) - q * q
    mid = q * horner(PPF_MID_NUM, mid_r) / horner(PPF_MID_DEN, mid_r)
    r = F.sqrt(-F.ln(F.least(p, F.lit(1.0) - p)))
    near_r, far_r = r - F.lit(1.6), r - F.lit(5.0)
    near = horner(PPF_NEAR_NUM, near_r) / horner(PPF_NEAR_DEN, near_r)
    far = horner(PPF_FAR_NUM, far_r) / horner(PPF_FAR_DEN, far_r)
    side = F.when(r <= 5.0, near).otherwise(far)
    return F.when(F.abs(q) <= 0.425, mid).when(q < 0, -side).otherwise(side)
