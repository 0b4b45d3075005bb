"""Number expressions and the p-values of the two drift tests."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """A double ratio; null when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """A double ratio; 0 when the denominator is 0."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def rounded_count(prediction: Column) -> Column:
    """Round half to even, then clip at 0."""
    return F.greatest(F.bround(prediction.cast("double"), 0), F.lit(0.0))


def ks_p_value(statistic: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic p-value of the two-sample Kolmogorov-Smirnov statistic: the first 100
    terms of the alternating series, which is 1 to double precision below 0.2."""
    x = statistic * F.sqrt(n1.cast("double") * n2 / (n1.cast("double") + n2))

    def term(total: Column, k: Column) -> Column:
        return total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), term)
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def _log_series(first: Column, step, n: Column) -> Column:
    """Sum of ``n`` terms given by the log of the first and the log ratio ``step(k)``."""
    start = F.struct(first.alias("log"), F.exp(first).alias("sum"))

    def add(acc: Column, k: Column) -> Column:
        log = acc["log"] + step(k)
        return F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum"))

    total = F.aggregate(F.sequence(F.lit(1), n - 1), start, add, lambda acc: acc["sum"])
    return F.when(n < 1, 0.0).when(n == 1, F.exp(first)).otherwise(total)


def _erfc(z: Column) -> Column:
    """Complementary error function: a series below 3, a continued fraction from there on."""
    size = F.abs(z)
    start = F.struct(size.alias("term"), size.alias("sum"))

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * (2.0 * size * size) / (2.0 * k + 1.0)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    near = F.least(size, F.lit(3.0))  # terms of the branch not taken stay finite
    series = F.aggregate(F.sequence(F.lit(1), F.lit(80)), start, add, lambda acc: acc["sum"])
    erf = 2.0 / math.sqrt(math.pi) * F.exp(-near * near) * series
    fraction = F.aggregate(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), size, lambda acc, k: size + k / 2.0 / acc)
    far = F.exp(-size * size) / (math.sqrt(math.pi) * fraction)
    tail = F.when(size < 3.0, 1.0 - erf).otherwise(far)
    return F.when(z < 0, 2.0 - tail).otherwise(tail)


# Coefficients of the uniform expansion near the mean, by powers of eta.
_NEAR_MEAN = (
    (-1 / 3, 1 / 12, -2 / 135, 1 / 864, 1 / 2835, -139 / 777600, 1 / 25515),
    (-1 / 540, -1 / 288, 1 / 378, -77 / 77760, 1 / 4860),
)


def _large_gamma_tail(a: Column, x: Column) -> Column:
    """Upper regularised incomplete gamma Q(a, x) for large ``a`` by Temme's uniform expansion: a fixed number of
    operations at any ``a``; the terms left out are below 1e-9 from a = 100 on."""
    mu = x / a - 1.0
    series = mu * mu * (0.5 - mu * (1 / 3 - mu * (0.25 - mu * (0.2 - mu * (1 / 6 - mu / 7)))))
    half_square = F.when(F.abs(mu) < 0.01, series).otherwise(mu - F.log1p(mu))
    eta = F.signum(mu) * F.sqrt(2.0 * half_square)

    def polynomial(coefficients) -> Column:
        total = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            total = total * eta + c
        return total

    near = F.abs(mu) < 0.05
    c0 = F.when(near, polynomial(_NEAR_MEAN[0])).otherwise(1.0 / mu - 1.0 / eta)
    far1 = 1.0 / (eta * eta * eta) - 1.0 / (mu * mu * mu) - 1.0 / (mu * mu) - 1.0 / (12.0 * mu)
    c1 = F.when(near, polynomial(_NEAR_MEAN[1])).otherwise(far1)
    rest = F.exp(-a * half_square) / F.sqrt(2.0 * math.pi * a) * (c0 + c1 / a)
    return 0.5 * _erfc(eta * F.sqrt(a / 2.0)) + rest


SMALL_DF = 200


def chi2_p_value(statistic: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution for whole ``df``, in a bounded number of terms.

    Up to ``SMALL_DF`` its closed form: a sum of df/2 terms, plus the complementary error function
    when df is odd; terms are kept as logs, so large statistics do not underflow to a wrong 1.
    Beyond, the uniform expansion of the incomplete gamma function.
    """
    x = statistic / 2.0
    log_x = F.ln(x)
    half = F.least(F.floor(df / 2), F.lit(SMALL_DF // 2)).cast("int")
    even = _log_series(-x, lambda k: log_x - F.ln(k.cast("double")), half)
    log_root = 0.5 * log_x - F.lit(math.lgamma(1.5)) - x
    odd = _log_series(log_root, lambda k: log_x - F.ln(k + 0.5), half)
    # erf by its series of positive terms; beyond 40 the complement is below 1e-18.
    log_erf = 0.5 * log_x - x + F.lit(math.log(2.0 / math.sqrt(math.pi)))
    erf = _log_series(log_erf, lambda k: log_x - F.ln(k + 0.5), F.lit(200))
    erfc = F.when(x > 40.0, 0.0).otherwise(F.greatest(1.0 - erf, F.lit(0.0)))
    small = F.when(df % 2 == 0, even).otherwise(erfc + odd)
    tail = F.when(df > SMALL_DF, _large_gamma_tail(df / 2.0, x)).otherwise(small)
    inside = F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0))
    return F.when((df <= 0) | (statistic <= 0), 1.0).otherwise(inside)
