"""Numeric functions on columns, including p-value series."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def softmax(logits: Column) -> Column:
    """Softmax over an array, shifted by its maximum."""
    powers = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(powers, lambda x: x / total)


def ratio(top: Column, bottom: Column, default: float | None = 0.0) -> Column:
    """Quotient as double; ``default`` when the divisor is zero."""
    q = F.try_divide(top.cast("double"), bottom.cast("double"))
    return q if default is None else F.coalesce(q, F.lit(default))


def kolmogorov_tail(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided Kolmogorov-Smirnov p-value."""
    n, m = n.cast("double"), m.cast("double")
    lam2 = d * d * n * m / (n + m)
    steps = F.sequence(F.lit(1), F.lit(terms))
    series = F.aggregate(
        steps, F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam2))
    # The alternating series does not settle for tiny arguments, where the tail is 1.
    return F.when(lam2 < 0.04, F.lit(1.0)).otherwise(clip(2.0 * series, 0.0, 1.0))


def log_gamma_half(twice: Column) -> Column:
    """``ln Gamma(twice / 2)`` for a positive integer ``twice``."""
    twice = twice.cast("int")
    odd = twice % 2 == 1
    start = F.when(odd, F.lit(math.log(math.pi) / 2)).otherwise(F.lit(0.0))
    factors = F.when(odd, (twice - 1) / 2).otherwise(twice / 2 - 1).cast("int")
    shift = F.when(odd, F.lit(-0.5)).otherwise(F.lit(0.0))
    steps = F.when(factors > 0, F.sequence(F.lit(1), F.greatest(factors, F.lit(1))))
    total = F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.ln(i + shift))
    return start + F.coalesce(total, F.lit(0.0))


def chi_square_tail(statistic: Column, freedom: Column) -> Column:
    """Upper tail of the chi-square distribution through the incomplete-gamma series."""
    half, x = freedom.cast("double") / 2, statistic / 2
    far = x > half + 12.0 * F.sqrt(half + 1.0) + 330.0
    # Terms rise until half + n ~ x; nine deviations later the rest is below 1e-16 of the sum.
    near = F.when(far, F.lit(0.0)).otherwise(x)
    count = F.ceil(F.greatest(near - half, F.lit(0.0)) + 9 * F.sqrt(F.greatest(near, F.lit(0.0))) + 200)
    state = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc, n):
        term = acc["term"] * x / (half + n)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), count.cast("int")), state, step, lambda acc: acc["total"])
    log_head = half * F.ln(x) - x - (log_gamma_half(freedom) + F.ln(half))
    lower = F.exp(log_head + F.ln(total))
    return (F.when(statistic.isNull(), F.lit(None).cast("double"))
            .when(statistic <= 0, F.lit(1.0)).when(far, F.lit(0.0))
            .otherwise(clip(1.0 - lower, 0.0, 1.0)))


def normal_two_sided(z: Column) -> Column:
    """Two-sided normal p-value; ``z**2`` is chi-square with one degree of freedom."""
    return chi_square_tail(z * z, F.lit(1))
