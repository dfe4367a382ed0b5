"""Tail probabilities, as Arrow-batched functions applied to result tables only."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        step = d * c
        h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return scale * h


def chi2_upper(x: float, dof: float) -> float:
    return upper_gamma(dof / 2.0, x / 2.0)


def binomial_two_sided(b: int, c: int) -> float:
    """Exact test that two discordant counts come from a fair coin."""
    n, low = b + c, min(b, c)
    if n == 0:
        return 1.0
    return min(1.0, 2.0 * sum(math.comb(n, i) for i in range(low + 1)) / 2.0**n)


def _map(fn, *series: pd.Series) -> pd.Series:
    out = [np.nan if any(pd.isna(v) for v in row) else fn(*row) for row in zip(*series)]
    return pd.Series(out, dtype="float64")


@pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p-value of a standard normal statistic."""
    return _map(normal_two_sided, z)


@pandas_udf(DoubleType())
def chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper-tail p-value of a chi-square statistic."""
    return _map(chi2_upper, x, dof)


@pandas_udf(DoubleType())
def mcnemar_p(b: pd.Series, c: pd.Series, statistic: pd.Series, exact: pd.Series) -> pd.Series:
    """Exact binomial p-value where ``exact`` holds, otherwise chi-square with one degree."""
    return _map(
        lambda n10, n01, stat, ex: binomial_two_sided(int(n10), int(n01)) if ex
        else chi2_upper(stat, 1.0),
        b, c, statistic, exact,
    )
