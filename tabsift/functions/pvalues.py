"""Tail probabilities of the chi-square and F distributions.

Spark has no incomplete gamma or beta function. These run as pandas UDFs over
tables with one row per feature, never over data rows. Series, continued
fractions and symmetry relations are the textbook ones (Abramowitz and Stegun,
6.5 and 26.5).
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# The functions travel inside the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_EPS = 1e-16


def _lentz(b0: float, terms) -> float:
    """Value of the continued fraction b0 + a1/(b1 + a2/(b2 + ...))."""
    value = b0 or _TINY
    c, d = value, 0.0
    for a, b in terms:
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        step = c * d
        value *= step
        if abs(step - 1.0) < _EPS:
            break
    return value


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while term > total * _EPS:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    limit = 1000 + int(20 * math.sqrt(a))
    tail = _lentz(x + 1.0 - a, ((-i * (i - a), x + 2 * i + 1.0 - a) for i in range(1, limit)))
    return min(1.0, front / tail)


def _beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_inc(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )

    def terms():
        for m in range(20000 + int(10 * math.sqrt(max(a, b)))):
            if m:
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0

    return min(1.0, front / (a * _lentz(1.0, terms())))


def chi2_tail(x: float, dof: float) -> float:
    return _gamma_upper(dof / 2.0, x / 2.0)


def f_tail(x: float, d1: float, d2: float) -> float:
    return 1.0 if x <= 0 else _beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * x))


def _present(*values) -> bool:
    return all(v is not None and v == v for v in values)


@F.pandas_udf(T.DoubleType())
def _chi2_sf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(
        [chi2_tail(s, k) if _present(s, k) and k > 0 else None for s, k in zip(x, dof)],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def _f_sf(x: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(
        [
            f_tail(s, a, b) if _present(s, a, b) and a > 0 and b > 0 else None
            for s, a, b in zip(x, d1, d2)
        ],
        dtype="float64",
    )


def chi2_sf(x: Column, dof: Column) -> Column:
    """P(X > x) for a chi-square variable; NULL in, NULL out."""
    return F.nanvl(_chi2_sf(x.cast("double"), dof.cast("double")), F.lit(None).cast("double"))


def f_sf(x: Column, d1: Column, d2: Column) -> Column:
    """P(X > x) for an F variable; NULL in, NULL out."""
    return F.nanvl(
        _f_sf(x.cast("double"), d1.cast("double"), d2.cast("double")),
        F.lit(None).cast("double"),
    )
