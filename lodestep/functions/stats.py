"""Normal and chi-square tails.

Neither is a Spark SQL function, so these are small vectorised helpers; the
operators call them on per-group results, never on raw rows.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


@F.pandas_udf(DoubleType())
def normal_cdf(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if v is None or v != v else 0.5 * math.erfc(-v / math.sqrt(2.0)))


@F.pandas_udf(DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if v is None or v != v else math.erfc(abs(v) / math.sqrt(2.0)))


def _upper_gamma_ratio(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: series below ``a + 1``, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = acc = 1.0 / a
        n = a
        while abs(term) > abs(acc) * 1e-16:
            n += 1
            term *= x / n
            acc += term
        return max(0.0, 1.0 - front * acc)
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        step = d * c
        h *= step
        if abs(step - 1) < 1e-16:
            break
    return front * h


@F.pandas_udf(DoubleType())
def chi_square_tail(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if s is None or s != s or not k or k != k else _upper_gamma_ratio(k / 2.0, s / 2.0)
            for s, k in zip(statistic, dof)
        ],
        dtype="float64",
    )


def _rising_sums(start: np.ndarray, count: np.ndarray, power: int) -> np.ndarray:
    """Sum of ``1 / (start + i) ** power`` for ``i`` in ``0 .. count - 1`` (power 1 or 2).

    Short sums are added up; long ones add the first 64 terms and take the
    Euler-Maclaurin expansion for the rest.
    """
    out = np.zeros_like(start)
    head = np.minimum(count, 64)
    for i in range(int(head.max(initial=0))):
        live = head > i
        out[live] += 1.0 / (start[live] + i) ** power
    rest = count > 64
    if rest.any():
        a = start[rest] + 64
        b = start[rest] + count[rest]
        if power == 1:
            out[rest] += (
                np.log(b / a) + 0.5 * (1 / a - 1 / b) + (1 / a**2 - 1 / b**2) / 12
                - (1 / a**4 - 1 / b**4) / 120
            )
        else:
            out[rest] += (
                (1 / a - 1 / b) + 0.5 * (1 / a**2 - 1 / b**2) + (1 / a**3 - 1 / b**3) / 6
                - (1 / a**5 - 1 / b**5) / 30
            )
    return out


def tie_sums(deaths: np.ndarray, risk: np.ndarray, tied_risk: np.ndarray):
    """Efron terms of one event time: sums of ``log u``, ``1/u`` and ``1/u^2`` with
    ``u_l = risk - l * tied_risk / deaths`` for ``l = 0 .. deaths - 1``.

    ``u_l = step * (k + i)`` with ``k + i`` rising, so each sum has constant cost
    however many events share the time.
    """
    deaths = np.asarray(deaths, dtype="float64")
    risk = np.asarray(risk, dtype="float64")
    tied_risk = np.asarray(tied_risk, dtype="float64")
    logs = np.zeros_like(risk)
    inv = np.zeros_like(risk)
    inv2 = np.zeros_like(risk)
    single = deaths == 1
    logs[single] = np.log(risk[single])
    inv[single] = 1 / risk[single]
    inv2[single] = 1 / risk[single] ** 2
    many = deaths > 1
    if many.any():
        step = tied_risk[many] / deaths[many]
        low = risk[many] / step - (deaths[many] - 1)
        n = deaths[many]
        lgamma = np.vectorize(math.lgamma, otypes=[float])
        logs[many] = n * np.log(step) + lgamma(low + n) - lgamma(low)
        inv[many] = _rising_sums(low, n, 1) / step
        inv2[many] = _rising_sums(low, n, 2) / step**2
    return logs, inv, inv2
