"""Tail probabilities for test statistics, on rows that are already aggregated.

Each UDF sees one row per test, never the data behind it. Tails are computed directly
(never as one minus a distribution function), so small p-values keep their digits.
"""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

TINY = 1e-300
EPS = 1e-16


def continued_fraction(term, start: float) -> float:
    """start + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method; term(i) -> (a, b)."""
    value = start or TINY
    c, d = value, 0.0
    for i in range(1, 1_000_000):
        a, b = term(i)
        d = 1.0 / ((b + a * d) or TINY)
        c = (b + a / c) or TINY
        value *= c * d
        if abs(c * d - 1.0) < EPS:
            break
    return value


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * EPS:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - scale * total)
    return scale / continued_fraction(lambda i: (-i * (i - a), x + 2 * i + 1 - a), x + 1 - a)


def beta_lower(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_lower(b, a, 1.0 - x)

    def term(i):
        m = i // 2
        if i == 1:
            return 1.0, 1.0
        i -= 1
        m = i // 2
        if i % 2 == 0:
            return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
        return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0

    front = a * math.log(x) + b * math.log1p(-x)
    front += math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    return math.exp(front) / a * continued_fraction(term, 0.0)


def chi2_sf(x: float, dof: float) -> float:
    return gamma_upper(dof / 2.0, x / 2.0)


def t_two_sided(t: float, dof: float) -> float:
    return beta_lower(dof / 2.0, 0.5, dof / (dof + t * t))


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


_PERIODIC: dict[int, tuple[int, list[int]]] = {}


def _periodic(m: int) -> tuple[int, list[int]]:
    """(period, coefficients) with 1/((1-q)(1-q)(1-q^2)...(1-q^m)) = coefficients(q) / (1-q^period)^(m+1)."""
    if m not in _PERIODIC:
        period, coef = math.lcm(*range(1, m + 1)), [1]
        for part in (1, *range(1, m + 1)):
            coef += [0] * period
            for k in range(len(coef) - 1, period - 1, -1):
                coef[k] -= coef[k - period]
            for k in range(part, len(coef)):
                coef[k] += coef[k - part]
            del coef[len(coef) - part:]
        _PERIODIC[m] = period, coef
    return _PERIODIC[m]


def _sums_up_to(m: int, k: int) -> int:
    """Number of ways to write the numbers up to k as sums of 1, 2, ..., m, order aside."""
    period, coef = _periodic(m)
    if k < 0:
        return 0
    return sum(coef[j] * math.comb((k - j) // period + m, m) for j in range(k % period, min(len(coef), k + 1), period))


def rank_count_tail(m: int, n: int, u: int) -> float:
    """P(U >= u) for the Mann-Whitney U of two untied samples, exactly, for any larger sample.

    The counts of U are the coefficients of the product of (1 - q^(n+i)) / (1 - q^i) over
    i = 1..m, m being the smaller size. The numerator has 2^m terms; the cumulative sums
    of the rest repeat with a period but for a polynomial, so no table grows with n.
    """
    m, n = min(m, n), max(m, n)
    signs = {0: 1}
    for i in range(1, m + 1):
        more = dict(signs)
        for power, sign in signs.items():
            more[power + n + i] = more.get(power + n + i, 0) - sign
        signs = more
    # U and m * n - U have the same distribution.
    low = sum(sign * _sums_up_to(m, m * n - max(u, 0) - power) for power, sign in signs.items())
    return low / math.comb(m + n, m)


def _poly(coefficients: list[float], x: float) -> float:
    total = 0.0
    for c in reversed(coefficients):
        total = total * x + c
    return total


# Polynomials (constant term first) of Royston, Applied Statistics 44 (1995), R94.
WEIGHT_LAST = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
WEIGHT_NEXT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SMALL_GAMMA = [-2.273, 0.459]
SMALL_MEAN = [0.5440, -0.39978, 0.025054, -0.0006714]
SMALL_SPREAD = [1.3822, -0.77857, 0.062767, -0.0020322]
LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
LARGE_SPREAD = [-0.4803, -0.082676, 0.0030302]
#: Size up to which the large-sample polynomials were fitted; beyond it they go on along their tangents.
FITTED_SIZE = 5_000


def _tangent(coefficients: list[float], size: float) -> float:
    """A polynomial of log n, continued along its tangent beyond the fitted sizes."""
    edge = math.log(FITTED_SIZE)
    slope = sum(i * c * edge ** (i - 1) for i, c in enumerate(coefficients) if i)
    return _poly(coefficients, min(size, edge)) + slope * max(size - edge, 0.0)


def shapiro_w(n: float, low: float, second: float, following: float, high: float, s: float, square: float, spread: float) -> float:
    """W of a sample from sums over its rows.

    ``s`` sums normal score times deviation, ``square`` the squared scores, ``spread`` the
    squared deviations; ``second`` and ``following`` are the values next to the ends.
    """
    if low == high:
        return 1.0
    if n == 3:
        total = (high - low) * math.sqrt(0.5)
    else:
        inverse = NormalDist().inv_cdf
        u, last, nxt = 1.0 / math.sqrt(n), inverse((n - 0.375) / (n + 0.25)), 0.0
        a_last, a_next = _poly(WEIGHT_LAST, u) + last / math.sqrt(square), 0.0
        if n > 5:
            nxt = inverse((n - 1.375) / (n + 0.25))
            a_next = _poly(WEIGHT_NEXT, u) + nxt / math.sqrt(square)
        phi = (square - 2 * last * last - 2 * nxt * nxt) / (1 - 2 * a_last * a_last - 2 * a_next * a_next)
        ends, inner_ends = high - low, following - second
        inner = (s - last * ends - nxt * inner_ends) / math.sqrt(phi)
        total = a_last * ends + a_next * inner_ends + inner
    return min(1.0, total * total / spread)


def shapiro_p(n: float, w: float) -> float:
    """P-value of W for n values."""
    if w >= 1.0:
        return 1.0
    if n == 3:
        return min(1.0, max(0.0, 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))))
    score = math.log1p(-w)
    if n <= 11:
        gamma = _poly(SMALL_GAMMA, n)
        if score >= gamma:
            return 0.0
        return normal_upper((-math.log(gamma - score) - _poly(SMALL_MEAN, n)) / math.exp(_poly(SMALL_SPREAD, n)))
    size = math.log(n)
    return normal_upper((score - _tangent(LARGE_MEAN, size)) / math.exp(_tangent(LARGE_SPREAD, size)))


def _rows(kernel, *columns: pd.Series) -> pd.Series:
    return pd.Series(
        [None if any(pd.isna(v) for v in row) else kernel(*row) for row in zip(*columns)],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def chi2_p(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return _rows(chi2_sf, statistic, dof)


@F.pandas_udf(T.DoubleType())
def t_p(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return _rows(t_two_sided, statistic, dof)


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _rows(normal_two_sided, z)


@F.pandas_udf(T.StructType([T.StructField("w", T.DoubleType()), T.StructField("p_value", T.DoubleType())]))
def shapiro_w_p(
    n: pd.Series, low: pd.Series, second: pd.Series, following: pd.Series, high: pd.Series, s: pd.Series,
    square: pd.Series, spread: pd.Series,
) -> pd.DataFrame:
    """W and its p-value of each group; none for fewer than 3 values."""
    ws = [shapiro_w(*row) if row[0] >= 3 else None for row in zip(n, low, second, following, high, s, square, spread)]
    ps = [None if w is None else shapiro_p(k, w) for k, w in zip(n, ws)]
    return pd.DataFrame({"w": pd.Series(ws, dtype="float64"), "p_value": pd.Series(ps, dtype="float64")})


@F.pandas_udf(T.DoubleType())
def mann_whitney_exact_p(m: pd.Series, n: pd.Series, u: pd.Series) -> pd.Series:
    return _rows(
        lambda a, b, x: min(1.0, 2.0 * rank_count_tail(int(a), int(b), math.ceil(x))), m, n, u
    )


# Workers then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
