"""Tail probabilities and quantiles of the Student t and F distributions.

Driver-side scalar math for the handful of model coefficients; based on
the regularised incomplete beta function evaluated by a continued
fraction (modified Lentz), as in standard numerical texts.
"""

from __future__ import annotations

import math

_EPS = 1e-16
_TINY = 1e-300


def _beta_cf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 100_000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_cf(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_cf(b, a, 1.0 - x) / b


# Beyond this many degrees of freedom t and F/d1 are their normal and
# chi-squared limits to well under 1e-9, and the beta route loses digits.
LARGE_DF = 1e7


def gammaincc(s: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(s, x)."""
    if x <= 0.0:
        return 1.0
    log_front = -x + s * math.log(x) - math.lgamma(s)
    if x < s + 1.0:
        term = total = 1.0 / s
        ap = s
        for _ in range(100_000):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * _EPS:
                break
        return 1.0 - total * math.exp(log_front)
    b = x + 1.0 - s
    c, d = 1.0 / _TINY, 1.0 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(log_front) * h


def t_two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student t with ``df`` degrees of freedom."""
    if math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    if df > LARGE_DF:
        return math.erfc(abs(t) / math.sqrt(2.0))
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """The ``p`` quantile of Student t (``p`` in (0, 1))."""
    if df <= 0:
        return float("nan")
    if p == 0.5:
        return 0.0
    upper = p > 0.5
    tail = 2.0 * (1.0 - p if upper else p)  # two-sided probability at the answer
    lo, hi = 0.0, 1.0
    while t_two_sided_p(hi, df) > tail:
        hi *= 2.0
        if hi > 1e300:
            break
    for _ in range(300):
        mid = 0.5 * (lo + hi)
        if mid in (lo, hi):
            break
        if t_two_sided_p(mid, df) > tail:
            lo = mid
        else:
            hi = mid
    q = 0.5 * (lo + hi)
    return q if upper else -q


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F >= f) for the F distribution with (d1, d2) degrees of freedom."""
    if math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    if d2 > LARGE_DF:
        return gammaincc(d1 / 2.0, d1 * f / 2.0)
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf_2df(x: float) -> float:
    """P(X >= x) for chi-squared with 2 degrees of freedom."""
    return math.exp(-x / 2.0) if x > 0 else 1.0


def skewness_z(skew: float, n: int) -> float:
    """D'Agostino's normal approximation for the sample skewness (n >= 8)."""
    y = skew * math.sqrt((n + 1.0) * (n + 3.0) / (6.0 * (n - 2.0)))
    beta2 = 3.0 * (n * n + 27.0 * n - 70.0) * (n + 1.0) * (n + 3.0) / ((n - 2.0) * (n + 5.0) * (n + 7.0) * (n + 9.0))
    w2 = -1.0 + math.sqrt(2.0 * (beta2 - 1.0))
    delta = 1.0 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2.0 / (w2 - 1.0))
    y = 1.0 if y == 0 else y
    return delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1.0))


def kurtosis_z(kurt: float, n: int) -> float:
    """Anscombe and Glynn's normal approximation for the sample kurtosis (non-excess, n >= 20)."""
    mean = 3.0 * (n - 1.0) / (n + 1.0)
    var = 24.0 * n * (n - 2.0) * (n - 3.0) / ((n + 1.0) ** 2 * (n + 3.0) * (n + 5.0))
    x = (kurt - mean) / math.sqrt(var)
    sqrt_beta1 = 6.0 * (n * n - 5.0 * n + 2.0) / ((n + 7.0) * (n + 9.0)) * math.sqrt(
        6.0 * (n + 3.0) * (n + 5.0) / (n * (n - 2.0) * (n - 3.0))
    )
    a = 6.0 + 8.0 / sqrt_beta1 * (2.0 / sqrt_beta1 + math.sqrt(1.0 + 4.0 / sqrt_beta1**2))
    term1 = 1.0 - 2.0 / (9.0 * a)
    denom = 1.0 + x * math.sqrt(2.0 / (a - 4.0))
    if denom == 0:
        return float("nan")
    term2 = math.copysign(abs((1.0 - 2.0 / a) / denom) ** (1.0 / 3.0), denom)
    return (term1 - term2) / math.sqrt(2.0 / (9.0 * a))


def omnibus(skew: float, kurt: float, n: int) -> tuple[float, float]:
    """D'Agostino-Pearson K^2 normality statistic and its chi-squared(2) tail probability."""
    if n < 20 or math.isnan(skew) or math.isnan(kurt):
        return float("nan"), float("nan")
    k2 = skewness_z(skew, n) ** 2 + kurtosis_z(kurt, n) ** 2
    return k2, chi2_sf_2df(k2)
