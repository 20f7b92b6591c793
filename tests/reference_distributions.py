"""Reference (plain Python) tail probabilities of Student's t and
chi-square, used by the tests to check the Column expressions in
``shopscope/functions/distributions.py``.

  two-sided t:   p = I_x(df/2, 1/2), x = df / (df + t^2)
  chi-square:    p = Q(k/2, x/2)     (regularised upper incomplete gamma)

I_x is evaluated with the continued fraction of the incomplete beta
(modified Lentz), Q with its series / continued fraction.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = 1e-16
_TINY = 1e-300
_ITER = 500


def _iterations(a: float, b: float) -> int:
    """The continued fractions need O(sqrt(max(a, b))) terms near their
    switch point (large degrees of freedom, |t| around 1.7): scale the
    budget with it instead of a fixed cap."""
    return _ITER + int(20.0 * math.sqrt(max(a, b, 1.0)))


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = _TINY if abs(d) < _TINY else d
    d = 1.0 / d
    h = d
    for m in range(1, _iterations(a, b) + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def _lgamma_diff(a: float, b: float) -> float:
    """lgamma(a + b) - lgamma(a) without cancellation for large a (Stirling
    series with the leading terms subtracted analytically)."""
    if a < 1e3:
        return math.lgamma(a + b) - math.lgamma(a)
    s = a + b
    return ((a - 0.5) * math.log1p(b / a) + b * math.log(s) - b
            + (1.0 / (12.0 * s) - 1.0 / (12.0 * a))
            - (1.0 / (360.0 * s ** 3) - 1.0 / (360.0 * a ** 3)))


def reg_inc_beta(a: float, b: float, x: float, y: float | None = None) -> float:
    """I_x(a, b); ``y`` = 1 - x when the caller knows it exactly (keeps the
    logarithms accurate when x is within 1e-10 of 1)."""
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    log_x = math.log1p(-y) if y < 0.5 else math.log(x)
    log_y = math.log1p(-x) if x < 0.5 else math.log(y)
    big, small = (a, b) if a >= b else (b, a)
    lbt = _lgamma_diff(big, small) - math.lgamma(small) + a * log_x + b * log_y
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, y) / b


def t_two_sided_p(t: float, df: float) -> float:
    if t is None or df is None or not np.isfinite(t) or df <= 0:
        return float("nan")
    t2 = t * t
    return reg_inc_beta(df / 2.0, 0.5, df / (df + t2), t2 / (df + t2))


def reg_upper_gamma(a: float, x: float) -> float:
    if x <= 0.0:
        return 1.0
    if x < a + 1.0:  # series for P, then Q = 1 - P
        ap, s, delta = a, 1.0 / a, 1.0 / a
        for _ in range(_iterations(a, x) * 4):
            ap += 1.0
            delta *= x / ap
            s += delta
            if abs(delta) < abs(s) * _EPS:
                break
        return 1.0 - s * math.exp(-x + a * math.log(x) - math.lgamma(a))
    b = x + 1.0 - a
    c, d = 1.0 / _TINY, 1.0 / b
    h = d
    for i in range(1, _iterations(a, x) * 4):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, k: float) -> float:
    if x is None or k is None or k <= 0 or not np.isfinite(x):
        return float("nan")
    return reg_upper_gamma(k / 2.0, x / 2.0)
