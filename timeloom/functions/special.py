"""Survival functions of the F and chi-square distributions, from the incomplete beta and gamma functions."""

from __future__ import annotations

import math

TINY, STEPS, CLOSE = 1e-300, 400, 1e-15


def _fraction(b0: float, terms) -> float:
    """A continued fraction b0 + a1/(b1 + a2/(b2 + …)) from pairs (a, b), by the modified Lentz method."""
    f = b0 or TINY
    c, d = f, 0.0
    for a, b in terms:
        d = b + a * d or TINY
        c = b + a / c or TINY
        d = 1 / d
        f *= c * d
        if abs(c * d - 1) < CLOSE:
            break
    return f


def beta_incomplete(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_incomplete(b, a, 1 - x)

    def terms():
        for j in range(1, STEPS):
            m = j // 2
            yield ((m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))) if j % 2 == 0 else (-(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))), 1.0

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front / a / _fraction(1.0, terms())


def f_survival(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    return 1.0 if f <= 0 else beta_incomplete(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def gamma_survival(a: float, x: float) -> float:
    """The regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        total = term = 1 / a
        n = a
        while abs(term) > abs(total) * CLOSE:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - front * total)
    return front / _fraction(x + 1 - a, ((-i * (i - a), x + 2 * i + 1 - a) for i in range(1, STEPS)))


def chi2_survival(x: float, k: float) -> float:
    """P(chi-square with k degrees of freedom > x)."""
    return gamma_survival(k / 2, x / 2)
