"""Complex arithmetic on pairs of DOUBLE columns, and null-safe numerics.

A complex value is a ``(re, im)`` tuple of columns, so it stays inside code generation.
Spark's NaN compares greater than every number and is not null: ``clean`` turns it into
null, which the aggregates then skip.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Complex = tuple[Column, Column]


def col(re: str = "re", im: str = "im") -> Complex:
    return F.col(re), F.col(im)


def clean(x: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(x), x)


def mul(a: Complex, b: Complex) -> Complex:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def conj(a: Complex) -> Complex:
    return a[0], -a[1]


def abs2(a: Complex) -> Column:
    return a[0] * a[0] + a[1] * a[1]


def amplitude(a: Complex) -> Column:
    return F.sqrt(abs2(a))


def phase_deg(a: Complex) -> Column:
    return F.degrees(F.atan2(a[1], a[0]))


def reciprocal(a: Complex) -> Complex:
    """1/a; null where a is zero, NaN or null."""
    d = abs2(a)
    ok = ~F.isnan(d) & (d > 0)
    return F.when(ok, a[0] / d), F.when(ok, -a[1] / d)


def div(a: Complex, b: Complex) -> Complex:
    return mul(a, reciprocal(b))


def scale(a: Complex, w: Column) -> Complex:
    return a[0] * w, a[1] * w


def phasor(turns: Column) -> Complex:
    """exp(2 pi i turns)."""
    angle = turns * (2 * math.pi)
    return F.cos(angle), F.sin(angle)


def delay_phasor(delay_s: Column, freq_hz: Column) -> Complex:
    return phasor(delay_s.cast("double") * freq_hz.cast("double"))


def safe_divide(a: Column, b: Column, default: float = 0.0) -> Column:
    """a / b, or ``default`` where b is zero, NaN or null."""
    return F.when(F.isnan(b) | (b == 0) | b.isNull(), F.lit(default)).otherwise(a / b)


def positive(x: Column) -> Column:
    """True only for numbers above zero (NaN and null are not)."""
    return F.coalesce(~F.isnan(x) & (x > 0), F.lit(False))


def power_law(coefficients: list[float], freq: Column) -> Column:
    """10 ** (a0 + a1 log10(freq) + a2 log10(freq)^2 ...)."""
    x, total = F.log10(freq), F.lit(0.0)
    for a in reversed(coefficients):
        total = total * x + F.lit(float(a))
    return F.pow(F.lit(10.0), total)


def polynomial_flux(s0: Column, coefficients: list[float], freq: Column, ref: float, log: bool) -> Column:
    """Component flux with an ordinary (in freq/ref - 1) or logarithmic polynomial."""
    x = F.log(freq / F.lit(ref)) if log else freq / F.lit(ref) - 1
    total = F.lit(0.0)
    for c in reversed(coefficients):
        total = (total + F.lit(float(c))) * x
    return s0 * F.exp(total) if log else s0 + total
