"""Tail probability of Student's t as a column expression.

With t = sqrt(df) * tan(a) the density turns into cos(a)^(df - 1), so the
two-sided tail is the share of that curve's area beyond atan(|t| / sqrt(df)).
The area is summed by Simpson's rule. For large df the curve vanishes long
before pi/2, so the upper end is pulled in to keep the points where it lives.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_PANELS = 2000
_REACH = 45.0


def _area(low: Column, high: Column, power: Column) -> Column:
    step = (high - low) / F.lit(float(_PANELS))

    def add(total: Column, i: Column) -> Column:
        weight = (
            F.when((i == 0) | (i == _PANELS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        )
        return total + weight * F.pow(F.cos(low + step * i), power)

    points = F.sequence(F.lit(0), F.lit(_PANELS))
    return F.aggregate(points, F.lit(0.0), add) * step / F.lit(3.0)


def two_sided_p(t: Column, df: Column) -> Column:
    high = F.least(F.lit(math.pi / 2), F.lit(_REACH) / F.sqrt(df))
    start = F.least(F.atan(F.abs(t) / F.sqrt(df)), high)
    power = df - F.lit(1.0)
    tail = _area(start, high, power) / _area(F.lit(0.0), high, power)
    return F.when(t.isNotNull() & df.isNotNull(), tail)


def greater_p(t: Column, df: Column) -> Column:
    half = two_sided_p(t, df) / F.lit(2.0)
    return F.when(t > 0, half).otherwise(F.lit(1.0) - half)


def _tail(t: float, df: int) -> float:
    """P(|T| > t) by Simpson's rule, as in two_sided_p."""
    start, end = math.atan(t / math.sqrt(df)), math.pi / 2

    def area(low: float) -> float:
        step = (end - low) / _PANELS
        return step / 3 * sum((1 if i in (0, _PANELS) else 4 if i % 2 else 2) * math.cos(low + step * i) ** (df - 1) for i in range(_PANELS + 1))

    return area(start) / area(0.0)


@cache
def _few(df: int) -> float:
    """97.5 % point of t for few degrees of freedom, by halving."""
    low, high = 1.9, 13.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _tail(middle, df) > 0.05 else (low, middle)
    return (low + high) / 2


def upper_critical(df: Column) -> Column:
    """97.5 % point of t: solved for up to 30 degrees of freedom, beyond by its series around the normal quantile."""
    z = 1.959963984540054  # fixed value: 97.5 % point of the standard normal
    terms = (
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
    )
    total = F.lit(z)
    for power, term in enumerate(terms, start=1):
        total = total + F.lit(term) / F.pow(df, F.lit(float(power)))
    points = F.array(*[F.lit(_few(k)) for k in range(1, 31)])
    return F.when(df.between(1, 30), F.try_element_at(points, F.floor(df).cast("int"))).otherwise(total)
