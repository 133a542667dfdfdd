"""Plain and seasonal differencing as fixed combinations of lags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def difference_polynomial(d: int, seasonal_d: int, season: int) -> list[int]:
    """Coefficients, by lag, of (1 - B)^d (1 - B^season)^seasonal_d."""
    poly = [1]
    for lag in [1] * d + [season] * seasonal_d:
        shifted = [0] * lag + poly
        poly = [a - b for a, b in zip(poly + [0] * lag, shifted)]
    return poly


def differenced(w: WindowSpec, value: str, poly: list[int]) -> Column:
    """NULL where the series does not reach back far enough or a value is missing."""
    terms = [
        (F.col(value) if k == 0 else F.lag(value, k).over(w)).cast("double") * F.lit(float(c))
        for k, c in enumerate(poly)
        if c
    ]
    return reduce(lambda a, b: a + b, terms)
