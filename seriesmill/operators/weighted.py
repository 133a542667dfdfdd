"""Rolling mean and standard deviation with window weights (symmetric closed forms)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import named


def _cosine_sum(*terms: float) -> Callable[[int], list[float]]:
    def weights(n: int) -> list[float]:
        return [
            sum((-1) ** k * a * math.cos(2 * math.pi * k * i / (n - 1)) for k, a in enumerate(terms)) for i in range(n)
        ]

    return weights


def _triang(n: int) -> list[float]:
    span = n + 1 if n % 2 else n
    return [1 - abs(2 * i - (n - 1)) / span for i in range(n)]


def _bartlett(n: int) -> list[float]:
    return [1 - abs(2 * i / (n - 1) - 1) for i in range(n)]


def _cosine(n: int) -> list[float]:
    return [math.sin(math.pi * (i + 0.5) / n) for i in range(n)]


def _bohman(n: int) -> list[float]:
    x = [abs(2 * i / (n - 1) - 1) for i in range(n)]
    return [(1 - v) * math.cos(math.pi * v) + math.sin(math.pi * v) / math.pi for v in x]


def _barthann(n: int) -> list[float]:
    x = [abs(i / (n - 1) - 0.5) for i in range(n)]
    return [0.62 - 0.48 * v + 0.38 * math.cos(2 * math.pi * v) for v in x]


def _parzen(n: int) -> list[float]:
    x = [abs(2 * i - (n - 1)) / n for i in range(n)]
    return [2 * (1 - v) ** 3 if v > 0.5 else 1 - 6 * v**2 + 6 * v**3 for v in x]


def _tukey(n: int, alpha: float = 0.5) -> list[float]:
    """Flat in the middle, half a cosine over the share ``alpha`` at the ends."""
    side = alpha * (n - 1) / 2
    return [0.5 * (1 - math.cos(math.pi * d / side)) if d < side else 1.0 for i in range(n) for d in [min(i, n - 1 - i)]]


def _exponential(n: int, tau: float = 1.0) -> list[float]:
    return [math.exp(-abs(i - (n - 1) / 2) / tau) for i in range(n)]


def _lanczos(n: int) -> list[float]:
    return [math.sin(math.pi * x) / (math.pi * x) if x else 1.0 for i in range(n) for x in [2 * i / (n - 1) - 1]]


# The published coefficients of the cosine-sum windows.
COSINE_SUMS: dict[str, tuple[float, ...]] = {
    "boxcar": (1.0,),
    "hamming": (0.54, 0.46),
    "hann": (0.5, 0.5),
    "blackman": (0.42, 0.5, 0.08),
    "blackmanharris": (0.35875, 0.48829, 0.14128, 0.01168),
    "nuttall": (0.3635819, 0.4891775, 0.1365995, 0.0106411),
    "flattop": (0.21557895, 0.41663158, 0.277263158, 0.083578947, 0.006947368),
}

WINDOWS: dict[str, Callable[[int], list[float]]] = {
    **{name: _cosine_sum(*terms) for name, terms in COSINE_SUMS.items()},
    "triang": _triang,
    "bartlett": _bartlett,
    "cosine": _cosine,
    "bohman": _bohman,
    "barthann": _barthann,
    "parzen": _parzen,
    "tukey": _tukey,
    "exponential": _exponential,
    "lanczos": _lanczos,
}


def rolling_weights(win_type: str, n: int) -> list[float]:
    """Weights from the oldest to the newest of ``n`` rows."""
    if win_type not in WINDOWS:
        raise ValueError(f"win_type {win_type!r} is not one of {', '.join(WINDOWS)}")
    return [1.0] if n == 1 else WINDOWS[win_type](n)


def _add(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def _terms(w: WindowSpec, target: str, weights: Sequence[float]) -> list[tuple[Column, Column]]:
    """(value, weight) of the rows before the current one; a missing value weighs nothing."""
    n = len(weights)
    values = [F.lag(named(target), k).over(w).cast("double") for k in range(n, 0, -1)]
    return [
        (F.coalesce(v, F.lit(0.0)), F.when(v.isNotNull(), F.lit(float(q))).otherwise(0.0))
        for v, q in zip(values, weights)
    ]


def enough_values(w: WindowSpec, target: str, window: int, min_periods: int | None) -> Column:
    return F.count(named(target)).over(w.rowsBetween(-window, -1)) >= (window if min_periods is None else min_periods)


def weighted_mean(w: WindowSpec, target: str, weights: Sequence[float]) -> Column:
    terms = _terms(w, target, weights)
    return F.try_divide(_add([v * q for v, q in terms]), _add([q for _, q in terms]))


def weighted_std(w: WindowSpec, target: str, weights: Sequence[float], mean: str) -> Column:
    """Root of sum(q*(v-mean)^2)/sum(q) * n/(n-1), n being the window length; ``mean`` is a column.

    A weight belongs to a place in the window, as for the mean. (pandas' kernel for the weighted std ties
    weights to absolute row numbers instead, so that they rotate; only ``boxcar`` agrees with it.)
    """
    n = len(weights)
    terms = _terms(w, target, weights)
    spread = F.try_divide(
        _add([q * (v - named(mean)) * (v - named(mean)) for v, q in terms]), _add([q for _, q in terms])
    )
    return F.when(enough_values(w, target, n, 2), F.sqrt(spread * (n / max(n - 1, 1))))
