"""Rolling mean and standard deviation under cosine-sum weights, with constant work per row in wide windows.

A weight of such a window is a sum of a few cosines of the place in the window, and cos(t(q - s)) = cos(tq) cos(ts) +
sin(tq) sin(ts) parts the place q of a row from the start s of a window. So a window's weighted sum follows from a few sums of
values times the cosine and sine of their own place. These are running sums over runs as long as the window, as in
``rolling``: a window is the end of one run and the beginning of the next, and nothing is subtracted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import named
from .layout import SeriesRows
from .rolling import WIDE, Step
from .weighted import COSINE_SUMS, rolling_weights

_PLACE = "__wave_place"


class WeightedRolling:
    """Weighted columns of one target for the windows in ``wide``, where every row of a window must hold a value.

    Other weights, short windows and windows that may lack values go the direct way: a missing value takes its weight
    out of the divisor, and a divisor near zero cannot be told from zero in a sum of cosines. Values are taken from the
    mean of their run, so that a spread is not lost beside a high level. A window with an infinite value has the plain
    sum of its values (infinite, or NaN) as its mean and NaN as its standard deviation.
    """

    def __init__(self, rows: SeriesRows, target: str, windows: Sequence[int], win_type: str | None, aggs: Sequence[str], min_periods: int | None):
        self.rows, self.value, self.win_type, self.std = rows, named(target).cast("double"), win_type, "std" in aggs
        self.terms = COSINE_SUMS.get(win_type, ()) if aggs else ()
        full = [n for n in windows if n >= WIDE and min_periods in (None, n)]
        self.wide = sorted(set(full)) if self.terms else []

    @property
    def steps(self) -> list[Step]:
        return [self._places, self._levels, self._runs, self._ends] if self.wide else []

    @property
    def helpers(self) -> list[str]:
        names = ("__wave_level_{}", "__wave_begun_{}", "__wave_left_{}", "__wave_begin_{}", "__wave_end_{}")
        return [_PLACE, *[name.format(n) for n in self.wide for name in names]] if self.wide else []

    def full(self, window: int) -> Column:
        ends = [F.coalesce(e["n"], F.lit(0)) for e in self._parts(window)]
        return ends[0] + ends[1] == window

    def mean(self, window: int) -> Column:
        total = F.lit(0.0)
        for part in self._parts(window):
            total += F.coalesce(self._moment(part, 1, window) + part["level"] * self._moment(part, 0, window), F.lit(0.0))
        return F.when(self.full(window), F.coalesce(self._odd(window), total / sum(rolling_weights(self.win_type, window))))

    def deviation(self, window: int, mean: str) -> Column:
        """Root of the weighted mean square about ``mean``, times n / (n - 1)."""
        weights = rolling_weights(self.win_type, window)
        spread = F.lit(0.0)
        for part in self._parts(window):
            off = part["level"] - named(mean)
            squares = self._moment(part, 2, window) + 2 * off * self._moment(part, 1, window) + off * off * self._moment(part, 0, window)
            spread += F.coalesce(squares, F.lit(0.0))
        spread = spread / sum(weights) * (window / (window - 1))
        if min(weights) > -1e-9:
            spread = F.greatest(spread, F.lit(0.0))
        nan = F.when(self._odd(window).isNotNull(), F.lit(float("nan")))
        return F.when(self.full(window), F.coalesce(nan, F.sqrt(spread)))

    def _parts(self, window: int) -> list[Column]:
        return [F.col(f"__wave_end_{window}"), F.col(f"__wave_begin_{window}")]

    def _odd(self, window: int) -> Column:
        """The sum of infinite values in the window, NULL without any."""
        a, b = [part["odd"] for part in self._parts(window)]
        return F.coalesce(a + b, a, b)

    def _angle(self, place: Column, wave: int, window: int) -> Column:
        """Weights repeat after window - 1 places, which keeps angles small however long the series is."""
        return F.pmod(place * wave, F.lit(window - 1)) * (2 * math.pi / (window - 1))

    def _moment(self, part: Column, power: int, window: int) -> Column:
        """Sum of weight * (value - level)^power over the rows of ``part``, for the window that ends before this row."""
        start = F.col(_PLACE) - window
        total = self.terms[0] * part[f"c{power}_0"]
        for k, term in list(enumerate(self.terms))[1:]:
            angle = self._angle(start, k, window)
            total += (-1) ** k * term * (F.cos(angle) * part[f"c{power}_{k}"] + F.sin(angle) * part[f"s{power}_{k}"])
        return total

    def _run(self, window: int) -> WindowSpec:
        return Window.partitionBy(*map(named, self.rows.partition_keys()), F.expr(f"{_PLACE} div {window}"))

    def _finite(self) -> Column:
        return F.when(F.abs(self.value) < float("inf"), self.value)

    def _places(self, w: WindowSpec) -> dict[str, Column]:
        return {_PLACE: (F.row_number().over(w) - 1).cast("long")}

    def _levels(self, _: WindowSpec) -> dict[str, Column]:
        return {f"__wave_level_{n}": F.coalesce(F.avg(self._finite()).over(self._run(n)), F.lit(0.0)) for n in self.wide}

    def _runs(self, _: WindowSpec) -> dict[str, Column]:
        out = {}
        for n in self.wide:
            run = self._run(n)
            out[f"__wave_begun_{n}"] = self._running(run.orderBy(F.col(_PLACE)), n)
            out[f"__wave_left_{n}"] = self._running(run.orderBy(F.col(_PLACE).desc()), n)
        return out

    def _running(self, ordered: WindowSpec, window: int) -> Column:
        frame = ordered.rowsBetween(Window.unboundedPreceding, 0)
        level = F.col(f"__wave_level_{window}")
        apart = F.coalesce(self._finite() - level, F.lit(0.0))
        odd = F.when(self._finite().isNull(), self.value)
        parts = {"n": F.count(self.value).over(frame), "odd": F.sum(odd).over(frame), "level": level}
        for power in range(3 if self.std else 2):
            scale = [F.lit(1.0), apart, apart * apart][power]
            for k in range(len(self.terms)):
                angle = self._angle(F.col(_PLACE), k, window)
                parts[f"c{power}_{k}"] = F.sum(scale * F.cos(angle) if k else scale).over(frame)
                if k:
                    parts[f"s{power}_{k}"] = F.sum(scale * F.sin(angle)).over(frame)
        return F.struct(*[c.alias(name) for name, c in parts.items()])

    def _ends(self, w: WindowSpec) -> dict[str, Column]:
        """The window's two parts; where it is one whole run, or begins with the series, there is only the later one."""
        out = {}
        for n in self.wide:
            out[f"__wave_begin_{n}"] = F.lag(f"__wave_begun_{n}", 1).over(w)
            out[f"__wave_end_{n}"] = F.when(F.col(_PLACE) % n != 0, F.lag(f"__wave_left_{n}", n).over(w))
        return out
