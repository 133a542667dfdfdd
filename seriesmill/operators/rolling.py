"""Rolling mean, std, min and max over the rows before the current one, with constant work per row in wide windows.

Spark aggregates a moving frame anew for every row, which costs the window's length each time. A window of WIDE
rows or more is put together from two running aggregates instead: a series is cut into runs as long as the window,
so that a window is the end of one run and the beginning of the next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import named
from .layout import SeriesRows

WIDE = 64
_PLACE = "__place"

Step = Callable[[WindowSpec], dict[str, Column]]


def direct(w: WindowSpec, keyed: Column, target: str, window: int, agg: str, min_periods: int | None = None) -> Column:
    """``agg`` over the ``window`` rows before the current one, NULL under ``min_periods`` values."""
    frame = w.rowsBetween(-window, -1)
    fn = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}[agg]
    need = window if min_periods is None else min_periods
    return F.when(keyed & (F.count(named(target)).over(frame) >= need), fn(named(target)).over(frame))


class Rolling:
    """Rolling columns of one target. ``steps`` come before a step that uses ``column``; ``helpers`` are dropped after.

    Both ends of a window hold exactly its own rows, so nothing is subtracted and an infinite value leaves with its
    row. Standard deviations come from centred sums. Decimals keep the direct way, whose result stays a decimal.
    """

    def __init__(self, rows: SeriesRows, target: str, windows: Sequence[int], aggs: Sequence[str]):
        self.rows, self.target, self.aggs = rows, target, set(aggs)
        exact = isinstance(rows.rows.schema[target].dataType, T.DecimalType)
        self.wide = [] if exact or not aggs else sorted({n for n in windows if n >= WIDE})

    @property
    def steps(self) -> list[Step]:
        return [self._places, self._runs, self._ends] if self.wide else []

    @property
    def helpers(self) -> list[str]:
        ends = [name.format(n) for n in self.wide for name in ("__begun_{}", "__left_{}", "__begin_{}", "__end_{}")]
        return [_PLACE, *ends] if self.wide else []

    def column(self, w: WindowSpec, window: int, agg: str, min_periods: int | None = None) -> Column:
        need = window if min_periods is None else min_periods
        if need > window:
            raise ValueError(f"min_periods {need} must be <= window {window}")
        if window not in self.wide:
            return direct(w, self.rows.has_key, self.target, window, agg, min_periods)
        ends = [F.col(f"__end_{window}"), F.col(f"__begin_{window}")]
        n = self._total(ends, "n")
        value = {
            "mean": lambda: F.try_divide(self._total(ends, "sum"), n),
            "std": lambda: F.when(n > 1, F.sqrt(self._spread(ends) / (n - 1))),
            "min": lambda: F.least(*[e["min"] for e in ends]),
            "max": lambda: F.greatest(*[e["max"] for e in ends]),
        }[agg]()
        return F.when(self.rows.has_key & (n >= need), value)

    def _places(self, w: WindowSpec) -> dict[str, Column]:
        return {_PLACE: F.row_number().over(w) - 1}

    def _runs(self, w: WindowSpec) -> dict[str, Column]:
        """At every row: the rows of its run up to it, and from it on (running aggregates in both directions)."""
        out = {}
        for n in self.wide:
            run = Window.partitionBy(*map(named, self.rows.partition_keys()), F.expr(f"{_PLACE} div {n}"))
            out[f"__begun_{n}"] = self._running(run.orderBy(F.col(_PLACE)))
            out[f"__left_{n}"] = self._running(run.orderBy(F.col(_PLACE).desc()))
        return out

    def _running(self, ordered: WindowSpec) -> Column:
        frame = ordered.rowsBetween(Window.unboundedPreceding, 0)
        value = named(self.target)
        parts = {"n": F.count(value)}
        if self.aggs & {"mean", "std"}:
            parts["sum"] = F.sum(value.cast("double"))
        if "std" in self.aggs:
            parts["var"] = F.var_pop(value.cast("double"))
        parts |= {a: fn(value) for a, fn in (("min", F.min), ("max", F.max)) if a in self.aggs}
        return F.struct(*[c.over(frame).alias(name) for name, c in parts.items()])

    def _ends(self, w: WindowSpec) -> dict[str, Column]:
        """The window's two parts; where it is one whole run, or begins with the series, there is only the later one."""
        out = {}
        for n in self.wide:
            out[f"__begin_{n}"] = F.lag(f"__begun_{n}", 1).over(w)
            out[f"__end_{n}"] = F.when(F.col(_PLACE) % n != 0, F.lag(f"__left_{n}", n).over(w))
        return out

    def _total(self, ends: Sequence[Column], part: str) -> Column:
        a, b = [F.coalesce(e[part], F.lit(0)) for e in ends]
        return a + b

    def _spread(self, ends: Sequence[Column]) -> Column:
        """Sum of squares about the mean of both parts together."""
        a, b = ends
        apart = a["sum"] / F.nullif(a["n"], F.lit(0)) - b["sum"] / F.nullif(b["n"], F.lit(0))
        between = apart * apart * (a["n"] * b["n"] / F.nullif(a["n"] + b["n"], F.lit(0)))
        within = [F.coalesce(e["var"] * e["n"], F.lit(0.0)) for e in ends]
        return within[0] + within[1] + F.coalesce(between, F.lit(0.0))
