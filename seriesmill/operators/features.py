"""Lag, rolling, difference, percent-change and exponentially weighted features of many series.

All frames are row frames: a lag of 1 is the previous row of the series, whatever its date. Rows with a
missing group key get NULL features. ``order_by`` must order a series completely.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import calendar, scalars
from ..functions.scalars import named
from ..session import materialize
from .layout import BLOCK_ROWS, SeriesRows, lay_out
from .rolling import Rolling
from .waves import WeightedRolling
from .weighted import enough_values, rolling_weights, weighted_mean, weighted_std

Step = Callable[[WindowSpec], dict[str, Column]]

_FILLED, _N = "__filled", "__n"
_DECAY_LIMIT = 100.0  # powers of ten a running weight may grow by before it starts again
_RUNS = 7  # 10^-700 of the largest double is 0


# --- column builders ------------------------------------------------------------------------------


def lag_columns(w: WindowSpec, keyed: Column, target: str, names: dict[str, int]) -> dict[str, Column]:
    return {name: F.when(keyed, F.lag(named(target), k).over(w)) for name, k in names.items()}


def diff_column(w: WindowSpec, keyed: Column, target: str, periods: int) -> Column:
    return F.when(keyed, named(target) - F.lag(named(target), periods).over(w))


def pct_change_column(w: WindowSpec, keyed: Column, filled: str, periods: int) -> Column:
    """Relative change of the forward-filled value."""
    return F.when(keyed, scalars.divide(named(filled), F.lag(named(filled), periods).over(w)) - 1)


# --- single operators -----------------------------------------------------------------------------


def _prepare(df: DataFrame, group_cols, order_by, layout) -> SeriesRows:
    return lay_out(scalars.nan_to_null(df), group_cols, order_by, layout)


def add_lag_features(
    df: DataFrame,
    target_col: str = "sales_amount",
    group_cols: Sequence[str] | None = None,
    lags: Sequence[int] = (1, 3, 6),
    order_by: Sequence[str] = ("yearmonth",),
    layout: str = "auto",
) -> DataFrame:
    rows = _prepare(df, group_cols, order_by, layout)
    names = {f"{target_col}_lag{k}": k for k in lags}
    return rows.with_columns(max(lags), lambda w: lag_columns(w, rows.has_key, target_col, names)).to_frame()


def add_rolling_features(
    df: DataFrame,
    target_col: str = "sales_amount",
    group_cols: Sequence[str] | None = None,
    windows: Sequence[int] = (3, 6, 12),
    order_by: Sequence[str] = ("yearmonth",),
    layout: str = "auto",
) -> DataFrame:
    rows = _prepare(df, group_cols, order_by, layout)
    rolled = Rolling(rows, target_col, windows, ("mean", "std"))

    def build(w: WindowSpec) -> dict[str, Column]:
        return {f"{target_col}_rolling_{agg}_{n}": rolled.column(w, n, agg) for n in windows for agg in ("mean", "std")}

    return rows.with_columns(max(windows), *rolled.steps, build).to_frame().drop(*rolled.helpers)


def _add(rows: SeriesRows, reach: int, target: str, *steps: Step) -> SeriesRows:
    """Add columns that use the forward-filled target: in one pass unless a value crosses blocks."""
    if rows.carries_locally(target):
        steps = (lambda w: {_FILLED: _last_known(w, target)}, *steps)
    else:
        rows = rows.with_last_known({target: _FILLED})
    rows = rows.with_columns(reach, *steps)
    return rows.on(rows.rows.drop(_FILLED))


def _last_known(w: WindowSpec, value: str) -> Column:
    return F.last(named(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def add_diff_features(
    df: DataFrame,
    target_col: str = "sales_amount",
    group_cols: Sequence[str] | None = None,
    periods: Sequence[int] = (1, 12),
    order_by: Sequence[str] = ("yearmonth",),
    layout: str = "auto",
) -> DataFrame:
    rows = _prepare(df, group_cols, order_by, layout)
    return _add(rows, max(periods), target_col, lambda w: _diff_block(w, rows.has_key, target_col, periods)).to_frame()


def _diff_block(w: WindowSpec, keyed: Column, target: str, periods: Sequence[int]) -> dict[str, Column]:
    out = {}
    for p in periods:
        out[f"{target}_diff_{p}"] = diff_column(w, keyed, target, p)
        out[f"{target}_pct_change_{p}"] = pct_change_column(w, keyed, _FILLED, p)
    return out


def prepare_features(
    df: DataFrame,
    value_col: str = "sales_amount",
    group_cols: Sequence[str] | None = None,
    lags: Sequence[int] = (1, 3, 6),
    rolling_windows: Sequence[int] = (3, 6, 12),
    diff_periods: Sequence[int] = (1, 12),
    date_col: str = "order_date",
    order_by: Sequence[str] | None = None,
    layout: str = "auto",
) -> DataFrame:
    """Calendar, lag, rolling and difference features in one pass over one window specification.

    Accepts the output of ``aggregate_sales`` with ``date_col="period"``.
    """
    dated = calendar.create_time_features(scalars.nan_to_null(df), date_col)
    rows = lay_out(dated, group_cols, order_by or (date_col,), layout)
    keyed = rows.has_key
    rolled = Rolling(rows, value_col, rolling_windows, ("mean", "std"))

    def build(w: WindowSpec) -> dict[str, Column]:
        out = lag_columns(w, keyed, value_col, {f"{value_col}_lag{k}": k for k in lags})
        for n in rolling_windows:
            for agg in ("mean", "std"):
                out[f"{value_col}_rolling_{agg}_{n}"] = rolled.column(w, n, agg)
        return out | _diff_block(w, keyed, value_col, diff_periods)

    reach = max([0, *lags, *rolling_windows, *diff_periods])
    return _add(rows, reach, value_col, *rolled.steps, build).to_frame().drop(*rolled.helpers)


# --- exponentially weighted mean ------------------------------------------------------------------


class _Means:
    """Exponentially weighted means of all values up to the row, for each (alpha, output name).

    Weights are (1-alpha)^age, a missing value is skipped. A row without a value repeats the mean of the last
    row that has one. The weighted sums are exact whatever the layout: nothing is dropped for being far back.
    """

    def __init__(self, rows: SeriesRows, target: str, outs: dict[float, str]):
        if not all(0 < alpha <= 1 for alpha in outs):
            raise ValueError(f"every alpha must be in (0, 1]: {list(outs)}")
        self.rows, self.target, self.outs = rows, target, outs
        self.names = [f"__ewm{i}" for i in range(len(outs))]
        self.at_value = {f"{n}_at_value": out for n, out in zip(self.names, outs.values())}

    def _sums(self, names: dict[str, str], keys: list[str], place: str, keeps: list[float]) -> list[Step]:
        found = [_Decay(out, value, keep, keys, place) for (out, value), keep in zip(names.items(), keeps)]
        return [getattr(d, stage) for stage in _STAGES for d in found]

    def _own(self) -> Column:
        value = named(self.target).cast("double")
        there = value.isNotNull()
        return F.struct(F.coalesce(value, F.lit(0.0)).alias("num"), there.cast("double").alias("den"))

    def _means(self, sums: dict[str, Column]) -> dict[str, Column]:
        there = named(self.target).isNotNull()
        return {out: F.when(there, F.try_divide(sums[n]["num"], sums[n]["den"])) for n, out in zip(self.names, self.at_value)}

    def then(self, reach: int, *steps: Step) -> SeriesRows:
        """Add the means and then ``steps``, which look ``reach`` rows back."""
        keeps = [1 - alpha for alpha in self.outs]
        rows = self.rows.with_position(_N)
        named = {n: _OWN_SUMS for n in self.names}
        own = lambda _: {_OWN_SUMS: self._own()}
        in_part = [own, *self._sums(named, rows.partition_keys(), _N, keeps)]
        helpers = [_N, _OWN_SUMS, *self.names, *[f"{n}_{part}" for n in self.names for part in ("run", "part", "before")]]
        if rows.block_rows is None:
            means = lambda _: self._means({n: F.col(n) for n in self.names})
            carry = lambda w: {out: _last_known(w, value) for value, out in self.at_value.items()}
            rows = rows.with_columns(reach, *in_part, means, carry, *steps)
        else:
            # Written once: the blocks' closing sums, the values to carry and the rows are all read from it.
            summed = rows.with_columns(0, *in_part)
            summed = summed.on(materialize(summed.rows.drop(*set(helpers) - set(self.names)), "sums"))
            rows = summed.with_carried(self.names, lambda names, keys, place: self._sums(names, keys, place, [k**rows.block_rows for k in keeps]))
            ages = {n: F.pow(F.lit(k), rows.since_block_start().cast("double")) if k else F.lit(0.0) for n, k in zip(self.names, keeps)}
            whole = {n: _plus(F.col(n), F.col(rows.carried(n)), ages[n]) for n in self.names}
            rows = rows.on(rows.rows.withColumns(self._means(whole)).drop(*rows.carry_columns(self.names)))
            rows = rows.with_last_known(self.at_value).with_columns(reach, *steps)
        return rows.on(rows.rows.drop(*helpers, *self.at_value, *self.outs.values()))


_OWN_SUMS = "__own_sums"
_STAGES = ("runs", "running", "before", "sums")


def _plus(sums: Column, earlier: Column, weight: Column) -> Column:
    """Sums (num, den), with earlier ones that have lost weight; there may be none earlier."""
    parts = [(sums[x] + F.coalesce(weight * earlier[x], F.lit(0.0))).alias(x) for x in ("num", "den")]
    return F.struct(*parts)


@dataclass(frozen=True)
class _Decay:
    """Decaying sums of a struct (num, den) along a series, in the order of ``_STAGES``.

    Sums are running sums of growing weights, restarted every ``run`` places so that these stay in range. A run adds
    the closing sums of the runs before it, each weighed down once more for every run between; after ``_RUNS`` runs any
    double has become 0.
    """

    name: str
    value: str
    keep: float  # what a weight keeps per place
    keys: list[str]
    place: str  # a number that grows by one from row to row

    def _part(self, part: str) -> str:
        return f"{self.name}_{part}"

    @property
    def run(self) -> int:
        return max(1, math.floor(_DECAY_LIMIT * math.log(10) / -math.log(self.keep))) if self.keep else 1

    @property
    def step(self) -> Column:
        return F.pmod(F.col(self.place), F.lit(self.run))

    def _power(self, exponent: Column) -> Column:
        return F.pow(F.lit(self.keep), exponent.cast("double"))

    def _window(self, *order: str) -> WindowSpec:
        return Window.partitionBy(*([named(k) for k in self.keys] or [F.lit(0)])).orderBy(*order)

    def runs(self, _: WindowSpec) -> dict[str, Column]:
        return {self._part("run"): F.floor(F.col(self.place) / self.run)}

    def running(self, _: WindowSpec) -> dict[str, Column]:
        keys = [*([named(k) for k in self.keys] or [F.lit(0)]), self._part("run")]
        w = Window.partitionBy(*keys).orderBy(self.place).rowsBetween(Window.unboundedPreceding, 0)
        if self.run == 1:
            return {self._part("part"): F.col(self.value)}
        grown, decayed = self._power(-self.step), self._power(self.step)
        return {self._part("part"): F.struct(*[(F.sum(F.col(self.value)[x] * grown).over(w) * decayed).alias(x) for x in ("num", "den")])}

    def before(self, _: WindowSpec) -> dict[str, Column]:
        """What the runs before have left at the end of the last one."""
        if not self.keep:
            return {self._part("before"): F.lit(None).cast("struct<num: double, den: double>")}
        at_end = F.when(self.step == self.run - 1, F.col(self._part("part")))
        w, shrink, total = self._window(self._part("run")), self.keep**self.run, None
        for k in range(_RUNS, 0, -1):
            closing = F.last(at_end, ignorenulls=True).over(w.rangeBetween(-k, -k))
            parts = {x: F.coalesce(closing[x], F.lit(0.0)) for x in ("num", "den")}
            total = {x: parts[x] if total is None else parts[x] + total[x] * shrink for x in parts}
        return {self._part("before"): F.struct(*[c.alias(x) for x, c in total.items()])}

    def sums(self, _: WindowSpec) -> dict[str, Column]:
        return {self.name: _plus(F.col(self._part("part")), F.col(self._part("before")), self._power(self.step + 1))}


# --- full feature set -----------------------------------------------------------------------------


def create_time_series_features(
    data: DataFrame,
    target: str,
    to_sort: str | Sequence[str] | None = None,
    to_group: str | Sequence[str] | None = None,
    lags: Sequence[int] | None = None,
    windows: Sequence[int] | None = None,
    weights: Sequence[float] | None = None,
    min_periods: int | None = None,
    win_type: str | None = None,
    date_related: bool = True,
    lag: bool = False,
    log_transformation: bool = False,
    roll: bool = False,
    ewm: bool = False,
    roll_mean: bool = False,
    roll_std: bool = False,
    roll_min: bool = False,
    roll_max: bool = False,
    date_col: str = "ds",
    layout: str = "auto",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Date parts of ``date_col``, then log1p of ``target`` in place, then lag, rolling and EWM columns.

    Output names start with ``sales_`` whatever the target is called. ``to_sort`` takes several columns
    and must order a series completely.
    """
    groups = [to_group] if isinstance(to_group, str) else list(to_group or [])
    order = [to_sort] if isinstance(to_sort, str) else list(to_sort or [date_col])
    lags, windows, weights = list(lags or []), list(windows or []), list(weights or [])

    df = scalars.nan_to_null(data)
    if date_related:
        df = calendar.ensure_datetime(df, date_col)
        df = df.withColumns(calendar.series_date_columns(date_col))
    if log_transformation:
        df = scalars.nan_to_null(df.withColumn(target, scalars.log1p(target)))
    aggs = [a for a, on in (("mean", roll_mean), ("std", roll_std), ("min", roll_min), ("max", roll_max)) if roll and on]
    if win_type and {"min", "max"} & set(aggs):
        raise ValueError("a weighted window has a mean and a std only")
    if not (lag or aggs or ewm):
        return df

    rows = lay_out(df, groups, order, layout, block_rows)
    keyed = rows.has_key
    means = {a: f"__ewm_{i}" for i, a in enumerate(weights)} if ewm else {}
    centres = {n: f"__centre_{n}" for n in windows} if win_type and aggs else {}
    plain = Rolling(rows, target, windows, [] if win_type else aggs)
    waves = WeightedRolling(rows, target, windows, win_type, aggs, min_periods)

    def weighted_centre(w: WindowSpec, n: int) -> Column:
        return waves.mean(n) if n in waves.wide else weighted_mean(w, target, rolling_weights(win_type, n))

    def weighted_centres(w: WindowSpec) -> dict[str, Column]:
        return {name: weighted_centre(w, n) for n, name in centres.items()}

    def rolled(w: WindowSpec, n: int, agg: str) -> Column:
        if not win_type:
            return plain.column(w, n, agg, min_periods)
        value = F.col(centres[n])
        if n in waves.wide:
            return F.when(keyed, waves.deviation(n, centres[n]) if agg == "std" else value)
        if agg == "std":
            value = weighted_std(w, target, rolling_weights(win_type, n), centres[n])
        return F.when(keyed & enough_values(w, target, n, min_periods), value)

    def build(w: WindowSpec) -> dict[str, Column]:
        out: dict[str, Column] = {}
        if lag:
            out |= lag_columns(w, keyed, target, {f"sales_lag_{k}": k for k in lags})
        out |= {f"sales_roll_{agg}_{n}": rolled(w, n, agg) for agg in aggs for n in windows}
        for alpha, name in means.items():
            out |= lag_columns(w, keyed, name, {f"sales_ewm_w_{alpha}_lag_{k}": k for k in lags})
        return out

    steps: list[Step] = [*waves.steps, weighted_centres, build] if centres else [*plain.steps, build]
    reach = max([0, *(lags if lag or ewm else []), *(windows if aggs else [])])
    done = _Means(rows, target, means).then(reach, *steps) if means else rows.with_columns(reach, *steps)
    return done.to_frame().drop(*centres.values(), *plain.helpers, *waves.helpers)
