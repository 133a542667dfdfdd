"""(S)ARIMA(X) for all series of a panel at once.

Estimation is two-stage least squares (Hannan and Rissanen 1982), not maximum likelihood, so coefficients
differ from those of a likelihood solver:

1. the equation is differenced; regressors and trend, if any, are fitted by least squares;
2. with moving-average terms, a long autoregression (Yule-Walker) gives estimated shocks;
3. the differenced value is regressed on its own lags, lagged shocks and the trend.

Products of plain and seasonal terms enter as free lags. Each stage is a grouped sum of products; only the
k x k solve per series runs in Python. Forecasts, intervals and updates use the parameter table alone.

``ArimaSpec(estimator="likelihood")`` estimates by exact likelihood instead (``likelihood``): products of polynomials, holes
skipped, for series short enough to be one array. The parameter table and all that reads it are the same.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..operators.layout import SeriesRows, lay_out
from ..session import materialize
from .dates import frequency_columns, future_date, gap_columns, with_frequency
from .differencing import difference_polynomial, differenced
from .exog import ID, future_rows, unknown_ids
from .history import SeriesHistory
from .likelihood import estimate, series_arrays
from .regression import explained, product_sums, solve_normal_equations, solve_yule_walker

History = DataFrame | SeriesHistory

TRENDS = {"n": (), "c": ("const",), "t": ("slope",), "ct": ("const", "slope")}


@dataclass(frozen=True)
class ArimaSpec:
    order: tuple[int, int, int] = (1, 1, 1)
    seasonal_order: tuple[int, int, int, int] = (0, 0, 0, 0)
    trend: str = "n"
    exog_cols: tuple[str, ...] = ()
    long_ar: int | None = None
    estimator: str = "two_stage"

    def __post_init__(self):
        if self.estimator not in ("two_stage", "likelihood"):
            raise ValueError(f"estimator {self.estimator!r} is not two_stage or likelihood")
        if self.trend not in TRENDS:
            raise ValueError(f"trend {self.trend!r} is not one of {', '.join(TRENDS)}")
        if any(self.seasonal_order[:3]) and self.seasonal_order[3] < 2:
            raise ValueError("seasonal terms need a season of at least 2")

    def _lags(self, plain: int, seasonal: int) -> list[int]:
        season = self.seasonal_order[3]
        return sorted({i + season * j for i in range(plain + 1) for j in range(seasonal + 1)} - {0})

    @property
    def ar_lags(self) -> list[int]:
        return self._lags(self.order[0], self.seasonal_order[0])

    @property
    def ma_lags(self) -> list[int]:
        return self._lags(self.order[2], self.seasonal_order[2])

    @property
    def difference(self) -> list[int]:
        return difference_polynomial(self.order[1], self.seasonal_order[1], self.seasonal_order[3])

    @property
    def span(self) -> int:
        return len(self.difference) - 1

    @property
    def trend_terms(self) -> tuple[str, ...]:
        return TRENDS[self.trend]

    @property
    def shock_lags(self) -> int:
        """Length of the long autoregression."""
        if not self.ma_lags or self.estimator == "likelihood":
            return 0
        return self.long_ar or max(8, max(self.ar_lags + self.ma_lags) + 4)

    @property
    def recursion_lags(self) -> int:
        return self.span + max(self.ar_lags, default=0)

    @property
    def tail(self) -> int:
        """How many last values of a series forecasts and updates need."""
        shocks = self.shock_lags + max(self.ma_lags, default=0)
        return max(self.span + max(shocks, max(self.ar_lags, default=0)), 1)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> ArimaSpec:
        return ArimaSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})


def spec_of(params: DataFrame) -> ArimaSpec:
    first = params.select("spec").first()
    return ArimaSpec.from_json(first[0]) if first else ArimaSpec()


# --- rows of the panel ----------------------------------------------------------------------------


def _panel(df: DataFrame, spec: ArimaSpec, id_col: str, y_col: str, ds_col: str) -> DataFrame:
    x = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(spec.exog_cols)]
    cols = [F.col(id_col).cast("string").alias(ID), F.col(ds_col).cast("timestamp_ntz").alias("ds")]
    return nan_to_null(df.select(*cols, F.col(y_col).cast("double").alias("y"), *x)).where(F.col(ID).isNotNull())


def _dot(coef: Column, cols: Sequence[Column], start: int = 0) -> Column:
    return reduce(lambda a, b: a + b, [F.get(coef, F.lit(start + i)) * c for i, c in enumerate(cols)], F.lit(0.0))


def _trend_columns(spec: ArimaSpec, t: str = "t") -> list[Column]:
    return [F.lit(1.0) if term == "const" else F.col(t).cast("double") for term in spec.trend_terms]


def _with_adjusted(rows: DataFrame, spec: ArimaSpec) -> DataFrame:
    """``adjusted``: the value without the part explained by regressors (column ``beta``)."""
    x = [F.col(f"x{i}") for i in range(len(spec.exog_cols))]
    return rows.withColumn("adjusted", F.col("y") - _dot(F.col("beta"), x))


def _u_step(spec: ArimaSpec):
    """``u``: the differenced adjusted value; ``uc``: ``u`` without its fitted trend (column ``centre``)."""

    def u(w: WindowSpec) -> dict[str, Column]:
        return {"u": differenced(w, "adjusted", spec.difference)}

    def uc(_: WindowSpec) -> dict[str, Column]:
        return {"uc": F.col("u") - _dot(F.col("centre"), _trend_columns(spec))}

    return [u, uc]


def _shock_step(spec: ArimaSpec):
    def shock(w: WindowSpec) -> dict[str, Column]:
        past = [F.lag("uc", h).over(w) for h in range(1, spec.shock_lags + 1)]
        return {"e": F.col("uc") - _dot(F.col("long_ar"), past)}

    return [shock]


def _regressor_step(spec: ArimaSpec):
    def regressors(w: WindowSpec) -> dict[str, Column]:
        out = {f"u_{k}": F.lag("u", k).over(w) for k in spec.ar_lags}
        return out | {f"e_{k}": F.lag("e", k).over(w) for k in spec.ma_lags}

    return [regressors]


def _regressors(spec: ArimaSpec) -> list[Column]:
    lags = [F.col(f"u_{k}") for k in spec.ar_lags] + [F.col(f"e_{k}") for k in spec.ma_lags]
    return [*_trend_columns(spec), *lags]


def _all_steps(spec: ArimaSpec):
    return [*_u_step(spec), *(_shock_step(spec) if spec.ma_lags else []), *_regressor_step(spec)]


def _join_table(rows: SeriesRows, table: DataFrame) -> SeriesRows:
    return rows.on(rows.rows.join(table, ID, "left"))


def _no_values() -> Column:
    return F.array().cast("array<double>")


# --- estimation -----------------------------------------------------------------------------------


def _fit_levels(rows: SeriesRows, spec: ArimaSpec) -> DataFrame | None:
    """``beta`` (regressors) and ``centre`` (trend) by least squares on the differenced equation."""
    k = len(spec.exog_cols)
    if not k and not (spec.ma_lags and spec.trend_terms):
        return None
    names = ["y", *[f"x{i}" for i in range(k)]]
    flat = rows.with_columns(
        spec.span, lambda w: {f"__d_{n}": differenced(w, n, spec.difference) for n in names}
    ).to_frame()
    xs = [F.col(f"__d_x{i}") for i in range(k)] + _trend_columns(spec)
    sums = product_sums(flat, ID, F.col("__d_y"), xs)
    solved = sums.select(ID, solve_normal_equations("xx", "xy").alias("__b"))
    return materialize(
        solved.select(
            ID,
            F.slice("__b", 1, k).alias("beta") if k else _no_values().alias("beta"),
            F.slice("__b", k + 1, len(spec.trend_terms)).alias("centre") if spec.trend_terms else _no_values().alias("centre"),
        ),
        "levels",
    )


def _fit_long_ar(rows: SeriesRows, spec: ArimaSpec) -> DataFrame:
    m = spec.shock_lags

    def products(w: WindowSpec) -> dict[str, Column]:
        return {f"__g{h}": F.col("uc") * (F.lag("uc", h).over(w) if h else F.col("uc")) for h in range(m + 1)}

    flat = rows.with_columns(spec.span + m, *_u_step(spec), products).to_frame()
    gamma = F.array(*[F.coalesce(F.sum(f"__g{h}"), F.lit(0.0)) for h in range(m + 1)])
    solved = flat.groupBy(ID).agg(gamma.alias("gamma")).select(ID, solve_yule_walker("gamma").alias("long_ar"))
    return materialize(solved, "long-ar")


def _solved(sums: DataFrame, spec: ArimaSpec) -> DataFrame:
    """Split the solution of the final regression into its parts and add the shock variance."""
    n_trend, n_ar, n_ma = len(spec.trend_terms), len(spec.ar_lags), len(spec.ma_lags)
    done = sums.withColumn("__b", solve_normal_equations("xx", "xy"))
    error = F.greatest(F.col("yy") - explained(F.col("xy"), F.col("__b")), F.lit(0.0))

    def part(start: int, size: int) -> Column:
        return F.slice("__b", start + 1, size) if size else _no_values()

    return done.withColumns(
        {
            "trend_coef": part(0, n_trend),
            "ar": part(n_trend, n_ar),
            "ma": part(n_trend + n_ar, n_ma),
            # no error is left to measure where every row has a coefficient of its own
            "sigma2": F.when(F.col("n_rows") > n_trend + n_ar + n_ma, F.try_divide(error, F.col("n_rows"))),
        }
    ).drop("__b")


def _tail_values(spec: ArimaSpec) -> dict[str, Column]:
    """Aggregates for the last values (adjusted) and last shocks of a series, latest first.

    One plain aggregate per kept row: how many are kept depends on the model order, never on the data.
    """

    def last(name: str, n: int) -> Column:
        return F.array(*[F.max(F.when(F.col("__back") == k, F.col(name))) for k in range(1, n + 1)])

    n_shocks = max(spec.ma_lags, default=0)
    return {
        "y_tail": F.slice(last("adjusted", spec.tail), F.lit(1), F.least(F.count(F.lit(1)), F.lit(spec.tail)).cast("int")),
        "e_tail": last("e", n_shocks) if n_shocks else _no_values(),
    }


def fit(
    df: DataFrame,
    spec: ArimaSpec,
    id_col: str = "unique_id",
    y_col: str = "y",
    ds_col: str = "ds",
    freq: str | None = None,
    layout: str = "auto",
) -> DataFrame:
    """The parameter table: one row per series.

    Columns: unique_id, n_obs, last_date, freq (with unit and step), beta (regressors), centre, long_ar,
    trend_coef, ar and ma (by lag, in the order of the spec), sigma2, the product sums (n_rows, yy, xy, xx),
    y_tail, e_tail and the spec. Rows with a missing value in a needed lag do not enter the sums; a series
    too short for its model has zero coefficients, and one with no more rows than coefficients has no sigma2
    and no interval.
    """
    panel = _panel(df, spec, id_col, y_col, ds_col)
    if spec.estimator == "likelihood":
        return materialize(_complete(_fit_likelihood(materialize(panel, "panel"), spec, freq), spec), "params")
    if layout == "auto" or spec.exog_cols or spec.ma_lags:  # read more than once
        panel = materialize(panel, "panel")
    rows = lay_out(panel, [ID], ["ds", "y"], layout).with_row_number("__back", from_end=True)
    if "slope" in spec.trend_terms:
        rows = rows.with_row_number("t")

    tables = []
    levels = _fit_levels(rows, spec)
    if levels is None:
        known = rows.on(rows.rows.withColumns({"beta": _no_values(), "centre": _no_values()}))
    else:
        known = _join_table(rows, levels)
        tables.append(levels)
    known = known.on(_with_adjusted(known.rows, spec))
    if spec.ma_lags:
        long_ar = _fit_long_ar(known, spec)
        tables.append(long_ar)
        known = _join_table(known, long_ar)

    # Everything else comes from one pass: the products of the final regression, the tails, the dates.
    also = {"n_obs": F.count(F.lit(1)), "last_date": F.max("ds")} | _tail_values(spec)
    steps = _all_steps(spec)
    if freq is None:
        also |= frequency_columns("ds")
        steps = [lambda w: gap_columns(w, "ds"), *steps]
    flat = known.with_columns(spec.tail, *steps).to_frame()
    solved = _solved(product_sums(flat, ID, F.col("u"), _regressors(spec), also=also), spec)
    params = reduce(lambda a, b: a.join(b, ID, "left"), tables, with_frequency(solved, freq))
    return materialize(_complete(params, spec), "params")


def _fit_likelihood(panel: DataFrame, spec: ArimaSpec, freq: str | None) -> DataFrame:
    """As ``fit``, by exact likelihood; regressors are fitted before, by least squares on the differenced equation."""
    rows = lay_out(panel, [ID], ["ds", "y"], "short")
    tables = []
    if spec.exog_cols:
        if "slope" in spec.trend_terms:
            rows = rows.with_row_number("t")
        tables.append(_fit_levels(rows, spec).drop("centre"))
        rows = _join_table(rows, tables[0])
    else:
        rows = rows.on(rows.rows.withColumn("beta", _no_values()))
    rows = rows.on(_with_adjusted(rows.rows, spec))
    flat = rows.with_columns(1, lambda w: gap_columns(w, "ds")).to_frame()
    stats = flat.groupBy(ID).agg(
        F.count(F.lit(1)).alias("n_obs"), F.max("ds").alias("last_date"), *[c.alias(n) for n, c in frequency_columns("ds").items()]
    )
    one = estimate(spec.order, spec.seasonal_order, spec.trend_terms, spec.difference, spec.ar_lags, spec.ma_lags, spec.tail)
    found = series_arrays(flat.select(ID, "ds", "adjusted"), ID, "adjusted", ["ds"]).select(ID, one("values").alias("found"))
    found = found.select(ID, "found.*").withColumns(
        {"yy": F.lit(None).cast("double"), "xy": _no_values(), "xx": _no_values()}  # no sums to add to
    )
    return reduce(lambda a, b: a.join(b, ID, "left"), tables, with_frequency(stats, freq).join(found, ID))


def _complete(params: DataFrame, spec: ArimaSpec) -> DataFrame:
    """All columns in a fixed order, also for series without enough rows."""

    def zeros(n: int) -> Column:
        return F.array_repeat(F.lit(0.0), n) if n else _no_values()

    sizes = {
        "beta": len(spec.exog_cols),
        "centre": len(spec.trend_terms),
        "long_ar": spec.shock_lags,
        "trend_coef": len(spec.trend_terms),
        "ar": len(spec.ar_lags),
        "ma": len(spec.ma_lags),
    }
    arrays = [
        (F.coalesce(c, zeros(n)) if c in params.columns else zeros(n)).cast("array<double>").alias(c)
        for c, n in sizes.items()
    ]
    return params.select(
        ID, "n_obs", "last_date", "freq", "freq_unit", "freq_step", *arrays,
        "n_rows", "sigma2", "yy", "xy", "xx", "y_tail", "e_tail", *(["loglik"] if spec.estimator == "likelihood" else []),
        F.lit(spec.to_json()).alias("spec"),
    )


# --- forecasting ----------------------------------------------------------------------------------


def _recursion_weights(spec: ArimaSpec) -> Column:
    """Weights of the last values, latest first, once differencing and autoregression are multiplied out."""
    delta = dict(enumerate(spec.difference))
    weights = []
    for lag in range(1, spec.recursion_lags + 1):
        w = F.lit(-float(delta.get(lag, 0)))
        for i, k in enumerate(spec.ar_lags):
            if delta.get(lag - k, 0):
                w = w + F.get("ar", F.lit(i)) * float(delta[lag - k])
        weights.append(w)
    return F.array(*weights) if weights else _no_values()


def _run(weights: Column, start: Column, inputs: Column, lags: int, steps: int) -> Column:
    """x_i = inputs_i + sum_k weights_k x_(i-k) for i = 1..steps, from ``start`` (latest first)."""

    def step(past: Column, given: Column) -> Column:
        weighted = F.zip_with(weights, F.slice(past, 1, lags), lambda a, b: a * b) if lags else _no_values()
        return F.concat(F.array(F.aggregate(weighted, given, lambda s, v: s + v)), past)

    return F.reverse(F.slice(F.aggregate(inputs, start.cast("array<double>"), step), 1, steps))


def _shock_part(spec: ArimaSpec, i: int) -> Column:
    """What known shocks still add ``i`` steps ahead."""
    terms = [
        F.get("ma", F.lit(n)) * F.coalesce(F.get("e_tail", F.lit(k - i)), F.lit(0.0))
        for n, k in enumerate(spec.ma_lags)
        if k >= i
    ]
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


def _trend_part(spec: ArimaSpec, i: Column) -> Column:
    at = [F.lit(1.0) if term == "const" else (F.col("n_obs") + i).cast("double") for term in spec.trend_terms]
    return _dot(F.col("trend_coef"), at)


def _padded(values: list[Column], steps: int, rest: Callable[[Column], Column]) -> Column:
    """``rest(i)`` for i = 1..steps, plus the ``i``-th of ``values`` where there is one."""
    known = F.array(*values) if values else _no_values()
    return F.transform(
        F.sequence(F.lit(1), F.lit(steps)), lambda i: rest(i) + F.coalesce(F.get(known, i - 1), F.lit(0.0))
    )


def forecast(
    params: DataFrame,
    horizon: int,
    future: DataFrame | None = None,
    alpha: float = 0.05,
    id_col: str = "unique_id",
    ds_col: str = "ds",
    freq: str | None = None,
) -> DataFrame:
    """unique_id, ds, yhat, yhat_lower, yhat_upper for ``horizon`` steps of every fitted series.

    A model with regressors needs their future values; a series with fewer than ``horizon`` future rows
    repeats its last one. yhat is NULL where a series is shorter than the model's recursion.
    """
    spec = spec_of(params)
    table = params
    if spec.exog_cols:
        if future is None:
            raise ValueError(f"the model needs future values of {', '.join(spec.exog_cols)}")
        table = params.join(future_rows(params, future, spec.exog_cols, horizon, id_col, ds_col), ID)
        lost = table.where(F.col("x_future").isNull()).select(ID).limit(5).collect()
        if lost:
            raise ValueError(f"no future regressor rows for series {', '.join(r[0] for r in lost)}")
    if freq is not None:
        table = with_frequency(table, freq)

    lags, last_ma = spec.recursion_lags, max(spec.ma_lags, default=0)
    shocks = [_shock_part(spec, i) for i in range(1, min(horizon, last_ma) + 1)]
    inputs = _padded(shocks, horizon, lambda i: _trend_part(spec, i))
    impulse = F.array(*[F.lit(1.0)] + [F.lit(0.0)] * max(lags - 1, 0))
    responses = [F.get("ma", F.lit(spec.ma_lags.index(i))) if i in spec.ma_lags else F.lit(0.0) for i in range(1, last_ma + 1)]
    gains = F.array(F.lit(1.0))
    if horizon > 1:
        echoes = _padded(responses, horizon - 1, lambda _: F.lit(0.0))
        gains = F.concat(gains, _run(F.col("__w"), impulse, echoes, lags, horizon - 1))
    long_enough = F.size("y_tail") >= lags
    paths = table.withColumn("__w", _recursion_weights(spec)).withColumns(
        {
            "__mean": F.when(long_enough, _run(F.col("__w"), F.col("y_tail"), inputs, lags, horizon)),
            "__psi": gains,
        }
    )
    z = NormalDist().inv_cdf(1 - alpha / 2)

    def step(i: Column) -> Column:
        gain = F.aggregate(F.slice("__psi", F.lit(1), i), F.lit(0.0), lambda s, v: s + v * v)
        yhat = F.get("__mean", i - 1)
        if spec.exog_cols:
            row = F.element_at("x_future", F.least(i, F.size("x_future")))
            yhat = yhat + _dot(F.col("beta"), [row[k] for k in range(len(spec.exog_cols))])
        return F.struct(
            future_date(F.col("last_date"), F.col("freq_unit"), F.col("freq_step"), i).alias("ds"),
            yhat.alias("yhat"),
            (z * F.sqrt(F.col("sigma2") * gain)).alias("half"),
        )

    # One struct per step before the rows are multiplied, so that no array is copied into every row.
    steps = paths.select(ID, F.explode(F.transform(F.sequence(F.lit(1), F.lit(horizon)), step)).alias("__s"))
    yhat, half = F.col("__s.yhat"), F.col("__s.half")
    return steps.select(
        ID, "__s.ds", "__s.yhat", (yhat - half).alias("yhat_lower"), (yhat + half).alias("yhat_upper")
    )


# --- updates --------------------------------------------------------------------------------------


def check_known(new_rows: DataFrame, params: DataFrame, id_col: str = "unique_id") -> None:
    """Raise when a series to update was never fitted."""
    strangers = unknown_ids(new_rows, params, id_col).limit(5).collect()
    if strangers:
        raise ValueError(f"series not fitted yet: {', '.join(r[0] for r in strangers)}")


def late_rows(new_rows: DataFrame, params: DataFrame) -> DataFrame:
    """Series (unique_id) with a new row that is not after their last date, or with two new rows of one date."""
    known = new_rows.join(params.select(ID, "last_date"), ID)
    late = known.where(F.col("ds") <= F.col("last_date")).select(ID)
    twice = new_rows.groupBy(ID, "ds").count().where("count > 1").select(ID)
    return late.unionByName(twice).distinct()


def append_history(history: History, new_rows: DataFrame) -> History:
    """All observations; a date present in both is kept twice."""
    if isinstance(history, SeriesHistory):
        return history.append(new_rows)
    return history.unionByName(new_rows.select(*history.columns))


def _rows_of(history: History, series: DataFrame, id_col: str) -> DataFrame:
    return history.rows_of(series) if isinstance(history, SeriesHistory) else history.join(series, id_col, "left_semi")


def refit(
    params: DataFrame,
    history: History,
    new_rows: DataFrame,
    id_col: str = "unique_id",
    y_col: str = "y",
    ds_col: str = "ds",
    freq: str | None = None,
    layout: str = "auto",
) -> tuple[DataFrame, History]:
    """Append new observations and fit again the series they touch. Returns (params, history).

    A frame as history is scanned whole and grows by a union; of a ``SeriesHistory`` only the series' buckets are read.
    """
    new_rows = materialize(new_rows.select(*history.columns), "new-rows")  # read several times below
    check_known(new_rows, params, id_col)
    longer = append_history(history, new_rows)
    touched = new_rows.select(id_col).distinct()
    again = fit(_rows_of(longer, touched, id_col), spec_of(params), id_col, y_col, ds_col, freq, layout)
    kept = params.join(again.select(ID), ID, "left_anti")
    return materialize(kept.unionByName(again), "params"), longer


def update(
    params: DataFrame,
    history: History,
    new_rows: DataFrame,
    id_col: str = "unique_id",
    y_col: str = "y",
    ds_col: str = "ds",
    freq: str | None = None,
    layout: str = "auto",
    update_params: bool = True,
) -> tuple[DataFrame, History]:
    """Update incrementally, and fit again only the series with late or repeated dates. Returns (params, history)."""
    new_rows = materialize(new_rows.select(*history.columns), "new-rows")
    check_known(new_rows, params, id_col)
    late = materialize(late_rows(_panel(new_rows, spec_of(params), id_col, y_col, ds_col), params), "late")
    is_late = new_rows[id_col].cast("string") == late[ID]
    on_time, behind = new_rows.join(late, is_late, "left_anti"), new_rows.join(late, is_late, "left_semi")
    moved = update_incremental(params, on_time, id_col, y_col, ds_col, update_params, layout)
    return refit(moved, append_history(history, on_time), behind, id_col, y_col, ds_col, freq, layout)


def needs_refit(spec: ArimaSpec, update_params: bool) -> bool:
    """Whether new rows cannot be added to the parameter table alone."""
    if spec.estimator == "likelihood":
        return update_params or bool(spec.ma_lags)
    return update_params and bool(spec.ma_lags or spec.exog_cols)


def update_incremental(
    params: DataFrame,
    new_rows: DataFrame,
    id_col: str = "unique_id",
    y_col: str = "y",
    ds_col: str = "ds",
    update_params: bool = True,
    layout: str = "auto",
) -> DataFrame:
    """Update from new observations and the parameter table only; the history is not read.

    ``update_params=False`` moves the state (last values, shocks, date) and keeps the coefficients. With
    ``update_params=True`` the new rows' products are added to the stored sums and the regression is solved
    again; that is exact without moving-average terms and regressors, and refused with them.

    Rows must come after a series' last date, one for each date: others raise, and need ``update`` or ``refit``.
    """
    spec = spec_of(params)
    if needs_refit(spec, update_params):
        raise NotImplementedError("coefficients with moving-average terms, regressors or of a likelihood need a refit")
    new = materialize(_panel(new_rows, spec, id_col, y_col, ds_col), "new-rows")  # read several times below
    check_known(new, params)
    behind = late_rows(new, params).limit(5).collect()
    if behind:
        raise ValueError(f"late or repeated dates need a refit: series {', '.join(r[0] for r in behind)}")
    state = params.select(ID, "last_date", "n_obs", "beta", "centre", "long_ar", "y_tail")
    state = state.join(new.select(ID).distinct(), ID, "left_semi")

    # Old rows: the kept tail, numbered -1, -2, ... going back. It already is free of regressors.
    old = state.select(ID, F.posexplode("y_tail").alias("__back", "adjusted")).select(
        ID, F.lit(None).cast("timestamp_ntz").alias("ds"), F.lit(None).cast("double").alias("y"),
        "adjusted", (-F.col("__back") - 1).alias("__age"),
    )
    fresh = _with_adjusted(new.join(state.select(ID, "beta"), ID), spec)
    fresh = fresh.select(ID, "ds", "y", "adjusted", F.lit(0).alias("__age"))
    both = old.unionByName(fresh)
    if layout == "auto":  # counted first, then read
        both = materialize(both, "update")
    rows = lay_out(both, [ID], ["__age", "ds", "y"], layout)
    if "slope" in spec.trend_terms:
        rows = rows.with_row_number("__t")
    rows = _join_table(rows, state.select(ID, "n_obs", "centre", "long_ar", F.size("y_tail").alias("__kept")))
    if "slope" in spec.trend_terms:
        rows = rows.on(rows.rows.withColumn("t", F.col("n_obs") - F.col("__kept") + F.col("__t")))

    rows = rows.with_row_number("__back", from_end=True)
    flat = rows.with_columns(spec.tail, *_all_steps(spec)).to_frame()
    is_new = F.col("__age") == 0
    also = {"__more": F.count(F.when(is_new, True)), "__latest": F.max("ds")} | _tail_values(spec)
    seen = product_sums(flat, ID, F.col("u"), _regressors(spec), is_new, also)
    seen = seen.withColumnsRenamed({c: f"__{c}" for c in ("n_rows", "yy", "xy", "xx")})
    changed = params.drop("y_tail", "e_tail").join(seen, ID)
    moved = {"n_obs": F.col("n_obs") + F.col("__more"), "last_date": F.greatest("last_date", "__latest")}
    if update_params:
        moved |= {
            "n_rows": F.col("n_rows") + F.col("__n_rows"),
            "yy": F.col("yy") + F.col("__yy"),
            "xy": _added("xy"),
            "xx": _added("xx"),
        }
        changed = _solved(changed.drop("trend_coef", "ar", "ma", "sigma2").withColumns(moved), spec)
    else:
        changed = changed.withColumns(moved)
    kept = params.join(state.select(ID), ID, "left_anti")
    return materialize(kept.unionByName(changed.select(*params.columns)), "params")


def _added(name: str) -> Column:
    return F.zip_with(F.col(name), F.col(f"__{name}"), lambda a, b: a + b)
