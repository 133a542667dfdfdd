"""(S)ARIMA(X) by exact Gaussian likelihood, for many series at once.

The differenced series is an ARMA process whose lag polynomials are products of a plain and a seasonal one. A Kalman filter
runs over all series of an Arrow batch together: a step of time is a few array operations over (series, state, state).
Missing values are skipped by the filter, so a hole costs only itself; a difference that needs a missing value is missing.
The filter starts from the stationary distribution. The shock variance is concentrated out and the rest is maximised by
a quasi-Newton search over partial autocorrelations, which keeps every polynomial stationary or invertible.

A series is one array in one row here: use it for series that are short by construction (sums per week or month). Longer ones
than ``MAX_ROWS`` are refused; the two-stage estimator of ``arima`` works in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

MAX_ROWS = 20_000
BATCH = 512
ITERATIONS = 60
STARTS = (0.0, -0.6)  # of the moving-average part


def polynomial(pacf: np.ndarray) -> np.ndarray:
    """Autoregressive coefficients (rows: series) from partial autocorrelations, by Durbin's recursion."""
    out = np.zeros_like(pacf)
    for k in range(pacf.shape[1]):
        before = out[:, :k].copy()
        out[:, :k] = before - pacf[:, k : k + 1] * before[:, ::-1]
        out[:, k] = pacf[:, k]
    return out


def multiplied(plain: np.ndarray, seasonal: np.ndarray, season: int, sign: int) -> np.ndarray:
    """Coefficients by lag of (1 + sign * plain(B)) (1 + sign * seasonal(B^season)), without the 1 and again times sign."""
    n, p, q = len(plain), plain.shape[1], seasonal.shape[1]
    out = np.zeros((n, p + season * q + 1))
    a = np.concatenate([np.ones((n, 1)), sign * plain], axis=1)
    b = np.concatenate([np.ones((n, 1)), sign * seasonal], axis=1)
    for j in range(q + 1):
        out[:, season * j : season * j + p + 1] += a * b[:, j : j + 1]
    return sign * out[:, 1:]


def stationary(transition: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """The covariance P with P = T P T' + noise, by doubling."""
    total, power = noise.copy(), transition
    for _ in range(24):
        more = power @ total @ power.transpose(0, 2, 1)
        total = total + more
        if np.abs(more).max(initial=0.0) <= 1e-13 * np.abs(total).max(initial=1.0):
            break
        power = power @ power
    return total


def innovations(w: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One-step errors, their variances (of unit shocks) and predictions; ``w``: series by time, NaN where missing."""
    n, steps = w.shape
    r = max(ar.shape[1], ma.shape[1] + 1)
    phi = np.zeros((n, r))
    phi[:, : ar.shape[1]] = ar
    gain = np.zeros((n, r))
    gain[:, 0], gain[:, 1 : ma.shape[1] + 1] = 1.0, ma
    noise = gain[:, :, None] * gain[:, None, :]
    transition = np.zeros((n, r, r))
    transition[:, :, 0] = phi
    transition[:, np.arange(r - 1), np.arange(1, r)] = 1.0
    a, p = np.zeros((n, r)), stationary(transition, noise)
    errors, variances, means = (np.full((n, steps), np.nan) for _ in range(3))
    for t in range(steps):
        seen = ~np.isnan(w[:, t])
        f = np.maximum(p[:, 0, 0], 1e-12)
        v = np.where(seen, w[:, t] - a[:, 0], 0.0)
        means[:, t] = a[:, 0]
        errors[seen, t], variances[seen, t] = v[seen], f[seen]
        k = np.where(seen[:, None], p[:, :, 0] / f[:, None], 0.0)
        a = a + k * v[:, None]
        p = p - k[:, :, None] * k[:, None, :] * f[:, None, None]
        a = np.concatenate([a[:, 1:], np.zeros((n, 1))], axis=1) + phi * a[:, :1]
        p = np.concatenate([p[:, 1:], np.zeros((n, 1, r))], axis=1) + phi[:, :, None] * p[:, :1]
        p = np.concatenate([p[:, :, 1:], np.zeros((n, r, 1))], axis=2) + p[:, :, :1] * phi[:, None, :] + noise
    return errors, variances, means


def log_likelihood(w: np.ndarray, ar: np.ndarray, ma: np.ndarray, sigma2: np.ndarray) -> np.ndarray:
    """Of the values that are there."""
    v, f, _ = innovations(w, ar, ma)
    s = sigma2[:, None] * f
    return -0.5 * np.nansum(np.log(2 * np.pi * s) + v * v / s, axis=1)


def minimised(objective: Callable[[np.ndarray], np.ndarray], start: np.ndarray, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """BFGS for every row of ``start`` at once. ``objective``: points (rows, numbers) to values (rows)."""
    x, (n, k) = start.copy(), start.shape
    value = objective(x)

    def slope(x: np.ndarray) -> np.ndarray:
        out, h = np.empty_like(x), 1e-5
        for j in range(k):
            step = np.zeros_like(x)
            step[:, j] = h
            out[:, j] = (objective(x + step) - objective(x - step)) / (2 * h)
        return np.nan_to_num(out)

    if not k:
        return x, value
    grad, inverse = slope(x), np.tile(np.eye(k), (n, 1, 1))
    for _ in range(iterations):
        way = -np.einsum("nij,nj->ni", inverse, grad)
        uphill = np.einsum("ni,ni->n", way, grad) >= 0
        inverse[uphill] = np.eye(k)
        way[uphill] = -grad[uphill]
        way /= np.maximum(1.0, np.abs(way).max(axis=1, keepdims=True))  # no step of more than one
        size, open_ = np.ones(n), np.ones(n, bool)
        new_x, new_value = x.copy(), value.copy()
        for _ in range(12):
            tried = x + size[:, None] * way
            got = objective(tried)
            better = open_ & (got < value + 1e-4 * size * np.einsum("ni,ni->n", way, grad))
            new_x[better], new_value[better] = tried[better], got[better]
            open_ &= ~better
            if not open_.any():
                break
            size = np.where(open_, size / 2, size)
        moved, before = new_x - x, grad
        gained = value - new_value
        x, value = new_x, new_value
        if (gained <= 1e-9 * (1 + np.abs(value))).all():
            break
        grad = slope(x)
        change = grad - before
        along = np.einsum("ni,ni->n", change, moved)
        good = along > 1e-12
        rho = np.where(good, 1.0 / np.where(good, along, 1.0), 0.0)
        left = np.eye(k) - rho[:, None, None] * moved[:, :, None] * change[:, None, :]
        inverse = np.where(good[:, None, None], left @ inverse @ left.transpose(0, 2, 1) + rho[:, None, None] * moved[:, :, None] * moved[:, None, :], inverse)
    return x, value


class Arma:
    """The numbers of a specification's polynomials and trend."""

    def __init__(self, order: tuple, seasonal_order: tuple, trends: tuple[str, ...]):
        (self.p, _, self.q), (self.sp, _, self.sq, self.season) = order, seasonal_order
        self.trends = trends
        self.sizes = np.cumsum([self.p, self.sp, self.q, self.sq])

    def coefficients(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = np.split(np.tanh(x[:, : self.sizes[-1]]), self.sizes[:-1], axis=1)
        plain, seasonal, ma, sma = map(polynomial, parts)
        return multiplied(plain, seasonal, self.season, -1), multiplied(-ma, -sma, self.season, 1)

    def level(self, x: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The trend at every time; its numbers come last."""
        level = np.zeros_like(times)
        for j, term in enumerate(self.trends):
            level = level + x[:, self.sizes[-1] + j, None] * (1.0 if term == "const" else times)
        return level

    def fit(self, w: np.ndarray, times: np.ndarray) -> dict[str, np.ndarray]:
        """ar, ma (by lag), trend (const and slope as the recursion has them), sigma2, loglik, n, errors and predictions."""
        n_seen = np.maximum((~np.isnan(w)).sum(axis=1), 1)
        mean = np.nansum(w, axis=1, keepdims=True) / n_seen[:, None]
        scale = np.sqrt(np.nansum((w - mean) ** 2, axis=1, keepdims=True) / n_seen[:, None])
        scale = np.where(np.isfinite(scale) & (scale > 0), scale, 1.0)
        w = w / scale
        length = max(times.max(initial=1.0), 1.0)
        times = times / length

        def objective(x: np.ndarray) -> np.ndarray:
            v, f, _ = innovations(w - self.level(x, times), *self.coefficients(x))
            s = np.maximum(np.nansum(v * v / f, axis=1) / n_seen, 1e-300)
            out = np.log(s) + np.nansum(np.log(f), axis=1) / n_seen
            return np.where(np.isfinite(out), out, 1e10)

        best_x = best = None
        for ma in STARTS if self.q or self.sq else STARTS[:1]:
            start = np.zeros((len(w), self.sizes[-1] + len(self.trends)))
            start[:, self.sizes[1] : self.sizes[-1]] = -np.arctanh(ma)
            if "const" in self.trends:
                start[:, self.sizes[-1]] = np.nan_to_num(np.nansum(w, axis=1) / n_seen)
            x, value = minimised(objective, start)
            better = np.ones(len(w), bool) if best is None else value < best
            best_x = x if best_x is None else np.where(better[:, None], x, best_x)
            best = value if best is None else np.where(better, value, best)
        ar, ma = self.coefficients(best_x)
        trend = self.level(best_x, times)
        v, f, mean = innovations(w - trend, ar, ma)
        sigma2 = np.nansum(v * v / f, axis=1) / n_seen
        total, late = 1 - ar.sum(axis=1), (ar * np.arange(1, ar.shape[1] + 1)).sum(axis=1)
        terms = {t: best_x[:, self.sizes[-1] + j] * scale[:, 0] / (1.0 if t == "const" else length) for j, t in enumerate(self.trends)}
        const, slope = terms.get("const", 0.0), terms.get("slope", 0.0)
        recursion = {"const": const * total + slope * late, "slope": slope * total}
        return {
            "ar": ar, "ma": ma, "trend": np.stack([recursion[t] for t in self.trends], axis=1) if self.trends else np.zeros((len(w), 0)),
            "sigma2": sigma2 * scale[:, 0] ** 2, "n": (~np.isnan(w)).sum(axis=1),
            "loglik": -0.5 * n_seen * (np.log(2 * np.pi * np.maximum(sigma2, 1e-300) * scale[:, 0] ** 2) + 1 + np.nansum(np.log(f), axis=1) / n_seen),
            "shocks": np.nan_to_num(v / f) * scale, "fitted": (mean + trend) * scale,
        }


def differences(y: np.ndarray, polynomial_: list[int]) -> np.ndarray:
    """Series by time, from the first difference that can be formed."""
    span = len(polynomial_) - 1
    return sum(c * y[:, span - k : y.shape[1] - k] for k, c in enumerate(polynomial_)) if y.shape[1] > span else np.zeros((len(y), 0))


def filled(y: np.ndarray, fitted: np.ndarray, polynomial_: list[int]) -> np.ndarray:
    """``y`` with its missing values replaced by their predictions, one after the other."""
    out, span = y.copy(), len(polynomial_) - 1
    for t in range(span, y.shape[1]):
        value = fitted[:, t - span] - sum(c * out[:, t - k] for k, c in enumerate(polynomial_) if k)
        out[:, t] = np.where(np.isnan(out[:, t]), value, out[:, t])
    return out


def aligned(series: list[np.ndarray]) -> np.ndarray:
    """Series by time, put to the right so that all end together; what is before a series is missing."""
    longest = max(len(s) for s in series)
    y = np.full((len(series), longest), np.nan)
    for i, s in enumerate(series):
        y[i, longest - len(s) :] = s
    return y


def slices(batch: pd.Series) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Positions and arrays of some series at a time, those of like length together."""
    arrays = [np.array([np.nan if x is None else x for x in s], float) for s in batch]
    order = np.argsort([len(a) for a in arrays], kind="stable")
    for at in range(0, len(arrays), BATCH):
        yield order[at : at + BATCH], [arrays[i] for i in order[at : at + BATCH]]


RESULT = "trend_coef array<double>, ar array<double>, ma array<double>, sigma2 double, n_rows long, loglik double, y_tail array<double>, e_tail array<double>"


def estimate(order: tuple, seasonal_order: tuple, trends: tuple[str, ...], delta: list[int], ar_lags: list[int], ma_lags: list[int], tail: int):
    """An expression from a series' values in order (array, null where missing) to its estimates."""
    arma = Arma(order, seasonal_order, trends)
    last_ma = max(ma_lags, default=0)

    def some(series: list[np.ndarray]) -> list[tuple]:
        y = aligned(series)
        longest = y.shape[1]
        w = differences(y, delta)
        sizes = np.array([len(s) for s in series])
        times = np.arange(len(delta), longest + 1)[None, :] - (longest - sizes)[:, None].astype(float)  # row numbers, from 1
        found = arma.fit(w, times)
        whole = filled(y, found["fitted"], delta)
        few = found["n"] <= arma.sizes[-1] + len(trends)
        rows = []
        for i, size in enumerate(sizes):
            last = whole[i, longest - size :][::-1][:tail]
            shocks = found["shocks"][i][::-1][:last_ma] if last_ma else []
            rows.append((
                found["trend"][i].tolist() if not few[i] else [0.0] * len(trends), [0.0 if few[i] else float(found["ar"][i, k - 1]) for k in ar_lags],
                [0.0 if few[i] else float(found["ma"][i, k - 1]) for k in ma_lags], None if few[i] else float(found["sigma2"][i]), int(found["n"][i]),
                None if few[i] else float(found["loglik"][i]), [None if np.isnan(x) else float(x) for x in last], [0.0 if few[i] else float(x) for x in shocks],
            ))
        return rows

    @F.pandas_udf(RESULT)
    def each(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [part.strip().split(" ")[0] for part in RESULT.split(", ")]
        for batch in values:
            rows: list[tuple] = [()] * len(batch)
            for part, series in slices(batch):
                for i, row in zip(part, some(series)):
                    rows[i] = row
            yield pd.DataFrame({n: pd.Series([r[k] for r in rows], dtype=object) for k, n in enumerate(names)}).astype({"n_rows": "int64"})

    return each


def series_arrays(rows: DataFrame, by: str, value: str, order: list[str]) -> DataFrame:
    """by, values: one array per series, null where a value is missing; refuses series of more than MAX_ROWS.

    The arrays are written once, none of them longer than MAX_ROWS, with the rows of their series counted in the same pass.
    """
    nth = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    listed = F.array_sort(F.collect_list(F.when(F.col("nth_") <= MAX_ROWS, F.struct(*order, F.col(value).alias("value_")))))
    arrays = rows.withColumn("nth_", nth).groupBy(by).agg(F.count(F.lit(1)).alias("rows_"), F.transform(listed, lambda r: r["value_"]).alias("values"))
    arrays = materialize(arrays, "arrays")
    longest = arrays.agg(F.max("rows_")).first()[0] or 0
    if longest > MAX_ROWS:
        raise ValueError(f"a series has {longest} rows; the likelihood takes at most {MAX_ROWS}: use the two-stage estimator")
    return arrays.drop("rows_")


def log_likelihoods(values: Column, ar: list[float], ma: list[float], sigma2: float, delta: list[int] | None = None) -> Column:
    """The log-likelihood of an array of values under given coefficients by lag."""
    delta = delta or [1]

    @F.pandas_udf("double")
    def each(batch: pd.Series) -> pd.Series:
        out = np.zeros(len(batch))
        for part, series in slices(batch):
            n, w = len(part), differences(aligned(series), delta)
            out[part] = log_likelihood(w, np.tile(np.array(ar, float), (n, 1)), np.tile(np.array(ma, float), (n, 1)), np.full(n, sigma2))
        return pd.Series(out)

    return each(values)
