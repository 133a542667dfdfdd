"""Estimation, forecasts, intervals and updates of (S)ARIMA against NumPy on simulated and small series."""

import numpy as np
import pandas as pd
import pytest

from seriesmill.forecasting import arima
from seriesmill.forecasting.arima import ArimaSpec
from seriesmill.forecasting.models import ArimaModel, SarimaModel


def to_panel(spark, series, start="2015-01-01", freq="MS", exog=None):
    rows = []
    for uid, y in series.items():
        ds = pd.date_range(start, periods=len(y), freq=freq)
        for i, v in enumerate(y):
            x = [float(exog[uid][i])] if exog else []
            rows.append((uid, ds[i].to_pydatetime(), None if np.isnan(v) else float(v), *x))
    cols = "unique_id string, ds timestamp_ntz, y double" + (", x double" if exog else "")
    return spark.createDataFrame(rows, cols).repartition(5)


def ols(y, X):
    return np.linalg.lstsq(X, y, rcond=None)[0]


def row(params, uid):
    return params.where(f"unique_id = '{uid}'").first()


def random_series(seed, n=60, k=3):
    rng = np.random.default_rng(seed)
    return {f"s{i}": 100 + np.cumsum(rng.normal(0, 3, n)) for i in range(k)}


def test_ar1_on_differences_is_ols(spark):
    series = random_series(1)
    params = arima.fit(to_panel(spark, series), ArimaSpec((1, 1, 0), trend="c"))
    for uid, y in series.items():
        w = np.diff(y)
        want = ols(w[1:], np.c_[np.ones(len(w) - 1), w[:-1]])
        got = row(params, uid)
        np.testing.assert_allclose([got.trend_coef[0], got.ar[0]], want, rtol=1e-8)
        assert (got.n_obs, got.freq, got.n_rows) == (60, "MS", 58)
        resid = w[1:] - np.c_[np.ones(len(w) - 1), w[:-1]] @ want
        np.testing.assert_allclose(got.sigma2, np.mean(resid**2), rtol=1e-7)

    fc = arima.forecast(params, 4).where("unique_id = 's0'").orderBy("ds").toPandas()
    y = series["s0"]
    c, phi = ols(np.diff(y)[1:], np.c_[np.ones(58), np.diff(y)[:-1]])
    level, step, want = y[-1], y[-1] - y[-2], []
    for _ in range(4):
        step = c + phi * step
        level += step
        want.append(level)
    np.testing.assert_allclose(fc.yhat, want, rtol=1e-9)
    assert fc.ds.tolist() == list(pd.date_range("2020-01-01", periods=4, freq="MS"))


def test_random_walk_interval(spark):
    series = random_series(2, 40, 1)
    params = arima.fit(to_panel(spark, series), ArimaSpec((0, 1, 0)))
    fc = arima.forecast(params, 3, alpha=0.1).orderBy("ds").toPandas()
    y = series["s0"]
    half = 1.6448536269514722 * np.sqrt(np.mean(np.diff(y) ** 2)) * np.sqrt([1, 2, 3])
    np.testing.assert_allclose(fc.yhat, y[-1])
    np.testing.assert_allclose(fc.yhat_upper - fc.yhat, half, rtol=1e-9)
    np.testing.assert_allclose(fc.yhat - fc.yhat_lower, half, rtol=1e-9)


def test_seasonal_random_walk_repeats_the_season(spark):
    series = random_series(3, 30, 2)
    params = arima.fit(to_panel(spark, series), ArimaSpec((0, 0, 0), (0, 1, 0, 12)))
    fc = arima.forecast(params, 14).where("unique_id = 's1'").orderBy("ds").toPandas()
    y = series["s1"]
    np.testing.assert_allclose(fc.yhat, np.r_[y[-12:], y[-12:-10]])


def simulate(phi, theta, n, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 100)
    y = np.zeros(n + 100)
    for t in range(1, n + 100):
        y[t] = phi * y[t - 1] + e[t] + theta * e[t - 1]
    return y[100:]


def test_arma_recovers_simulated_coefficients(spark):
    series = {f"s{i}": simulate(0.6, 0.3, 400, i) for i in range(12)}
    params = arima.fit(to_panel(spark, series, freq="D"), ArimaSpec((1, 0, 1))).toPandas()
    assert abs(np.mean([a[0] for a in params.ar]) - 0.6) < 0.06
    assert abs(np.mean([a[0] for a in params.ma]) - 0.3) < 0.08
    assert abs(params.sigma2.mean() - 1) < 0.1
    assert (params.freq == "D").all()


def arma_by_hand(y, spec):
    """The documented two-stage estimate of one series, in NumPy."""
    d = np.array(spec.difference, float)
    u = np.convolve(y, d, "valid")
    t = np.arange(len(y) - len(u) + 1, len(y) + 1.0)
    trend = np.c_[tuple(np.ones(len(u)) if k == "const" else t for k in spec.trend_terms)] if spec.trend_terms else np.zeros((len(u), 0))
    uc = u - trend @ ols(u, trend) if spec.trend_terms else u
    m = spec.shock_lags
    g = np.array([np.sum(uc[h:] * uc[: len(uc) - h]) for h in range(m + 1)])
    a = np.linalg.solve(g[np.abs(np.subtract.outer(range(m), range(m)))], g[1:])
    e = np.full(len(u), np.nan)
    for i in range(m, len(u)):
        e[i] = uc[i] - a @ uc[i - m : i][::-1]
    lag = lambda x, k: np.r_[np.full(k, np.nan), x[:-k]]
    X = np.c_[tuple([*trend.T, *[lag(u, k) for k in spec.ar_lags], *[lag(e, k) for k in spec.ma_lags]])]
    ok = ~np.isnan(X).any(axis=1)
    return ols(u[ok], X[ok]), e


SPECS = [
    ArimaSpec((1, 1, 1)),
    ArimaSpec((2, 0, 1), trend="ct"),
    ArimaSpec((1, 1, 1), (1, 1, 1, 12)),
    ArimaSpec((1, 0, 2), trend="c", long_ar=12),
]


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: f"{s.order}{s.seasonal_order}{s.trend}")
@pytest.mark.parametrize("layout", ["whole", "blocks"])
def test_two_stage_estimate(spark, spec, layout, monkeypatch):
    if layout == "blocks":
        import functools

        monkeypatch.setattr(arima, "lay_out", functools.partial(arima.lay_out, block_rows=40))
    series = random_series(4, 150, 2)
    params = arima.fit(to_panel(spark, series), spec, layout=layout)
    for uid, y in series.items():
        want, e = arma_by_hand(y, spec)
        got = row(params, uid)
        np.testing.assert_allclose([*got.trend_coef, *got.ar, *got.ma], want, rtol=1e-6)
        np.testing.assert_allclose(got.e_tail, e[::-1][: max(spec.ma_lags)], rtol=1e-6, atol=1e-8)
        np.testing.assert_allclose(got.y_tail, y[::-1][: spec.tail], rtol=1e-12)

    fc = arima.forecast(params, 5).where("unique_id = 's0'").orderBy("ds").toPandas()
    y = series["s0"]
    b, e = arma_by_hand(y, spec)
    k, p = len(spec.trend_terms), len(spec.ar_lags)
    d = np.array(spec.difference, float)
    ys, es, psi = list(y), list(e), [1.0]
    full = np.zeros(spec.recursion_lags + 1)
    ar = np.zeros(max(spec.ar_lags, default=0) + 1)
    ar[0] = 1
    for c, l in zip(b[k : k + p], spec.ar_lags):
        ar[l] = -c
    full = -np.convolve(ar, d)[1:]
    for h in range(1, 6):
        terms = [1.0 if t == "const" else len(y) + h for t in spec.trend_terms]
        v = b[:k] @ terms if k else 0.0
        v += sum(c * es[-l] for c, l in zip(b[k + p :], spec.ma_lags))
        v += full @ np.array(ys[::-1][: len(full)])
        ys.append(v)
        es.append(0.0)
        th = dict(zip(spec.ma_lags, b[k + p :]))
        psi.append(th.get(h, 0.0) + sum(full[i] * psi[h - 1 - i] for i in range(min(h, len(full)))))
    np.testing.assert_allclose(fc.yhat, ys[-5:], rtol=1e-6)
    half = 1.959963984540054 * np.sqrt(row(params, "s0").sigma2 * np.cumsum(np.square(psi[:5])))
    np.testing.assert_allclose(fc.yhat_upper - fc.yhat, half, rtol=1e-6)


def test_exog_is_fitted_padded_and_used(spark):
    rng = np.random.default_rng(5)
    x = {"a": rng.normal(size=80), "b": rng.normal(size=80)}
    y = {"a": 5 * x["a"] + np.cumsum(rng.normal(0, 0.01, 80)), "b": -2 * x["b"] + np.cumsum(rng.normal(0, 0.01, 80))}
    params = arima.fit(to_panel(spark, y, exog=x), ArimaSpec((0, 1, 0), exog_cols=("x",)))
    assert row(params, "a").beta[0] == pytest.approx(5, abs=0.01)
    assert row(params, "b").beta[0] == pytest.approx(-2, abs=0.01)
    future = to_panel(spark, {"a": [0.0] * 2, "b": [0.0] * 5}, "2021-09-01", exog={"a": [1, 2], "b": [1, 2, 3, 4, 5]})
    got = arima.forecast(params, 4, future).orderBy("unique_id", "ds").toPandas()
    level = {u: y[u][-1] - row(params, u).beta[0] * x[u][-1] for u in y}
    want = [level["a"] + row(params, "a").beta[0] * v for v in (1, 2, 2, 2)]
    want += [level["b"] + row(params, "b").beta[0] * v for v in (1, 2, 3, 4)]
    np.testing.assert_allclose(got.yhat, want, rtol=1e-9)
    with pytest.raises(ValueError):
        arima.forecast(params, 4)
    with pytest.raises(ValueError, match="b"):
        arima.forecast(params, 4, future.where("unique_id = 'a'"))


@pytest.mark.parametrize("spec", [ArimaSpec((2, 1, 0), trend="c"), ArimaSpec((1, 0, 0), trend="ct"), ArimaSpec((1, 1, 0), (1, 0, 0, 4))],
                         ids=lambda s: f"{s.order}{s.trend}")
def test_incremental_update_equals_fit_on_union(spark, spec):
    series = random_series(6, 50, 3)
    first = to_panel(spark, {u: y[:40] for u, y in series.items()})
    later = to_panel(spark, {u: series[u][40:] for u in ("s0", "s2")}, "2018-05-01")
    updated = arima.update_incremental(arima.fit(first, spec), later).toPandas().set_index("unique_id")
    full = arima.fit(first.unionByName(later), spec).toPandas().set_index("unique_id")
    for uid in series:
        for c in ("n_obs", "n_rows", "last_date"):
            assert updated.loc[uid, c] == full.loc[uid, c]
        for c in ("trend_coef", "ar", "sigma2", "y_tail"):
            np.testing.assert_allclose(updated.loc[uid, c], full.loc[uid, c], rtol=1e-6)


def test_state_update_keeps_coefficients_and_moves_shocks(spark):
    spec = ArimaSpec((1, 1, 1), trend="c")
    series = random_series(7, 90, 2)
    first = to_panel(spark, {u: y[:80] for u, y in series.items()})
    later = to_panel(spark, {u: y[80:] for u, y in series.items()}, "2021-09-01")
    fitted = arima.fit(first, spec)
    moved = arima.update_incremental(fitted, later, update_params=False)
    for uid, y in series.items():
        a, b = row(fitted, uid), row(moved, uid)
        assert (a.ar, a.ma, a.sigma2) == (b.ar, b.ma, b.sigma2)
        assert b.n_obs == 90 and str(b.last_date)[:10] == "2022-06-01"
        uc = np.diff(y) - a.centre[0]
        e = uc[-1] - np.dot(a.long_ar, uc[-9 : -1][::-1])
        assert b.e_tail[0] == pytest.approx(e, rel=1e-7)
    with pytest.raises(NotImplementedError):
        arima.update_incremental(fitted, later)


def test_refit_touches_only_updated_series(spark):
    spec = ArimaSpec((1, 1, 0))
    series = random_series(8, 50, 3)
    first = to_panel(spark, {u: y[:40] for u, y in series.items()})
    later = to_panel(spark, {"s1": series["s1"][40:]}, "2018-05-01")
    before = arima.fit(first, spec)
    params, history = arima.refit(before, first, later)
    full = arima.fit(first.unionByName(later), spec)
    assert history.count() == 130 and params.count() == 3
    assert row(params, "s0").ar == row(before, "s0").ar
    np.testing.assert_allclose(row(params, "s1").ar, row(full, "s1").ar, rtol=1e-9)
    with pytest.raises(ValueError, match="zz"):
        arima.refit(before, first, to_panel(spark, {"zz": [1.0, 2.0]}))


def test_short_and_constant_series_keep_their_rows(spark):
    series = {"one": [5.0], "two": [5.0, 6.0], "flat": [4.0] * 40}
    params = arima.fit(to_panel(spark, series), ArimaSpec((1, 1, 1)))
    fc = arima.forecast(params, 2).orderBy("unique_id", "ds").toPandas()
    assert len(fc) == 6
    assert fc[fc.unique_id == "flat"].yhat.tolist() == [4.0, 4.0]
    assert fc[fc.unique_id == "two"].yhat.tolist() == [6.0, 6.0]
    assert fc[fc.unique_id == "one"].yhat.isna().all()


def test_models_fit_predict_update(spark):
    series = random_series(10, 60, 2)
    first = to_panel(spark, {u: y[:50] for u, y in series.items()})
    later = to_panel(spark, {u: y[50:] for u, y in series.items()}, "2019-03-01")
    full = first.unionByName(later)

    model = SarimaModel((1, 1, 0), (0, 0, 0, 0)).fit(first)
    want = arima.forecast(arima.fit(full, ArimaSpec((1, 1, 0))), 3)
    got = model.update(later).predict(3)
    assert got.columns == ["unique_id", "ds", "yhat", "yhat_lower", "yhat_upper"]
    pd.testing.assert_frame_equal(got.toPandas().sort_values(["unique_id", "ds"], ignore_index=True),
                                  want.toPandas().sort_values(["unique_id", "ds"], ignore_index=True))
    with pytest.raises(NotImplementedError):
        model.update(later, refit=False)
    with pytest.raises(ValueError):
        ArimaModel().predict(1)

    for order in ((1, 1, 0), (1, 1, 1)):
        got = ArimaModel(order).fit(first, fh=2).update(later).predict()
        want = ArimaModel(order).fit(full).predict(2)
        assert got.columns == ["unique_id", "ds", "yhat"]
        np.testing.assert_allclose(
            got.orderBy("unique_id", "ds").toPandas().yhat, want.orderBy("unique_id", "ds").toPandas().yhat, rtol=1e-7
        )


def test_empty_panel_gives_an_empty_forecast(spark):
    params = arima.fit(to_panel(spark, {"a": [1.0, 2.0]}).where("y > 5"), ArimaSpec((1, 0, 0)))
    got = arima.forecast(params, 3)
    assert got.columns == ["unique_id", "ds", "yhat", "yhat_lower", "yhat_upper"] and got.count() == 0


def test_spec_checks():
    with pytest.raises(ValueError):
        ArimaSpec(trend="x")
    with pytest.raises(ValueError):
        ArimaSpec((1, 0, 0), (1, 0, 0, 0))
    spec = ArimaSpec((1, 1, 1), (1, 1, 1, 12), "ct", ("x",))
    assert ArimaSpec.from_json(spec.to_json()) == spec
    assert spec.ar_lags == [1, 12, 13] and spec.span == 13


def test_no_interval_without_spare_rows(spark):
    """Three rows for four coefficients fit without error; that is no certainty."""
    df = to_panel(spark, {"a": [float(i * i % 7) for i in range(6)]})
    params = arima.fit(df, ArimaSpec((3, 0, 0), trend="c"), freq="MS", layout="whole")
    assert params.first().sigma2 is None
    got = arima.forecast(params, 2).collect()
    assert len(got) == 2 and all(r.yhat is not None and r.yhat_lower is None and r.yhat_upper is None for r in got)
