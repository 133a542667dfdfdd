"""The exact likelihood against multivariate normal densities, and models fitted by it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.forecasting import arima, likelihood
from seriesmill.forecasting.arima import ArimaSpec
from seriesmill.forecasting.dates import fill_dates, given_frequency
from seriesmill.forecasting.models import ArimaModel, SarimaModel


def covariances(ar, ma, n):
    psi = [1.0]
    for k in range(1, 4000):
        psi.append((ma[k - 1] if k <= len(ma) else 0.0) + sum(a * psi[k - 1 - j] for j, a in enumerate(ar) if j < k))
    psi = np.array(psi)
    return np.array([psi[: len(psi) - h] @ psi[h:] for h in range(n)])


@pytest.mark.parametrize(
    "ar, ma, holes", [([], [], [2]), ([0.7], [], []), ([0.5, -0.3], [0.4], [3, 4, 11, 29]), ([], [0.2, 0, 0.9], [0]), ([0, 0, 0.8], [-0.9], [7])]
)
def test_likelihood_of_a_multivariate_normal(ar, ma, holes):
    n, sigma2 = 30, 1.7
    s = sigma2 * covariances(ar, ma, n)[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    y = np.random.default_rng(4).multivariate_normal(np.zeros(n), s)
    y[holes] = np.nan
    k = ~np.isnan(y)
    s, v = s[np.ix_(k, k)], y[k]
    want = -0.5 * (k.sum() * np.log(2 * np.pi) + np.linalg.slogdet(s)[1] + v @ np.linalg.solve(s, v))
    got = likelihood.log_likelihood(y[None], np.array([ar]), np.array([ma]), np.array([sigma2]))
    assert got[0] == pytest.approx(want, rel=1e-9)


def test_products_of_polynomials():
    phi, big = np.array([[0.5, 0.2]]), np.array([[0.3]])
    assert likelihood.multiplied(phi, big, 4, -1)[0] == pytest.approx([0.5, 0.2, 0, 0.3, -0.15, -0.06])
    assert likelihood.multiplied(phi, big, 4, 1)[0] == pytest.approx([0.5, 0.2, 0, 0.3, 0.15, 0.06])


def test_estimates_are_the_best_near_by():
    rng = np.random.default_rng(5)
    e = rng.normal(size=(3, 200))
    w = np.zeros_like(e)
    for t in range(13, 200):
        w[:, t] = 0.6 * w[:, t - 1] + e[:, t] - 0.5 * e[:, t - 12]
    w[1, 50:60] = np.nan
    arma = likelihood.Arma((1, 0, 0), (0, 0, 1, 12), ())
    found = arma.fit(w, np.arange(1.0, 201)[None].repeat(3, 0))
    assert found["ar"][:, 0] == pytest.approx([0.6] * 3, abs=0.2) and found["ma"][:, 11] == pytest.approx([-0.5] * 3, abs=0.25)
    best = likelihood.log_likelihood(w, found["ar"], found["ma"], found["sigma2"])
    assert best == pytest.approx(found["loglik"], rel=1e-9)
    for da, dm in ((0.02, 0), (-0.02, 0), (0, 0.02), (0, -0.02)):
        ma = found["ma"].copy()
        ma[:, 11] += dm
        assert (likelihood.log_likelihood(w, found["ar"] + da, ma, found["sigma2"]) < best).all()


def panel_of(spark, values):
    rows = [(s, t, None if v is None or np.isnan(v) else float(v)) for s, y in values.items() for t, v in enumerate(y)]
    return spark.createDataFrame(rows, "unique_id string, k int, y double").select(
        "unique_id", F.expr("cast(add_months(date'2020-01-01', k) AS timestamp_ntz)").alias("ds"), "y"
    )


def test_fit_skips_holes_and_short_series(spark):
    rng = np.random.default_rng(6)
    y = np.cumsum(rng.normal(1, 1, 80))
    holed = y.copy()
    holed[[10, 11, 40, 79]] = np.nan
    panel = panel_of(spark, {"a": y, "b": holed, "c": [1.0, 2.0], "d": [None, None], "e": [3.0]})
    spec = ArimaSpec((0, 1, 0), trend="c", estimator="likelihood")
    got = {r.unique_id: r for r in arima.fit(panel, spec, freq="MS").collect()}
    assert got["a"].trend_coef[0] == pytest.approx((y[-1] - y[0]) / 79, rel=1e-6)
    assert got["a"].sigma2 == pytest.approx(np.diff(y).var(), rel=1e-6)
    seen = np.diff(holed)
    assert got["b"].n_rows == (~np.isnan(seen)).sum() and got["b"].trend_coef[0] == pytest.approx(np.nanmean(seen), rel=1e-6)
    assert got["b"].y_tail[0] == pytest.approx(holed[78] + np.nanmean(seen), rel=1e-6)  # the last value is missing: its prediction
    assert got["c"].sigma2 is None and got["d"].sigma2 is None and got["e"].n_obs == 1
    paths = arima.forecast(arima.fit(panel, spec, freq="MS"), 2).orderBy("unique_id", "ds").collect()
    assert len(paths) == 10 and paths[0].yhat == pytest.approx(y[-1] + (y[-1] - y[0]) / 79, rel=1e-6)


def test_seasonal_model_beats_naive_on_noise_with_a_season(spark):
    rng = np.random.default_rng(7)
    season = np.tile(rng.normal(0, 2, 12), 7)
    series = {f"s{i}": 50 + season + rng.normal(0, 1, 84) for i in range(4)}
    train = panel_of(spark, {k: v[:72] for k, v in series.items()})
    got = SarimaModel().fit(train, freq="MS").predict(12).orderBy("unique_id", "ds").toPandas()
    truth = np.concatenate([series[f"s{i}"][72:] for i in range(4)])
    naive = np.concatenate([series[f"s{i}"][60:72] for i in range(4)])
    assert np.sqrt(((got["yhat"] - truth) ** 2).mean()) < 0.9 * np.sqrt(((naive - truth) ** 2).mean())
    assert got["yhat"].between(got["yhat_lower"], got["yhat_upper"]).all()


def test_update_of_a_likelihood_model_fits_again(spark):
    y = {"a": np.cumsum(np.random.default_rng(8).normal(0, 1, 40))}
    first, later = (panel_of(spark, y).where(c) for c in ("ds < '2023-01-01'", "ds >= '2023-01-01'"))
    got = ArimaModel((1, 1, 0), estimator="likelihood").fit(first, freq="MS").update(later).predict(3).orderBy("ds").collect()
    want = ArimaModel((1, 1, 0), estimator="likelihood").fit(panel_of(spark, y), freq="MS").predict(3).orderBy("ds").collect()
    assert [r.yhat for r in got] == pytest.approx([r.yhat for r in want])


def test_update_with_late_rows_fits_those_series_again(spark):
    rng = np.random.default_rng(9)
    y = {"a": rng.normal(0, 1, 40).cumsum(), "b": rng.normal(0, 1, 40).cumsum()}
    whole = panel_of(spark, y)
    held = (F.col("unique_id") == "b") & (F.month("ds") == 5) | (F.col("ds") >= "2023-01-01")
    for change in (True, False):
        model = ArimaModel((1, 1, 0)).fit(whole.where(~held), freq="MS").update(whole.where(held), update_params=change)
        want = {r.unique_id: r.yhat for r in ArimaModel((1, 1, 0)).fit(whole, freq="MS").predict(1).collect()}
        got = {r.unique_id: r.yhat for r in model.predict(1).collect()}
        assert got["b"] == pytest.approx(want["b"])
        assert (got["a"] == pytest.approx(want["a"])) is change


def test_filled_dates_and_unknown_frequencies(spark):
    panel = panel_of(spark, {"a": [1.0, 2.0, 3.0, 4.0], "b": [1.0]}).where("NOT (unique_id = 'a' AND k_ IN (1, 2))".replace("k_", "month(ds) - 1"))
    got = [(r.unique_id, r.ds.month, r.y) for r in fill_dates(panel, "MS").orderBy("unique_id", "ds").collect()]
    assert got == [("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, 4.0), ("b", 1, 1.0)]
    for name in ("BME", "SMS", "nonsense", "1 day"):
        with pytest.raises(ValueError):
            given_frequency(name)


def test_filled_dates_and_arrays_take_one_shuffle(spark, monkeypatch):
    days = ["2024-01-31", "2024-03-31", "2024-03-31", "2024-04-15", "2024-07-31", None]
    rows = [(i, None if d is None else f"{d} 06:30:00", float(n)) for i in ("a", None) for n, d in enumerate(days)] + [("b", "2024-05-01 00:00:00", 9.0)]
    for kind in ("timestamp", "timestamp_ntz"):
        panel = spark.createDataFrame(rows, "unique_id string, d string, y double").select("unique_id", F.col("d").cast(kind).alias("ds"), "y")
        for freq, each in (("MS", "interval '1' month"), ("2MS", "interval '2' month"), ("D", "interval '1' day"), ("5h", "interval '5' hour"), ("QS", "interval '3' month")):
            panel.where("ds IS NOT NULL").createOrReplaceTempView("known_panel")
            spark.sql(f"""SELECT unique_id, explode(sequence(min(ds), max(ds), {each})) AS ds FROM known_panel GROUP BY 1""").createOrReplaceTempView("grid_panel")
            want = spark.sql("""SELECT g.unique_id, g.ds, y FROM grid_panel g LEFT JOIN known_panel k ON g.unique_id = k.unique_id AND g.ds = k.ds
                UNION ALL SELECT k.* FROM known_panel k LEFT ANTI JOIN grid_panel g ON g.unique_id = k.unique_id AND g.ds = k.ds""")
            assert sorted(fill_dates(panel, freq).collect(), key=str) == sorted(want.collect(), key=str), (kind, freq)
    frames = []
    monkeypatch.setattr(likelihood, "materialize", lambda df, label: frames.append(df) or df)
    got = likelihood.series_arrays(fill_dates(panel, "MS"), "unique_id", "y", ["ds"])
    assert {r.unique_id: r["values"] for r in got.collect()}["a"] == [0.0, None, 1.0, 2.0, 3.0, None, None, None, 4.0]
    assert str(frames[0]._jdf.queryExecution().sparkPlan()).count("Join") == 0
    assert str(frames[0]._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning") == 1


def test_long_series_are_refused(spark, monkeypatch):
    monkeypatch.setattr(likelihood, "MAX_ROWS", 10)
    with pytest.raises(ValueError, match="two-stage"):
        SarimaModel().fit(panel_of(spark, {"a": np.arange(20.0)}), freq="MS")
