"""Calendar, joins, sums, measures, splits, cross-validation and scaling on small frames with edge cases."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from seriesmill.functions.calendar import create_time_features, ensure_datetime, series_date_columns
from seriesmill.functions.scalars import divide, expm1, log1p, nan_to_null, round_half_even
from seriesmill.operators import metrics as m
from seriesmill.operators.aggregate import aggregate_sales
from seriesmill.operators.cross_validation import cv_least_squares, cv_line, cv_training_mean, score_summary, time_series_cv
from seriesmill.operators.enrich import enrich_product_transaction, left_merge
from seriesmill.operators.scaling import extract_subsequences, fit_min_max, scale_min_max, unscale_min_max
from seriesmill.operators.split import POSITION, expanding_folds, fold_bounds, time_series_split, train_val_test_split, with_split_label

INF, NAN = math.inf, math.nan


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


# --- calendar and scalars -------------------------------------------------------------------------


def test_calendar_edges(spark):
    text = ["2021-01-03 23:30:00", "2020-02-29 05:00:00", "2021-10-01 00:00:00", "2021-10-02 00:00:00"]
    df = spark.createDataFrame([(t,) for t in text], "order_date string")
    got = create_time_features(df).toPandas()
    want = pd.to_datetime(pd.Series(text))
    assert got.week.tolist() == want.dt.isocalendar().week.tolist() == [53, 9, 39, 39]
    assert got.weekday.tolist() == want.dt.weekday.tolist()
    assert got.hour.tolist() == [23, 5, 0, 0]
    assert got.is_month_end.tolist() == want.dt.is_month_end.astype(int).tolist() == [0, 1, 0, 0]
    assert got.is_month_start.tolist() == [0, 0, 1, 0]
    assert got.is_weekend.tolist() == [1, 1, 0, 1]
    assert got.month_number.tolist() == [13, 2, 22, 22]
    weekend = ensure_datetime(df, "order_date").select(series_date_columns("order_date")["is_wknd"])
    assert [r[0] for r in weekend.collect()] == (want.dt.weekday // 4).tolist() == [1, 1, 1, 1]


def test_missing_date_has_zero_flags(spark):
    got = create_time_features(spark.createDataFrame([(None,), ("2020-01-01",)], "order_date string")).orderBy("order_date").first()
    assert (got.year, got.yearmonth, got.is_weekend, got.is_month_start, got.is_month_end) == (None, None, 0, 0, 0)


def test_text_that_is_no_date_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ensure_datetime(spark.createDataFrame([("soon",)], "order_date string")).collect()


def test_scalars(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (0.0,), (None,)], "x double")
    got = values(df, log1p("x"))
    assert got[0] == -INF and math.isnan(got[1]) and got[2] == 0 and got[3] is None
    assert values(df, expm1("x"))[2] == 0
    pairs = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, 2.0), (None, 0.0)], "a double, b double")
    got = values(pairs, divide(F.col("a"), F.col("b")))
    assert got[:2] == [INF, -INF] and math.isnan(got[2]) and got[3:] == [0.5, None]
    ties = spark.createDataFrame([(0.125,), (2.675,), (1.005,), (-0.125,)], "x double")
    assert values(ties, round_half_even("x", 2)) == [0.12, 2.68, 1.0, -0.12]
    assert values(nan_to_null(spark.createDataFrame([(NAN,), (1.0,)], "x double")), "x") == [None, 1.0]


# --- joins and sums -------------------------------------------------------------------------------


def test_left_merge_matches_missing_keys_and_fans_out(spark):
    fact = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "product_id int, name string")
    dim = spark.createDataFrame([(1, 10, "x"), (None, 20, "y"), (1, 11, "z")], "product_id int, v int, name string")
    got = enrich_product_transaction(fact, dim)
    assert got.columns == ["product_id", "name_x", "v", "name_y"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(1, "a", 10, "x"), (1, "a", 11, "z"), (None, "b", 20, "y"), (3, "c", None, None)], key=str
    )
    with pytest.raises(ValueError, match="not unique"):
        left_merge(fact, dim, "product_id", unique=True)


def test_joins_carry_no_broadcast_hint(spark):
    fact = spark.range(10).withColumnRenamed("id", "product_id")
    plan = enrich_product_transaction(fact, fact.withColumn("v", F.lit(1)))._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()


def sales(spark):
    rows = [
        ("a", dt.datetime(2021, 1, 31, 9), 1.0), ("a", dt.datetime(2021, 2, 1), 2.0), ("a", dt.datetime(2021, 2, 7), NAN),
        ("b", dt.datetime(2021, 2, 7), None), (None, dt.datetime(2021, 2, 7), 9.0), ("b", None, 9.0),
    ]
    return spark.createDataFrame(rows, "g string, order_date timestamp_ntz, sales_amount double")


def test_aggregate_sales_by_month(spark):
    got = aggregate_sales(sales(spark), group_cols=["g"]).orderBy("g", "period").collect()
    assert [tuple(r) for r in got] == [
        ("a", dt.date(2021, 1, 1), 1.0, "2021-01"), ("a", dt.date(2021, 2, 1), 2.0, "2021-02"), ("b", dt.date(2021, 2, 1), 0.0, "2021-02"),
    ]


def test_aggregate_sales_by_week_and_date_and_total(spark):
    weeks = aggregate_sales(sales(spark), group_cols=["g"], freq="w").orderBy("g", "period").collect()
    assert [(r.period, r.sales_amount, r.yearmonth) for r in weeks][:2] == [
        (dt.date(2021, 1, 25), 1.0, "2021-01"), (dt.date(2021, 2, 1), 2.0, "2021-02"),
    ]
    assert aggregate_sales(sales(spark), group_cols=["g"], freq="D").count() == 4
    total = aggregate_sales(sales(spark)).orderBy("period").collect()
    assert [(r.period, r.sales_amount) for r in total] == [(dt.date(2021, 1, 1), 1.0), (dt.date(2021, 2, 1), 11.0)]


# --- measures -------------------------------------------------------------------------------------


def pairs(spark, *rows):
    return spark.createDataFrame([(a, p) for a, p in rows], "a double, p double")


def measure(df, fn, **kw):
    return df.agg(fn("a", "p", **kw)).first()[0]


def test_measures(spark):
    rng = np.random.default_rng(0)
    a, p = rng.normal(10, 3, 50), rng.normal(10, 3, 50)
    df = pairs(spark, *zip(a.tolist(), p.tolist()))
    e = a - p
    want = {
        m.mae: np.abs(e).mean(), m.mse: (e**2).mean(), m.rmse: np.sqrt((e**2).mean()), m.mape: np.abs(e / a).mean() * 100,
        m.mape_eps: np.abs(e / (a + 1e-9)).mean() * 100, m.r2: 1 - (e**2).sum() / ((a - a.mean()) ** 2).sum(),
    }
    for fn, value in want.items():
        assert measure(df, fn) == pytest.approx(value, rel=1e-12)


def test_measure_edges(spark):
    assert measure(pairs(spark, (0.0, 1.0), (1.0, 1.0)), m.mape) == INF
    assert measure(pairs(spark, (0.0, 1.0), (1.0, 1.0)), m.mape_eps) == pytest.approx(5e10)
    assert measure(pairs(spark, (2.0, 2.0), (2.0, 2.0)), m.r2) == 1
    assert measure(pairs(spark, (2.0, 2.0), (2.0, 3.0)), m.r2) == 0
    assert measure(pairs(spark, (2.0, 2.0)), m.r2) is None
    gap = pairs(spark, (1.0, 2.0), (None, 1.0))
    assert measure(gap, m.mae) is None
    assert measure(gap, m.mae, strict=False) == 1


def test_regressor_report_rounds_like_its_source(spark):
    df = pairs(spark, (1.0, 1.3), (2.0, 1.9), (4.0, 4.25))
    got = m.evaluate_regressor(df, "a", "p", "line").first()
    mse = round((0.3**2 + 0.1**2 + 0.25**2) / 3, 4)
    assert (got.Model, got.MSE, got.RMSE) == ("line", mse, round(math.sqrt(mse), 4))
    assert got.MAE == round((0.3 + 0.1 + 0.25) / 3, 4)


def test_residual_table_and_histogram(spark):
    df = pairs(spark, (1.005, 1.0), (2.0, 3.0), (5.0, 1.0))
    assert sorted(r.Residual for r in m.compare_actual_predicted(df, "a", "p").collect()) == [0.0, 1.0, 4.0]
    bins = m.residual_distribution(df, "a", "p", 5).orderBy("bin").collect()
    assert [(r.bin, r.rows) for r in bins] == [(0, 1), (1, 1), (4, 1)]
    assert sum(r.density for r in bins) == pytest.approx(1.0)
    flat = m.residual_distribution(pairs(spark, (1.0, 1.0), (2.0, 2.0)), "a", "p", 5).collect()
    assert [(r.bin, r.rows) for r in flat] == [(0, 2)]


# --- splits and cross-validation --------------------------------------------------------------------


def test_cutoff_split_leaves_out_missing_dates(spark):
    df = sales(spark)
    train, test = time_series_split(df, "2021-02-01", "order_date")
    assert (train.count(), test.count()) == (1, 4)
    assert with_split_label(df, "2021-02-01", "order_date").where("split IS NULL").count() == 1


def test_cutoff_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = time_series_split(orders, "2000-01-01", "o_orderdate")[0]._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate" in plan


def test_fold_bounds():
    assert [(f.train_end, f.val_start, f.val_end) for f in fold_bounds(80)] == [
        (15, 15, 28), (28, 28, 41), (41, 41, 54), (54, 54, 67), (67, 67, 80)
    ]
    assert [(f.train_end, f.val_start, f.val_end) for f in fold_bounds(10, 2, 3, 1)] == [(3, 4, 7), (6, 7, 10)]
    for bad in [(5, 5, None, 0), (10, 2, 5, 0), (10, 2, 4, 2)]:
        with pytest.raises(ValueError):
            fold_bounds(*bad)


def test_folds_are_disjoint_and_ordered(spark):
    df = spark.range(47).select((46 - F.col("id")).alias("t")).repartition(5)
    rows = expanding_folds(df, ["t"], 4, gap=2).labelled().toPandas()
    for _, fold in rows.groupby("fold"):
        train, val = fold[fold.role == "train"], fold[fold.role == "val"]
        assert train.t.max() + 3 == val.t.min() and train.t.min() == 0
        assert (fold.t == fold[POSITION]).all()


def test_train_val_test_fractions(spark):
    got = train_val_test_split(spark.range(100), ["id"]).groupBy("split").agg(F.min("id"), F.max("id")).collect()
    assert {tuple(r) for r in got} == {("train", 0, 69), ("val", 70, 84), ("test", 85, 99)}


def by_hand(pdf, predict, n_splits):
    scores = []
    for f in fold_bounds(len(pdf), n_splits):
        train, val = pdf.iloc[: f.train_end], pdf.iloc[f.val_start : f.val_end]
        scores.append(np.sqrt(np.mean((val.y - predict(train, val)) ** 2)))
    return scores


def test_cross_validation_scores(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"t": range(60), "x": rng.normal(size=60)})
    pdf["y"] = 3 * pdf.x + rng.normal(size=60) + 1000
    df = spark.createDataFrame(pdf).repartition(4)

    def line(train, val):
        b, a = np.polyfit(train.x, train.y, 1)
        return a + b * val.x

    want_line = by_hand(pdf, line, 4)
    want_mean = by_hand(pdf, lambda tr, va: tr.y.mean(), 4)
    folds = expanding_folds(df, ["t"], 4)
    np.testing.assert_allclose(values(cv_line(folds, "y", "x").orderBy("fold"), "rmse"), want_line, rtol=1e-9)
    np.testing.assert_allclose(values(cv_training_mean(folds, "y").orderBy("fold"), "rmse"), want_mean, rtol=1e-9)
    fitted = time_series_cv(df, LinearRegression(solver="normal"), "y", ["t"], features=["x"], n_splits=4)
    np.testing.assert_allclose(values(fitted.orderBy("fold"), "rmse"), want_line, rtol=1e-6)
    summary = score_summary(fitted).first()
    assert summary.mean_score == round(np.mean(want_line), 4) and summary.std_score == round(np.std(want_line), 4)


@pytest.mark.parametrize("log", [False, True])
def test_least_squares_folds_equal_a_fit_per_fold(spark, log):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1.0, (90, 2))
    y = 0.2 * (x[:, 0] - 1e6) - 0.3 * (x[:, 1] - 1e6) + rng.normal(3, 0.1, 90)
    cells = [(t, float(y[t]), float(x[t, 0]), float(x[t, 1]), float(2 * x[t, 0])) for t in range(90)]
    cells[7] = (7, None, *cells[7][2:])
    cells[85] = (*cells[85][:2], NAN, *cells[85][3:])
    df = spark.createDataFrame(cells, "t int, y double, `a.b` double, c double, twice double")
    folds = expanding_folds(df, ["t"], 4, 15, 3)
    got = values(cv_least_squares(folds, "y", ["a.b", "c", "twice"], log).orderBy("fold"), "rmse")
    back = np.expm1 if log else (lambda v: v)
    use = np.array([t not in (7, 85) for t in range(90)])
    design = np.column_stack([np.ones(90), x - 1e6])
    for f, score in zip(folds.bounds, got):
        at = np.arange(90)
        train, val = use & (at < f.train_end), use & (at >= f.val_start) & (at < f.val_end)
        beta = np.linalg.lstsq(design[train], y[train], rcond=None)[0]
        want = np.sqrt(np.mean((back(y[val]) - back(design[val] @ beta)) ** 2))
        np.testing.assert_allclose(score, want, rtol=1e-6)


def test_least_squares_folds_without_usable_rows_and_scans(spark, tmp_path):
    spark.range(12).selectExpr("id AS t", "cast(null AS double) AS y", "id AS x").write.parquet(str(tmp_path / "t"))
    scores = cv_least_squares(expanding_folds(spark.read.parquet(str(tmp_path / "t")), ["t"], 3), "y", ["x"])
    assert [tuple(r) for r in scores.orderBy("fold").collect()] == [(0, None), (1, None), (2, None)]
    assert scores._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2  # the rows, and their offsets


def test_cross_validation_of_a_function_on_log_scale(spark):
    df = spark.range(30).selectExpr("id AS t", "ln(1 + cast(id AS double)) AS y")
    zero = lambda train, val: val.withColumn("prediction", F.lit(0.0))
    got = values(time_series_cv(df, zero, "y", ["t"], n_splits=2, log=True).orderBy("fold"), "rmse")
    np.testing.assert_allclose(got, [np.sqrt(np.mean(np.arange(a, a + 10.0) ** 2)) for a in (10, 20)])


# --- scaling --------------------------------------------------------------------------------------


def test_min_max_and_back(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, k double")
    scaler = fit_min_max(df, ["a", "k"])
    scaled = scale_min_max(df, scaler, ["a", "k"])
    assert [tuple(r) for r in scaled.collect()] == [(0.0, 0.0), (1.0, 0.0), (0.5, 0.0)]
    assert values(unscale_min_max(scaled, scaler, {"a": "a"}), "a") == [1.0, 3.0, 2.0]


@pytest.mark.parametrize("layout", ["whole", "blocks"])
def test_subsequences(spark, layout):
    df = spark.range(6).selectExpr("id AS t", "cast(id AS double) AS a", "cast(id * 10 AS double) AS b")
    got = extract_subsequences(df, ["a", "b"], "a", 2, ["t"], layout=layout).orderBy("t").collect()
    assert len(got) == 4
    assert got[0].subsequence == [[0.0, 0.0], [1.0, 10.0]] and got[0].next_target == 2.0


def test_residual_density_is_a_kernel_density(spark):
    rng = np.random.default_rng(3)
    r = np.concatenate([rng.normal(0, 1, 300), rng.normal(5, 0.5, 100)])
    df = spark.createDataFrame([(float(v), 0.0) for v in r] + [(None, 1.0)], "a double, f double")
    got = m.residual_density(df, "a", "f", 400).orderBy("point").toPandas()
    h = r.std(ddof=1) * len(r) ** -0.2
    want = np.exp(-0.5 * ((got["x"].to_numpy()[:, None] - r) / h) ** 2).sum(axis=1) / (len(r) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(got["density"], want, atol=2e-3 * want.max())
    assert (got["density"] * (got["x"][1] - got["x"][0])).sum() == pytest.approx(1, abs=1e-3)
    for few in ([(1.0, 0.0)], [(2.0, 1.0)] * 3, []):
        assert m.residual_density(spark.createDataFrame(few, "a double, f double"), "a", "f").count() == 0
