"""Window features against pandas, in both layouts, on random panels with missing values and null keys."""

import numpy as np
import pandas as pd
import pytest
from pandas._libs.window.aggregations import roll_weighted_mean, roll_weighted_var
from pyspark.sql import functions as F

from seriesmill.operators.features import (
    add_diff_features, add_lag_features, add_rolling_features, create_time_series_features, prepare_features,
)
from seriesmill.operators.layout import lay_out, number_rows
from seriesmill.operators.metrics import evaluate_result_forecast
from seriesmill.operators.scaling import fit_min_max, scale_min_max
from seriesmill.operators.weighted import WINDOWS, rolling_weights


def panel(seed=0, lengths=(120, 40, 7, 1), missing=0.2):
    rng = np.random.default_rng(seed)
    parts = []
    for i, n in enumerate(lengths):
        y = rng.normal(100, 30, n).round(3)
        y[rng.random(n) < missing] = np.nan
        if n > 20:
            y[5:18] = np.nan
        parts.append(pd.DataFrame({"g": f"s{i}", "t": np.arange(n), "y": y}))
    parts.append(pd.DataFrame({"g": None, "t": np.arange(5), "y": 1.0}))
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, pdf):
    rows = [tuple(None if (isinstance(v, float) and np.isnan(v)) else v for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "g string, t int, y double").repartition(4)


def with_small_blocks(monkeypatch, size):
    import seriesmill.operators.features as feat

    monkeypatch.setattr(feat, "lay_out", lambda df, g, o, *_: lay_out(df, g, o, "blocks", size))


def same(got, want):
    np.testing.assert_allclose(
        got.astype(float).to_numpy(), want.astype(float).to_numpy(), rtol=1e-9, atol=1e-9, equal_nan=True
    )


LAYOUTS = ["whole", 4, 17, 1000]


def use(monkeypatch, layout):
    if layout != "whole":
        with_small_blocks(monkeypatch, layout)
    return "whole"


@pytest.mark.parametrize("layout", LAYOUTS)
def test_prepare_features_equals_pandas(spark, monkeypatch, layout):
    mode = use(monkeypatch, layout)
    pdf = panel()
    pdf["d"] = pd.Timestamp("2020-01-30") + pd.to_timedelta(pdf.t * 9, unit="D")
    sdf = to_spark(spark, pdf[["g", "t", "y"]]).withColumn(
        "d", (F.lit("2020-01-30").cast("date") + F.col("t") * 9).cast("timestamp_ntz")
    )
    got = prepare_features(sdf, "y", ["g"], date_col="d", order_by=["t"], layout=mode).toPandas()
    got = got.sort_values(["g", "t"], na_position="last").reset_index(drop=True)
    want = pdf.sort_values(["g", "t"], na_position="last").reset_index(drop=True)
    by = want.groupby("g")["y"]
    for k in (1, 3, 6):
        same(got[f"y_lag{k}"], by.shift(k))
    for w in (3, 6, 12):
        same(got[f"y_rolling_mean_{w}"], by.transform(lambda x: x.shift(1).rolling(w).mean()))
        same(got[f"y_rolling_std_{w}"], by.transform(lambda x: x.shift(1).rolling(w).std()))
    for p in (1, 12):
        same(got[f"y_diff_{p}"], by.diff(p))
        same(got[f"y_pct_change_{p}"], by.transform(lambda x: x.ffill().pct_change(p, fill_method=None)))
    d = want["d"].dt
    same(got["week"], d.isocalendar().week)
    same(got["weekday"], d.weekday)
    same(got["is_month_end"], d.is_month_end)
    same(got["month_number"], (d.year - d.year.min()) * 12 + d.month)
    same(got["weekday_cos"], np.cos(2 * np.pi * d.weekday / 7))
    assert (got["yearmonth"] == d.to_period("M").astype(str)).all()


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("min_periods", [None, 1, 2])
def test_time_series_features_equal_pandas(spark, monkeypatch, layout, min_periods):
    mode = use(monkeypatch, layout)
    pdf = panel(1, (400, 90, 3))
    got = create_time_series_features(
        to_spark(spark, pdf), "y", to_sort="t", to_group="g", lags=[1, 4], windows=[3, 6], weights=[0.95, 0.5, 0.01, 1.0],
        min_periods=min_periods, date_related=False, lag=True, roll=True, ewm=True,
        roll_mean=True, roll_std=True, roll_min=True, roll_max=True, layout=mode,
    ).toPandas().sort_values(["g", "t"], na_position="last").reset_index(drop=True)
    want = pdf.sort_values(["g", "t"], na_position="last").reset_index(drop=True)
    by = want.groupby("g")["y"]
    for k in (1, 4):
        same(got[f"sales_lag_{k}"], by.shift(k))
        for a in (0.95, 0.5, 0.01, 1.0):
            same(got[f"sales_ewm_w_{a}_lag_{k}"], by.transform(lambda x: x.shift(k).ewm(alpha=a).mean()))
    for w in (3, 6):
        for agg in ("mean", "std", "min", "max"):
            want_col = by.transform(lambda x: getattr(x.shift(1).rolling(w, min_periods=min_periods), agg)())
            same(got[f"sales_roll_{agg}_{w}"], want_col)


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("min_periods", [None, 2])
def test_wide_windows_equal_pandas(spark, monkeypatch, layout, min_periods):
    mode = use(monkeypatch, layout)
    pdf = panel(4, (700, 131, 64, 1))
    pdf["y"] = pdf["y"] + 1e7  # far from zero: sums of squares would lose the spread
    got = create_time_series_features(
        to_spark(spark, pdf), "y", to_sort="t", to_group="g", windows=[5, 64, 130, 1000], min_periods=min_periods,
        date_related=False, roll=True, roll_mean=True, roll_std=True, roll_min=True, roll_max=True, layout=mode,
    ).toPandas().sort_values(["g", "t"], na_position="last").reset_index(drop=True)
    assert [c for c in got.columns if c.startswith("__")] == []
    want = pdf.sort_values(["g", "t"], na_position="last").reset_index(drop=True)
    by = want.groupby("g")["y"]
    for w in (5, 64, 130, 1000):
        for agg in ("mean", "std", "min", "max"):
            roll = by.transform(lambda x: getattr(x.shift(1).rolling(w, min_periods=min_periods), agg)())
            np.testing.assert_allclose(got[f"sales_roll_{agg}_{w}"].astype(float), roll, rtol=1e-9 if agg != "std" else 1e-5)


def test_wide_windows_of_whole_features_infinities_and_shuffles(spark):
    y = np.random.default_rng(1).normal(size=300)
    y[100] = np.inf
    pdf = pd.DataFrame({"g": "a", "t": np.arange(300), "y": y})
    out = add_rolling_features(to_spark(spark, pdf), "y", ["g"], [64], ["t"], "whole")
    got = out.toPandas().sort_values("t").reset_index(drop=True)
    assert np.isinf(got.y_rolling_mean_64[101:165]).all()
    rest = np.r_[64:101, 165:300]
    np.testing.assert_allclose(got.y_rolling_mean_64[rest], [y[i - 64 : i].mean() for i in rest], rtol=1e-9)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_ewm_carries_over_a_gap_longer_than_its_reach(spark, monkeypatch):
    with_small_blocks(monkeypatch, 10)
    y = np.r_[3.0, 5.0, np.full(200, np.nan), 7.0]
    pdf = pd.DataFrame({"g": "a", "t": np.arange(len(y)), "y": y})
    got = create_time_series_features(
        to_spark(spark, pdf), "y", "t", "g", lags=[1], weights=[0.95], date_related=False, ewm=True
    ).toPandas().sort_values("t")
    same(got["sales_ewm_w_0.95_lag_1"], pdf.y.shift(1).ewm(alpha=0.95).mean())


def test_ewm_golden(spark):
    pdf = pd.DataFrame({"g": "a", "t": range(6), "y": [np.nan, 1, np.nan, np.nan, 4, 2]})
    got = create_time_series_features(
        to_spark(spark, pdf), "y", "t", "g", lags=[0], weights=[0.5], date_related=False, ewm=True, layout="whole"
    ).toPandas().sort_values("t")
    same(got["sales_ewm_w_0.5_lag_0"].round(4), pd.Series([np.nan, 1, 1, 1, 3.6667, 2.6]))


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("win_type", ["boxcar", "hamming", "flattop", "parzen"])
def test_wide_weighted_windows_equal_direct_sums(spark, monkeypatch, layout, win_type):
    mode = use(monkeypatch, layout)
    pdf = panel(4, (700, 131, 64, 1))
    pdf["y"] = pdf["y"] + 1e5
    sizes = [5, 64, 130, 365] if win_type != "parzen" else [5, 64]
    got = create_time_series_features(
        to_spark(spark, pdf), "y", to_sort="t", to_group="g", windows=sizes, win_type=win_type,
        date_related=False, roll=True, roll_mean=True, roll_std=True, layout=mode,
    ).toPandas().sort_values(["g", "t"], na_position="last").reset_index(drop=True)
    assert [c for c in got.columns if c.startswith("__")] == []
    want = pdf.sort_values(["g", "t"], na_position="last").reset_index(drop=True)
    for n in sizes:
        q = np.array(rolling_weights(win_type, n))

        def spread(x):
            mean = (q * x).sum() / q.sum()
            return np.sqrt((q * (x - mean) ** 2).sum() / q.sum() * n / (n - 1))

        for name, fn in (("mean", lambda x: (q * x).sum() / q.sum()), ("std", spread)):
            rolled = want.groupby("g")["y"].transform(lambda x: x.shift(1).rolling(n).apply(fn, raw=True))
            np.testing.assert_allclose(got[f"sales_roll_{name}_{n}"].astype(float), rolled, rtol=1e-9 if name == "mean" else 1e-5)


def test_wide_weighted_window_with_infinity_and_holes(spark):
    y = np.random.default_rng(2).normal(size=400)
    y[100], y[250] = np.inf, np.nan
    pdf = pd.DataFrame({"g": "a", "t": np.arange(400), "y": y})
    got = create_time_series_features(
        to_spark(spark, pdf), "y", "t", "g", windows=[64], win_type="hamming", date_related=False,
        roll=True, roll_mean=True, roll_std=True, layout="whole",
    ).toPandas().sort_values("t").reset_index(drop=True)
    q = np.array(rolling_weights("hamming", 64))
    assert np.isinf(got.sales_roll_mean_64[101:165]).all() and got.sales_roll_std_64[101:165].isna().all()
    assert got.sales_roll_mean_64[np.r_[0:64, 251:315]].isna().all()
    for i in np.r_[64:101, 165:251, 315:400]:
        assert got.sales_roll_mean_64[i] == pytest.approx((q * y[i - 64 : i]).sum() / q.sum(), rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("win_type", list(WINDOWS))
@pytest.mark.parametrize("min_periods", [None, 2])
def test_weighted_rolling_equals_pandas_kernels(spark, win_type, min_periods):
    pdf = panel(2, (60,))[lambda d: d.g.notna()]
    n = 5
    weights = rolling_weights(win_type, n)
    got = create_time_series_features(
        to_spark(spark, pdf), "y", "t", "g", windows=[n], min_periods=min_periods, win_type=win_type, date_related=False,
        roll=True, roll_mean=True, roll_std=True, layout="whole",
    ).toPandas().sort_values("t")
    got = got.rename(columns={f"sales_roll_mean_{n}": "m", f"sales_roll_std_{n}": "s"})
    shifted = pdf.y.shift(1).to_numpy()
    minp = n if min_periods is None else min_periods
    same(got.m, pd.Series(np.asarray(roll_weighted_mean(shifted, np.array(weights), minp))))
    def spread(x):
        keep = ~np.isnan(x)
        if keep.sum() < max(minp, 2):
            return np.nan
        v, q = x[keep], np.array(weights)[keep]
        total = q.sum()
        return np.sqrt((q * (v - (q * v).sum() / total) ** 2).sum() / total * n / (n - 1)) if total else np.nan

    padded = np.r_[np.full(n - 1, np.nan), shifted]
    same(got.s, pd.Series([spread(padded[i : i + n]) for i in range(len(shifted))]))
    if win_type == "boxcar":
        kernel = np.asarray(roll_weighted_var(shifted, np.array(weights), minp, 1))
        same(got.s, pd.Series(np.sqrt(kernel)))


def test_window_weights_known_values():
    assert rolling_weights("triang", 3) == [0.5, 1.0, 0.5]
    assert rolling_weights("triang", 4) == [0.25, 0.75, 0.75, 0.25]
    assert rolling_weights("bartlett", 5) == [0, 0.5, 1, 0.5, 0]
    np.testing.assert_allclose(rolling_weights("hamming", 5), np.hamming(5))
    np.testing.assert_allclose(rolling_weights("hann", 6), np.hanning(6), atol=1e-15)
    np.testing.assert_allclose(rolling_weights("blackman", 7), np.blackman(7), atol=1e-15)


def test_pct_change_edge_values(spark):
    rows = [("a", 0, 2.0), ("a", 1, None), ("a", 2, 3.0), ("a", 3, 0.0), ("a", 4, 5.0), ("b", 0, 0.0), ("b", 1, 0.0), ("b", 2, -1.0)]
    df = spark.createDataFrame(rows, "g string, t int, y double")
    from seriesmill.operators.features import add_diff_features

    got = add_diff_features(df, "y", ["g"], [1], ["t"]).orderBy("g", "t").toPandas()["y_pct_change_1"]
    same(got, pd.Series([np.nan, 0, 0.5, -1, np.inf, np.nan, np.nan, -np.inf]))


def test_null_key_rows_get_no_lag(spark):
    from seriesmill.operators.features import add_lag_features

    rows = [("a", 1, 1.0), ("a", 2, 2.0), (None, 3, 3.0), (None, 4, 4.0), ("b", 5, 5.0)]
    df = spark.createDataFrame(rows, "g string, t int, y double")
    got = add_lag_features(df, "y", ["g"], [1], ["t"]).orderBy("t").toPandas()["y_lag1"]
    same(got, pd.Series([np.nan, 1, np.nan, np.nan, np.nan]))


def test_no_group_is_one_series(spark):
    from seriesmill.operators.features import add_lag_features

    df = spark.range(20).selectExpr("id AS t", "cast(id AS double) AS y")
    for layout in ("whole", "blocks"):
        got = add_lag_features(df, "y", None, [2], ["t"], layout).orderBy("t").toPandas()["y_lag2"]
        same(got, pd.Series(range(20)).shift(2))


def test_numbering_is_dense_under_a_hot_key(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id")
    got = number_rows(df, ["k", "id"], "p").toPandas().sort_values(["k", "id"])
    assert got.p.tolist() == list(range(5000))


def test_min_periods_above_window_raises(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "g string, t int, y double")
    with pytest.raises(ValueError):
        create_time_series_features(df, "y", "t", "g", windows=[2], min_periods=3, date_related=False, roll=True, roll_mean=True)


def test_blocks_bound_the_rows_of_a_task(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('s', id)) AS g", "id AS t")
    rows = lay_out(df, ["g"], ["t"], "blocks", 100)
    copies = rows._with_reach(100, 10)
    assert copies.groupBy("__block", "g").count().agg({"count": "max"}).first()[0] <= 110
    assert copies.where("__own").count() == 3000
    numbered = rows.with_row_number("n").with_row_number("back", from_end=True).to_frame()
    hot = numbered.where("g = 'hot'").orderBy("t").toPandas()
    assert hot.n.tolist() == list(range(1, 1001)) and hot.back.tolist() == list(range(1000, 0, -1))


def test_results_do_not_depend_on_the_number_of_partitions(spark):
    pdf = panel(5, (80, 30))
    results = []
    for partitions in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        for layout in ("whole", "blocks"):
            out = create_time_series_features(
                to_spark(spark, pdf).repartition(int(partitions)), "y", "t", "g", lags=[2], windows=[4], weights=[0.3],
                min_periods=1, date_related=False, lag=True, roll=True, ewm=True, roll_mean=True, roll_std=True, layout=layout,
            )
            results.append(out.toPandas().sort_values(["g", "t"], na_position="last", ignore_index=True))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    for other in results[1:]:
        pd.testing.assert_frame_equal(results[0], other, rtol=1e-12)


def test_whole_series_above_the_limit_go_in_blocks(spark, monkeypatch):
    import seriesmill.operators.layout as layout

    df = spark.range(2000).selectExpr("if(id % 4 = 0, null, concat('s', id % 4)) AS g", "id AS t", "cast(id * 37 % 101 AS double) AS y")
    flags = dict(to_sort="t", to_group="g", windows=[70], roll=True, roll_mean=True, roll_std=True, date_related=False, block_rows=90)
    monkeypatch.setattr(layout, "WHOLE_SERIES_ROWS", 499)
    assert lay_out(df, ["g"], ["t"], "whole", 90).block_rows == 90
    assert lay_out(df, ["g"], ["t"], "short", 90).block_rows is None
    for win_type in (None, "hamming"):
        got = create_time_series_features(df, "y", layout="whole", win_type=win_type, **flags).orderBy("t").toPandas()
        want = create_time_series_features(df, "y", layout="short", win_type=win_type, **flags).orderBy("t").toPandas()
        assert got["sales_roll_std_70"].notna().sum() == 3 * 430
        pd.testing.assert_frame_equal(got, want, rtol=1e-9)


def test_a_pass_over_blocks_has_tasks_by_its_rows(spark, monkeypatch):
    import seriesmill.operators.layout as layout

    monkeypatch.setattr(layout, "TASK_ROWS", 500)
    rows = lay_out(spark.range(10_000).selectExpr("id % 3 AS g", "id AS t"), ["g"], ["t"], "blocks", 50)
    for dealt in (rows._with_reach(50, 10), rows._join_per_block(rows._per_block({"n": F.count(F.lit(1))}))):
        sizes = dealt.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert len(sizes) >= 15 and sizes.max() <= 2000


def test_the_first_order_of_a_series_is_found_among_those_of_its_place(spark, tmp_path):
    from seriesmill.plans.feature_queries import _huge_first

    rows = [(k, d, p, 1.0) for p in ("a", "b", None) for k, d in ((1, "2020-01-02"), (2, "2020-01-01"), (2, "2020-01-01"), (5, "2020-01-03"))]
    rows += [(3, None, "b", 1.0), (None, None, "b", 1.0), (None, None, "b", 1.0)]
    orders = spark.createDataFrame(rows, "o_orderkey long, d string, o_orderpriority string, o_totalprice double")
    orders.withColumn("o_orderdate", F.col("d").cast("timestamp_ntz")).drop("d").write.parquet(f"{tmp_path}/orders.parquet")
    found = _huge_first(spark, str(tmp_path))
    assert found.count() == len(rows)
    huge = sorted(((r.o_orderpriority, r.o_orderkey) for r in found.where("y = 1e30").collect()), key=str)
    assert huge == sorted([("a", 2), ("b", None), (None, 2)], key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan.partition("Window")[2]  # only rows of a first place are ranked


def test_ewm_is_the_same_in_every_layout(spark, monkeypatch):
    """A value of 1e30 long ago still counts, whatever the layout, and missing values lie at block ends too."""
    rows = [("a", i, None if i % 7 == 3 else 1e30 if i == 0 else float(i)) for i in range(600)]
    rows += [("b", i, None if i < 120 else float(i % 11)) for i in range(300)] + [("c", 0, 2.0), (None, 0, 1.0)]
    df = spark.createDataFrame(rows, "g string, i int, y double")
    alphas = [0.5, 0.9, 0.01, 1.0]
    for layout, size in (("whole", 100), ("blocks", 100), ("blocks", 37)):
        out = create_time_series_features(df, "y", "i", "g", lags=[1], weights=alphas, date_related=False, ewm=True, layout=layout, block_rows=size)
        got = out.where("g IS NOT NULL").toPandas().sort_values(["g", "i"])
        for a in alphas:
            want = got.groupby("g")["y"].transform(lambda s: s.ewm(alpha=a).mean().shift(1))
            assert np.allclose(got[f"sales_ewm_w_{a}_lag_1"].astype(float), want, rtol=1e-9, equal_nan=True), (layout, size, a)


def test_ties_are_ordered_alike_in_every_layout(spark):
    df = spark.range(200).selectExpr("id % 2 AS g", "id div 10 AS i", "cast(id * 37 % 101 AS double) AS y", "id")
    parts = [add_lag_features(df.repartition(n), "y", ["g"], [1, 3], ["i"], layout) for layout, n in (("whole", 1), ("whole", 7), ("blocks", 5))]
    first, *others = [sorted(tuple(r) for r in p.collect()) for p in parts]
    assert all(o == first for o in others)


@pytest.mark.parametrize("layout", ["whole", "blocks"])
def test_own_output_goes_in_again(spark, layout):
    """Names such as sales_ewm_w_0.5_lag_1 hold a dot."""
    df = spark.range(40).selectExpr("id % 2 AS `a.g`", "id AS `the.i`", "cast(id AS double) AS `y.z`")
    first = create_time_series_features(df, "y.z", "the.i", "a.g", lags=[1], weights=[0.5], date_related=False, ewm=True, lag=True, layout=layout)
    name = "sales_ewm_w_0.5_lag_1"
    second = create_time_series_features(first, name, "the.i", "a.g", lags=[2], windows=[3], weights=[0.9], date_related=False, ewm=True, lag=True, roll=True, roll_mean=True, layout=layout)
    assert second.count() == 40
    for add in (add_rolling_features, add_diff_features):
        assert add(first, name, ["a.g"], [3], ["the.i"], layout).count() == 40
    scaled = scale_min_max(first, fit_min_max(first, [name]), [name])
    assert evaluate_result_forecast(scaled.where(f"`{name}` IS NOT NULL"), name, "y.z").count() == 1
