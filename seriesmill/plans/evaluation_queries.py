"""Error measures, chronological splits, cross-validation, scaling and windows of past rows."""

from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from ..functions.scalars import log1p
from ..operators import metrics as m
from ..operators.cross_validation import cv_least_squares, cv_line, cv_training_mean, score_summary, time_series_cv
from ..operators.scaling import extract_subsequences, fit_min_max, scale_min_max, unscale_min_max
from ..operators.split import POSITION, expanding_folds, train_val_test_split, with_split_label
from ..session import materialize
from .inputs import BRAND_MONTHS, CUTOFF, PAIRS, TOTAL_MONTHS, brand_months, seasonal_pairs, table, total_months
from .registry import register, rounded

# name -> (measure, output, digits, SQL expression over columns a and f)
_MEASURES = {
    "g7_mape_eps": (m.mape_eps, "mape_eps", 6, "avg(abs((a - f) / (a + 1e-9))) * 100"),
    "g8_rmse": (m.rmse, "rmse", 4, "sqrt(avg((a - f) * (a - f)))"),
    "g10_mae": (m.mae, "mae", 4, "avg(abs(a - f))"),
    "g13_r2": (m.r2, "r2", 6, "1 - avg((a - f) * (a - f)) / var_pop(a)"),
    "g14_mape": (m.mape, "mape", 6, "avg(abs((a - f) / a)) * 100"),
}
_AF = "SELECT p_brand, period, actual AS a, forecast AS f FROM pairs"


def _register_measure(name, fn, out, digits, expression):
    sql = f"WITH {PAIRS}, af AS ({_AF}) SELECT p_brand, round({expression}, {digits}) AS {out} FROM af GROUP BY p_brand"

    @register(name, sql)
    def run(spark, sf_dir):
        pairs = seasonal_pairs(spark, sf_dir)
        return rounded(pairs.groupBy("p_brand").agg(fn("actual", "forecast").alias(out)), digits)


for _name, _parts in _MEASURES.items():
    _register_measure(_name, *_parts)


# Squares of money reach 1e12, where a double has 3 decimals: compared in millions squared.
@register(
    "g11_mse",
    f"""WITH {PAIRS}, af AS ({_AF}) SELECT p_brand, round(avg((a - f) * (a - f)) / 1e12, 9) AS mse_in_millions
    FROM af GROUP BY p_brand""",
)
def g11_mse(spark, sf_dir):
    scores = seasonal_pairs(spark, sf_dir).groupBy("p_brand").agg(m.mse("actual", "forecast").alias("mse"))
    return scores.select("p_brand", F.round(F.col("mse") / 1e12, 9).alias("mse_in_millions"))


@register(
    "g9_mape_and_rmse",
    f"""WITH {PAIRS}, af AS ({_AF}) SELECT round(avg(abs((a - f) / (a + 1e-9))) * 100, 6) AS "MAPE",
    round(sqrt(avg((a - f) * (a - f))), 4) AS "RMSE" FROM af""",
)
def g9_mape_and_rmse(spark, sf_dir):
    return rounded(m.evaluate_result_forecast(seasonal_pairs(spark, sf_dir), "actual", "forecast"), 6, RMSE=4)


@register(
    "g12_rmse_of_rounded_mse",
    f"""WITH {PAIRS}, af AS ({_AF}) SELECT p_brand,
    round_even(sqrt(round_even(avg((a - f) * (a - f) / 1e6), 4)), 4) AS "RMSE" FROM af GROUP BY p_brand""",
)
def g12_rmse_of_rounded_mse(spark, sf_dir):
    in_thousands = seasonal_pairs(spark, sf_dir).withColumns(
        {"actual": F.col("actual") / 1e3, "forecast": F.col("forecast") / 1e3}
    )
    return m.evaluate_regressor(in_thousands, "actual", "forecast", by=["p_brand"]).select("p_brand", "RMSE")


@register(
    "g15_evaluate_regressor",
    f"""WITH {PAIRS}, af AS (SELECT p_brand, actual / 1e6 AS a, forecast / 1e6 AS f FROM pairs),
    s AS (SELECT p_brand, avg(abs(a - f)) AS mae, avg((a - f) * (a - f)) AS mse, avg(abs((a - f) / a)) * 100 AS mape,
      1 - avg((a - f) * (a - f)) / var_pop(a) AS r2 FROM af GROUP BY p_brand)
    SELECT p_brand, 'seasonal naive' AS "Model", round_even(mae, 4) AS "MAE", round_even(mse, 4) AS "MSE",
    round_even(mape, 4) AS "MAPE", round_even(sqrt(round_even(mse, 4)), 4) AS "RMSE", round_even(r2, 4) AS "R2" FROM s""",
)
def g15_evaluate_regressor(spark, sf_dir):
    in_millions = seasonal_pairs(spark, sf_dir).withColumns(
        {"actual": F.col("actual") / 1e6, "forecast": F.col("forecast") / 1e6}
    )
    return m.evaluate_regressor(in_millions, "actual", "forecast", "seasonal naive", ["p_brand"])


@register(
    "g16_reference_line",
    f"""WITH {BRAND_MONTHS} SELECT p_brand, round(min(sales_amount), 6) AS line_min, round(max(sales_amount), 6) AS line_max
    FROM monthly WHERE period < DATE '{CUTOFF}' GROUP BY p_brand""",
)
def g16_reference_line(spark, sf_dir):
    return rounded(m.reference_line(brand_months(spark, sf_dir, before=CUTOFF), "sales_amount", ["p_brand"]))


@register(
    "g17_residual_distribution",
    f"""WITH {PAIRS}, r AS (SELECT actual - forecast AS r FROM pairs),
    b AS (SELECT min(r) AS lo, (max(r) - min(r)) / 20 AS width, count(*) AS n FROM r),
    c AS (SELECT CAST(least(floor((r - lo) / width), 19) AS INTEGER) AS bin, count(*) AS rows FROM r, b GROUP BY 1)
    SELECT bin, round(lo + bin * width, 4) AS bin_start, rows, round(rows / (n * width) * 1e6, 6) AS density_per_million FROM c, b""",
)
def g17_residual_distribution(spark, sf_dir):
    pairs = materialize(seasonal_pairs(spark, sf_dir), "pairs")  # read for the range and for the counts
    bins = m.residual_distribution(pairs, "actual", "forecast", 20)
    return rounded(
        bins.select("bin", "bin_start", "rows", (F.col("density") * 1e6).alias("density_per_million")), 6, bin_start=4
    )


@register(
    "g17_residual_density",
    f"""WITH {PAIRS}, r AS (SELECT actual - forecast AS r FROM pairs WHERE actual - forecast IS NOT NULL),
    s AS (SELECT min(r) AS lo, max(r) AS hi, count(*) AS n, stddev_samp(r) * pow(count(*), -0.2) AS h FROM r),
    g AS (SELECT lo - 3 * h AS low, (hi - lo + 6 * h) / 99 AS step, n, h FROM s),
    p AS (SELECT (r - low) / step AS place FROM r, g), b AS (SELECT least(floor(place), 98) AS bin, place FROM p),
    w AS (SELECT bin, sum(1 - (place - bin)) AS here, sum(place - bin) AS next FROM b GROUP BY bin)
    SELECT CAST(k AS INTEGER) AS point, round(low + k * step, 3) AS x, round(1e6 / (n * h * sqrt(2 * pi())) * (SELECT
      sum(here * exp(-0.5 * pow((k - bin) * step / h, 2)) + next * exp(-0.5 * pow((k - bin - 1) * step / h, 2))) FROM w), 6) AS density_per_million
    FROM g, range(0, 100) AS t(k)""",
)
def g17_residual_density(spark, sf_dir):
    pairs = materialize(seasonal_pairs(spark, sf_dir), "pairs")  # read for the range and for the bins
    found = m.residual_density(pairs, "actual", "forecast", 100)
    return rounded(found.select("point", "x", (F.col("density") * 1e6).alias("density_per_million")), 6, x=3)


# --- splits ---------------------------------------------------------------------------------------


@register(
    "t1_time_series_split",
    f"""SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def t1_time_series_split(spark, sf_dir):
    return with_split_label(table(spark, sf_dir, "orders"), CUTOFF, "o_orderdate").select("o_orderkey", "split")


def fold_sql(rows, n_splits=5, gap=0):
    """``pos`` (from 0) and the columns of ``rows``; then one row per fold with its ranges."""
    return f"""size AS (SELECT count(*) AS n, count(*) // ({n_splits} + 1) AS ts FROM {rows}),
    folds AS (SELECT CAST(k AS INTEGER) AS fold, n - ({n_splits} - k) * ts AS val_start, n - ({n_splits} - k) * ts + ts AS val_end,
      n - ({n_splits} - k) * ts - {gap} AS train_end FROM size, range({n_splits}) r(k))"""


_NUMBERED_ORDERS = """numbered AS (SELECT o_orderkey, o_orderdate, o_totalprice, o_custkey,
  row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)"""
_NUMBERED_TOTAL = f"""{TOTAL_MONTHS}, numbered AS (SELECT period, sales_amount, row_number() OVER (ORDER BY period) - 1 AS pos
  FROM total)"""


@register(
    "t2_folds_of_one_series",
    f"""WITH {_NUMBERED_TOTAL}, {fold_sql('numbered')}
    SELECT fold, CASE WHEN pos < train_end THEN 'train' ELSE 'val' END AS role, period, pos AS position
    FROM numbered JOIN folds ON pos < train_end OR (pos >= val_start AND pos < val_end)""",
)
def t2_folds_of_one_series(spark, sf_dir):
    folds = expanding_folds(total_months(spark, sf_dir), ["period"])
    return rounded(folds.labelled().select("fold", "role", "period", POSITION))


@register(
    "t2_folds_of_all_orders",
    f"""WITH {_NUMBERED_ORDERS}, {fold_sql('numbered')}
    SELECT fold, CASE WHEN pos < train_end THEN 'train' ELSE 'val' END AS role, o_orderkey, pos AS position
    FROM numbered JOIN folds ON pos < train_end OR (pos >= val_start AND pos < val_end)""",
)
def t2_folds_of_all_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return expanding_folds(orders, ["o_orderdate", "o_orderkey"]).labelled().select("fold", "role", "o_orderkey", POSITION)


def _report_sql(gap):
    return f"""WITH {_NUMBERED_ORDERS}, {fold_sql('numbered', 5, gap)},
    member AS (SELECT *, pos < train_end AS t FROM numbered JOIN folds ON pos < train_end OR (pos >= val_start AND pos < val_end))
    SELECT fold, min(pos) FILTER (t) AS train_first, max(pos) FILTER (t) AS train_last, count(*) FILTER (t) AS train_rows,
    min(o_orderdate) FILTER (t) AS train_from, max(o_orderdate) FILTER (t) AS train_to,
    min(pos) FILTER (NOT t) AS val_first, max(pos) FILTER (NOT t) AS val_last, count(*) FILTER (NOT t) AS val_rows,
    min(o_orderdate) FILTER (NOT t) AS val_from, max(o_orderdate) FILTER (NOT t) AS val_to FROM member GROUP BY fold"""


def _register_report(name, gap):
    @register(name, _report_sql(gap))
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
        return expanding_folds(orders, ["o_orderdate", "o_orderkey"], gap=gap).report("o_orderdate")


_register_report("t3_fold_report", 0)
_register_report("t3_fold_report_with_gap", 100)


# --- cross-validation -----------------------------------------------------------------------------

_IN_MILLIONS = f"""{TOTAL_MONTHS}, numbered AS (SELECT period, sales_amount / 1e6 AS y,
  CAST(row_number() OVER (ORDER BY period) - 1 AS DOUBLE) AS x, row_number() OVER (ORDER BY period) - 1 AS pos FROM total)"""


def _millions(spark, sf_dir):
    return total_months(spark, sf_dir).select("period", (F.col("sales_amount") / 1e6).alias("y"))


@register(
    "t4_cv_training_mean",
    f"""WITH {_NUMBERED_ORDERS}, {fold_sql('numbered')},
    fit AS (SELECT fold, avg(o_totalprice) AS mean FROM numbered JOIN folds ON pos < train_end GROUP BY fold)
    SELECT fold, round(sqrt(avg(pow(o_totalprice - mean, 2))), 4) AS rmse
    FROM numbered JOIN folds ON pos >= val_start AND pos < val_end JOIN fit USING (fold) GROUP BY fold""",
)
def t4_cv_training_mean(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return rounded(cv_training_mean(expanding_folds(orders, ["o_orderdate", "o_orderkey"]), "o_totalprice"), 4)


_LINE_CV = f"""fit AS (SELECT fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM numbered JOIN folds ON pos < train_end
      GROUP BY fold),
    scores AS (SELECT fold, sqrt(avg(pow(y - a - b * x, 2))) AS rmse
      FROM numbered JOIN folds ON pos >= val_start AND pos < val_end JOIN fit USING (fold) GROUP BY fold)"""


def _line_scores(spark, sf_dir):
    folds = expanding_folds(_millions(spark, sf_dir), ["period"])
    return cv_line(folds, "y", POSITION)


@register(
    "t4_cv_line",
    f"WITH {_IN_MILLIONS}, {fold_sql('numbered')}, {_LINE_CV} SELECT fold, round(rmse, 6) AS rmse FROM scores",
)
def t4_cv_line(spark, sf_dir):
    return rounded(_line_scores(spark, sf_dir))


_ORDER_LINE = """fit AS (SELECT fold, regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a
      FROM numbered JOIN folds ON pos < train_end GROUP BY fold)"""


@register(
    "t4_cv_linear_regression",
    f"""WITH {_NUMBERED_ORDERS}, {fold_sql('numbered')}, {_ORDER_LINE}
    SELECT fold, round(sqrt(avg(pow(o_totalprice - a - b * o_custkey, 2))), 3) AS rmse
    FROM numbered JOIN folds ON pos >= val_start AND pos < val_end JOIN fit USING (fold) GROUP BY fold""",
)
def t4_cv_linear_regression(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    line = LinearRegression(solver="normal", standardization=False)
    keys = ["o_orderdate", "o_orderkey"]
    return rounded(time_series_cv(orders, line, "o_totalprice", keys, features=["o_custkey"]), 3)


@register(
    "t4_cv_three_features",
    f"""WITH numbered AS (SELECT o_totalprice AS y, CAST(o_custkey AS DOUBLE) AS x1, CAST(month(o_orderdate) AS DOUBLE) AS x2,
      CAST(day(o_orderdate) AS DOUBLE) AS x3, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders),
    {fold_sql('numbered')},
    s AS (SELECT fold, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3,
      var_pop(x1) AS a, var_pop(x2) AS b, var_pop(x3) AS c, covar_pop(x1, x2) AS d, covar_pop(x1, x3) AS e,
      covar_pop(x2, x3) AS f, covar_pop(x1, y) AS p, covar_pop(x2, y) AS q, covar_pop(x3, y) AS r
      FROM numbered JOIN folds ON pos < train_end GROUP BY fold),
    det AS (SELECT *, a * (b * c - f * f) - d * (d * c - f * e) + e * (d * f - b * e) AS det FROM s),
    fit AS (SELECT *, (p * (b * c - f * f) - d * (q * c - f * r) + e * (q * f - b * r)) / det AS b1,
      (a * (q * c - f * r) - p * (d * c - f * e) + e * (d * r - q * e)) / det AS b2,
      (a * (b * r - q * f) - d * (d * r - q * e) + p * (d * f - b * e)) / det AS b3 FROM det)
    SELECT fold, round(sqrt(avg(pow(y - my - b1 * (x1 - m1) - b2 * (x2 - m2) - b3 * (x3 - m3), 2))), 3) AS rmse
    FROM numbered JOIN folds ON pos >= val_start AND pos < val_end JOIN fit USING (fold) GROUP BY fold""",
)
def t4_cv_three_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_custkey",
        F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"),
    )
    folds = expanding_folds(orders, ["o_orderdate", "o_orderkey"])
    return rounded(cv_least_squares(folds, "o_totalprice", ["o_custkey", "month", "day"]), 3)


@register("t4_cv_boosted_trees")
def t4_cv_boosted_trees(spark, sf_dir):
    """Boosted trees on the past of each brand, all brands in one model."""
    from ..operators.features import add_lag_features

    lagged = add_lag_features(brand_months(spark, sf_dir), "sales_amount", ["p_brand"], [1, 12], ["period"], "short")
    rows = lagged.where("sales_amount_lag12 IS NOT NULL").withColumn("month", F.month("period"))
    trees = GBTRegressor(seed=7)
    return time_series_cv(
        rows, trees, "sales_amount", ["period", "p_brand"],
        features=["sales_amount_lag1", "sales_amount_lag12", "month"],
    )


@register(
    "t5_cv_on_original_scale",
    f"""WITH numbered AS (SELECT o_custkey, ln(1 + o_totalprice) AS y,
      row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders), {fold_sql('numbered')},
    fit AS (SELECT fold, regr_slope(y, o_custkey) AS b, regr_intercept(y, o_custkey) AS a
      FROM numbered JOIN folds ON pos < train_end GROUP BY fold)
    SELECT fold, round(sqrt(avg(pow(exp(y) - exp(a + b * o_custkey), 2))), 3) AS rmse
    FROM numbered JOIN folds ON pos >= val_start AND pos < val_end JOIN fit USING (fold) GROUP BY fold""",
)
def t5_cv_on_original_scale(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", log1p("o_totalprice").alias("y"))
    line = LinearRegression(solver="normal", standardization=False)
    keys = ["o_orderdate", "o_orderkey"]
    return rounded(time_series_cv(orders, line, "y", keys, features=["o_custkey"], log=True), 3)


@register(
    "t6_g18_score_summary",
    f"""WITH {_IN_MILLIONS}, {fold_sql('numbered')}, {_LINE_CV}
    SELECT round_even(avg(rmse), 4) AS mean_score, round_even(stddev_pop(rmse), 4) AS std_score FROM scores""",
)
def t6_g18_score_summary(spark, sf_dir):
    return score_summary(_line_scores(spark, sf_dir))


# --- scaling and windows --------------------------------------------------------------------------

_SCALED = ["o_totalprice", "o_custkey"]
_RANGES = """ranges AS (SELECT min(o_totalprice) AS p0, max(o_totalprice) - min(o_totalprice) AS p1,
  min(o_custkey) AS c0, max(o_custkey) - min(o_custkey) AS c1 FROM orders)"""
_SCALED_SQL = f"""{_RANGES}, scaled AS (SELECT o_orderkey, o_orderdate, o_orderpriority,
  (o_totalprice - p0) / p1 AS o_totalprice, (o_custkey - c0) / c1 AS o_custkey FROM orders, ranges)"""


def _scaled_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", *_SCALED)
    scaler = fit_min_max(orders, _SCALED)
    return scale_min_max(orders, scaler, _SCALED), scaler


@register(
    "m1_min_max_scaled",
    f"""WITH {_SCALED_SQL} SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, round(o_custkey, 6) AS o_custkey FROM scaled""",
)
def m1_min_max_scaled(spark, sf_dir):
    scaled, _ = _scaled_orders(spark, sf_dir)
    return rounded(scaled.select("o_orderkey", *_SCALED))


@register(
    "m1_scaler",
    """SELECT min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
    CAST(min(o_custkey) AS DOUBLE) AS o_custkey_min, CAST(max(o_custkey) AS DOUBLE) AS o_custkey_max FROM orders""",
)
def m1_scaler(spark, sf_dir):
    return fit_min_max(table(spark, sf_dir, "orders"), _SCALED)


# A nested list is compared through its size, its flattened sum and its ends.
@register(
    "m2_subsequences",
    f"""WITH {_SCALED_SQL}, w AS (SELECT o_orderkey, o_totalprice AS y,
      list([o_totalprice, o_custkey]) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS s FROM scaled)
    SELECT o_orderkey, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS row, round(unnest(s)[1], 6) AS price,
    round(unnest(s)[2], 6) AS customer, round(y, 6) AS next_target FROM w WHERE len(s) = 6""",
)
def m2_subsequences(spark, sf_dir):
    scaled, _ = _scaled_orders(spark, sf_dir)
    windows = extract_subsequences(
        scaled, _SCALED, "o_totalprice", 6, ["o_orderdate", "o_orderkey"], ["o_orderpriority"]
    )
    cells = windows.select("o_orderkey", F.posexplode("subsequence").alias("row", "cells"), "next_target")
    return rounded(cells.select("o_orderkey", "row", F.col("cells")[0].alias("price"), F.col("cells")[1].alias("customer"), "next_target"))


@register(
    "m3_train_val_test",
    f"""WITH {_NUMBERED_ORDERS}, size AS (SELECT count(*) AS n FROM orders)
    SELECT o_orderkey, CASE WHEN pos < CAST(floor(n * 0.7::DOUBLE) AS BIGINT) THEN 'train'
      WHEN pos < CAST(floor(n * 0.85::DOUBLE) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM numbered, size""",
)
def m3_train_val_test(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return train_val_test_split(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "split")


@register(
    "m4_scores_on_original_scale",
    """WITH w AS (SELECT o_orderpriority, o_totalprice / 1e3 AS a,
      lag(o_totalprice / 1e3) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS f FROM orders),
    s AS (SELECT o_orderpriority, avg(abs(a - f)) AS mae, avg((a - f) * (a - f)) AS mse FROM w WHERE f IS NOT NULL GROUP BY 1)
    SELECT o_orderpriority, round_even(mae, 4) AS "MAE", round_even(sqrt(round_even(mse, 4)), 4) AS "RMSE" FROM s""",
)
def m4_scores_on_original_scale(spark, sf_dir):
    """The last scaled value of each window predicts the next; scores are in thousands of the original unit."""
    scaled, scaler = _scaled_orders(spark, sf_dir)
    windows = extract_subsequences(
        scaled, ["o_totalprice"], "o_totalprice", 1, ["o_orderdate", "o_orderkey"], ["o_orderpriority"]
    ).select("o_orderpriority", F.col("next_target").alias("a"), F.col("subsequence")[0][0].alias("f"))
    original = unscale_min_max(windows, scaler, {"a": "o_totalprice", "f": "o_totalprice"})
    original = original.withColumns({"a": F.col("a") / 1e3, "f": F.col("f") / 1e3})
    report = m.evaluate_regressor(original, "a", "f", "last value", ["o_orderpriority"])
    return report.select("o_orderpriority", "MAE", "RMSE")
