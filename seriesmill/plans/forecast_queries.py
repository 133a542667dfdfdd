"""Differencing, frequencies, baselines and (S)ARIMA(X) over the monthly panels."""

from pyspark.sql import functions as F

from ..forecasting import arima
from ..forecasting.arima import ArimaSpec
from ..forecasting.baselines import fit_baselines, forecast_baselines
from ..forecasting.dates import fill_dates, future_date, infer_frequency
from ..forecasting.differencing import difference_polynomial, differenced
from ..forecasting.exog import last_rows, padded_future, unknown_ids
from ..forecasting.history import SeriesHistory
from ..forecasting.likelihood import log_likelihoods, series_arrays
from ..forecasting.models import ArimaModel, SarimaModel
from ..operators.layout import lay_out
from ..operators.metrics import evaluate_result_forecast
from ..operators.split import time_series_split, union_all
from ..session import materialize, scratch_path
from ..sources.artifacts import load_object, save_object
from ..streaming.updates import latest, publish, update_from_stream
from .inputs import (
    CUTOFF, PANEL, PANEL_X, PART_MONTHS, brand_panel, brand_panel_with_orders, part_months, sales_by, table,
)
from .registry import register, rounded

SUMMED = "short"  # one row per series and month
_W = "OVER (PARTITION BY unique_id ORDER BY ds)"
_CUT = f"TIMESTAMP '{CUTOFF}'"
_HORIZON = 6


def _in_millions(panel):
    return panel.withColumn("y", F.col("y") / 1e6)


def _train(spark, sf_dir):
    return _in_millions(brand_panel(spark, sf_dir, before=CUTOFF))


def _whole(spark, sf_dir):
    return _in_millions(brand_panel(spark, sf_dir))


_WHOLE = f"{PANEL}, train AS (SELECT unique_id, ds, y / 1e6 AS y FROM panel)"
_TRAIN = f"{PANEL}, train AS (SELECT unique_id, ds, y / 1e6 AS y FROM panel WHERE ds < {_CUT})"
_LATER = f"later AS (SELECT unique_id, ds, y / 1e6 AS y FROM panel WHERE ds >= {_CUT})"


@register(
    "f4_differenced",
    f"""WITH {PANEL} SELECT unique_id, ds, round(y - lag(y, 1) {_W}, 6) AS plain,
    round(y - lag(y, 1) {_W} - lag(y, 12) {_W} + lag(y, 13) {_W}, 6) AS seasonal FROM panel""",
)
def f4_differenced(spark, sf_dir):
    rows = lay_out(brand_panel(spark, sf_dir), ["unique_id"], ["ds"], SUMMED)
    plain, seasonal = difference_polynomial(1, 0, 0), difference_polynomial(1, 1, 12)
    out = rows.with_columns(
        13, lambda w: {"plain": differenced(w, "y", plain), "seasonal": differenced(w, "y", seasonal)}
    )
    return rounded(out.to_frame().drop("y"))


# --- frequencies and dates ------------------------------------------------------------------------

_MONTH_GAPS = """gaps AS (SELECT *, (year(ds) * 12 + month(ds)) - lag(year(ds) * 12 + month(ds)) OVER w AS months
  FROM {source} WINDOW w AS (PARTITION BY unique_id ORDER BY ds)),
  freqs AS (SELECT unique_id, count(*) AS n, min(months) AS lo, max(months) AS hi, max(ds) AS last_date FROM gaps GROUP BY unique_id),
  named AS (SELECT *, n >= 3 AND lo = hi AS even,
    CASE WHEN n < 3 OR lo <> hi THEN 'D' WHEN lo = 1 THEN 'MS' WHEN lo = 3 THEN 'QS' WHEN lo = 12 THEN 'YS'
      ELSE CAST(lo AS VARCHAR) || 'MS' END AS freq FROM freqs)"""


@register(
    "f8_frequencies",
    f"WITH {PANEL}, {_MONTH_GAPS.format(source='panel')} SELECT unique_id, freq FROM named",
)
def f8_frequencies(spark, sf_dir):
    return infer_frequency(brand_panel(spark, sf_dir), layout=SUMMED).select("unique_id", "freq")


_PARTS = f"{PART_MONTHS}, parts AS (SELECT CAST(product_id AS VARCHAR) AS unique_id, CAST(period AS TIMESTAMP) AS ds FROM part_monthly)"


def _part_panel(spark, sf_dir):
    return part_months(spark, sf_dir).select(
        F.col("product_id").cast("string").alias("unique_id"),
        F.col("period").cast("timestamp_ntz").alias("ds"),
        F.col("sales_amount").alias("y"),
    )


@register(
    "f8_frequencies_with_gaps",
    f"WITH {_PARTS}, {_MONTH_GAPS.format(source='parts')} SELECT unique_id, freq FROM named",
)
def f8_frequencies_with_gaps(spark, sf_dir):
    return infer_frequency(_part_panel(spark, sf_dir), layout=SUMMED).select("unique_id", "freq")


@register(
    "f8_weekly_frequencies",
    f"""WITH {PANEL.split(', monthly AS')[0]}, weekly AS (SELECT DISTINCT p_brand AS unique_id,
      CAST(date_trunc('week', order_date) AS DATE) AS ds FROM fact JOIN part ON product_id = p_partkey),
    gaps AS (SELECT *, ds - lag(ds) OVER (PARTITION BY unique_id ORDER BY ds) AS days FROM weekly)
    SELECT unique_id, CASE WHEN count(*) < 3 OR min(days) <> max(days) THEN 'D' WHEN min(days) = 7 THEN 'W-MON'
      ELSE CAST(min(days) AS VARCHAR) || 'D' END AS freq FROM gaps GROUP BY unique_id""",
)
def f8_weekly_frequencies(spark, sf_dir):
    weeks = sales_by(spark, sf_dir, ["p_brand"], "W").select(
        F.col("p_brand").alias("unique_id"), F.col("period").cast("timestamp_ntz").alias("ds")
    )
    return infer_frequency(weeks, layout=SUMMED).select("unique_id", "freq")


@register(
    "f9_future_dates",
    f"""WITH {_PARTS}, {_MONTH_GAPS.format(source='parts')}
    SELECT unique_id, CAST(i AS INTEGER) AS step, CASE WHEN even THEN last_date + to_months(CAST(i * lo AS INTEGER))
      ELSE last_date + to_days(CAST(i AS INTEGER)) END AS ds FROM named, range(1, 7) r(i)""",
)
def f9_future_dates(spark, sf_dir):
    parts = _part_panel(spark, sf_dir)
    last = parts.groupBy("unique_id").agg(F.max("ds").alias("last_date"))
    known = infer_frequency(parts, layout=SUMMED).join(last, "unique_id")
    steps = known.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(6))))
    date = future_date(F.col("last_date"), F.col("freq_unit"), F.col("freq_step"), F.col("step"))
    return steps.select("unique_id", "step", date.alias("ds"))


# --- baselines ------------------------------------------------------------------------------------

_BASE_STATS = """stats AS (SELECT unique_id, count(*) AS n, max(ds) AS last_date, avg(y) AS mean_y, arg_min(y, ds) AS first_y,
  arg_max(y, ds) AS last_y, list(y ORDER BY ds)[-12:] AS season FROM train GROUP BY unique_id)"""
_BASE_FORECAST = """fc AS (SELECT unique_id, last_date + to_months(CAST(i AS INTEGER)) AS ds, CAST(i AS INTEGER) AS step,
  mean_y AS mean, last_y AS naive, season[(i - 1) % len(season) + 1] AS seasonal_naive,
  last_y + i * (last_y - first_y) / (n - 1) AS drift FROM stats, range(1, 13) r(i))"""


@register(
    "f13_baselines",
    f"""WITH {_WHOLE}, {_BASE_STATS}, {_BASE_FORECAST} SELECT unique_id, ds, step, round(mean, 6) AS mean,
    round(naive, 6) AS naive, round(seasonal_naive, 6) AS seasonal_naive, round(drift, 6) AS drift FROM fc""",
)
def f13_baselines(spark, sf_dir):
    return rounded(forecast_baselines(fit_baselines(_whole(spark, sf_dir), freq="MS", layout=SUMMED), 12))


@register(
    "f13_scored_seasonal_naive",
    f"""WITH {_TRAIN}, {_LATER}, {_BASE_STATS}, {_BASE_FORECAST}
    SELECT round(avg(abs((y - seasonal_naive) / (y + 1e-9))) * 100, 6) AS "MAPE",
    round(sqrt(avg(pow(y - seasonal_naive, 2))), 6) AS "RMSE" FROM later JOIN fc USING (unique_id, ds)""",
)
def f13_scored_seasonal_naive(spark, sf_dir):
    """Split at the cutoff, forecast the test months, score them."""
    forecasts = forecast_baselines(fit_baselines(_train(spark, sf_dir), freq="MS", layout=SUMMED), 12)
    scored = _later(spark, sf_dir).join(forecasts, ["unique_id", "ds"])
    return rounded(evaluate_result_forecast(scored, "y", "seasonal_naive"))


# --- ARIMA with a closed-form check ---------------------------------------------------------------

_AR1 = ArimaSpec((1, 1, 0), trend="c")


def _ar1_sql(source):
    return f"""w AS (SELECT unique_id, ds, y, y - lag(y) {_W} AS w FROM {source}),
    lagged AS (SELECT *, lag(w) {_W} AS w1 FROM w),
    coef AS (SELECT unique_id, regr_slope(w, w1) AS phi, regr_intercept(w, w1) AS c, CAST(regr_count(w, w1) AS BIGINT) AS n_rows,
      regr_syy(w, w1) / regr_count(w, w1) * (1 - regr_r2(w, w1)) AS sigma2 FROM lagged GROUP BY unique_id),
    state AS (SELECT unique_id, count(*) AS n_obs, max(ds) AS last_date, arg_max(y, ds) AS y0, arg_max(w, ds) AS w0
      FROM w GROUP BY unique_id)"""


_AR1_PARAMS = """SELECT unique_id, n_obs, last_date, n_rows, round(c, 6) AS const, round(phi, 6) AS phi,
  round(sigma2, 6) AS sigma2 FROM coef JOIN state USING (unique_id)"""


def _ar1_columns(params):
    return rounded(
        params.select(
            "unique_id", "n_obs", "last_date", "n_rows",
            F.col("trend_coef")[0].alias("const"), F.col("ar")[0].alias("phi"), "sigma2",
        )
    )


def _later(spark, sf_dir):
    return _in_millions(brand_panel(spark, sf_dir, since=CUTOFF))


@register("f2_ar1_parameters", f"WITH {_WHOLE}, {_ar1_sql('train')} {_AR1_PARAMS}")
def f2_ar1_parameters(spark, sf_dir):
    return _ar1_columns(arima.fit(_whole(spark, sf_dir), _AR1, freq="MS", layout=SUMMED))


@register("f2_ar1_parameters_in_blocks", f"WITH {_WHOLE}, {_ar1_sql('train')} {_AR1_PARAMS}")
def f2_ar1_parameters_in_blocks(spark, sf_dir):
    return _ar1_columns(arima.fit(_whole(spark, sf_dir), _AR1, freq="MS", layout="blocks"))


_AR1_PATH = f"""path AS (SELECT unique_id, h, last_date + to_months(CAST(h AS INTEGER)) AS ds,
  y0 + list_sum(list_transform(range(1, h + 1), lambda i: pow(phi, i) * w0 + c * (1 - pow(phi, i)) / (1 - phi))) AS yhat,
  1.959963984540054 * sqrt(sigma2 * list_sum(list_transform(range(0, h), lambda j: pow((1 - pow(phi, j + 1)) / (1 - phi), 2)))) AS half
  FROM coef JOIN state USING (unique_id), range(1, {_HORIZON} + 1) r(h))
  SELECT unique_id, ds, round(yhat, 6) AS yhat, round(yhat - half, 6) AS yhat_lower, round(yhat + half, 6) AS yhat_upper FROM path"""


@register("f5_ar1_forecast", f"WITH {_WHOLE}, {_ar1_sql('train')}, {_AR1_PATH}")
def f5_ar1_forecast(spark, sf_dir):
    return rounded(arima.forecast(arima.fit(_whole(spark, sf_dir), _AR1, freq="MS", layout=SUMMED), _HORIZON))


@register(
    "f6_random_walk_interval",
    f"""WITH {_WHOLE}, w AS (SELECT unique_id, ds, y, y - lag(y) {_W} AS w FROM train),
    s AS (SELECT unique_id, max(ds) AS last_date, arg_max(y, ds) AS y0, sqrt(avg(w * w)) AS sigma FROM w GROUP BY unique_id)
    SELECT unique_id, last_date + to_months(CAST(h AS INTEGER)) AS ds, round(y0, 6) AS yhat,
    round(y0 - 1.959963984540054 * sigma * sqrt(h), 6) AS yhat_lower,
    round(y0 + 1.959963984540054 * sigma * sqrt(h), 6) AS yhat_upper FROM s, range(1, {_HORIZON} + 1) r(h)""",
)
def f6_random_walk_interval(spark, sf_dir):
    walk = arima.fit(_whole(spark, sf_dir), ArimaSpec((0, 1, 0)), freq="MS", layout=SUMMED)
    return rounded(arima.forecast(walk, _HORIZON))


@register(
    "f3_seasonal_random_walk",
    f"""WITH {_WHOLE}, tail AS (SELECT unique_id, max(ds) AS last_date, list(y ORDER BY ds)[-12:] AS season FROM train GROUP BY 1)
    SELECT unique_id, last_date + to_months(CAST(h AS INTEGER)) AS ds, round(season[(h - 1) % 12 + 1], 6) AS yhat
    FROM tail, range(1, 19) r(h)""",
)
def f3_seasonal_random_walk(spark, sf_dir):
    spec = ArimaSpec((0, 0, 0), (0, 1, 0, 12))
    params = arima.fit(_whole(spark, sf_dir), spec, freq="MS", layout=SUMMED)
    return rounded(arima.forecast(params, 18).select("unique_id", "ds", "yhat"))


_SEASONAL_AR = ArimaSpec((0, 1, 0), (1, 0, 0, 12))


@register(
    "f3_seasonal_ar_parameters",
    f"""WITH {_WHOLE}, w AS (SELECT unique_id, ds, y - lag(y) {_W} AS w FROM train),
    l AS (SELECT unique_id, w, lag(w, 12) {_W} AS w12 FROM w), p AS (SELECT * FROM l WHERE w IS NOT NULL AND w12 IS NOT NULL)
    SELECT unique_id, count(*) AS n_rows, round(sum(w * w12) / sum(w12 * w12), 6) AS phi FROM p GROUP BY unique_id""",
)
def f3_seasonal_ar_parameters(spark, sf_dir):
    params = arima.fit(_whole(spark, sf_dir), _SEASONAL_AR, freq="MS", layout=SUMMED)
    return rounded(params.select("unique_id", "n_rows", F.col("ar")[0].alias("phi")))


# The two-stage estimate needs the solution of an 8 x 8 system per series: no SQL; tested against NumPy.
@register("f2_arima_forecast")
def f2_arima_forecast(spark, sf_dir):
    params = arima.fit(_whole(spark, sf_dir), ArimaSpec((1, 1, 1), trend="c"), freq="MS", layout=SUMMED)
    return rounded(arima.forecast(params, _HORIZON))


@register("f2_arima_of_products")
def f2_arima_of_products(spark, sf_dir):
    """One model per product: the many-series case."""
    params = arima.fit(_part_panel(spark, sf_dir), ArimaSpec((1, 0, 1), trend="c"), freq="MS", layout=SUMMED)
    return rounded(arima.forecast(params, _HORIZON))


@register("f3_sarima_forecast")
def f3_sarima_forecast(spark, sf_dir):
    params = arima.fit(_whole(spark, sf_dir), ArimaSpec((1, 1, 1), (1, 1, 1, 12)), freq="MS", layout=SUMMED)
    return rounded(arima.forecast(params, 12))


# --- exact likelihood ------------------------------------------------------------------------------


@register("f3_sarima_scored_by_brand")
def f3_sarima_scored_by_brand(spark, sf_dir):
    """Default seasonal model and seasonal naive on the months after the cutoff: errors and covered share per brand."""
    train = materialize(_train(spark, sf_dir), "train")
    model = SarimaModel().fit(train, freq="MS", layout=SUMMED)
    naive = forecast_baselines(fit_baselines(train, freq="MS", layout=SUMMED), 12).select("unique_id", "ds", "seasonal_naive")
    both = _later(spark, sf_dir).join(model.predict(12), ["unique_id", "ds"]).join(naive, ["unique_id", "ds"])
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))
    return rounded(
        both.groupBy("unique_id").agg(
            F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), 2))).alias("rmse"),
            F.sqrt(F.avg(F.pow(F.col("y") - F.col("seasonal_naive"), 2))).alias("naive_rmse"),
            F.avg(inside.cast("double")).alias("covered"),
        )
    )


_PHI = 0.4


@register(
    "f2_likelihood_with_holes",
    f"""WITH {PART_MONTHS}, panel AS (SELECT CAST(product_id AS VARCHAR) AS unique_id, CAST(period AS TIMESTAMP) AS ds, sales_amount / 1e5 AS y FROM part_monthly),
    gaps AS (SELECT unique_id, y, lag(y) {_W} AS y0, year(ds) * 12 + month(ds) - lag(year(ds) * 12 + month(ds)) {_W} AS g FROM panel),
    steps AS (SELECT unique_id, CASE WHEN g IS NULL THEN y ELSE y - pow({_PHI}, g) * y0 END AS v,
      CASE WHEN g IS NULL THEN 1 ELSE 1 - pow({_PHI}, 2 * g) END / (1 - {_PHI} * {_PHI}) AS f FROM gaps)
    SELECT unique_id, count(*) AS n_rows, round(-0.5 * sum(ln(2 * pi() * f) + v * v / f), 6) AS loglik FROM steps GROUP BY unique_id""",
)
def f2_likelihood_with_holes(spark, sf_dir):
    """Exact log-likelihood of an AR(1) with unit shocks over monthly sales per part, months without sales missing."""
    months = _part_panel(spark, sf_dir).withColumn("y", F.col("y") / 1e5)
    series = series_arrays(fill_dates(months, "MS"), "unique_id", "y", ["ds"])
    n = F.size(F.filter("values", lambda v: v.isNotNull())).cast("long")
    return rounded(series.select("unique_id", n.alias("n_rows"), log_likelihoods(F.col("values"), [_PHI], [], 1.0).alias("loglik")))


# --- regressors -----------------------------------------------------------------------------------

_TRAIN_X = f"""{PANEL_X}, train AS (SELECT unique_id, ds, y / 1e6 AS y, n_lines FROM panel WHERE ds < {_CUT}),
  given AS (SELECT unique_id, ds, n_lines FROM panel WHERE ds >= {_CUT} AND month(ds) BETWEEN 7 AND 10)"""


def _future_x(spark, sf_dir):
    """Regressor rows after the cutoff, with months left out, so that forecasts must repeat the last row."""
    later = brand_panel_with_orders(spark, sf_dir, since=CUTOFF)
    return later.where(F.month("ds").between(7, 10)).select("unique_id", "ds", "n_lines")


_FIRST_X = """nth AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS step FROM given)"""


@register(
    "j4_o4_future_rows",
    f"""WITH {_TRAIN_X}, {_FIRST_X} SELECT unique_id, CAST(step AS INTEGER) AS step, n_lines FROM nth WHERE step <= 3
    AND unique_id IN (SELECT unique_id FROM train)""",
)
def j4_o4_future_rows(spark, sf_dir):
    fitted = brand_panel(spark, sf_dir, before=CUTOFF).select("unique_id").distinct()
    return padded_future(fitted, _future_x(spark, sf_dir), ["n_lines"], 3)


_PADDED = f"""{_FIRST_X}, ends AS (SELECT unique_id, max(step) AS last_step FROM nth GROUP BY unique_id),
  padded AS (SELECT e.unique_id, h AS step, e.n_lines FROM (SELECT * FROM ends JOIN nth USING (unique_id)) e, range(1, 9) r(h)
    WHERE e.step = least(h, last_step))"""


@register(
    "u4_padded_future_rows",
    f"WITH {_TRAIN_X}, {_PADDED} SELECT unique_id, CAST(step AS INTEGER) AS step, n_lines FROM padded",
)
def u4_padded_future_rows(spark, sf_dir):
    fitted = brand_panel(spark, sf_dir, before=CUTOFF).select("unique_id").distinct()
    return padded_future(fitted, _future_x(spark, sf_dir), ["n_lines"], 8)


@register(
    "j6_aligned_regressors",
    f"""WITH {PANEL_X} SELECT unique_id, ds, round(y, 6) AS y, n_lines FROM panel""",
)
def j6_aligned_regressors(spark, sf_dir):
    """Target and regressor from two frames, aligned by series and date."""
    lines = brand_panel_with_orders(spark, sf_dir).select("unique_id", "ds", "n_lines")
    return rounded(brand_panel(spark, sf_dir).join(lines, ["unique_id", "ds"], "left"))


@register(
    "u1_forecasts_of_two_models",
    f"""WITH {_WHOLE}, s AS (SELECT unique_id, max(ds) AS last_date, arg_max(y, ds) AS y0, list(y ORDER BY ds)[-12:] AS season
      FROM train GROUP BY 1)
    SELECT 'walk' AS model, unique_id, last_date + to_months(CAST(h AS INTEGER)) AS ds, round(y0, 6) AS yhat FROM s, range(1, 4) r(h)
    UNION ALL SELECT 'seasonal walk', unique_id, last_date + to_months(CAST(h AS INTEGER)), round(season[h], 6) FROM s, range(1, 4) r(h)""",
)
def u1_forecasts_of_two_models(spark, sf_dir):
    train = materialize(_whole(spark, sf_dir), "train")  # read by each fit
    specs = {"walk": ArimaSpec((0, 1, 0)), "seasonal walk": ArimaSpec((0, 0, 0), (0, 1, 0, 12))}
    parts = [
        arima.forecast(arima.fit(train, spec, freq="MS", layout=SUMMED), 3).select(F.lit(name).alias("model"), "unique_id", "ds", "yhat")
        for name, spec in specs.items()
    ]
    return rounded(union_all(parts))


@register(
    "f7_forecast_with_regressor",
    f"""WITH {_TRAIN_X}, {_PADDED}, d AS (SELECT unique_id, ds, y, n_lines, y - lag(y) {_W} AS dy,
      n_lines - lag(n_lines) {_W} AS dx FROM train),
    b AS (SELECT unique_id, sum(dx * dy) / sum(dx * dx) AS beta, arg_max(y, ds) AS y0, arg_max(n_lines, ds) AS x0,
      max(ds) AS last_date FROM d GROUP BY unique_id),
    s AS (SELECT unique_id, sqrt(avg(pow(dy - beta * dx, 2))) AS sigma FROM d JOIN b USING (unique_id) GROUP BY unique_id)
    SELECT unique_id, last_date + to_months(CAST(step AS INTEGER)) AS ds, round(y0 + beta * (n_lines - x0), 6) AS yhat,
    round(y0 + beta * (n_lines - x0) - 1.959963984540054 * sigma * sqrt(step), 6) AS yhat_lower,
    round(y0 + beta * (n_lines - x0) + 1.959963984540054 * sigma * sqrt(step), 6) AS yhat_upper
    FROM padded JOIN b USING (unique_id) JOIN s USING (unique_id)""",
)
def f7_forecast_with_regressor(spark, sf_dir):
    train = _in_millions(brand_panel_with_orders(spark, sf_dir, before=CUTOFF))
    params = arima.fit(train, ArimaSpec((0, 1, 0), exog_cols=("n_lines",)), freq="MS", layout=SUMMED)
    return rounded(arima.forecast(params, 8, _future_x(spark, sf_dir)))


@register(
    "o5_last_rows",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""",
)
def o5_last_rows(spark, sf_dir):
    """The whole latest order of every customer; of one day's the one with the largest key."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    latest = last_rows(orders.withColumn("at", F.struct("o_orderdate", "o_orderkey")), "o_custkey", "at")
    return latest.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")


# --- updates --------------------------------------------------------------------------------------


@register(
    "j5_unknown_ids",
    f"""WITH {_PARTS}, before AS (SELECT DISTINCT unique_id FROM parts WHERE ds < TIMESTAMP '1995-06-01')
    SELECT DISTINCT unique_id FROM parts WHERE unique_id NOT IN (SELECT unique_id FROM before)""",
)
def j5_unknown_ids(spark, sf_dir):
    before, after = time_series_split(_part_panel(spark, sf_dir), "1995-06-01")
    return unknown_ids(after, before.select("unique_id").distinct())


@register(
    "u3_append_history",
    f"""WITH {PANEL} SELECT unique_id, ds, round(y, 6) AS y FROM panel WHERE ds < {_CUT} UNION ALL
      SELECT unique_id, ds, round(y, 6) AS y FROM panel WHERE ds >= {_CUT} - INTERVAL 1 MONTH""",
)
def u3_append_history(spark, sf_dir):
    """New rows overlap the history by a month; both copies stay."""
    history = brand_panel(spark, sf_dir, before=CUTOFF)
    new_rows = brand_panel(spark, sf_dir, since="2000-06-01")
    return rounded(arima.append_history(history, new_rows))


_UNION_PARAMS = f"WITH {PANEL}, whole AS (SELECT unique_id, ds, y / 1e6 AS y FROM panel), {_ar1_sql('whole')} {_AR1_PARAMS}"


@register("f10_refit_after_update", _UNION_PARAMS)
def f10_refit_after_update(spark, sf_dir):
    train = _train(spark, sf_dir)
    before = arima.fit(train, _AR1, freq="MS", layout=SUMMED)
    after, _ = arima.refit(before, train, _later(spark, sf_dir), freq="MS", layout=SUMMED)
    return _ar1_columns(after)


@register("f10_refit_from_buckets", _UNION_PARAMS.replace("FROM panel)", f"FROM panel WHERE ds < {_CUT} OR unique_id LIKE '%1')", 1))
def f10_refit_from_buckets(spark, sf_dir):
    """The brands that end in 1 report on, month by month; only their buckets of the stored history are read again."""
    train = _train(spark, sf_dir)
    params = arima.fit(train, _AR1, freq="MS", layout=SUMMED)
    history = SeriesHistory.create(train)
    later = materialize(_later(spark, sf_dir).where("unique_id LIKE '%1'"), "later")
    early = F.col("ds") < F.add_months(F.lit(CUTOFF), 6)
    for months in (later.where(early), later.where(~early)):
        params, history = arima.refit(params, history, months, freq="MS", layout=SUMMED)
    return _ar1_columns(params)


@register("f11_incremental_update", _UNION_PARAMS)
def f11_incremental_update(spark, sf_dir):
    before = arima.fit(_train(spark, sf_dir), _AR1, freq="MS", layout=SUMMED)
    return _ar1_columns(arima.update_incremental(before, _later(spark, sf_dir), layout=SUMMED))


# The brands that end in 1 report May 2000 after June.
_WITHHELD = "ds = TIMESTAMP '2000-05-01' AND unique_id LIKE '%1'"


@register("f11_update_with_late_rows", _UNION_PARAMS)
def f11_update_with_late_rows(spark, sf_dir):
    """Series on time are updated, those with a late month fitted again: as one fit of everything."""
    panel = materialize(_in_millions(brand_panel(spark, sf_dir)), "panel")
    known = (F.col("ds") < F.lit(CUTOFF).cast("timestamp_ntz")) & ~F.expr(_WITHHELD)
    before = arima.fit(panel.where(known), _AR1, freq="MS", layout=SUMMED)
    after, _ = arima.update(before, panel.where(known), panel.where(~known), freq="MS", layout=SUMMED)
    return _ar1_columns(after)


_STATE_FORECAST = f"""WITH {_TRAIN}, whole AS (SELECT unique_id, ds, y / 1e6 AS y FROM panel), {_ar1_sql('train')},
    w2 AS (SELECT unique_id, ds, y, y - lag(y) {_W} AS w FROM whole),
    moved AS (SELECT unique_id, max(ds) AS last_date, arg_max(y, ds) AS y0, arg_max(w, ds) AS w0 FROM w2 GROUP BY unique_id)
    SELECT unique_id, last_date + to_months(1) AS ds, round(y0 + c + phi * w0, 6) AS yhat FROM coef JOIN moved USING (unique_id)"""


@register("f11_state_update", _STATE_FORECAST)
def f11_state_update(spark, sf_dir):
    """Coefficients of the training months, last values of all months, next month's forecast."""
    before = arima.fit(_train(spark, sf_dir), _AR1, freq="MS", layout=SUMMED)
    moved = arima.update_incremental(before, _later(spark, sf_dir), update_params=False, layout=SUMMED)
    return rounded(arima.forecast(moved, 1).select("unique_id", "ds", "yhat"))


# --- the same through a stream, and through the model class ---------------------------------------


def _streamed(spark, sf_dir, update_params):
    """The parameter table after two runs of a file stream of later months, the second from the first one's checkpoint."""
    folder, source, checkpoint = (scratch_path(spark, label) for label in ("stream-params", "later-months", "checkpoint"))
    publish(folder, arima.fit(_train(spark, sf_dir), _AR1, freq="MS", layout=SUMMED))
    later = materialize(_later(spark, sf_dir), "later")
    early = F.col("ds") < F.add_months(F.lit(CUTOFF), 6)
    for months in (later.where(early), later.where(~early)):
        months.write.mode("append").parquet(source)
        stream = spark.readStream.schema(later.schema).parquet(source)
        writer = update_from_stream(stream, folder, update_params=update_params)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return latest(spark, folder)


@register("h1_streamed_parameters", _UNION_PARAMS)
def h1_streamed_parameters(spark, sf_dir):
    return _ar1_columns(_streamed(spark, sf_dir, True))


@register("h1_streamed_state", _STATE_FORECAST)
def h1_streamed_state(spark, sf_dir):
    return rounded(arima.forecast(_streamed(spark, sf_dir, False), 1).select("unique_id", "ds", "yhat"))


@register("f1_fit_update_predict", _STATE_FORECAST.replace(_ar1_sql("train"), _ar1_sql("whole")))
def f1_fit_update_predict(spark, sf_dir):
    model = ArimaModel((1, 1, 0)).fit(_train(spark, sf_dir), fh=1, freq="MS", layout=SUMMED)
    return rounded(model.update(_later(spark, sf_dir)).predict())


@register(
    "f12_model_metadata",
    f"""WITH {PANEL}, {_MONTH_GAPS.format(source='panel')} SELECT unique_id, n AS n_obs, last_date, freq,
    CASE WHEN even THEN 'month_start' ELSE 'seconds' END AS freq_unit, '{ArimaSpec((1, 0, 0)).to_json()}' AS spec FROM named""",
)
def f12_model_metadata(spark, sf_dir):
    path = scratch_path(spark, "params")
    save_object(path, arima.fit(brand_panel(spark, sf_dir), ArimaSpec((1, 0, 0)), layout=SUMMED))
    return load_object(spark, path).select("unique_id", "n_obs", "last_date", "freq", "freq_unit", "spec")
