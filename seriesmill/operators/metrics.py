"""Forecast error measures as grouped aggregates; every measure is combined before the shuffle."""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column, divide, nan_to_null, round_half_even

MAPE_EPSILON = 1e-9
REPORT_DIGITS = 4


def _pair(actual: str | Column, forecast: str | Column) -> tuple[Column, Column, Column]:
    a, p = as_column(actual).cast("double"), as_column(forecast).cast("double")
    return a, p, a.isNotNull() & p.isNotNull()


def _guard(value: Column, complete: Column, strict: bool) -> Column:
    """With ``strict``, one missing pair makes the measure missing; otherwise such pairs are left out."""
    return F.when(F.bool_and(complete), value) if strict else value


def _mean_of(term: Column, complete: Column, strict: bool) -> Column:
    return _guard(F.avg(F.when(complete, term)), complete, strict)


def mape_eps(actual, forecast, strict: bool = True) -> Column:
    a, p, ok = _pair(actual, forecast)
    return _mean_of(F.abs(divide(a - p, a + MAPE_EPSILON)), ok, strict) * 100


def mape(actual, forecast, strict: bool = True) -> Column:
    """Without the epsilon: infinite when an actual value is zero."""
    a, p, ok = _pair(actual, forecast)
    return _mean_of(F.abs(divide(a - p, a)), ok, strict) * 100


def mae(actual, forecast, strict: bool = True) -> Column:
    a, p, ok = _pair(actual, forecast)
    return _mean_of(F.abs(a - p), ok, strict)


def mse(actual, forecast, strict: bool = True) -> Column:
    a, p, ok = _pair(actual, forecast)
    return _mean_of((a - p) * (a - p), ok, strict)


def rmse(actual, forecast, strict: bool = True) -> Column:
    return F.sqrt(mse(actual, forecast, strict))


def r2(actual, forecast, strict: bool = True) -> Column:
    """1 - SSres/SStot from one pass; a constant target scores 1 if met exactly and 0 otherwise."""
    a, p, ok = _pair(actual, forecast)
    spread = F.var_pop(F.when(ok, a))
    error = F.avg(F.when(ok, (a - p) * (a - p)))
    score = F.when(spread > 0, 1 - F.try_divide(error, spread)).otherwise(F.when(error == 0, 1.0).otherwise(0.0))
    return _guard(F.when(F.count(F.when(ok, a)) >= 2, score), ok, strict)


def _summarise(df: DataFrame, by: Sequence[str], *measures: Column) -> DataFrame:
    return nan_to_null(df).groupBy(*by).agg(*measures)


def evaluate_result_forecast(df: DataFrame, actual_col: str, forecast_col: str, by: Sequence[str] = ()) -> DataFrame:
    return _summarise(
        df, by, mape_eps(actual_col, forecast_col).alias("MAPE"), rmse(actual_col, forecast_col).alias("RMSE")
    )


def evaluate_regressor(
    df: DataFrame, actual_col: str, forecast_col: str, model_name: str = "model", by: Sequence[str] = ()
) -> DataFrame:
    """One row per group: Model, MAE, MSE, MAPE, RMSE, R2 to 4 digits; RMSE is the root of the rounded MSE."""
    pair = (actual_col, forecast_col)
    scores = _summarise(df, by, *[fn(*pair).alias(n) for n, fn in (("MAE", mae), ("MSE", mse), ("MAPE", mape), ("R2", r2))])
    rounded = {c: round_half_even(c, REPORT_DIGITS) for c in ("MAE", "MSE", "MAPE", "R2")}
    report = scores.withColumns(rounded).withColumn("RMSE", round_half_even(F.sqrt("MSE"), REPORT_DIGITS))
    return report.select(*by, F.lit(model_name).alias("Model"), "MAE", "MSE", "MAPE", "RMSE", "R2")


def reference_line(train: DataFrame, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Ends of the actual-equals-predicted line: range of the training target."""
    return _summarise(train, by, F.min(target).alias("line_min"), F.max(target).alias("line_max"))


def residual(actual, forecast) -> Column:
    return as_column(actual) - as_column(forecast)


def compare_actual_predicted(df: DataFrame, actual_col: str, forecast_col: str, keys: Sequence[str] = ()) -> DataFrame:
    a, p = F.col(actual_col).cast("double"), F.col(forecast_col).cast("double")
    return df.select(
        *keys,
        round_half_even(a, 2).alias("Actual"),
        round_half_even(p, 2).alias("Predicted"),
        round_half_even(F.abs(p - a), 2).alias("Residual"),
    )


def residual_distribution(df: DataFrame, actual_col: str, forecast_col: str, bins: int = 20) -> DataFrame:
    """Histogram of actual minus forecast: one row per non-empty bin of equal width."""
    errors = nan_to_null(df).select(residual(actual_col, forecast_col).cast("double").alias("r")).where("r IS NOT NULL")
    range_ = errors.agg(F.struct(F.min("r").alias("low"), F.max("r").alias("high"), F.count("r").alias("n"))).scalar()
    low, high, total = range_["low"], range_["high"], range_["n"]
    width = (high - low) / bins
    place = F.when(width > 0, F.least(F.floor(F.try_divide(F.col("r") - low, width)), F.lit(bins - 1))).otherwise(0)
    counts = errors.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        "rows",
        F.try_divide(F.col("rows").cast("double"), total * width).alias("density"),
    )


def residual_density(df: DataFrame, actual_col: str, forecast_col: str, points: int = 200, cut: float = 3.0, bandwidth: float | None = None) -> DataFrame:
    """point, x, density: a Gaussian kernel density of actual minus forecast on an even grid.

    Residuals are shared between their two neighbouring grid points (linear binning), in one aggregate of at most ``points``
    rows, and the bins are convolved with the kernel: the work beyond one pass does not depend on the rows. The bandwidth
    is the sample deviation times n^(-1/5) unless given; the grid reaches ``cut`` bandwidths over the ends. Residuals
    that are all equal, or fewer than two, have no density: no rows.
    """
    errors = nan_to_null(df).select(residual(actual_col, forecast_col).cast("double").alias("r")).where("r IS NOT NULL")
    stats = errors.agg(F.struct(F.min("r").alias("low"), F.max("r").alias("high"), F.count("r").alias("n"), F.stddev_samp("r").alias("sd"))).scalar()
    h = F.lit(float(bandwidth)) if bandwidth else stats["sd"] * F.pow(stats["n"].cast("double"), -0.2)
    low = stats["low"] - cut * h
    step = (stats["high"] - stats["low"] + 2 * cut * h) / (points - 1)
    placed = errors.withColumn("place", F.try_divide(F.col("r") - low, step)).where("place IS NOT NULL")
    bin_ = F.least(F.floor("place"), F.lit(points - 2)).cast("int")
    bins = placed.withColumn("bin", bin_).withColumn("share", F.col("place") - F.col("bin"))
    bins = bins.groupBy("bin").agg(F.sum(1 - F.col("share")).alias("here"), F.sum("share").alias("next"))
    held = bins.agg(F.array_sort(F.collect_list(F.struct("bin", "here", "next"))).alias("bins")).withColumns(
        {"low": low, "step": step, "h": h, "n": stats["n"].cast("double")}
    )

    def kernel(distance: Column) -> Column:
        return F.exp(-0.5 * F.pow(distance * F.col("step") / F.col("h"), 2))

    def total(k: Column) -> Column:
        near = F.transform("bins", lambda b: b["here"] * kernel(k - b["bin"]) + b["next"] * kernel(k - b["bin"] - 1))
        return F.aggregate(near, F.lit(0.0), lambda s, v: s + v)

    each = F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)),
        lambda k: F.struct(
            k.alias("point"), (F.col("low") + k * F.col("step")).alias("x"),
            (total(k) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"),
        ),
    )
    return held.where("size(bins) > 0").select(F.explode(each).alias("g")).select("g.*")
