"""Scores of models over expanding folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import expm1, nan_to_null, round_half_even
from .metrics import rmse
from .split import POSITION, Fold, Folds, expanding_folds, union_all

FitPredict = Callable[[DataFrame, DataFrame], DataFrame]


def fitted_by(estimator: Estimator, target: str, features: Sequence[str]) -> FitPredict:
    """Train a Spark ML estimator on the features and add ``prediction`` to the validation rows."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="__features")
    stage = estimator.copy({estimator.getParam("featuresCol"): "__features", estimator.getParam("labelCol"): target})

    def run(train: DataFrame, val: DataFrame) -> DataFrame:
        return Pipeline(stages=[assembler, stage]).fit(train).transform(val)

    return run


def time_series_cv(
    df: DataFrame,
    model: Estimator | FitPredict,
    target: str,
    order_by: Sequence[str],
    features: Sequence[str] | None = None,
    test_size: int | None = None,
    gap: int = 0,
    n_splits: int = 5,
    log: bool = False,
) -> DataFrame:
    """RMSE per fold. ``log`` says the target is log1p-scaled and scores on the original scale.

    A plain least-squares ``LinearRegression`` is not fitted fold by fold: see ``cv_least_squares``.
    """
    chosen = features or [c for c in df.columns if c != target and c not in order_by]
    folds = expanding_folds(df, order_by, n_splits, test_size, gap)
    if isinstance(model, LinearRegression) and _is_least_squares(model):
        return cv_least_squares(folds, target, chosen, log)
    if isinstance(model, Estimator):
        model = fitted_by(model, target, chosen)
    actual, predicted = (expm1(target), expm1("prediction")) if log else (F.col(target), F.col("prediction"))
    return union_all(
        [
            model(folds.train(f.fold), folds.validation(f.fold)).agg(
                F.lit(f.fold).alias("fold"), rmse(actual, predicted).alias("rmse")
            )
            for f in folds.bounds
        ]
    )


def cv_training_mean(folds: Folds, target: str) -> DataFrame:
    """RMSE per fold of predicting the mean of the training rows: all folds in one aggregate."""
    y = F.col(target).cast("double")

    def measure(f: Fold) -> dict[str, Column]:
        bias = F.avg(F.when(f.is_val(), y)) - F.avg(F.when(f.is_train(), y))
        return {"rmse": F.sqrt(F.var_pop(F.when(f.is_val(), y)) + bias * bias)}

    return folds.per_fold(measure)


def cv_line(folds: Folds, target: str, feature: str) -> DataFrame:
    """RMSE per fold of a least-squares line in one feature: all folds in one aggregate."""
    y, x = F.col(target).cast("double"), F.col(feature).cast("double")

    def measure(f: Fold) -> dict[str, Column]:
        ty, tx = F.when(f.is_train(), y), F.when(f.is_train(), x)
        vy, vx = F.when(f.is_val(), y), F.when(f.is_val(), x)
        slope, intercept = F.regr_slope(ty, tx), F.regr_intercept(ty, tx)
        spread = F.var_pop(vy) + slope * slope * F.var_pop(vx) - 2 * slope * F.covar_pop(vy, vx)
        bias = F.avg(vy) - intercept - slope * F.avg(vx)
        return {"rmse": F.sqrt(F.greatest(spread, F.lit(0.0)) + bias * bias)}

    return folds.per_fold(measure)


def _is_least_squares(model: LinearRegression) -> bool:
    plain = model.getRegParam() == 0 and model.getLoss() == "squaredError" and model.getFitIntercept()
    return plain and not model.isSet("weightCol")


def _segment_moments(folds: Folds, columns: Sequence[str]) -> DataFrame:
    """Per range of positions between neighbouring fold borders: ``n``, ``means`` and ``products`` (centred, summed).

    Folds share these ranges, so that a row is read once whatever their number. At most 3 ranges a fold; the sums
    are combined before the shuffle. Rows with a missing value are left out.
    """
    borders = sorted({b for f in folds.bounds for b in (f.train_end, f.val_start, f.val_end)})
    segment = sum((F.when(F.col(POSITION) >= b, 1).otherwise(0) for b in borders), F.lit(0))
    values = [F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    rows = nan_to_null(folds.rows.select(segment.alias("segment"), F.col(POSITION), *values)).dropna()
    v = [F.col(f"v{i}") for i in range(len(columns))]
    pairs = [F.covar_pop(v[i], v[j]) * F.count(F.lit(1)) for i in range(len(v)) for j in range(i, len(v))]
    return rows.groupBy("segment").agg(
        F.min(POSITION).alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in v]).alias("means"),
        F.array(*pairs).alias("products"),
    )


def _merged(part: pd.DataFrame, k: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Number, means and centred product sums of several ranges together."""
    n, means = part["n"].to_numpy(float), np.stack(part["means"].to_numpy())
    i, j = np.triu_indices(k)
    within = np.zeros((len(part), k, k))
    within[:, i, j] = within[:, j, i] = np.stack(part["products"].to_numpy())
    mean = n @ means / n.sum()
    off = means - mean
    return n.sum(), mean, within.sum(0) + (off * n[:, None]).T @ off


def _solved(products: np.ndarray) -> np.ndarray:
    """Slopes of the first column on the others, scaled to a unit diagonal; least norm where singular."""
    scale = np.sqrt(np.diagonal(products)[1:])
    scale = np.where(scale > 0, scale, 1.0)
    unit = products[1:, 1:] / np.outer(scale, scale)
    return np.linalg.pinv(unit, rcond=1e-12, hermitian=True) @ (products[1:, 0] / scale) / scale


def _fold_fits(folds: Folds, columns: Sequence[str]) -> DataFrame:
    """fold, intercept, slopes and, from the moments of the validation ranges alone, rmse (null without such rows)."""
    marks = [
        F.when(inside, F.struct(F.lit(f.fold).alias("fold"), F.lit(role).alias("role")))
        for f in folds.bounds
        for role, inside in (
            ("train", F.col("first") < f.train_end),
            ("val", (F.col("first") >= f.val_start) & (F.col("first") < f.val_end)),
        )
    ]
    members = _segment_moments(folds, columns).withColumn("m", F.explode(F.array_compact(F.array(*marks))))
    k = len(columns)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        train, val = part[part["role"] == "train"], part[part["role"] == "val"]
        out = {"fold": part["fold"].iloc[0], "intercept": None, "slopes": None, "rmse": None}
        if len(train):
            _, mean, products = _merged(train, k)
            slopes = _solved(products)
            out["intercept"], out["slopes"] = mean[0] - slopes @ mean[1:], slopes
            if len(val):
                n, mean, products = _merged(val, k)
                weights = np.concatenate([[1.0], -slopes])
                bias = weights @ mean - out["intercept"]
                out["rmse"] = np.sqrt(max(weights @ products @ weights / n, 0.0) + bias * bias)
        return pd.DataFrame([out])

    # A group is the ranges of one fold: at most 3 for every fold.
    schema = "fold int, intercept double, slopes array<double>, rmse double"
    return members.select("m.fold", "m.role", "n", "means", "products").groupBy("fold").applyInPandas(fit, schema)


def cv_least_squares(folds: Folds, target: str, features: Sequence[str], log: bool = False) -> DataFrame:
    """RMSE per fold of a least-squares fit with intercept on any number of features.

    Expanding folds share their past, so one aggregate over ranges between fold borders gives the system of every
    fold, and of its validation rows the errors too. On the original scale (``log``) the errors need the rows: one
    more pass, each validation row meeting the one fit of its fold. Missing values leave a row out; collinear
    features share a slope of least norm; a fold without usable rows scores null. Errors that are tiny beside the
    spread of the target carry the rounding of the sums.
    """
    columns = [target, *features]
    fits = _fold_fits(folds, columns)
    if log:
        fold = F.coalesce(*[F.when(f.is_val(), F.lit(f.fold)) for f in folds.bounds])
        values = [F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
        rows = nan_to_null(folds.rows.select(fold.alias("fold"), *values)).dropna()
        terms = sum((F.col(f"v{i + 1}") * F.col("slopes")[i] for i in range(len(features))), F.col("intercept"))
        scored = rows.join(F.broadcast(fits.drop("rmse")), "fold").withColumn("prediction", terms)  # one row a fold
        scores = scored.groupBy("fold").agg(rmse(expm1("v0"), expm1("prediction")).alias("rmse"))
    else:
        scores = fits.select("fold", "rmse")
    wanted = folds.rows.sparkSession.createDataFrame([(f.fold,) for f in folds.bounds], "fold int")
    return wanted.join(scores, "fold", "left")


def score_summary(scores: DataFrame, score_col: str = "rmse") -> DataFrame:
    """Mean and population standard deviation of the fold scores, to 4 digits."""
    return scores.agg(
        round_half_even(F.avg(score_col), 4).alias("mean_score"),
        round_half_even(F.stddev_pop(score_col), 4).alias("std_score"),
    )
