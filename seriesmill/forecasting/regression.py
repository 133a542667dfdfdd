"""Least squares for all series at once: product sums in Spark, one small system per series in Python."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sum_of(a: Column, b: Column) -> Column:
    return F.coalesce(F.sum(a * b), F.lit(0.0))


def product_sums(
    rows: DataFrame,
    by: str,
    y: Column,
    xs: Sequence[Column],
    counted: Column | None = None,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Per series over the complete rows: ``n_rows``, ``yy``, ``xy`` and the upper triangle ``xx``.

    The sums are additive, so they are combined before the shuffle and can be kept for later updates.
    ``counted`` restricts the rows that enter the sums; ``also`` are further aggregates over all rows.
    """
    named = {f"__x{i}": x.cast("double") for i, x in enumerate(xs)} | {"__y": y.cast("double")}
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in named])
    if counted is not None:
        full = full & counted
    rows = rows.withColumns(named).withColumn("__full", full)
    masked = rows.withColumns({c: F.when(F.col("__full"), F.col(c)) for c in named})
    cols = [F.col(f"__x{i}") for i in range(len(xs))]
    upper = [_sum_of(cols[i], cols[j]) for i in range(len(cols)) for j in range(i, len(cols))]
    empty = F.array().cast("array<double>")
    return masked.groupBy(by).agg(
        F.count(F.when(F.col("__full"), True)).alias("n_rows"),
        _sum_of(F.col("__y"), F.col("__y")).alias("yy"),
        (F.array(*[_sum_of(c, F.col("__y")) for c in cols]) if cols else empty).alias("xy"),
        (F.array(*upper) if upper else empty).alias("xx"),
        *[c.alias(n) for n, c in (also or {}).items()],
    )


def _solve(matrices: np.ndarray, rights: np.ndarray) -> np.ndarray:
    """Solutions of stacked symmetric systems, scaled to a unit diagonal; least norm where singular."""
    scale = np.sqrt(np.diagonal(matrices, axis1=1, axis2=2))
    scale = np.where(scale > 0, scale, 1.0)
    unit = matrices / (scale[:, :, None] * scale[:, None, :])
    inverse = np.linalg.pinv(unit, rcond=1e-12, hermitian=True)
    return np.einsum("nij,nj->ni", inverse, rights / scale) / scale


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def solve_normal_equations(xx: pd.Series, xy: pd.Series) -> pd.Series:
    if xy.empty or len(xy.iloc[0]) == 0:
        return pd.Series([[]] * len(xy), dtype=object)
    rights = np.stack(xy.to_numpy())
    k = rights.shape[1]
    matrices = np.zeros((len(xy), k, k))
    i, j = np.triu_indices(k)
    matrices[:, i, j] = matrices[:, j, i] = np.stack(xx.to_numpy())
    return pd.Series(list(_solve(matrices, rights)))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def solve_yule_walker(gamma: pd.Series) -> pd.Series:
    """Autoregressive coefficients from the autocovariance sums at lags 0..m."""
    if gamma.empty:
        return pd.Series([], dtype=object)
    g = np.stack(gamma.to_numpy())
    m = g.shape[1] - 1
    lag = np.abs(np.subtract.outer(np.arange(m), np.arange(m)))
    return pd.Series(list(_solve(g[:, lag], g[:, 1:])))


def explained(xy: Column, coef: Column) -> Column:
    return F.aggregate(F.zip_with(xy, coef, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
