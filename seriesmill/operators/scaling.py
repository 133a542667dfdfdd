"""Min-max scaling and fixed-length windows of past rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import named, nan_to_null
from .layout import lay_out


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The scaler: one row with ``<col>_min`` and ``<col>_max`` for every column."""
    return nan_to_null(df).agg(
        *[fn(named(c)).cast("double").alias(f"{c}_{n}") for c in cols for n, fn in (("min", F.min), ("max", F.max))]
    )


def _range(scaler: DataFrame, col: str) -> tuple[Column, Column]:
    """Low end and width, from one scalar subquery over the whole scaler row that all columns share."""
    row = scaler.select(F.struct(*map(named, scaler.columns))).scalar()
    low, high = row[f"{col}_min"], row[f"{col}_max"]
    return low, F.when(high == low, 1.0).otherwise(high - low)


def scale_min_max(df: DataFrame, scaler: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Map every column to 0..1; a constant column becomes 0."""
    out = {}
    for c in cols:
        low, span = _range(scaler, c)
        out[c] = (named(c) - low) / span
    return df.withColumns(out)


def unscale_min_max(df: DataFrame, scaler: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Back to the original scale; ``cols`` maps a column to the scaler column it was scaled with."""
    out = {}
    for c, source in cols.items():
        low, span = _range(scaler, source)
        out[c] = named(c) * span + low
    return df.withColumns(out)


def extract_subsequences(
    df: DataFrame,
    feature_cols: Sequence[str],
    target: str,
    lag: int,
    order_by: Sequence[str],
    group_cols: Sequence[str] | None = None,
    layout: str = "auto",
) -> DataFrame:
    """The ``lag`` rows of features before each row (oldest first) with the row's target as ``next_target``.

    Only rows with ``lag`` rows before them are kept.
    """
    keep = [*(group_cols or []), *order_by]
    needed = list(dict.fromkeys([*keep, *feature_cols, target]))
    rows = lay_out(df.select(*needed), group_cols, order_by, layout)
    vector = F.array(*[F.col(c).cast("double") for c in feature_cols])
    done = rows.with_columns(
        lag, lambda w: {"subsequence": F.collect_list(vector).over(w.rowsBetween(-lag, -1))}
    ).to_frame()
    return done.where(F.size("subsequence") == lag).select(*keep, "subsequence", F.col(target).alias("next_target"))
