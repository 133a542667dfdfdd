"""Closed-form forecasts that need no estimation: mean, last value, last season, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.layout import lay_out
from .dates import frequency_columns, future_date, with_frequency, with_gaps


def fit_baselines(
    panel: DataFrame,
    season: int = 12,
    id_col: str = "unique_id",
    y_col: str = "y",
    ds_col: str = "ds",
    freq: str | None = None,
    layout: str = "auto",
) -> DataFrame:
    """One row per series: count, mean, first and last value, the last ``season`` values, frequency."""
    base = panel.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("unique_id"),
        F.col(ds_col).cast("timestamp_ntz").alias("ds"),
        F.col(y_col).cast("double").alias("y"),
    )
    rows = lay_out(base, ["unique_id"], ["ds"], layout).with_row_number("__back", from_end=True)
    kept = F.collect_list(F.when(F.col("__back") <= season, F.struct(-F.col("__back"), "y")))
    values = {
        "n_obs": F.count(F.lit(1)),
        "last_date": F.max("ds"),
        "mean_y": F.avg("y"),
        "first_y": F.min_by("y", "ds"),
        "last_y": F.max_by("y", "ds"),
        "last_season": F.transform(F.sort_array(kept), lambda r: r["y"]),
    }
    if freq is None:
        rows = with_gaps(rows, "ds")
        values |= frequency_columns("ds")
    stats = rows.to_frame().groupBy("unique_id").agg(*[c.alias(n) for n, c in values.items()])
    return with_frequency(stats, freq)


def forecast_baselines(fitted: DataFrame, horizon: int) -> DataFrame:
    """unique_id, ds, step and one column per baseline."""
    steps = fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    i, size = F.col("step"), F.size("last_season")
    drift = F.try_divide(F.col("last_y") - F.col("first_y"), F.col("n_obs") - 1)
    return steps.select(
        "unique_id",
        future_date(F.col("last_date"), F.col("freq_unit"), F.col("freq_step"), i).alias("ds"),
        "step",
        F.col("mean_y").alias("mean"),
        F.col("last_y").alias("naive"),
        F.element_at("last_season", ((i - 1) % size + 1).cast("int")).alias("seasonal_naive"),
        (F.col("last_y") + i * drift).alias("drift"),
    )
