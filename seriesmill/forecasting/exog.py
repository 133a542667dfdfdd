"""Future regressor rows of every fitted series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ID = "unique_id"


def future_rows(
    fitted: DataFrame, future: DataFrame, exog_cols: Sequence[str], horizon: int, id_col: str = ID, ds_col: str = "ds"
) -> DataFrame:
    """Per fitted series the first ``horizon`` future rows as one array, in date order.

    ``row_number <= horizon`` is applied in every task before the shuffle, so an array never holds more
    than ``horizon`` rows however many were given.
    """
    nth = F.row_number().over(Window.partitionBy(ID).orderBy(F.col(ds_col).asc_nulls_last()))
    values = F.array(*[F.col(c).cast("double") for c in exog_cols])
    first = (
        future.select(F.col(id_col).cast("string").alias(ID), ds_col, values.alias("__x"))
        .withColumn("__nth", nth)
        .where(F.col("__nth") <= horizon)
    )
    ordered = F.sort_array(F.collect_list(F.struct("__nth", "__x")))
    arrays = first.groupBy(ID).agg(F.transform(ordered, lambda r: r["__x"]).alias("x_future"))
    return fitted.select(ID).join(arrays, ID, "left")


def padded_future(
    fitted: DataFrame, future: DataFrame, exog_cols: Sequence[str], horizon: int, id_col: str = ID, ds_col: str = "ds"
) -> DataFrame:
    """One row per fitted series and step; the last given row is repeated up to the horizon.

    A series without future rows has no rows here.
    """
    arrays = future_rows(fitted, future, exog_cols, horizon, id_col, ds_col).where(F.col("x_future").isNotNull())
    steps = arrays.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    row = F.element_at("x_future", F.least(F.col("step"), F.size("x_future")))
    return steps.select(ID, "step", *[row[i].alias(c) for i, c in enumerate(exog_cols)])


def last_rows(df: DataFrame, id_col: str, ds_col: str) -> DataFrame:
    """The latest row of every series (an aggregate, combined before the shuffle)."""
    others = [c for c in df.columns if c != id_col]
    latest = df.groupBy(id_col).agg(F.max_by(F.struct(*others), F.col(ds_col)).alias("__last"))
    return latest.select(id_col, *[F.col(f"__last.{c}").alias(c) for c in others])


def unknown_ids(new_rows: DataFrame, fitted: DataFrame, id_col: str = ID) -> DataFrame:
    """Series in ``new_rows`` that were never fitted."""
    ids = new_rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias(ID)).distinct()
    return ids.join(fitted.select(ID), ID, "left_anti")
