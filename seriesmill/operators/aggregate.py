"""Sums of sales per group and calendar period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import ensure_datetime, yearmonth
from ..functions.scalars import all_present, nan_to_null


def period_start(date_col: str, freq: str) -> Column:
    """First day of the month (M) or of the Monday-to-Sunday week (W); the date itself otherwise."""
    unit = {"M": "month", "W": "week"}.get(freq.upper())
    return F.date_trunc(unit, F.col(date_col)).cast("date") if unit else F.col(date_col)


def aggregate_sales(
    df: DataFrame,
    value_col: str = "sales_amount",
    group_cols: Sequence[str] | None = None,
    freq: str = "M",
    date_col: str = "order_date",
) -> DataFrame:
    """One row per group and period: the groups, ``period``, the sum and a ``yearmonth`` label.

    Rows with a missing group or date are left out; a sum of missing values only is 0. The sum is
    combined before the shuffle, so a hot group costs one row per task and period.
    """
    groups = list(group_cols or [])
    rows = ensure_datetime(df, date_col).select(*groups, date_col, value_col)
    rows = nan_to_null(rows).where(all_present([*groups, date_col]))
    total = F.coalesce(F.sum(value_col).cast("double"), F.lit(0.0))
    sums = rows.groupBy(*groups, period_start(date_col, freq).alias("period")).agg(total.alias(value_col))
    return sums.withColumn("yearmonth", yearmonth("period"))
