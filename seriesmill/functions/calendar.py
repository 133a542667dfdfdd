"""Calendar features of a date column (Monday = 0, ISO weeks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import as_column


def ensure_datetime(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Cast to a zone-free timestamp; text that is no date raises (ANSI cast)."""
    if isinstance(df.schema[date_col].dataType, T.TimestampNTZType):
        return df
    return df.withColumn(date_col, F.col(date_col).cast("timestamp_ntz"))


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def _cycle(fn, c: Column, length: int) -> Column:
    return fn(2 * F.pi() * c / length)


def year(c: str | Column) -> Column:
    return F.year(as_column(c))


def month(c: str | Column) -> Column:
    return F.month(as_column(c))


def day(c: str | Column) -> Column:
    return F.dayofmonth(as_column(c))


def hour(c: str | Column) -> Column:
    return F.hour(as_column(c))


def weekday(c: str | Column) -> Column:
    return F.weekday(as_column(c))


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(as_column(c))


def quarter(c: str | Column) -> Column:
    return F.quarter(as_column(c))


def day_of_year(c: str | Column) -> Column:
    return F.dayofyear(as_column(c))


def yearmonth(c: str | Column) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def is_weekend(c: str | Column) -> Column:
    return _flag(weekday(c) >= 5)


def is_friday_to_sunday(c: str | Column) -> Column:
    return F.floor(weekday(c) / 4).cast("int")


def is_month_start(c: str | Column) -> Column:
    return _flag(day(c) == 1)


def is_month_end(c: str | Column) -> Column:
    return _flag(F.to_date(as_column(c)) == F.last_day(as_column(c)))


def cyclical(c: str | Column) -> dict[str, Column]:
    m, w = month(c), weekday(c)
    return {
        "month_sin": _cycle(F.sin, m, 12),
        "month_cos": _cycle(F.cos, m, 12),
        "weekday_sin": _cycle(F.sin, w, 7),
        "weekday_cos": _cycle(F.cos, w, 7),
    }


def month_number(df: DataFrame, date_col: str) -> Column:
    """Months since January of the first year of the whole table, counted from 1.

    The minimum is a scalar subquery: an aggregate of one column, not a window over all rows. It reads
    ``df`` once more, so write an expensive ``df`` first (``session.materialize``).
    """
    first_year = df.agg(F.year(F.min(date_col))).scalar()
    return (year(date_col) - first_year) * 12 + month(date_col)


def create_time_features(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    df = ensure_datetime(df, date_col)
    return df.withColumns(
        {
            "year": year(date_col),
            "month": month(date_col),
            "day": day(date_col),
            "hour": hour(date_col),
            "weekday": weekday(date_col),
            "week": iso_week(date_col),
            "yearmonth": yearmonth(date_col),
            "month_number": month_number(df, date_col),
            **cyclical(date_col),
            "is_weekend": is_weekend(date_col),
            "is_month_start": is_month_start(date_col),
            "is_month_end": is_month_end(date_col),
        }
    )


def series_date_columns(date_col: str) -> dict[str, Column]:
    """The date block of ``create_time_series_features``."""
    return {
        "dayofweek": weekday(date_col),
        "quarter": quarter(date_col),
        "month": month(date_col),
        "year": year(date_col),
        "dayofyear": day_of_year(date_col),
        "dayofmonth": day(date_col),
        "weekofyear": iso_week(date_col).cast("double"),
        "is_wknd": is_friday_to_sunday(date_col),
        "is_month_start": is_month_start(date_col),
        "is_month_end": is_month_end(date_col),
    }
