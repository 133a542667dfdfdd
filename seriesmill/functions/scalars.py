"""Column helpers with pandas/NumPy meaning: missing values, IEEE division, rounding, logarithms."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF, NAN = float("inf"), float("nan")


def named(name: str) -> Column:
    """A column by its literal name: a dot in it is no field access."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_column(c: str | Column) -> Column:
    return named(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL in every operator; Spark's avg, sum and max do not skip NaN."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(named(c)), named(c)) for c in floating}) if floating else df


def all_present(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [named(c).isNotNull() for c in cols], F.lit(True))


def divide(num: Column, den: Column) -> Column:
    """IEEE division: x/0 is +-inf and 0/0 is NaN, also under ANSI mode."""
    num, den = num.cast("double"), den.cast("double")
    at_zero = F.when(num > 0, INF).when(num < 0, -INF).when(num == 0, NAN)
    return F.when(den == 0, at_zero).otherwise(F.try_divide(num, den))


def round_half_even(c: str | Column, digits: int) -> Column:
    """Scaled to whole numbers, rounded half to even and scaled back, as NumPy does."""
    scale = 10.0**digits
    return F.rint(as_column(c).cast("double") * scale) / scale


def log1p(c: str | Column) -> Column:
    """log(1 + x): -inf at -1 and NaN below, where Spark alone gives NULL."""
    x = as_column(c).cast("double")
    return F.when(x > -1, F.log1p(x)).when(x == -1, -INF).when(x < -1, NAN)


def expm1(c: str | Column) -> Column:
    return F.expm1(as_column(c).cast("double"))
