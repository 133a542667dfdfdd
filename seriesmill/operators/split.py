"""Chronological splits: by date, by fraction of the rows, and expanding cross-validation folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import named
from .layout import number_rows

POSITION = "position"


def time_series_split(df: DataFrame, cutoff_date, date_col: str = "ds") -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff, and rows on or after it. The filters reach a parquet scan."""
    cutoff = F.lit(cutoff_date).cast(df.schema[date_col].dataType)
    return df.where(named(date_col) < cutoff), df.where(named(date_col) >= cutoff)


def with_split_label(df: DataFrame, cutoff_date, date_col: str = "ds") -> DataFrame:
    cutoff = F.lit(cutoff_date).cast(df.schema[date_col].dataType)
    return df.withColumn("split", F.when(named(date_col) < cutoff, "train").when(named(date_col) >= cutoff, "test"))


def train_val_test_split(
    df: DataFrame, order_by: Sequence[str], fractions: tuple[float, float, float] = (0.7, 0.15, 0.15)
) -> DataFrame:
    """``split`` label by position in time: the first part trains, the next validates, the rest tests."""
    rows = number_rows(df, order_by, POSITION)
    n = rows.count()
    train_end, val_end = int(n * fractions[0]), int(n * (fractions[0] + fractions[1]))
    label = F.when(F.col(POSITION) < train_end, "train").when(F.col(POSITION) < val_end, "val").otherwise("test")
    return rows.withColumn("split", label)


@dataclass(frozen=True)
class Fold:
    fold: int
    train_end: int  # one past the last training position
    val_start: int
    val_end: int  # one past the last validation position

    def is_train(self) -> Column:
        return F.col(POSITION) < self.train_end

    def is_val(self) -> Column:
        return (F.col(POSITION) >= self.val_start) & (F.col(POSITION) < self.val_end)


def fold_bounds(n: int, n_splits: int = 5, test_size: int | None = None, gap: int = 0) -> list[Fold]:
    """Expanding training ranges, each followed by a gap and a validation range; the last one ends at ``n``."""
    if n_splits + 1 > n:
        raise ValueError(f"{n_splits + 1} folds are more than {n} rows")
    size = test_size or n // (n_splits + 1)
    if n - gap - size * n_splits <= 0:
        raise ValueError(f"{n_splits} splits of {size} rows and a gap of {gap} do not fit in {n} rows")
    starts = [n - (n_splits - i) * size for i in range(n_splits)]
    return [Fold(i, start - gap, start, start + size) for i, start in enumerate(starts)]


@dataclass(frozen=True)
class Folds:
    """Rows numbered in time order, and the position range of every fold. A fold is a filter, not a copy."""

    rows: DataFrame
    bounds: list[Fold]

    def train(self, fold: int) -> DataFrame:
        return self.rows.where(self.bounds[fold].is_train())

    def validation(self, fold: int) -> DataFrame:
        return self.rows.where(self.bounds[fold].is_val())

    def labelled(self) -> DataFrame:
        """One row per fold and member row, with ``fold`` and ``role``."""
        marks = [
            F.when(inside, F.struct(F.lit(f.fold).alias("fold"), F.lit(role).alias("role")))
            for f in self.bounds
            for role, inside in (("train", f.is_train()), ("val", f.is_val()))
        ]
        member = F.explode(F.array_compact(F.array(*marks)))
        return self.rows.withColumn("__m", member).select("__m.fold", "__m.role", *self.rows.columns)

    def per_fold(self, measure) -> DataFrame:
        """``measure(fold)`` gives aggregate columns for one fold; all folds are computed in one pass."""
        cells = [F.struct(F.lit(f.fold).alias("fold"), *[c.alias(n) for n, c in measure(f).items()]) for f in self.bounds]
        return self.rows.agg(F.array(*cells).alias("__folds")).select(F.inline("__folds"))

    def report(self, label_col: str) -> DataFrame:
        """First and last position, label (a date) and row count of both ranges of every fold."""

        def measure(f: Fold) -> dict[str, Column]:
            out = {}
            for role, inside in (("train", f.is_train()), ("val", f.is_val())):
                out[f"{role}_first"] = F.min(F.when(inside, F.col(POSITION)))
                out[f"{role}_last"] = F.max(F.when(inside, F.col(POSITION)))
                out[f"{role}_rows"] = F.count(F.when(inside, True))
                out[f"{role}_from"] = F.min(F.when(inside, F.col(label_col)))
                out[f"{role}_to"] = F.max(F.when(inside, F.col(label_col)))
            return out

        return self.per_fold(measure)


def expanding_folds(
    df: DataFrame, order_by: Sequence[str], n_splits: int = 5, test_size: int | None = None, gap: int = 0
) -> Folds:
    rows = number_rows(df, order_by, POSITION)
    return Folds(rows, fold_bounds(rows.count(), n_splits, test_size, gap))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
