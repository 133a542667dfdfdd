"""Named queries, each with an independent SQL statement for the same result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """For comparison with SQL: round all double columns (``other`` gives digits by column), dates as timestamps."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, T.DoubleType):
            out[f.name] = F.round(F.col(f"`{f.name}`"), other.get(f.name, digits))
        elif isinstance(f.dataType, T.DateType):
            out[f.name] = F.col(f"`{f.name}`").cast("timestamp_ntz")
    return df.withColumns(out) if out else df
