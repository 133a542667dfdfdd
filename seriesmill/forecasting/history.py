"""Observations of many series as a table in buckets of series, to which updates are appended."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import named
from ..session import scratch_path

BUCKETS = 64
VERSION, BUCKET = "series_version", "series_bucket"


@dataclass(frozen=True)
class SeriesHistory:
    """A state of the table in ``path``: the versions up to ``version``, which later appends do not change.

    A series lies in the bucket its id hashes to, so the rows of some series are read from their buckets only, by one scan
    however many appends there were. An append that fails leaves this state as it was and may be made again; two
    writers must not append to one state. A bucket larger than Spark's advisory size is written by several tasks.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    id_col: str
    buckets: int
    version: int

    @classmethod
    def create(cls, rows: DataFrame, id_col: str = "unique_id", path: str | None = None, buckets: int = BUCKETS) -> SeriesHistory:
        """Write ``rows`` as the first version, in the shared folder unless a new ``path`` is given."""
        if buckets < 1:
            raise ValueError("buckets: at least 1")
        if {VERSION, BUCKET} & set(rows.columns):
            raise ValueError(f"columns named {VERSION} or {BUCKET} are not possible here")
        path = (path or scratch_path(rows.sparkSession, "history")).rstrip("/")
        return cls(rows.sparkSession, path, rows.schema, id_col, buckets, -1).append(rows)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(named(self.id_col).cast("string")), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame) -> SeriesHistory:
        """The next state, with ``rows`` added; a date present twice stays twice."""
        after = replace(self, version=self.version + 1)
        added = rows.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).withColumn(BUCKET, self._bucket())
        target = f"{self.path}/{VERSION}={after.version}"
        added.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        return after

    def _scan(self) -> DataFrame:
        parts = [T.StructField(VERSION, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())]
        stored = self.spark.read.schema(T.StructType([*self.schema.fields, *parts])).parquet(self.path)
        return stored.where(F.col(VERSION) <= self.version)

    def rows(self) -> DataFrame:
        return self._scan().select(*map(named, self.columns))

    def rows_of(self, series: DataFrame) -> DataFrame:
        """The rows of the series whose ids are in ``series``; as many numbers as there are buckets reach the driver."""
        touched = [r[0] for r in series.select(self._bucket().alias(BUCKET)).distinct().collect()]
        pruned = self._scan().where(F.col(BUCKET).isin(touched)).select(*map(named, self.columns))
        return pruned.join(series.select(named(self.id_col)).distinct(), self.id_col, "left_semi")

    def compact(self, path: str | None = None) -> SeriesHistory:
        """The same rows as one version in another folder, for when many appends have left small files."""
        return SeriesHistory.create(self.rows(), self.id_col, path, self.buckets)
