"""Saved artifacts: tables (parameters, scalers, histories) as parquet, Spark ML models in their own format.

Every save is a new version in a folder of its own, which counts from the moment an empty mark is put beside it: one
file creation, whole or not there on any file system. A save that fails half-way leaves the version before readable.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession

KEEP = 2


def _at(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, none where there is no such folder."""
    files, at = _at(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.delete(at, True)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole versions, oldest first."""
    return [n for n in names_in(spark, f"{path}/_marks") if n.startswith("v")]


def _newest(spark: SparkSession, path: str) -> str:
    path = path.rstrip("/")
    versions = _versions(spark, path)
    return f"{path}/{versions[-1]}" if versions else path  # without marks: written by something else


def save_object(path: str, obj: DataFrame | MLWritable, keep: int = KEEP) -> None:
    """Save the next version under ``path`` and drop all but the last ``keep``; parent folders are created.

    A table read from ``path`` may be saved there again. A reader keeps its version until ``keep`` later saves.
    """
    if not isinstance(obj, (DataFrame, MLWritable)):
        raise TypeError(f"cannot save {type(obj).__name__}: expected a DataFrame or a Spark ML model")
    if keep < 1:
        raise ValueError("keep: at least 1")
    spark, path = SparkSession.active(), path.rstrip("/")
    before = _versions(spark, path)
    number = int(before[-1][1:].split("-")[0]) + 1 if before else 0
    name = f"v{number:010d}-{uuid.uuid4().hex}"
    if isinstance(obj, DataFrame):
        obj.write.parquet(f"{path}/{name}")
    else:
        obj.write().save(f"{path}/{name}")
    files, mark = _at(spark, f"{path}/_marks/{name}")
    files.create(mark, False).close()
    for old in [*before, name][:-keep]:
        delete(spark, f"{path}/_marks/{old}")  # first, so that no mark stands for a version that is half gone
        delete(spark, f"{path}/{old}")


def load_object(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a table."""
    return spark.read.parquet(_newest(spark, path))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(_newest(SparkSession.active(), path))
