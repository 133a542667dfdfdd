"""Keep a parameter table up to date from a stream of new observations.

Every micro-batch turns the newest version of the table into the next one. A version counts once its mark is written
beside it: which stream (the id Spark keeps with the checkpoint) and which batch of it made the version. A batch that
is run again after a failure is known by its mark and not applied twice, and a stream that starts with a new checkpoint
goes on from the newest version, whatever its own numbers are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..forecasting.arima import update_incremental
from ..sources.artifacts import delete, names_in

KEEP = 10
MARK = "stream string, batch long"


def _version_path(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/params/version={version}"


def _mark_path(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/marks/version={version}"


def publish(folder: str, params: DataFrame, version: int = 0, stream: str | None = None, batch: int | None = None) -> None:
    """Write a version and then its mark; a version without a mark is not read and may be written over."""
    params.write.mode("overwrite").parquet(_version_path(folder, version))
    mark = params.sparkSession.createDataFrame([(stream, batch)], MARK)
    mark.coalesce(1).write.mode("overwrite").parquet(_mark_path(folder, version))


def _newest(spark: SparkSession, folder: str) -> Row:
    """version, stream, batch of the newest version: one row per version is looked at."""
    marks = spark.read.schema(f"{MARK}, version int").parquet(f"{folder.rstrip('/')}/marks")
    return marks.orderBy(F.desc("version")).first()


def retire(spark: SparkSession, folder: str, keep: int = KEEP) -> None:
    """Drop all versions but the last ``keep`` that are marked, their marks first."""
    numbers = sorted(int(n.split("=")[1]) for n in names_in(spark, f"{folder.rstrip('/')}/marks") if n.startswith("version="))
    for version in numbers[:-keep]:
        delete(spark, _mark_path(folder, version))
        delete(spark, _version_path(folder, version))


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version of the parameter table."""
    return spark.read.parquet(_version_path(folder, _newest(spark, folder)["version"]))


def update_from_stream(
    stream: DataFrame,
    folder: str,
    id_col: str = "unique_id",
    y_col: str = "y",
    ds_col: str = "ds",
    update_params: bool = False,
    keep: int = KEEP,
) -> DataStreamWriter:
    """Apply ``update_incremental`` per micro-batch; version 0 must have been published in ``folder``.

    The last ``keep`` versions stay. What runs longer than ``keep`` batches on one version reads a copy of its own.
    A series that was never fitted, or a late or repeated date, stops the stream. The caller adds a checkpoint location and a trigger.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        newest = _newest(spark, folder)
        if newest["stream"] is not None and newest["stream"] == name and newest["batch"] >= batch_id:
            return  # run again after its version was written
        after = update_incremental(latest(spark, folder), batch, id_col, y_col, ds_col, update_params)
        publish(folder, after, newest["version"] + 1, name, batch_id)
        retire(spark, folder, keep)

    if keep < 1:
        raise ValueError("keep: at least 1")
    return stream.writeStream.outputMode("append").foreachBatch(apply)
