"""Session settings the operators rely on, and the shared folder for written intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()
_scratch: list[list[str]] = []


def build_session(app_name: str = "seriesmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above whose workers can import this package."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once; needed where it is not installed on them."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="seriesmill-")) / "seriesmill.zip"  # read by the driver, served by Spark
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only where nothing is configured and Spark runs in one local JVM.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="seriesmill-")
    return _local_dirs[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/seriesmill/{label}-{uuid.uuid4().hex}"
    for listed in _scratch:
        listed.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete at the end what operators wrote to the shared folder within: finish with their results before.

        with scratch_scope(spark):
            add_lag_features(rows, layout="blocks").write.parquet(target)
    """
    paths: list[str] = []
    _scratch.append(paths)
    try:
        yield paths
    finally:
        _scratch.remove(paths)
        jvm = spark._jvm
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage to recompute when executors are lost, is read with column pruning, and
    keeps values that would differ between two evaluations (row numbers of a range-sorted frame).
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
