"""Helpers of the corpus operators: reading tables, id columns that cannot clash, and files in the shared folder."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIX = 0x9E3779B97F4A7C15


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def q(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(df: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """Just doc_id (long) and text (string), whatever else the table holds; with ``carry`` all else as ``row_``."""
    doc, text = q(id_col).cast("long").alias("doc_id"), q(text_col).cast("string").alias("text")
    return df.select(doc, text, F.struct(*[q(c) for c in df.columns if c != text_col]).alias("row_")) if carry else df.select(doc, text)


def restored(found: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """The carried rows with their text, in the table's own columns."""
    return found.select(*[F.col("text").alias(c) if c == text_col else F.col("row_").getField(c).alias(c) for c in columns])


def schema_of(found: str, texts: DataFrame, *names: str) -> T.StructType:
    """A schema in words, and the fields of ``texts`` that are named and there."""
    return T.StructType([*T._parse_datatype_string(found).fields, *[f for f in texts.schema if f.name in names]])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(amount: float, per_part: float, least: int = 1) -> int:
    """How many groups of ``per_part`` hold ``amount``."""
    return max(least, math.ceil((amount or 0) / per_part))


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Spark's workers stay alive beside the next stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def batches(make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """The function of mapInArrow for a generator over one batch."""

    def over(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            yield from make(batch)
        give_back()

    return over


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column, empty where null."""
    column = batch.column(name)
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def some_texts(texts: pa.Array, rows: int = 256) -> Iterator[bytes]:
    """UTF-8 bytes of a column of texts, empty where null, copied some rows at a time."""
    for start in range(0, len(texts), rows):
        yield from (t or b"" for t in texts.slice(start, rows).cast(pa.large_binary()).to_pylist())


BROADCAST_BYTES = 32 << 20


def mark_ids(df: DataFrame, ids: DataFrame, flag: str) -> DataFrame:
    """Add a boolean column: whether the row's doc_id is among ``ids`` (one column doc_id, distinct).

    The ids are broadcast where their measured number takes less than BROADCAST_BYTES, else both sides are shuffled.
    """
    found = ids.withColumn(flag, F.lit(True))
    if ids.count() * 64 <= BROADCAST_BYTES:
        found = F.broadcast(found)
    return df.join(found, "doc_id", "left").withColumn(flag, F.coalesce(q(flag), F.lit(False)))
