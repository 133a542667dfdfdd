"""Operator 1: token ids of whole texts, written as packed binary files in id order, and read back.

Documents are range-partitioned by doc_id and sorted; every task encodes its documents and writes files of
``file_ids`` ids (format: pfor.py) under a name of its own attempt. Spark's writer commits the list of files
of the attempts that succeeded, so files of lost attempts are never read. Positions over the whole table are
one number per partition, added up in order; their number is the setting of shuffle partitions.

Defined results: a null text is empty; an empty text has the end id only; null doc_ids come first; repeated
rows are kept, each as a document, in any order among themselves; other columns are ignored. A file holds whole
documents, so a task needs memory for ``file_ids`` ids and its longest text.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import id_and_text, shuffle_partitions, texts_of
from .pfor import PERCENTILE, Reader, encode
from .wordids import word_ids

FILE_IDS = 1 << 21
READ_IDS = 1 << 19
FILES = "part int, seq int, file string, n_docs long, n_ids long, start_in_part long"
POSITIONS = "doc_id long, start_in_file long, n_tokens long, ids_crc32 long, ord_in_file long, part int, file_start long"


def write_ids(
    df: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    file_ids: int = FILE_IDS, percentile: int = PERCENTILE,
) -> DataFrame:
    """Write the files and their list (``folder``/files) and return the list."""
    spark = df.sparkSession
    end = int(end_id).to_bytes(4, "little")
    attempt_folder = f"{folder}/ids"

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(attempt_folder)
        store.create_dir(root, recursive=True)
        words, part = word_ids(tokenizer), TaskContext.get().partitionId()
        seq = start = pending = 0
        doc_ids: list[int | None] = []
        counts: list[int] = []
        chunks: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq, start, pending
            name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.ids"
            ids = np.frombuffer(b"".join(chunks), "<u4")
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(encode(doc_ids, counts, ids, percentile))
            row = {"part": [part], "seq": [seq], "file": [name], "n_docs": [len(doc_ids)], "n_ids": [len(ids)], "start_in_part": [start]}
            seq, start, pending = seq + 1, start + len(ids), 0
            doc_ids.clear(), counts.clear(), chunks.clear()
            return pa.RecordBatch.from_pydict(row, schema=LIST)

        for batch in stream:
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                n = 1
                for ids in words.stream(text):
                    chunks.append(ids)
                    n += len(ids) // 4
                chunks.append(end)
                doc_ids.append(doc)
                counts.append(n)
                pending += n
                if pending >= file_ids:
                    yield flush()
        if doc_ids:
            yield flush()

    LIST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("start_in_part", pa.int64())])
    docs = id_and_text(df, id_col, text_col)
    # equal ids are spread by their text
    ordered = docs.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    ordered.mapInArrow(write, FILES).write.parquet(f"{folder}/files")
    return spark.read.schema(FILES).parquet(f"{folder}/files")


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """From the files: doc_id, start (ids before it), n_tokens, ids_crc32 of every document."""
    attempt_folder = f"{folder}/ids"

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(attempt_folder)
        for batch in stream:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{root}/{row['file']}") as source:
                    file = Reader(source.read())
                stops = np.cumsum(file.counts)
                starts = stops - file.counts
                crcs, done = np.zeros(len(stops), np.int64), 0
                while done < len(stops):  # some documents at a time, one at least
                    upto = max(done + 1, int(np.searchsorted(stops, starts[done] + READ_IDS, side="right")))
                    base = int(starts[done])
                    ids = file.ids(base, int(stops[upto - 1])).astype("<u4").tobytes()
                    for k in range(done, upto):
                        crcs[k] = zlib.crc32(memoryview(ids)[4 * (int(starts[k]) - base) : 4 * (int(stops[k]) - base)])
                    done = upto
                n = len(stops)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(file.counts, pa.int64()), pa.array(crcs),
                        pa.array(np.arange(n, dtype=np.int64)), pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["start_in_part"], np.int64)),
                    ],
                    names=["doc_id", "start_in_file", "n_tokens", "ids_crc32", "ord_in_file", "part", "file_start"],
                )

    # a row per range partition: as many as the setting says
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("ids_of_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("ids_of_part").over(before), F.lit(0)).alias("part_start"))
    spread = files.repartition(max(1, shuffle_partitions(files.sparkSession)), "file")
    found = spread.mapInArrow(read, POSITIONS).join(F.broadcast(bases), "part")
    start = F.col("part_start") + F.col("file_start") + F.col("start_in_file")
    return found.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def token_output(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Write all documents as packed ids and return, from the files, each one's place, length and checksum."""
    folder = folder or scratch_path(df.sparkSession, "token-ids")
    return read_ids(write_ids(df, folder, tokenizer, end_id, id_col, text_col), folder)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import documents

    return token_output(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 1)
