"""Operator 8: documents packed into sequences by first-fit decreasing over a tournament tree, in random groups.

A document's ids (and the end id) are cut at every ``capacity`` ids; full pieces are sequences of their own. The
other pieces go to random groups of about ``group_tokens`` ids. A group takes its pieces by falling length and
puts each into the first sequence with room, found by descending a tree whose nodes hold the largest room below
them. A sequence may end at a power of two without padding; what a group's last sequence lacks is small against
the group.

Only the lengths and checksums of pieces are shuffled, never ids. Pieces are written once before they are
grouped, so a repeated task groups them as before.

Defined results: a null text is empty; every document has the end id, so no piece is empty; repeated rows are
documents of their own (a group is chosen by row, not by doc_id); other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import give_back, id_and_text, parts_for, texts_of
from .wordids import REMEMBERED, word_ids

CAPACITY = 4096
GROUP_TOKENS = 1 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = "row_ long, sequence_id long, offset long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; equal lengths in their given order."""
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    leaves = 1
    while leaves < n:
        leaves *= 2
    room = [capacity] * (2 * leaves)  # the winner of each match: the largest room below
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, need in zip(order.tolist(), lengths[order].tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < need:
                at += 1
        bins[k], offsets[k] = at - leaves, capacity - room[at]
        room[at] -= need
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
    return bins, offsets


def pieces(
    df: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens. ``remembered``: words whose ids a worker keeps."""
    end, size = int(end_id).to_bytes(4, "little"), 4 * capacity
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer, remembered)
        for batch in stream:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                sums, rest = [], b""
                for ids in words.stream(text):
                    rest += ids
                    while len(rest) >= size:
                        sums.append(zlib.crc32(rest[:size]))
                        rest = rest[size:]
                rest += end
                total = len(sums) * capacity + len(rest) // 4
                rows += [(doc, k * capacity, capacity, c, total) for k, c in enumerate(sums)]
                rows.append((doc, len(sums) * capacity, len(rest) // 4, zlib.crc32(rest), total))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5, names=names)
        give_back()

    return id_and_text(df, id_col, text_col).mapInArrow(cut, PIECES)


def pack(found: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS, seed: int = 7) -> DataFrame:
    """Add sequence_id and offset to pieces."""
    found = materialize(found.withColumn("row_", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") >= capacity
    rest = found.where(~full)
    groups = parts_for(rest.agg(F.sum("length")).first()[0], group_tokens)

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_", ignore_index=True)
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        return pd.DataFrame({"row_": group["row_"], "sequence_id": (bins * groups + key[0]) * 2, "offset": offsets})

    # only numbers that are never null go through pandas, which would make doubles of a column with nulls
    grouped = rest.select("row_", "length", F.pmod(F.xxhash64("row_", F.lit(seed)), F.lit(groups)).alias("group_"))
    placed = rest.join(grouped.groupBy("group_").applyInPandas(fit, PLACED), "row_")
    alone = found.where(full).withColumns({"offset": F.lit(0).cast("long"), "sequence_id": F.col("row_") * 2 + 1})
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return alone.select(columns).unionByName(placed.select(columns))


def pack_documents(
    df: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = REMEMBERED, **options: int,
) -> DataFrame:
    return pack(pieces(df, tokenizer, end_id, capacity, id_col, text_col, remembered), capacity, **options)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import documents

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2)
