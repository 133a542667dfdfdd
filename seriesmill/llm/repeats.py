"""Operator 7: repeated byte strings across documents, by prefix doubling over sampled positions.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller doc_id.
Prefix doubling gives every position the rank of its first 8 bytes, then of 16, 32 ... from the pair of ranks at
the position and at the growing offset, until it is unique or past the threshold. Here a rank is a 64-bit name made
from the pair, not its place in an order, since only equality counts; and the corpus-wide steps work on
fewer positions:

1. Positions are sampled by their content: of every string of ``length`` bytes at least one sampled position has
   its 24 bytes inside (the least name of the string's 24-byte runs), the same one wherever the string stands. The
   names of sampled positions are sorted together, corpus-wide; those found in one document only are unique and go.
2. For the others, the bytes around them are dealt by name; there the doubling is carried to ``length`` for every
   string that holds the position, ranks are sorted, and each string gets the smallest doc_id that has it. Equal
   names are compared byte by byte.
3. What is found comes back to the texts, which lose the bytes of every string that has a smaller document.

Texts are written once into a table of shards of about ``shard_bytes``, bucketed by shard, so that steps 2 and 3 join
what comes back without moving texts. Shards send each name once, however often they hold it, with packed arrays
in place of rows. A name with very many documents (``hot`` or more) is not dealt by itself but by each string that
holds it, so that no group holds more than distinct strings that are truly equal, once per shard.

Defined results: a null text is empty; a document with a null doc_id neither loses bytes nor causes a loss; rows
of the same doc_id do not affect each other; strings are judged on the input, never across documents; other
columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path
from .common import batches, id_and_text, parts_for, restored, texts_of

LENGTH = 50
GRAM = 24
SHARD_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
HOT = 10_000
STEP = 1 << 19
EARLIER_RECORDS = 1 << 14
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_LOW = np.uint64(0xFFFFFFFF)


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at every position, along the last axis."""
    shape = (*data.shape[:-1], data.shape[-1] - 7)
    return np.ndarray(shape, "<u8", data, 0, (*data.strides[:-1], 1))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a string from the names of its two parts."""
    x = a * _K[0]
    x ^= x >> np.uint64(29)
    x += b
    x *= _K[1]
    x ^= x >> np.uint64(32)
    x *= _K[2]
    x ^= x >> np.uint64(29)
    return x


def _names(data: np.ndarray, size: int) -> np.ndarray:
    """The names of all strings of ``size`` (16 or more) bytes along the last axis, by doubling from 8."""
    names, have = _words(data), 8
    while have < size:
        offset = min(have, size - have)
        n = names.shape[-1] - offset
        names = _pair(names[..., :n], names[..., offset : offset + n])
        have += offset
    return names


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    have = 1
    while have < width:
        offset = min(have, width - have)
        values = best(values[:-offset], values[offset:])
        have += offset
    return values


class Shard:
    """Some documents' bytes in a row, with the sampled positions."""

    def __init__(self, doc_ids: list[int | None], texts: list[bytes], length: int = LENGTH):
        self.length, self.spread = length, length - GRAM
        self.doc_ids = doc_ids
        self.docs = np.array([-1 if d is None else d for d in doc_ids], np.int64)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        pad = bytes(length)
        self.data = np.frombuffer(b"".join([*texts, pad]), np.uint8)
        n = len(self.data) - length
        whole = np.ones(n + 1, bool)  # strings that lie in one document
        whole[n] = False
        last = self.ends[:, None] - 1 - np.arange(length - 1)
        whole[last[last >= self.starts[:, None]]] = False
        for k, d in enumerate(doc_ids):
            if d is None:
                whole[self.starts[k] : self.ends[k]] = False
        self.at, self.name = self._sample(whole, n)
        self.doc = np.searchsorted(self.ends, self.at, side="right")

    def _sample(self, whole: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        at, found, wide = [], [], self.spread + 1
        for begin in range(0, n, STEP):
            end = min(n, begin + STEP)
            low = max(0, begin - self.spread)
            names = _names(self.data[low : end + self.length], GRAM) | np.uint64(1)
            least = _sliding(names, wide, np.minimum)[: end - low]
            least = np.where(whole[low : low + len(least)], least, np.uint64(0))
            around = np.concatenate([np.zeros(self.spread, np.uint64), least])
            most = _sliding(around, wide, np.maximum)  # over the strings that hold the position
            chosen = np.flatnonzero(most == names[: len(most)])
            chosen = chosen[chosen >= begin - low]
            at.append(chosen + low)
            found.append(names[chosen])
        return np.concatenate(at) if at else np.zeros(0, np.int64), np.concatenate(found) if found else np.zeros(0, np.uint64)

    def keys(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys (bucket and 32 bits of the name), in how many documents each is, and each position's key."""
        key = _bucket(self.name, buckets) << np.uint64(32) | self.name & _LOW
        order = np.argsort(key, kind="stable")  # positions, and so documents, in order below a key
        key, doc = key[order], self.doc[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        fresh = new.copy()
        fresh[1:] |= doc[1:] != doc[:-1]
        starts = np.flatnonzero(new)
        inverse = np.empty(len(key), np.int64)
        inverse[order] = np.cumsum(new) - 1
        return key[starts], np.add.reduceat(fresh.astype(np.int64), starts) if len(starts) else starts, inverse

    def candidates(self, codes: np.ndarray, inverse: np.ndarray, buckets: int) -> list["Records"]:
        """The records around positions that are not unique: whole contexts, and single strings of hot names."""
        code = codes[inverse]
        usual, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        at, doc = self.at[usual], self.doc[usual]
        left = np.minimum(self.spread, at - self.starts[doc])
        right = np.minimum(self.spread, self.ends[doc] - GRAM - at)
        found = [Records(self, at - self.spread, left, right, doc, _bucket(self.name[usual], buckets), self.length + self.spread)]
        at = (self.at[hot][:, None] - np.arange(self.spread + 1)).reshape(-1)
        doc = np.repeat(self.doc[hot], self.spread + 1)
        fits = (at >= self.starts[doc]) & (at + self.length <= self.ends[doc])
        at, place = np.unique(at[fits], return_index=True)
        doc, zero = doc[fits][place], np.zeros(len(at), np.int64)
        found.append(Records(self, at, zero, zero, doc, None, self.length, buckets))
        return found

    def removed(self, starts: list[np.ndarray]) -> np.ndarray:
        """Which bytes go, from where repeated strings start."""
        change = np.zeros(len(self.data) + 1, np.int64)
        for s in starts:
            np.add.at(change, s, 1)
            np.add.at(change, s + self.length, -1)
        return np.cumsum(change)[: len(self.data) - self.length] > 0


def _bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    """Even buckets: sampled names are the least of their strings, so their own high bits are not spread."""
    return (names * _K[1] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


class Records:
    """Distinct byte strings of one size in a shard, the smallest document of each, and where they stand.

    A record with ``left`` and ``right`` usable bytes around its middle holds the strings that start at its
    places ``spread - left`` to ``right``; what lies outside the document is blanked.
    """

    def __init__(self, shard: Shard, at: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray, bucket: np.ndarray | None, size: int, buckets: int = 0):
        self.shard, self.at, self.size, self.strings = shard, at, size, size - shard.length + 1
        rows = np.zeros((len(at), size + 2), np.uint8)
        place = np.arange(size)
        for k in range(0, len(at), 1 << 13):
            part = slice(k, k + (1 << 13))
            where = at[part, None] + place
            spread = size - shard.length
            inside = (place >= spread - left[part, None]) & (place < size - spread + right[part, None])
            rows[part, :size] = np.where(inside, shard.data[np.clip(where, 0, len(shard.data) - 1)], 0)
        rows[:, size], rows[:, size + 1] = left, right
        self.rows, self.inverse, self.bucket = rows[:0], np.zeros(0, np.int64), np.zeros(0, np.uint64)
        self.least = self.docs = np.zeros(0, np.int64)
        if not len(at):
            return
        ids = shard.docs[doc]
        _, first, inverse = np.unique(rows.view(f"V{size + 2}").reshape(-1), return_index=True, return_inverse=True)
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, inverse, ids)
        buckets_of = bucket[first] if bucket is not None else _bucket(_names(np.ascontiguousarray(rows[first, :size]), size)[:, 0], buckets)
        by = np.argsort(buckets_of, kind="stable")
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        self.rows, self.bucket, self.least = rows[first][by], buckets_of[by], least[by]
        self.inverse, self.docs = rank[inverse], ids

    def parts(self) -> Iterator[tuple[int, int, int]]:
        """Bucket, first and last + 1 record of each bucket."""
        if len(self.bucket):
            starts = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1]])
            yield from zip(self.bucket[starts].tolist(), starts.tolist(), np.r_[starts[1:], len(self.bucket)].tolist())

    def repeated(self, masks: np.ndarray) -> Iterator[np.ndarray]:
        """Where repeated strings start, given which strings of each record a smaller document of another shard has."""
        left = self.rows[:, self.size].astype(np.int64)[self.inverse]
        right = self.rows[:, self.size + 1].astype(np.int64)[self.inverse]
        later = self.docs > self.least[self.inverse]  # this very record is found in a smaller document here
        mask = masks[self.inverse]
        for k in range(self.strings):
            chosen = (k >= self.strings - 1 - left) & (k <= right) & (later | (mask >> np.uint64(k) & np.uint64(1)).astype(bool))
            yield self.at[chosen] + k


def earlier(rows: np.ndarray, docs: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For records of several shards: the strings (as bits) that stand in a record of a smaller document too.

    Equal strings were found through equal 24 bytes in the middle, so records are taken by these, some at a time.
    """
    size, masks = rows.shape[1] - 2, np.zeros(len(rows), np.uint64)
    parts = -(-len(rows) // EARLIER_RECORDS)
    if parts <= 1:
        return _earlier(rows, docs, length)
    middle = rows[:, size - length : size - length + GRAM] if size > length else rows[:, :size]
    part = _bucket(_names(np.ascontiguousarray(middle), middle.shape[1])[:, 0] * _K[2], parts)
    for k in range(parts):
        mine = np.flatnonzero(part == k)
        if len(mine):
            masks[mine] = _earlier(rows[mine], docs[mine], length)
    return masks


def _earlier(rows: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    size = rows.shape[1] - 2
    strings = size - length + 1
    _, first, same = np.unique(np.ascontiguousarray(rows).view(f"V{size + 2}").reshape(-1), return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, same, docs)
    once = rows[first]
    place = np.arange(strings)
    valid = (place >= strings - 1 - once[:, size, None].astype(np.int64)) & (place <= once[:, size + 1, None])
    r, k = np.nonzero(valid)
    name = np.concatenate([_names(np.ascontiguousarray(once[b : b + 8192, :size]), length) for b in range(0, len(once), 8192)])[r, k]
    order = np.lexsort((least[r], name))
    r, k, name = r[order], k[order], name[order]
    group = np.cumsum(np.r_[True, name[1:] != name[:-1]]) - 1 if len(name) else np.zeros(0, np.int64)
    head = np.flatnonzero(np.r_[True, name[1:] != name[:-1]]) if len(name) else group
    views = np.lib.stride_tricks.sliding_window_view(once[:, :size], length, axis=1)
    found = np.zeros(len(r), bool)
    for b in range(0, len(r), 1 << 17):
        part = slice(b, b + (1 << 17))
        top = head[group[part]]
        behind = np.flatnonzero(top != np.arange(b, b + len(top)))
        mine, theirs = behind + b, top[behind]
        if not (views[r[mine], k[mine]] == views[r[theirs], k[theirs]]).all():
            return _earlier_by_bytes(rows, docs, length)
        found[mine] = least[r[mine]] > least[r[theirs]]
    mask = np.zeros(len(once), np.uint64)
    np.bitwise_or.at(mask, r[found], np.uint64(1) << k[found].astype(np.uint64))
    every = np.zeros(len(once), np.uint64)
    np.bitwise_or.at(every, r, np.uint64(1) << k.astype(np.uint64))
    return np.where(docs > least[same], every[same], mask[same])


def _earlier_by_bytes(rows: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """The same without names, for the case that two strings share one."""
    size = rows.shape[1] - 2
    strings, least = size - length + 1, {}
    held = []
    for row, doc in zip(rows, docs.tolist()):
        left, right, data = int(row[size]), int(row[size + 1]), row.tobytes()
        own = [(k, data[k : k + length]) for k in range(strings - 1 - left, right + 1)]
        held.append(own)
        for _, s in own:
            least[s] = min(doc, least.get(s, doc))
    return np.array([sum(1 << k for k, s in own if least[s] < doc) for own, doc in zip(held, docs.tolist())], np.uint64)


def write_shards(df: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The table of shards: shard, bytes, docs, texts; bucketed by shard."""
    spark = df.sparkSession
    carried = "row_" in df.columns

    def gather(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        texts: list[bytes] = []
        rows: list[pa.Array] = []

        def row() -> pa.RecordBatch:
            columns = [pa.array([part << 32 | seq]), pa.array([size]), pa.array([docs], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.binary()))]
            if carried:
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), pa.concat_arrays(rows)))
            return pa.RecordBatch.from_arrays(columns, names=["shard", "bytes", "docs", "texts", "rows"][: len(columns)])

        for batch in stream:
            begin = 0
            for k, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), texts_of(batch))):
                docs.append(doc)
                texts.append(text)
                size += len(text)
                if size >= shard_bytes:
                    if carried:
                        rows.append(batch.column("row_").slice(begin, k + 1 - begin))
                    yield row()
                    docs, texts, rows, begin, seq, size = [], [], [], k + 1, seq + 1, 0
            if carried and begin < batch.num_rows:
                rows.append(batch.column("row_").slice(begin))
        if docs:
            yield row()

    schema = T.StructType(T._parse_datatype_string("shard long, bytes long, docs array<long>, texts array<binary>").fields)
    if carried:
        schema = schema.add("rows", T.ArrayType(df.schema["row_"].dataType))
    shards = df.mapInArrow(gather, schema)
    name = f"shards_{uuid.uuid4().hex}"
    total = df.count()
    buckets = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(total, 4096)))
    writer = shards.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, "shards"))
    writer.bucketBy(buckets, "shard").saveAsTable(name)
    return spark.table(name)


def _shards(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, Shard, int]]:
    for k in range(batch.num_rows):
        texts = batch.column("texts")[k].values.to_pylist()
        yield batch.column("shard")[k].as_py(), Shard(batch.column("docs")[k].as_py(), texts, length), k


NAMED = "bucket int, shard long, n long, keys binary, docs binary"
CODED = "shard long, bucket int, codes binary"
DEALT = "size int, bucket int, shard long, n long, rows binary, docs binary"
ANSWERED = "shard long, size int, bucket int, masks binary"


def _rank_sampled(shards: DataFrame, buckets: int, length: int, hot: int) -> DataFrame:
    """Step 1. Per shard and bucket a code for every name sent: 0 unique, 1 in several documents, 2 in very many."""

    def send(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for shard, held, _ in _shards(batch, length):
            key, docs, _ = held.keys(buckets)
            bucket = (key >> np.uint64(32)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(key) else np.zeros(0, np.int64)
            stops = np.r_[starts[1:], len(key)]
            low, few = (key & _LOW).astype("<u4"), np.minimum(docs, 255).astype(np.uint8)
            rows = {
                "bucket": pa.array(bucket[starts], pa.int32()),
                "shard": pa.array([shard] * len(starts), pa.int64()),
                "n": pa.array(stops[: len(starts)] - starts, pa.int64()),
                "keys": pa.array([low[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary()),
                "docs": pa.array([zlib.compress(few[a:b].tobytes(), 1) for a, b in zip(starts, stops)], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(rows)

    def rank(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        names = np.frombuffer(b"".join(group["keys"]), "<u4")
        docs = np.frombuffer(b"".join(map(zlib.decompress, group["docs"])), np.uint8)
        order = np.argsort(names, kind="stable")
        starts = np.flatnonzero(np.r_[True, names[order][1:] != names[order][:-1]])
        total = np.add.reduceat(docs[order].astype(np.int64), starts)
        code = np.where(total >= hot, 2, np.where(total > 1, 1, 0)).astype(np.uint8)
        codes = np.empty(len(names), np.uint8)
        codes[order] = np.repeat(code, np.diff(np.r_[starts, len(names)]))
        cuts = np.cumsum(group["n"].to_numpy())[:-1]
        return pd.DataFrame({"shard": group["shard"], "bucket": key[0], "codes": [zlib.compress(c.tobytes(), 1) for c in np.split(codes, cuts)]})

    sent = shards.mapInArrow(batches(send), NAMED)
    return sent.groupBy("bucket").applyInPandas(rank, CODED)


def _codes(listed: list[dict]) -> np.ndarray:
    parts = sorted((x["bucket"], x["codes"]) for x in listed or [])
    return np.frombuffer(b"".join(zlib.decompress(c) for _, c in parts), np.uint8)


def _back(shards: DataFrame, answers: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Shards with what came back for them, in one list. The texts stay in their buckets."""
    listed = answers.groupBy(F.col("shard").alias("to_shard")).agg(F.collect_list(F.struct(*columns)).alias(name))
    return shards.join(listed.hint("merge"), F.col("shard") == F.col("to_shard"), "left").drop("to_shard")


def _rank_contexts(coded: DataFrame, buckets: int, length: int) -> DataFrame:
    """Step 2. Per shard, record size and bucket the strings of every record that a smaller document has."""

    def send(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for shard, held, k in _shards(batch, length):
            _, _, inverse = held.keys(buckets)
            for found in held.candidates(_codes(batch.column("codes")[k].as_py()), inverse, buckets):
                parts = list(found.parts())
                rows = {
                    "size": pa.array([found.size] * len(parts), pa.int32()),
                    "bucket": pa.array([b for b, _, _ in parts], pa.int32()),
                    "shard": pa.array([shard] * len(parts), pa.int64()),
                    "n": pa.array([j - i for _, i, j in parts], pa.int64()),
                    "rows": pa.array([zlib.compress(found.rows[i:j].tobytes(), 1) for _, i, j in parts], pa.binary()),
                    "docs": pa.array([zlib.compress(found.least[i:j].tobytes(), 1) for _, i, j in parts], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(rows)

    def rank(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        size = key[0]
        rows = np.frombuffer(b"".join(map(zlib.decompress, group["rows"])), np.uint8).reshape(-1, size + 2)
        docs = np.frombuffer(b"".join(map(zlib.decompress, group["docs"])), np.int64)
        masks = earlier(rows, docs, length)
        cuts = np.cumsum(group["n"].to_numpy())[:-1]
        return pd.DataFrame(
            {"shard": group["shard"], "size": size, "bucket": key[1], "masks": [zlib.compress(m.tobytes(), 1) for m in np.split(masks, cuts)]}
        )

    return coded.mapInArrow(batches(send), DEALT).groupBy("size", "bucket").applyInPandas(rank, ANSWERED)


SPANS = "doc_id long, n_bytes long, spans array<struct<first: long, after: long>>, kept binary"


def repeated_spans(
    df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES,
    bucket_bytes: int = BUCKET_BYTES, hot: int = HOT, carry: bool = False,
) -> DataFrame:
    """doc_id, n_bytes, spans (first byte, byte after) that go, and the kept bytes. ``length``: 32 to 87.

    With ``carry`` also row_, the other columns of each row, and the kept bytes are whole characters.
    """
    if not 32 <= length <= 87:
        raise ValueError("length: 32 to 87")
    shards = write_shards(id_and_text(df, id_col, text_col, carry), shard_bytes)
    total = shards.agg(F.sum("bytes")).first()[0]
    buckets = parts_for(total, bucket_bytes, 8)
    codes = materialize(_rank_sampled(shards, buckets, length, hot), "ranks")
    coded = _back(shards, codes, ["bucket", "codes"], "codes")
    masks = materialize(_rank_contexts(coded, buckets, length), "repeated")
    answered = _back(coded, masks, ["size", "bucket", "masks"], "masks")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, held, k in _shards(batch, length):
            _, _, inverse = held.keys(buckets)
            listed = batch.column("masks")[k].as_py() or []
            starts: list[np.ndarray] = []
            for found in held.candidates(_codes(batch.column("codes")[k].as_py()), inverse, buckets):
                parts = sorted((x["bucket"], x["masks"]) for x in listed if x["size"] == found.size)
                answer = np.frombuffer(b"".join(zlib.decompress(m) for _, m in parts), np.uint64)
                starts += found.repeated(answer)
            gone = held.removed(starts)
            turns = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
            out = _documents(held, gone, turns, whole=carry)
            yield out.append_column("row_", batch.column("rows")[k].values) if carry else out

    schema = T._parse_datatype_string(SPANS)
    if carry:
        schema = T.StructType(schema.fields).add("row_", shards.schema["rows"].dataType.elementType)
    return answered.mapInArrow(batches(cut), schema)


def _documents(held: Shard, gone: np.ndarray, turns: np.ndarray, whole: bool = False) -> pa.RecordBatch:
    kept, spans = [], []
    for begin, end in zip(held.starts.tolist(), held.ends.tolist()):
        mine = gone[begin:end]
        if not mine.any():
            kept.append(held.data[begin:end].tobytes())
            spans.append([])
            continue
        left = held.data[begin:end][~mine].tobytes()
        kept.append(left.decode(errors="ignore").encode() if whole else left)
        inner = turns[np.searchsorted(turns, begin, side="right") : np.searchsorted(turns, end, side="left")].tolist()
        edges = [begin] * bool(mine[0]) + inner + [end] * bool(mine[-1])
        spans.append([{"first": a - begin, "after": b - begin} for a, b in zip(edges[::2], edges[1::2])])
    span = pa.struct([("first", pa.int64()), ("after", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [pa.array(held.doc_ids, pa.int64()), pa.array(held.sizes), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())],
        names=["doc_id", "n_bytes", "spans", "kept"],
    )


def without_repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of ``df`` with what is left of their texts.

    A cut inside a character takes the rest of it too. Rows of which nothing is left go; those without text at all stay.
    """
    found = repeated_spans(df, length, id_col, text_col, carry=True, **options)
    left = found.select("n_bytes", F.col("kept").cast("string").alias("text"), "row_")
    return restored(left.where("text <> '' OR n_bytes = 0"), df.columns, text_col)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import documents

    found = repeated_spans(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["after"] - s["first"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
