"""Operator 3: SimHash near-duplicates by multi-index hashing, and their components.

A fingerprint is two segments of 32 bits, each with a table from segment value to fingerprints. Two fingerprints within
2 bits differ in at most one bit of the first segment, or not at all in the second (``radii`` gives this for every
distance), so a fingerprint looks up the 33 values of a small Hamming ball in the first table and one in the second,
and complete distances are verified on all that stands there.

A segment value that more than HOT fingerprints share would cost their square. Whoever looks up such a value is joined
instead on whole fingerprints: each is written with all values within half the distance, two within 2 bits meet
at a value half-way, a bucket holds no more than a ball (65), and links of each to the smallest keep the components.

Equal fingerprints are one node, whatever the number of documents. Components are found by stars over written
tables; nothing but counts reaches the driver.

Defined results: a null text, or one without words, has fingerprint zero and is linked like any other; fewer words
than a shingle form one shingle; repeated rows are documents of their own; a null doc_id is never the id of
a component unless all its ids are null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_and_text, q, shuffle_partitions, some_texts
from .components import components

WORDS = 3
MAX_BITS = 2
SEED = 42
HOT = 64
SEGMENT_BITS = 32
PIECE_BYTES = 1 << 20
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
SPACE = b" \t\n\r\x0b\x0c"


def word_pieces(text: bytes, piece_bytes: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text (between 20 and 09 to 0D, A-Z lower-cased), about a megabyte at a time."""
    begin, size = 0, len(text)
    while begin < size:
        end = min(size, begin + piece_bytes)
        while end < size and text[end] not in SPACE:
            end += 1
        yield text[begin:end].translate(LOWER).split()
        begin = end


def fingerprint(text: bytes, n: int = WORDS, piece_bytes: int = PIECE_BYTES) -> int:
    digest, ones, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    carried: list[bytes] = []
    for words in word_pieces(text, piece_bytes):
        words = carried + words
        if len(words) >= n:
            found = [digest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(n)))]
            bits = np.unpackbits(np.array(found, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(found)
        carried = words[max(0, len(words) - n + 1) :]
    if not total:
        return digest(b" ".join(carried), SEED) if carried else 0
    return sum(1 << k for k in np.flatnonzero(2 * ones > total).tolist())


def fingerprint_of(text: Column, words: int = WORDS) -> Column:
    """The fingerprint as a signed long; only texts go to Python."""

    @F.arrow_udf("long")
    def each(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, words) for t in some_texts(texts)], np.uint64).view(np.int64))

    return each(text)


def fingerprints(df: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), text_hash of every row."""
    return id_and_text(df, id_col, text_col).select("doc_id", fingerprint_of(F.col("text"), words).alias("fp"), F.xxhash64("text").alias("text_hash"))


def _ball(radius: int, bits: int) -> list[tuple[int, int]]:
    """Masks of up to ``radius`` of the lowest ``bits`` bits, as signed longs, with their number of bits."""
    masks = [(sum(1 << b for b in chosen), k) for k in range(radius + 1) for chosen in combinations(range(bits), k)]
    return [(m - (1 << 64) if m >> 63 else m, k) for m, k in masks]


def radii(max_bits: int, segments: int = 2) -> list[int]:
    """How far to look in each segment (-1: not at all) so that no pair within ``max_bits`` is missed.

    With max_bits = segments * r + a, a pair that is over r apart in each of the first a + 1 segments, and over r - 1 in
    the others, is over max_bits apart in all.
    """
    r, a = divmod(max_bits, segments)
    return [r if k <= a else r - 1 for k in range(segments)]


def _segment(k: int) -> Column:
    return F.shiftrightunsigned("fp", k * SEGMENT_BITS).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _table_key(k: int, value: Column) -> Column:
    """One long for a segment's number and value."""
    return value + F.lit(k << SEGMENT_BITS)


def _halfway_links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """u, v by a join on all values within half the distance: a bucket's members linked to its smallest."""
    radius, near = -(-max_bits // 2), max_bits // 2
    ball = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k <= near).alias("near")) for m, k in _ball(radius, 64)])
    keys = nodes.select("fp", F.explode(ball).alias("b"))
    keys = keys.select("fp", F.col("fp").bitwiseXOR(F.col("b.mask")).alias("key"), F.col("b.near").alias("near"))
    buckets = keys.groupBy("key").agg(F.collect_list("fp").alias("members"), F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"))
    pairs = buckets.where(F.size("members") > 1).select(F.col("hub").alias("u"), F.explode("members").alias("v"))
    return pairs.where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))


def links(nodes: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """u, v: fingerprints within ``max_bits`` (0 to 4), as many as keep their components. ``nodes``: distinct fp.

    All pairs but those met at a segment value of more than ``hot`` fingerprints, which are linked half-way.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits: 0 to 4")
    spread = nodes.repartition(shuffle_partitions(nodes.sparkSession), "fp")  # few files hold many fingerprints
    reach = [(k, r) for k, r in enumerate(radii(max_bits)) if r >= 0]
    table = spread.select("fp", F.explode(F.array(*[_table_key(k, _segment(k)) for k, _ in reach])).alias("key"))
    looks = [_table_key(k, _segment(k).bitwiseXOR(F.lit(m).cast("long"))) for k, r in reach for m, _ in _ball(r, SEGMENT_BITS)]
    probes = spread.select(F.col("fp").alias("probe"), F.explode(F.array(*looks)).alias("key"))
    crowded = materialize(table.groupBy("key").count().where(F.col("count") > hot).select("key"), "crowded")
    many = not crowded.isEmpty()
    met = probes.join(table.join(crowded, "key", "left_anti") if many else table, "key")
    apart = F.bit_count(F.col("probe").bitwiseXOR(F.col("fp")))
    found = met.where((F.col("probe") != F.col("fp")) & (apart <= max_bits)).select(F.col("probe").alias("u"), F.col("fp").alias("v"))
    if not many:
        return found
    lookers = probes.join(crowded, "key", "left_semi").select(F.col("probe").alias("fp")).distinct()
    return found.unionByName(_halfway_links(lookers, max_bits))


def _grouped(docs: DataFrame, max_bits: int) -> DataFrame:
    """fp, component (its smallest fp), component_id, for every fingerprint of ``docs`` (doc_id, fp)."""
    nodes = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    found = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    linked = nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    first = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return linked.join(first, "component").select("fp", "component", "component_id")


def near_duplicates(
    df: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (smallest doc_id reachable)."""
    docs = materialize(fingerprints(df, words, id_col, text_col), "fingerprints")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return docs.join(_grouped(docs, max_bits), "fp").select("doc_id", text.alias("fingerprint"), "component_id")


def one_of_each_group(
    df: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each group a row of its smallest doc_id, of several the smallest fingerprint's.

    A row is found again by its doc_id and its text's hash, so texts are fingerprinted once; of rows that share both one stays.
    """
    docs = materialize(fingerprints(df, words, id_col, text_col), "fingerprints")
    groups = docs.join(_grouped(docs, max_bits), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = F.min(F.struct("fp", "text_hash"))
    chosen = groups.groupBy("component").agg(first.alias("first"), F.first("component_id").alias("chosen_id"))
    chosen = materialize(chosen.select("chosen_id", F.col("first.fp").alias("chosen_fp"), F.col("first.text_hash").alias("chosen_hash")), "chosen")
    same = (q("hash_") == F.col("chosen_hash")) & q("id_").eqNullSafe(F.col("chosen_id"))
    inner = F.struct(*[q(c) for c in df.columns]).alias("row_")
    rows = df.select(inner, q(id_col).cast("long").alias("id_"), F.xxhash64(q(text_col).cast("string")).alias("hash_"))
    kept = rows.join(chosen, same, "left_semi")
    twice = docs.join(chosen, (F.col("text_hash") == F.col("chosen_hash")) & F.col("doc_id").eqNullSafe(F.col("chosen_id")), "left_semi")
    if twice.groupBy("text_hash", "doc_id").count().where("count > 1").limit(1).count():  # rows that are repeated, id and all
        kept = kept.dropDuplicates(["hash_", "id_"])
    return kept.select(*[F.col("row_").getField(c).alias(c) for c in df.columns])


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import documents

    return near_duplicates(documents(spark, sf_dir))
