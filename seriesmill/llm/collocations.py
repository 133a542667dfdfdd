"""Operator 11: phrase collocations by set-oriented mining (SETM) over sorted occurrence relations.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and into words. A relation of level k has
a row for every place of a phrase of k words: (block, pos, g1 .. gk), where g are the numbers of frequent words of the
text's language. A round

1. merge-joins the relation with itself at adjacent positions of the same piece, which makes the places of phrases one
   word longer whose two parts are in the relation,
2. counts them by group, with partial sums before the shuffle, and keeps the groups with ``min_count`` places,
3. semi-joins the places with the frequent groups, which gives the next level's relation. The semi-join goes through a
   bitmap of hashes of bounded size, so that places stay where they are: it keeps all places of frequent groups and
   few others, and the exact count of the next round drops what those make.

Relations are written bucketed by block and sorted by (block, pos), so a round's join needs no shuffle; only partial
counts are shuffled. A block is a run of at most ``BLOCK`` words of one text, with as many words of what follows as a phrase can
reach into; a text or a piece of any length becomes many blocks, and a place is counted where it begins. Ends of pieces
take a position of their own, so that words on both sides of one are not adjacent.

A group holds the counts of all its beginnings and ends, so a score needs no further join. Words are broadcast where their
measured number takes less than ``BROADCAST_BYTES``, else joined by shuffle.

Defined results: a null or empty text has no words; a null lang is ``und``; repeated rows count each; other columns are
ignored; a phrase with the score and count of another ranks by its bytes; a table without frequent phrases gives no rows.
"""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import BROADCAST_BYTES, batches, documents, q, shuffle_partitions, texts_of

BLOCK = 1 << 13
LEVEL_BITS = 33  # of monotonically_increasing_id: rows within a partition
MAX_BUCKETS = 100_000
MAP_BITS = 28  # of a bitmap of frequent groups, 32 MB at most
WORD_BYTES = 64  # of a broadcast word, about
TOURNAMENT = (256, 16, 1)
# The marks that end a piece, all written as a full stop; A-Z lower-cased, tabs as spaces
ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes(0x2E if b in ENDS else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def tokens_of(text: bytes) -> list[bytes]:
    """Words in order, with b"." wherever a piece ends."""
    return text.translate(TABLE).replace(b".", b" . ").split()


def _blocks(df: DataFrame, lang_col: str, text_col: str, block: int, ahead: int) -> DataFrame:
    """block, lang, words: the words of a block in one string, those it only looks ahead to included."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        langs, words = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
            tokens = tokens_of(text)
            for at in range(0, len(tokens), block):
                langs.append(lang)
                words.append(b" ".join(tokens[at : at + block + ahead]))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string())], names=["lang", "words"])

    texts = df.select(F.coalesce(q(lang_col).cast("string"), F.lit("und")).alias("lang"), q(text_col).cast("string").alias("text"))
    return texts.mapInArrow(batches(each), "lang string, words string").withColumn("block", F.monotonically_increasing_id())


def _places(blocks: DataFrame) -> DataFrame:
    """lang, block, pos, word of every word."""
    return blocks.select("lang", "block", F.posexplode(F.split("words", " ")).alias("pos", "word")).where("word <> '.'")


@contextlib.contextmanager
def _as_stored(spark: SparkSession) -> Iterator[None]:
    """Joins use the buckets of tables, also on more keys than the bucket's, and their order; the settings come back at the end."""
    wanted = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextlib.contextmanager
def _relation(places: DataFrame, buckets: int, label: str) -> Iterator[DataFrame]:
    """Write a relation sorted by (block, pos); its name leaves the catalog at the end, its files with the scratch scope."""
    spark, name = places.sparkSession, f"{label}_{uuid.uuid4().hex}"
    path = scratch_path(spark, label)
    places.write.format("parquet").option("path", path).bucketBy(buckets, "block").sortBy("block", "pos").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _numbered(groups: DataFrame) -> tuple[DataFrame, int]:
    """The written words with a small number each (``g``), and how many there are."""
    groups = materialize(groups.withColumn("id_", F.monotonically_increasing_id()), "groups")
    part, row = F.shiftright("id_", LEVEL_BITS), F.col("id_").bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))
    n, parts = groups.agg(F.count(F.lit(1)), F.max(part)).first()
    return groups.withColumn("g", row * ((parts or 0) + 1) + part).drop("id_"), n


def _hash(words: list[str]) -> Column:
    return F.xxhash64(*words)


def _frequent(groups: DataFrame, words: list[str]):
    """The semi-join with the frequent groups: an expression over the hash of a group, false only where it is not among them.

    Each group sets a bit of a bitmap of at most MAP_BITS bits, made by one aggregate of its 64-bit words. A group that shares a
    frequent one's bit passes; the next count, which is exact, drops what is made of it.
    """
    spark, n = groups.sparkSession, groups.count()
    bits = max(10, min(MAP_BITS, (16 * n).bit_length()))
    bit = F.shiftrightunsigned(_hash(words), 64 - bits)
    rows = groups.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("set")
    )
    found = rows.toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[found.column("at").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    held = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def among(hashes: pa.Array) -> pa.Array:
        h = hashes.to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - bits)
        return pa.array((held.value[h >> np.uint64(6)] >> (h & np.uint64(63)) & np.uint64(1)).astype(bool))

    return among(_hash(words))


def phrases(
    df: DataFrame, longest: int = 3, min_count: int = 10, lang_col: str = "lang", text_col: str = "text", block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(groups, totals). Groups: lang, words, a, firsts, lasts, extended for every frequent phrase of 2 to ``longest`` words;
    ``firsts[k]`` (``lasts[k]``) is the count of its first (last) k+1 words, ``extended`` the largest count of a phrase one
    word longer that holds it. Totals: lang, n words.
    """
    spark = df.sparkSession
    buckets = min(shuffle_partitions(spark), MAX_BUCKETS)
    blocks = _blocks(df, lang_col, text_col, block, longest - 1)
    counted = materialize(_places(blocks).where(F.col("pos") < block).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("a")), "words")
    totals = counted.groupBy("lang").agg(F.sum("a").alias("n"))
    words, n = _numbered(counted.where(F.col("a") >= min_count))
    level = words.select(F.col("g").alias("g1"), "lang", F.array("word").alias("words"), "a", F.array("a").alias("firsts"), F.array("a").alias("lasts"))

    numbers = words.select("lang", "word", F.col("g").alias("g1"))
    if n * WORD_BYTES <= BROADCAST_BYTES:
        first = _places(blocks.repartition(buckets, "block")).join(F.broadcast(numbers), ["lang", "word"])
    else:  # places meet the words by shuffle, then go to their blocks
        first = _places(blocks).join(numbers, ["lang", "word"]).repartition(buckets, "block")
    out = []
    with contextlib.ExitStack() as held:
        held.enter_context(_as_stored(spark))
        relation = held.enter_context(_relation(first.select("block", "pos", "g1"), buckets, "places1"))
        for k in range(2, longest + 1):
            ids = [f"g{i}" for i in range(1, k + 1)]
            after = relation.select("block", (F.col("pos") - 1).alias("pos"), F.col(ids[k - 2]).alias(ids[-1]))
            longer = relation.join(after.hint("merge"), ["block", "pos"])
            found = longer.where(F.col("pos") < block).groupBy(*ids).agg(F.count(F.lit(1)).alias("a")).where(F.col("a") >= min_count)
            found = materialize(found, "groups")
            left = level.select(*ids[:-1], "lang", F.col("words").alias("w1"), F.col("firsts").alias("f1"))
            right = level.select(*[F.col(c).alias(ids[i + 1]) for i, c in enumerate(ids[:-1])], F.element_at("words", -1).alias("w2"), F.col("lasts").alias("l2"))
            grown = found.join(left, ids[:-1]).join(right, ids[1:]).select(
                *ids, "lang", F.concat("w1", F.array("w2")).alias("words"), "a", F.concat("f1", F.array("a")).alias("firsts"),
                F.concat("l2", F.array("a")).alias("lasts"),
            )
            if k > 2:
                ends = F.explode(F.array(F.struct(*ids[:-1]), F.struct(*[F.col(c).alias(ids[i]) for i, c in enumerate(ids[1:])])))
                holds = found.select(ends.alias("part"), "a").groupBy(*[F.col("part")[c].alias(c) for c in ids[:-1]]).agg(F.max("a").alias("extended"))
                out.append(level.join(holds, ids[:-1], "left"))
            level = materialize(grown, "level")
            if k < longest:
                relation = held.enter_context(_relation(longer.where(_frequent(found, ids)), buckets, f"places{k}"))
        out.append(level.withColumn("extended", F.lit(None).cast("long")))
    kept = [x.select("lang", "words", "a", "firsts", "lasts", "extended") for x in out]
    return functools.reduce(DataFrame.unionByName, kept), totals


def _cut() -> Column:
    """(score, k, l, r) of the lowest-scoring cut of a phrase, the first of equal ones. Counts fit into 15 digits."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda k: F.struct(k.alias("k"), F.get("firsts", k - 1).alias("l"), F.get("lasts", F.size("words") - k - 1).alias("r")),
    )
    scored = """transform(cuts_, c -> struct(
        (1000000BD * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0))) div (cast(c.l AS decimal(15,0)) * cast(c.r AS decimal(15,0))) AS score,
        c.k AS k, c.l AS l, c.r AS r))"""
    return cuts, F.array_min(F.expr(scored))


def collocations(
    df: DataFrame, top: int = 2000, longest: int = 3, min_count: int = 10, lang_col: str = "lang", text_col: str = "text", block: int = BLOCK,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases per lang; phrases inside a longer one with half their count go."""
    groups, totals = phrases(df, longest, min_count, lang_col, text_col, block)
    cuts, scored = _cut()
    kept = groups.where(F.coalesce(100 * F.col("extended") < 50 * F.col("a"), F.lit(True)))
    kept = kept.withColumn("cuts_", cuts).withColumn("cut_", scored)
    kept = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut_.l", "cut_.r", "cut_.score")
    for groups_of in TOURNAMENT:  # the best of each part, of some parts, of all: no task reads more than a few times ``top`` rows
        part = F.pmod(F.xxhash64("phrase"), F.lit(groups_of))
        order = W.partitionBy("lang", part).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        kept = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = materialize(kept, "ranked")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


SQL = r"""
WITH pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\n\x0b\x0c\r]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
    FROM words, range(1, 4) AS r(k)
), f AS MATERIALIZED (
    SELECT lang, k, g, count(*) AS a FROM grams GROUP BY ALL HAVING k = 1 OR a >= 10
), totals AS (
    SELECT lang, cast(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS MATERIALIZED (
    SELECT lang, k, g, a, string_split(g, ' ') AS w FROM f WHERE k > 1
), parts AS (
    SELECT lang, g, a, i, array_to_string(w[1:i], ' ') AS g1, array_to_string(w[i + 1:], ' ') AS g2 FROM candidates, range(1, 3) AS s(i) WHERE i < k
), cuts AS (
    SELECT c.lang, c.g, c.a, c.i, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
    FROM parts c JOIN f l ON l.lang = c.lang AND l.g = c.g1 JOIN f r ON r.lang = c.lang AND r.g = c.g2
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1
), held AS (
    SELECT lang, g, max(a) AS longer FROM (
        SELECT lang, array_to_string(w[1:2], ' ') AS g, a FROM candidates WHERE k = 3
        UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3)
    GROUP BY lang, g
), ranked AS (
    SELECT x.lang, x.g AS phrase, x.a, x.l, x.r, x.score FROM lowest x LEFT JOIN held h ON h.lang = x.lang AND h.g = x.g
    WHERE h.longer IS NULL OR 100 * h.longer < 50 * x.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, cast(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) QUALIFY rank <= 2000
"""
