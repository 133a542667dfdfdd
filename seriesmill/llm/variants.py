"""Operator 12: spelling variants by partition-and-enumerate signatures (PartEnum) over letter multisets.

A word is the set of its letters with their occurrence numbers (a1, a2, n1, ...), a binary vector. One inserted or deleted
code point changes one dimension, a replaced one two, so near words have vectors at a Hamming distance of one or two. The
dimensions are dealt to ``PARTS`` parts; for a distance of up to d, every choice of d parts to leave out gives a
signature of the dimensions in the others. Two vectors within d agree on the signature that leaves out the parts in which
they differ, so an equi-join of signatures finds them all, exactly; candidates are then verified by edit distance.

Signatures are those of one pair of lengths, d = 2 for equal lengths and d = 1 for lengths that differ by one, and hold half of
the word besides: one edit leaves at least one half (the first or the last code points) of the shorter word alone. This
splits the signatures that many anagrams share; it drops no near pair. The join verifies while it joins, so only near pairs come
out, each once after a ``distinct``.

Words are counted with partial sums before the shuffle; all later work is on different words. Forms are followed by
doubling: a round replaces each link's end by the end of that end's link. Counts grow tenfold along a chain, so a chain is
short and the rounds are few.

Defined results: a null or empty text has no words; a null doc_id counts as the empty string in the hash; repeated rows
count each; words differing only in case beyond A-Z are different; other columns are ignored; a table without words gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import batches, documents, id_and_text, shuffle_partitions

PARTS = 4
MIN_LETTERS = 7
MIN_COUNT = 2
FORM_RATIO = 10
TYPO_MODULUS = 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EQUAL, SHORTER, LONGER = 0, 1, 2  # what a word is in the pairs of a signature
MASK = (1 << 64) - 1


def planted_typos(doc_id: Column, run: Column) -> Column:
    """The run without one code point, where TYPO_MODULUS divides the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % TYPO_MODULUS == 0, short).otherwise(run)


def count_words(df: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of all words with so many letters and occurrences."""
    runs = id_and_text(df, id_col, text_col).select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{min_letters},}}"), F.lit(0))).alias("run")
    )
    lowered = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    words = runs.select("doc_id", lowered.alias("run")).select(planted_typos(F.col("doc_id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _dimension(letter: str, occurrence: int) -> int:
    """A 64-bit value for a dimension, so that the sum of them stands for a set."""
    x = (ord(letter) * 0x9E3779B97F4A7C15 + occurrence * 0xD6E8FEB86659FD93 + 1) & MASK
    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & MASK
    return x ^ x >> 29


def signatures(word: str, parts: int = PARTS) -> Iterator[tuple[int, int]]:
    """(64-bit key, role) of all signatures of a word; keys of equal length pairs and of other pairs differ."""
    sums, seen = [0] * parts, {}
    for letter in word:
        k = seen[letter] = seen.get(letter, -1) + 1
        part = (ord(letter) + k) % parts
        sums[part] += _dimension(letter, k)
    total, size = sum(sums), len(word)
    # pairs of equal length: d = 2; of this and one more: d = 1, the shorter word gives the length
    for role, length, half, out in (
        (EQUAL, size, size // 2, 2), (SHORTER, size, (size + 1) // 2, 1), (LONGER, size - 1, size // 2, 1),
    ):
        for left_out in combinations(range(parts), out):
            rest = (total - sum(sums[p] for p in left_out)) & MASK
            for side, affix in (("<", word[:half]), (">", word[-half:])):
                yield xxhash.xxh64_intdigest(f"{out}{left_out}{length}{side}{affix}{rest:x}") - (1 << 63), role


def _signed(words: DataFrame, parts: int) -> DataFrame:
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 4096):
            rows = batch.slice(start, 4096)
            keys, roles, at = [], [], []
            for i, word in enumerate(rows.column("word").to_pylist()):
                for key, role in signatures(word, parts):
                    keys.append(key)
                    roles.append(role)
                    at.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(roles, pa.int8()), rows.column("word").take(pa.array(at, pa.int32()))], names=["key", "role", "word"]
            )

    return words.select("word").mapInArrow(batches(each), "key long, role byte, word string")


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """word, other: both directions of every pair that differs by one inserted, deleted or replaced code point."""
    signed = materialize(_signed(words.repartition(shuffle_partitions(words.sparkSession), "word"), parts), "signatures")
    left = signed.where(F.col("role") != LONGER).select("key", "role", "word")
    right = signed.where(F.col("role") != SHORTER).select("key", F.col("role").alias("role2"), F.col("word").alias("other"))
    same = (F.col("role") == EQUAL) & (F.col("role2") == EQUAL) & (F.col("word") < F.col("other"))
    longer = (F.col("role") == SHORTER) & (F.col("role2") == LONGER)
    found = left.join(right, (left["key"] == right["key"]) & (same | longer) & (F.levenshtein("word", "other", 1) == 1))
    pairs = materialize(found.select("word", "other").distinct(), "near")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms that follow from a word. ``forms``: word, root (its form)."""
    while True:
        forms = materialize(forms, "forms")
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        doubled = forms.join(onward, "root", "left")
        if doubled.where("next IS NOT NULL").limit(1).count() == 0:
            return forms
        forms = doubled.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(words: DataFrame, form_ratio: int = FORM_RATIO, parts: int = PARTS) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of different words with counts (word, n)."""
    words = materialize(words, "words")
    near = near_words(words, parts).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("least"), "other")).alias("best"))
    counted = materialize(words.join(best, "word", "left"), "counted")
    form_n = -F.col("best.least")
    is_form = form_n >= form_ratio * F.col("n")
    counted = counted.select(
        "word", F.when(is_form, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, form_n).alias("form_n"),
    )
    roots = _roots(counted.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    found = counted.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(documents(spark, sf_dir)))


SQL = r"""
WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS t
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) WHERE length(run) >= 7
), different AS MATERIALIZED (
    SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL
), bytes AS (
    SELECT *, flatten(list_transform(string_split(coalesce(cast(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + (unicode(c) & 63))::BIGINT] END)) AS b
    FROM different
), hashed AS (
    SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h
    FROM bytes, crc
), words AS MATERIALIZED (
    SELECT word, cast(sum(k) AS BIGINT) AS n FROM (
        SELECT k, CASE WHEN h % 31 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word
        FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), cuts AS MATERIALIZED (
    SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM words, range(1, 200) AS r(i) WHERE i <= length(word)
), pairs AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM pairs GROUP BY word
), formed AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), j1 AS (
    SELECT a.word, coalesce(b.form, a.form) AS form FROM formed a LEFT JOIN formed b ON b.word = a.form WHERE a.form IS NOT NULL
), j2 AS (
    SELECT a.word, coalesce(b.form, a.form) AS form FROM j1 a LEFT JOIN j1 b ON b.word = a.form
), j3 AS (
    SELECT a.word, coalesce(b.form, a.form) AS form FROM j2 a LEFT JOIN j2 b ON b.word = a.form
), j4 AS (
    SELECT a.word, coalesce(b.form, a.form) AS form FROM j3 a LEFT JOIN j3 b ON b.word = a.form
)
SELECT f.word, f.form, coalesce(j4.form, f.word) AS root, f.n, f.n_near, f.form_n FROM formed f LEFT JOIN j4 ON j4.word = f.word
"""
