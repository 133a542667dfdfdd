"""Operator 9: quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Word unigrams and bigrams are hashed into ``buckets`` buckets and counted over the whole corpus, once for all
documents (raw) and once for those labelled good and not toxic (trusted). With both totals scaled to the raw
one and ``prior`` counts added to each side, a bucket's weight is the log of trusted over raw. A document's score
is the mean weight of its n-grams; it is kept if no base rule fails and the score is at least ``threshold``.
Weights are whole millionths, so a score is the same in any order of additions.

With ``smoothing`` (the query and the pipeline, see BOUNDED) every text counts once, however many rows hold it, and is
trusted if one of them is; each side also gets ``smoothing`` of the bucket's raw counts and the mean counts of a
bucket. No weight is then below log(smoothing / (1 + smoothing)), copies change none, and in a large corpus, where the
mean outweighs ``prior``, weights depend on shares only. Without ``smoothing`` every row counts and weights have no
lower bound.

Counting is combined in every task before the shuffle: a task sends a row per bucket. The weights (8 bytes a
bucket) are the only thing that every task gets. The labels are broadcast only when measured small.

Defined results: a null or empty text has no words and fails the base rule; without trusted n-grams all weights
are 0; a doc_id labelled several times is trusted if one label says so; a null doc_id is never labelled;
repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import BROADCAST_BYTES, id_and_text, mark_ids, q

BUCKETS = 1 << 16
PRIOR = 10
THRESHOLD = -0.15
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MILLION = 1_000_000
#: Weights of -2.4 at least (log(0.1 / 1.1)); the threshold is a thirtieth of that.
BOUNDED = {"smoothing": 0.1, "prior": 30, "threshold": -0.08}


def words_of(text: Column) -> Column:
    """Words between spaces and the controls 09 to 0D."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    A column computed by a projection would be put into the lambdas that use it, and computed for each element, wherever
    the optimizer pushes a filter through that projection.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _first(hashes: Column, less: int) -> Column:
    """All but the last ``less``."""
    return F.slice(hashes, 1, F.greatest(F.size(hashes) - less, F.lit(0)))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def _pairs(hashes: Column) -> Column:
    return F.transform(_first(hashes, 1), lambda x, i: F.xxhash64(x, F.get(hashes, i + 1)))


def _once(marked: DataFrame) -> DataFrame:
    """text, share, trusted_share: what a row adds, so that all rows of a text add up to one."""
    text = F.coalesce("text", F.lit(""))
    keyed = marked.withColumn("h", F.xxhash64(text)).withColumn("g", F.xxhash64(F.lit(1), text))
    copies = keyed.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.max("is_trusted").alias("one_trusted")).where("n > 1")
    copies = materialize(copies, "text-copies")
    if copies.count() * 64 <= BROADCAST_BYTES:
        copies = F.broadcast(copies)
    share = 1.0 / F.coalesce("n", F.lit(1))
    good = F.when(F.coalesce("one_trusted", "is_trusted"), share).otherwise(0.0)
    return keyed.join(copies, ["h", "g"], "left").select("text", share.alias("share"), good.alias("trusted_share"))


def ngram_counts(df: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, once: bool = False) -> DataFrame:
    """bucket, raw, trusted: counts over all documents and over those whose doc_id is in ``trusted``.

    With ``once`` over different texts; sums of shares are whole numbers and rounded to them.
    """

    def grams(h: Column) -> Column:
        return F.transform(F.concat(h, _pairs(h)), lambda x: _bucket(x, buckets))

    found = let(_hashes(words_of(F.coalesce("text", F.lit("")))), grams)
    marked = mark_ids(df, trusted, "is_trusted")
    if once:
        rows = _once(marked).select("share", "trusted_share", F.explode_outer(found).alias("bucket")).where("bucket IS NOT NULL")
        raw, good = F.round(F.sum("share")).cast("long"), F.round(F.sum("trusted_share")).cast("long")
        return rows.groupBy("bucket").agg(raw.alias("raw"), good.alias("trusted"))
    # outer, so that no filter on the array is put before it, which would compute it twice
    rows = marked.select("is_trusted", F.explode_outer(found).alias("bucket")).where("bucket IS NOT NULL")
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.sum(F.col("is_trusted").cast("long")).alias("trusted")
    )


def weights(counts: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR, smoothing: float | None = None) -> DataFrame:
    """One row: the weights of all buckets, in order, in millionths."""
    raw, trusted = counts.agg(F.sum("raw"), F.sum("trusted")).first()
    scale = raw / trusted if trusted else None
    spark = counts.sparkSession
    every = spark.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    r, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("raw", "trusted"))
    of_raw = smoothing or 0.0
    both = prior + raw / buckets if smoothing and raw else prior
    value = F.log((t * scale + of_raw * r + both) / (r + of_raw * r + both)) if scale else F.lit(0.0)
    found = every.select("bucket", F.round(value * MILLION).cast("long").alias("weight"))
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "weight")))
    return found.agg(F.transform(ordered, lambda x: x["weight"]).alias("weights"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _repeated_words(hashes: Column) -> Column:
    """Words inside 3-word windows that are found twice or more."""
    windows = F.transform(_first(hashes, 2), lambda x, i: F.xxhash64(x, F.get(hashes, i + 1), F.get(hashes, i + 2)))

    def any_twice(g: Column) -> Column:
        repeats = let(F.sort_array(g), lambda s: F.exists(F.sequence(F.lit(1), F.size(s) - 1), lambda i: F.get(s, i) == F.get(s, i - 1)))
        return F.when(F.size(g) > 1, repeats).otherwise(F.lit(False))

    def places(s: Column) -> Column:
        """Where the windows stand that equal a neighbour in sorted order."""
        same = F.filter(s, lambda x, i: F.get(s, i - 1)["h"].eqNullSafe(x["h"]) | F.get(s, i + 1)["h"].eqNullSafe(x["h"]))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        return _total(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))).cast("long")))

    def count(g: Column) -> Column:
        placed = F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(any_twice(g), let(let(F.sort_array(placed), places), covered)).otherwise(F.lit(0).cast("long"))

    return let(windows, count)


def measures(text: Column, table: Column, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept of a text that is not null.

    ``table``: the weights of all buckets.
    """

    def weight(h: Column) -> Column:
        return F.get(table, _bucket(h, buckets))

    def counts(w: Column, h: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _total(F.transform(w, lambda x: F.char_length(x).cast("long"))).alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeated_words(h).alias("n_repeat_words"),
            (_total(F.transform(h, weight)) + _total(F.transform(_pairs(h), weight))).alias("sum"),
        )

    def judged(c: Column) -> Column:
        n = c["n_words"] + F.greatest(c["n_words"] - 1, F.lit(0).cast("long"))
        failed = (c["n_words"] < MIN_WORDS) | (c["n_repeat_words"] * 100 > c["n_words"] * MAX_REPEATED_PERCENT)
        score = F.when(n > 0, c["sum"] / n / MILLION).otherwise(F.lit(0.0))
        kept = (~failed & (score >= threshold)).alias("kept")
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        return F.struct(*[c[x].alias(x) for x in names], failed.alias("base_failed"), score.alias("score"), kept)

    return let(let(words_of(text), lambda w: let(_hashes(w), lambda h: counts(w, h))), judged)


def quality_rules(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, buckets: int = BUCKETS, prior: float = PRIOR, carry: bool = False,
    smoothing: float | None = None,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score.

    With ``carry`` also text and row_ (common.restored). ``labels``: doc_id, quality (1 is trusted), toxic (1 is not).
    """
    good = (q("quality") == 1) & (F.coalesce(q("toxic"), F.lit(0)) == 0)
    trusted = labels.where(good).select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    docs = id_and_text(df, id_col, text_col)
    counts = ngram_counts(docs, trusted, buckets, smoothing is not None)
    table = weights(materialize(counts, "ngram-counts"), buckets, prior, smoothing)
    rows = id_and_text(df, id_col, text_col, carry)
    found = rows.withColumn("weights", table.scalar())
    found = found.withColumn("m", measures(F.coalesce("text", F.lit("")), F.col("weights"), threshold, buckets))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return found.select("doc_id", *[F.col("m")[x].alias(x) for x in names], *(["text", "row_"] if carry else []))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import documents

    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), **BOUNDED)
