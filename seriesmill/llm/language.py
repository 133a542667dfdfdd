"""Operator 4: language identification by error-correcting output codes over hashed byte n-grams.

Every language has a codeword of +1 and -1; every bit has a linear classifier that tells the languages with +1
from those with -1 by the byte n-grams of the lower-cased text. A bit's weights are the log ratio of the two
sides' n-gram frequencies, languages counted alike. A document's bit values are means over its n-grams, set in
relation to what is usual in training. Decoding chooses the codeword of least weighted logistic loss; the weight
of a bit for a language is how often that bit is right on that language's training rows. A document whose two
best codewords are closer than ``margin`` is flagged ambiguous.

The training rows are a bounded sample: at most ``sample`` rows for each language, those with the smallest hash of
doc_id. Sums over them are made in Spark; the model is (buckets x bits) numbers, whatever the size of the data.
Prediction reads every whole text where it lies, without a shuffle.

Codewords: up to 7 languages the exhaustive code (2^(n-1) - 1 bits), beyond that ``dense_bits`` bits from a seeded
generator, of several draws the one with the largest least distance.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every text when there is
no training row; with one learned language every text with a letter gets it. Rows without lang, doc_id or text
are not learned from; repeated rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batches, id_and_text, q, some_texts, texts_of

UNKNOWN = "und"
ORDERS = (3, 4)
BUCKETS = 1 << 15
SAMPLE = 2000
DENSE_BITS = 63
SHARPNESS = 4.0
MARGIN = 0.05
PIECE_BYTES = 1 << 20
#: A-Z lower-cased, other ASCII but letters turned into spaces
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def codewords(n: int, dense_bits: int = DENSE_BITS, seed: int = 11) -> np.ndarray:
    """A row of +1 and -1 for each of n classes."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        bits = np.arange(1, 2 ** (n - 1))
        rows = [np.ones(len(bits))] + [np.where(bits >> k & 1, -1.0, 1.0) for k in range(n - 1)]
        return np.array(rows)
    draw, best, found = np.random.default_rng(seed), -1.0, np.ones((n, 0))
    for _ in range(50):
        code = np.where(draw.random((n, dense_bits)) < 0.5, -1.0, 1.0)
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code @ code.T) / 2
        least = apart[~np.eye(n, dtype=bool)].min()
        if least > best:
            best, found = least, code
    return found


def has_letter(text: bytes) -> bool:
    return bool(re.search(rb"[A-Za-z]", text)) or (not text.isascii() and any(c.isalpha() for c in text.decode(errors="replace")))


def ngram_pieces(text: bytes, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket of every n-gram of a text, about a megabyte at a time."""
    lower = np.frombuffer((b" " + text + b" ").translate(TABLE), np.uint8)
    longest = max(ORDERS)
    for begin in range(0, len(lower), PIECE_BYTES):
        piece = lower[begin : begin + PIECE_BYTES + longest - 1].astype(np.uint32)
        for order in ORDERS:
            n = min(PIECE_BYTES, len(piece) - order + 1)  # n-grams that begin in this piece and end in the text
            if n <= 0:
                continue
            key = piece[:n].copy()
            for k in range(1, order):
                key |= piece[k : k + n] << np.uint32(8 * k)
            key *= np.uint32(0x9E3779B1)
            key ^= key >> np.uint32(15)
            key *= np.uint32(0x85EBCA77)
            yield (key >> np.uint32(32 - (buckets.bit_length() - 1))).astype(np.int64)


def bit_values(text: bytes, weights: np.ndarray) -> np.ndarray:
    """Mean weight of the n-grams, per bit."""
    total, n = np.zeros(weights.shape[1]), 0
    for found in ngram_pieces(text, len(weights)):
        total += weights[found].sum(axis=0, dtype=np.float64)
        n += len(found)
    return total / max(n, 1)


def training_rows(df: DataFrame, learn: Column, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """text, lang of at most ``sample`` rows per language."""
    doc = q(id_col).cast("long")
    known = df.where(learn & q(lang_col).isNotNull() & doc.isNotNull() & q(text_col).isNotNull())
    known = known.select(doc.alias("doc_id"), q(lang_col).cast("string").alias("lang"), q(text_col).cast("string").alias("text"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))  # a row per language
    near = F.xxhash64("doc_id") / 2.0**64 + 0.5 < 1.5 * sample / F.col("n")  # leaves few more than the sample to be ranked
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").join(F.broadcast(sizes), "lang").where(near | (F.col("n") <= 2 * sample))
    ids = ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    ids = ids.select("doc_id", "lang").distinct()  # at most sample rows for each language: a known bound
    return known.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").select("lang", "text")


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray):
        self.languages, self.code, self.weights = languages, code, weights.astype(np.float32)
        self.usual = np.ones(code.shape[1])
        self.trust = np.full(code.shape, 1.0 / max(1, code.shape[1]))

    def decode(self, values: np.ndarray) -> tuple[str, float, bool]:
        """Language, share of it among all codewords, and whether the next one is too near."""
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.logaddexp(0.0, -SHARPNESS * self.code * (values / self.usual))).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(loss[order[0]] - loss)
        return self.languages[order[0]], float(1.0 / share.sum()), bool(loss[order[1]] - loss[order[0]] < MARGIN)


def fit(rows: DataFrame, buckets: int = BUCKETS, smoothing: float = 1e-7) -> Model | None:
    """Learn from text, lang; None without rows."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
            found = np.zeros(buckets)
            for piece in ngram_pieces(text, buckets):
                found += np.bincount(piece, minlength=buckets)
            into = sums.setdefault(lang, np.zeros(buckets))
            into += found / max(found.sum(), 1)
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(found[at])], names=["lang", "bucket", "amount"])

    counted = rows.mapInArrow(batches(count), "lang string, bucket long, amount double").groupBy("lang", "bucket").agg(F.sum("amount").alias("amount"))
    table = counted.orderBy("lang", "bucket").toPandas()  # languages x buckets at most
    languages = sorted(table["lang"].unique())
    if not languages:
        return None
    share = np.full((len(languages), buckets), smoothing)
    np.add.at(share, (table["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(), table["bucket"].to_numpy()), table["amount"].to_numpy())
    share /= share.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    sides = [np.log(share[code[:, k] > 0].mean(axis=0) + smoothing) - np.log(share[code[:, k] < 0].mean(axis=0) + smoothing) for k in range(code.shape[1])]
    model = Model(languages, code, np.array(sides).T if sides else np.zeros((buckets, 0)))
    if len(languages) > 1:
        _weigh(model, rows)
    return model


def _weigh(model: Model, rows: DataFrame) -> None:
    """How large each bit's values usually are and how often they are right, by language."""
    index = {x: k for k, x in enumerate(model.languages)}
    weights, code = model.weights, model.code

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(index), 2 * code.shape[1] + 1))
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
            side = code[index[lang]] * bit_values(text, weights)
            sums[index[lang]] += np.concatenate([[1], side, side > 0])
        yield pa.RecordBatch.from_arrays([pa.array(list(index.values()), pa.int32()), pa.array(list(sums), pa.list_(pa.float64()))], names=["lang", "sums"])

    found = rows.mapInArrow(batches(measure), "lang int, sums array<double>").select("lang", F.posexplode("sums").alias("k", "x"))
    table = found.groupBy("lang", "k").agg(F.sum("x").alias("x")).toPandas()  # languages x bits
    sums = np.zeros((len(index), 2 * code.shape[1] + 1))
    sums[table["lang"], table["k"]] = table["x"]
    bits = code.shape[1]
    mean = sums[:, 1:] / np.maximum(sums[:, :1], 1)
    model.usual = np.maximum(mean[:, :bits].mean(axis=0), 1e-6)
    right = np.maximum(mean[:, bits:], 1e-3)
    model.trust = right / right.sum(axis=1, keepdims=True)


FOUND = "lang_pred string, score double, ambiguous boolean"


def decoded(model: Model | None, text: Column) -> Column:
    """A struct of lang_pred, score, ambiguous; only texts go to Python, and only this comes back."""
    kinds = {"lang_pred": pa.string(), "score": pa.float64(), "ambiguous": pa.bool_()}

    @F.arrow_udf(FOUND)
    def decode(texts: pa.Array) -> pa.Array:
        found = [
            model.decode(bit_values(t, model.weights)) if model and has_letter(t) else (UNKNOWN, 0.0, True)
            for t in some_texts(texts)
        ]
        return pa.StructArray.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))

    return decode(text)


def identify(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row."""
    return id_and_text(df, id_col, text_col).select("doc_id", decoded(model, F.col("text")).alias("found_")).select("doc_id", "found_.*")


def clearly_told(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose language is told and not ambiguous."""
    found = decoded(model, q(text_col).cast("string"))
    return df.where((found["lang_pred"] != UNKNOWN) & ~found["ambiguous"])


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import documents

    docs = documents(spark, sf_dir)
    model = fit(training_rows(docs, ~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
