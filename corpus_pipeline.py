"""A corpus from raw documents to packed sequences, in stages that each read what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import language, packing, quality, repeats, simhash
from seriesmill.llm.common import restored
from seriesmill.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told clearly; learn from those with a language of their own.

    Rejected: texts that are null or have no letter, and those whose two best languages are too close.
    """
    model = language.fit(language.training_rows(docs, ~language.held_out(F.col("doc_id"))))
    return language.clearly_told(docs, model)


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality rules keep.

    Null and empty texts have no words and go; long ones are judged whole, repeated and equal rows alike; an empty table stays empty.
    """
    found = quality.quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=True, **quality.BOUNDED)
    return restored(found.where("kept"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group, the one with the smallest doc_id.

    Null and empty texts are one group; a null doc_id comes before all; of rows with one doc_id and text one stays.
    """
    return simhash.one_of_each_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out bytes that an earlier document has.

    Null and empty texts stay as they are; of rows with one doc_id none is earlier; documents of which nothing is left go.
    """
    return repeats.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens.

    A null or empty text is its end id; ids may be null or of any size; repeated rows are packed each, an empty table gives no pieces.
    """
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2, remembered=200_000)


STAGES = [
    ("language ID", identify_language),
    ("quality rules", check_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack),
]

#: No SQL: the stages learn a model, compare hashes within a distance, and pack.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
