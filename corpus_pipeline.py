"""A corpus from raw documents to packed sequences, stage by stage.

Each stage works on all that the one before kept, and is written and read again before the next. The first four
return the columns of `documents`; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import jaccard_join, line_dedup, packing, private, toxicity
from spanlake.llm.scratch import small_batches, written

LINES, LINE_WORDS = 2, 4
SHINGLE_WORDS, SIMILARITY = 5, 80
KEY = b"spanlake demonstration key"
SEQUENCE = 2048

#: The stages fit models, hash words and run tokenizers, which SQL cannot express; tests hold each against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays under the limit; the model is fitted on a bounded sample of `labels`."""
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(~F.col("toxic")).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines, or single lines of LINE_WORDS words, that stood before. A document of which nothing but white space is left goes; one
    that was empty before stays. n_chars follows the text."""
    cleaned = line_dedup.dedup_lines(docs, LINES, LINE_WORDS)
    left = (F.col("n_deleted") == 0) | F.col("text").rlike(r"\S")
    changed = F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.where(left).withColumn("n_chars", changed).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles."""
    small_batches(spark)
    return jaccard_join.one_of_each(docs, SHINGLE_WORDS, SIMILARITY).select(docs.columns)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private values replaced by pseudonyms of the same format. Every row stays, null texts too; n_chars follows the text."""
    small_batches(spark)
    hidden = private.pseudonymise(docs, KEY, counts=False)
    return hidden.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset; a null or empty text is the end id alone."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end=1, length=SEQUENCE)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("private", hide_private),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
