"""One query for each operator of this subpackage, over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import ann, byte_bpe, fill_middle, jaccard_join, language_id, line_dedup, near_vectors, packing, passages, private, spelling, token_store, toxicity
from spanlake.llm.scratch import fresh_path, small_batches


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50, among all others."""
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the bit-packed store in the shared folder and read every document's ids back."""
    path = fresh_path(spark, "tokens")
    token_store.write_tokens(_documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return token_store.document_digests(spark, path)


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that join passages to classes, with the class of each; pairs within a class follow from these."""
    return passages.passage_classes(_documents(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_documents(spark, sf_dir), k=3, percent=90)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(_documents(spark, sf_dir), lines=2)
    return cleaned.select("doc_id", "n_lines", "n_deleted", "longest_run", F.md5("text").alias("text_md5"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, severity, grade, toxic of every document, by a model fitted on a bounded sample of `labels`."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).drop("text")


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.93)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The placed pieces; the checksum is of the ids that stand in the sequences."""
    packed = packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end=1, length=2048, keep_ids=True)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text with pseudonyms, and how many of each kind; in production the key comes from a secret store."""
    return private.pseudonymise(_documents(spark, sf_dir).select("doc_id", "text"), key=b"spanlake demonstration key")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, sf_dir))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's rearranged text and of the text restored from it."""
    return fill_middle.digests(_documents(spark, sf_dir))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_token_store": op2_token_store,
    "op3_passages": op3_passages,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_near_vectors": op7_near_vectors,
    "op8_packing": op8_packing,
    "op9_private": op9_private,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling": op11_spelling,
    "op12_fill_middle": op12_fill_middle,
    "op13_language": op13_language,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {
    "op4_jaccard_join": jaccard_join.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op7_near_vectors": near_vectors.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op12_fill_middle": fill_middle.ORACLE,
}
