"""The corpus pipeline: STAGES over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import byte_bpe, mixing, near_dedup, repeats, secrets
from storelens.llm.common import documents, small_batches, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all their columns.

    A null or empty text has no words and goes; repeated rows are judged alike and all stay or go; columns named as the rules'
    own measures keep their values and types; an empty table stays empty.
    """
    small_batches(spark)
    own = {name.lower() for name, _ in repeats.COLUMNS}
    aside = {c: f"own_{i}_" if c.lower() in own else c for i, c in enumerate(docs.columns)}
    named = docs.select(*(F.col(f"`{c}`").alias(a) for c, a in aside.items()))
    return repeats.quality(named).where("kept").select(*(F.col(f"`{a}`").alias(c) for c, a in aside.items()))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id, with all its columns.

    A null id is larger than all others; null and empty texts are one class; of rows with one id and text any one stays.
    """
    small_batches(spark)
    return near_dedup.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and ``n_chars`` made to fit; a null text and its ``n_chars`` stay, and so do all other columns."""
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return secrets.redact(docs).withColumn("n_chars", length)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, with all its columns.

    A text without a word adds nothing to its source and is taken as often as others of it; a null source is one source, the last; equal rows are taken together.
    """
    small_batches(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens`` and the packed ``ids`` of every document of the mix; a null or empty text has none."""
    small_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "source", "n_tokens", "ids")


STAGES = [("quality", quality), ("near_dedup", dedup), ("secrets", redact), ("mixing", mix), ("byte_bpe", tokens)]

#: sampling, hashing and the tokenizer can't be told in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
