"""Keyword search over a written index: a query reads the postings of its own words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.stemming import portuguese_stem
from storelens.functions.text import stop_words, words
from storelens.session import file_sized

#: folders that terms are dealt to by their hash
BUCKETS = 64


def build_index(df: DataFrame, key: str, columns: list[str], path: str, stems: bool = False) -> None:
    """Write the postings ``term, key, tf`` of the columns' words, the rows per term, and the number of rows.

    Postings lie in folders by the term's hash, sorted by term, so that a reader opens the folders of its words and
    skips row groups of others; a word of a third of all rows is cut over several files. With ``stems``
    words are replaced by their Portuguese stems, worked out once per distinct word.
    """
    tokens = df.select(F.col(key).alias("key"), F.explode(words(F.concat_ws(" ", *columns))).alias("term"))
    counted = tokens.groupBy("key", "term").agg(F.count("*").alias("tf"))
    if stems:
        each = counted.select("term").distinct().mapInPandas(_stemmed, "term string, stem string")
        counted = counted.join(each, "term").groupBy("key", F.col("stem").alias("term")).agg(F.sum("tf").alias("tf"))
    dealt = counted.withColumn("bucket", _bucket(F.col("term")))
    with file_sized(dealt.sparkSession):
        dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "key").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    kind = df.schema[key].dataType.simpleString()
    terms = postings(df.sparkSession, path, kind).groupBy("bucket", "term").agg(F.count("*").alias("rows"))
    with file_sized(terms.sparkSession):
        terms.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/terms")
    df.agg(F.count("*").alias("rows"), F.lit(stems).alias("stems")).write.mode("overwrite").parquet(f"{path}/size")


def _stemmed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.assign(stem=frame["term"].map(portuguese_stem))


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def postings(spark: SparkSession, path: str, key_type: str = "bigint") -> DataFrame:
    return spark.read.schema(f"key {key_type}, term string, tf bigint, bucket int").parquet(f"{path}/postings")


def _of(df: DataFrame, terms: list[str]) -> DataFrame:
    """Rows of the terms; folders of other terms are left out, and the term reaches the scan."""
    buckets = [_bucket(F.lit(t)) for t in terms]
    return df.filter(F.col("bucket").isin(*buckets) & F.col("term").isin(terms))


def search(spark: SparkSession, path: str, query: str, language: str | None = "portuguese", key_type: str = "bigint") -> DataFrame:
    """``key`` and ``score`` (tf-idf) of every row that holds a word of the query; stop words do not count."""
    rows, stems = spark.read.schema("rows bigint, stems boolean").parquet(f"{path}/size").first()
    dropped = stop_words(spark, language) if language else set()
    asked = [w for w in dict.fromkeys(re.findall(r"[^\W_]+", query.lower())) if w not in dropped]
    if stems:
        asked = list(dict.fromkeys(map(portuguese_stem, asked)))
    if not asked:
        return postings(spark, path, key_type).select("key", F.lit(0.0).alias("score")).limit(0)
    held = {r.term: r.rows for r in _of(spark.read.schema("term string, rows bigint, bucket int").parquet(f"{path}/terms"), asked).collect()}
    found = [t for t in asked if t in held]
    if not found:
        return postings(spark, path, key_type).select("key", F.lit(0.0).alias("score")).limit(0)
    hits = _of(postings(spark, path, key_type), found)
    # one count per word, so that scores add up in the words' order
    tf = hits.groupBy("key").agg(*(F.max(F.when(F.col("term") == t, F.col("tf")).otherwise(0)).alias(f"tf{i}") for i, t in enumerate(found)))
    score = F.lit(0.0)
    for i, t in enumerate(found):
        score = score + F.col(f"tf{i}") * (F.ln(F.lit((rows + 1) / (held[t] + 1))) + 1)
    return tf.select("key", score.alias("score"))
