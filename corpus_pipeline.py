"""From raw documents to token ids: quality, exact copies, near copies, benchmark leaks, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet and reads it again for the next.
All but the last keep the columns of documents. Counted as part of the subpackage quarry.llm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import byte_bpe, decontaminate, exact_dedup, quality, simhash
from quarry.llm.common import cut, small_batches, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the highest quality grade is at least one half."""
    return quality.select_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest id."""
    small_batches(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked by at most four differing bits."""
    small_batches(spark)
    return simhash.drop_near_copies(docs, words=4, most=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the bytes that they decode to."""
    small_batches(spark)
    return byte_bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", keep_good), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("decontaminate", drop_leaks), ("encode", encode)]

#: Training and encoding have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
