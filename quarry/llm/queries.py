"""One registered query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, byte_bpe, collocations, decontaminate, exact_dedup, html_extract, language_model, quality, simhash, suffix_dedup, toxicity, url_filters, warc
from .common import table


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filters.RULES, "action string, host string, path string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(docs.select("doc_id", "text"), quality.fit(docs, labels))
    return scored.selectExpr("doc_id", "expected_grade", "tail_probability", "tail_probability >= 0.5 AS kept")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    return toxicity.score(docs, model).withColumn("held_out", toxicity.held_out())


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), words=4, most=4)


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "share", "consistent")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"), ~language_model.held_out())


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup, "op1_decontaminate": op1_decontaminate, "op4_html_extract": op4_html_extract, "op5_warc": op5_warc, "op6_simhash": op6_simhash, "op2_quality": op2_quality, "op8_toxicity": op8_toxicity, "op10_byte_bpe": op10_byte_bpe, "op3_url_filters": op3_url_filters, "op7_exact_dedup": op7_exact_dedup, "op11_collocations": op11_collocations, "op12_language_model": op12_language_model, "op13_alignment": op13_alignment}

ORACLES = {
    "op11_collocations": collocations.ORACLE,
    "op3_url_filters": url_filters.ORACLE,
    "op5_warc": warc.ORACLE,
    "op7_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n
""",
}
