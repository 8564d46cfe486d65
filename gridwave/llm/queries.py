"""One query for each training-data operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwave.llm import (decontaminate, exact_dedup, importance_resampling, language_id, license_scan, lm_scoring,
                          pii, quality_rules, sentencepiece_codec, simhash, token_counts, url_filter,
                          whitening)
from gridwave.llm.common import table

PIECE_MODEL = "piece_bpe_32k.model"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path(PIECE_MODEL))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_texts(table(spark, sf_dir, "documents"),
                                            public_tokenizers.path(PIECE_MODEL))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = url_filter.evaluate(url_filter.captures_of_pages(pages), url_filter.entries_of_pages(pages),
                                "page_id", "url", "fetch_day")
    return found.withColumn("fetch_day", found.fetch_day.cast("string"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of about half the rows each: the first is indexed, the second looked up."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"),
                                        F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_pii": op2_pii,
    "op3_token_counts": op3_token_counts,
    "op4_simhash": op4_simhash,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_url_filter": op7_url_filter,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_license_scan": op10_license_scan,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_exact_dedup": op13_exact_dedup,
}
