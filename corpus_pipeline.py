"""Corpus pipeline: raw documents to token ids, in five stages.

Every stage takes what the one before kept, written as Parquet and read again;
all but the last return the columns of ``documents``.

1. quality rules: documents that a rule rejects go;
2. SimHash near-dedup: one document of each group of near copies stays;
3. benchmark decontamination: documents that overlap with a benchmark item go;
4. PII: spans are replaced by the name of their kind, ``n_chars`` follows;
5. SentencePiece: texts become piece ids, and decoding them is checked.

Null and empty texts fall to the first stage; an empty input gives an empty
result of the same columns.  Columns beyond those of ``documents`` are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwave.llm import decontaminate, pii, quality_rules, sentencepiece_codec, simhash
from gridwave.llm.common import table, written
from gridwave.session import ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PIECE_MODEL = "piece_bpe_32k.model"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs.select(*COLUMNS))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one(docs.select(*COLUMNS), shingle_words=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    masked = pii.mask_pii(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast(masked.schema["n_chars"].dataType))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return sentencepiece_codec.encode_texts(docs, public_tokenizers.path(PIECE_MODEL),
                                            keep=("lang", "source", "n_chars"))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("sentencepiece", sentencepiece_stage),
]

# Fingerprints, the random field and piece ids are beyond SQL; the tests hold the
# pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
