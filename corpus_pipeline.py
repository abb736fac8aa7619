"""A corpus pipeline over ``documents``: each stage reads what the one before it wrote.

Rejected, in this order: documents that the quality rules do not keep, all but one of
each group of near-duplicates, documents with a passage of ``benchmark``. Then personal
data in the texts is replaced by its kind, and the texts become token ids.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, jaccard_join, pii, quality_rules, sentencepiece_backend
from ledgerloom.llm.queries import public_tokenizer, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

MODEL = "piece_bpe_32k.model"


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the new text where it was known."""
    clean = pii.without_pii(docs)
    length = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_backend.encode(docs, public_tokenizer(MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", drop_low_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("pii", replace_personal_data),
    ("sentencepiece", to_tokens),
]

#: SQL expresses neither the label model nor the tokenizer; tests compare with plain versions
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
