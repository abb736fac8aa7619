"""The registered queries of this subpackage: each operator over its whole table, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    compression_classifier,
    decontaminate,
    filter_audit,
    importance_resampling,
    jaccard_join,
    lm_scoring,
    pii,
    quality_rules,
    secret_scan,
    sentencepiece_backend,
    spans,
    token_files,
    topk_search,
    url_filters,
    url_list,
)
from ledgerloom.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _span_counts(found: DataFrame, kinds: tuple[str, ...], *more: Column) -> DataFrame:
    return found.select(
        "doc_id",
        *[spans.count("spans", k).alias(f"n_{k}") for k in kinds],
        spans.base_digest("spans").alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"),
        *more,
    )


def fold(n: int = 5) -> Column:
    """crc32(doc_id as text) mod ``n``; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(n))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    n_hit = F.aggregate(
        "hits", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"]
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = url_filters.evaluate(url_list.captures(pages), url_list.events(pages))
    return found.withColumn("fetched", F.col("fetched").cast("string"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    # what context did: added spans, and the scores of all spans in their order
    scores = F.transform("scores", lambda x: F.round(x, 1).cast("string"))
    added = F.size(F.filter("spans", lambda x: ~x["base"])).cast("long")
    return _span_counts(
        found, pii.BASE, added.alias("n_added"), F.array_join(scores, ",").alias("scores")
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score(table(spark, sf_dir, "documents"), fold() != 1)
    return scored.select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return _span_counts(found, secret_scan.BASE)


def public_tokenizer(name: str) -> str:
    """Where this machine has one of the public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_files.write(docs, path, public_tokenizer("byte_bpe_50k.json"))
    return token_files.documents(spark.read.parquet(path))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, model = table(spark, sf_dir, "documents"), public_tokenizer("piece_bpe_32k.model")
    return sentencepiece_backend.encode(docs, model, with_ids=False)


def op10_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = compression_classifier.fit(docs, labels.where(fold() != 0))
    scored = compression_classifier.classify(docs, model)
    return scored.select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return drawn.drop("n_words")


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_url_filters,
        op3_quality_rules,
        op4_pii,
        op5_lm_scoring,
        op6_secret_scan,
        op7_token_files,
        op8_jaccard_join,
        op9_sentencepiece,
        op10_compression_classifier,
        op11_importance_resampling,
        op12_topk_search,
        op13_filter_audit,
    )
}

ORACLES: dict[str, str] = {
    "op2_url_filters": url_list.oracle(),
    "op11_importance_resampling": importance_resampling.oracle(),
    "op12_topk_search": topk_search.oracle(),
    "op13_filter_audit": filter_audit.oracle(),
}
