"""Registered queries of the operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm import (
    clustering,
    conversations,
    decontamination,
    embedding_dedup,
    licenses,
    lm_scoring,
    oracle,
    packing,
    quality,
    secrets,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
)
from roadlake.llm.common import store, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"), texts=False)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_spans=False)
    return found.selectExpr("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "n_hit > 0 AS contaminated")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate, its place and judgement; the value itself only as a hash."""
    found = secrets.judged(table(spark, sf_dir, "documents"))
    return found.selectExpr(
        "doc_id", "place", "start", "end", "kind", "sha2(value, 256) AS value_sha256", "score", "is_secret"
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("places")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each length that occurs, and the standard limits and quantiles (quantile_wanted) beside them."""
    histogram = store(token_counts.length_histogram(table(spark, sf_dir, "documents")))
    lengths = token_counts.from_histogram(histogram).withColumn("quantile_wanted", F.lit(None).cast("double"))
    return lengths.unionByName(token_counts.answers(histogram))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_report(table(spark, sf_dir, "conversations"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_substring_dedup,
            op2_quality,
            op3_decontamination,
            op4_secret_scan,
            op5_lm_scoring,
            op6_embedding_dedup,
            op7_packing,
            op8_license_scan,
            op9_token_counts,
            op10_simhash,
            op11_clustering,
            op12_toxicity,
            op13_conversation_repair,
        )
    }


def oracle_queries() -> dict[str, str]:
    return dict(oracle.SQL)
