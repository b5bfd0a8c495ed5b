"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.llm import (
    collision_ann,
    decontamination,
    html_layout,
    license_scan,
    parity_join,
    quality_gam,
    secret_ledger,
    source_mix,
    suffix_lm,
    token_alignment,
    token_counts,
    toxicity,
    whitening,
)
from pulselake.llm.common import table
from pulselake.llm.oracle import ORACLE  # noqa: F401


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "leak.n_words",
        "leak.n_hit",
        "leak.n_items",
        "leak.items_sha256",
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.similarity_components(table(spark, sf_dir, "documents"))


def op4_collision_counting_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = secret_ledger.scan_versions(docs)
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(secret_ledger.spans_text(F.col("spans")), 256).alias("base_sha256"),
        secret_ledger.spans_text(F.col("spans")).alias("spans"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, sf_dir, "documents"))[0]


def op7_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract_pages(table(spark, sf_dir, "pages"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents"))[0]


def op10_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_lm.score_documents(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_benchmark_decontamination,
        op3_ngram_jaccard_join,
        op4_collision_counting_ann,
        op5_secret_scan,
        op6_license_scan,
        op7_html_layout,
        op8_quality_classifier,
        op9_source_mix,
        op10_suffix_tree_scores,
        op11_token_alignment,
        op12_embedding_whitening,
        op13_toxicity,
    )
}
