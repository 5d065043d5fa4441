"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import ann, decontam, html, langid, licenses, merkle, pieces, secrets, suffixes, tokens, toxicity, whitening
from tripmart.llm.jaccard import jaccard_groups
from tripmart.llm.shared import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")[0]


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_tampered(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_language_id": op5_language_id,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_secret_scan": op7_secret_scan,
    "op8_license_scan": op8_license_scan,
    "op9_toxicity": op9_toxicity,
    "op10_html_extraction": op10_html_extraction,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_counts": op12_token_counts,
    "op13_embedding_whitening": op13_embedding_whitening,
}
