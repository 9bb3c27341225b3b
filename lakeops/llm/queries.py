"""The registered queries of the text operators, with the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import (
    decontaminate, divergence, html_text, licences, line_windows, packing, sharding, simhash, suffixes, toxicity,
    vector_codes, vectors,
)
from lakeops.llm.common import table
from lakeops.llm.tokens import count_tokens

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op2_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.search(table(spark, folder, "embeddings"), lambda i: i % 20 == 0, 20)


def op3_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.report(table(spark, folder, "documents"))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.report(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    return line_windows.report(table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), TOKEN_LIMIT)


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.report(table(spark, folder, "embeddings"))


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.report(table(spark, folder, "documents"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_nearest_vectors": op2_nearest_vectors,
    "op3_simhash_components": op3_simhash_components,
    "op4_license_scan": op4_license_scan,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_line_windows": op8_line_windows,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_sharding": op12_sharding,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES = {
    "op5_suffix_dedup": suffixes.REPORT_SQL,
    "op8_line_windows": line_windows.REPORT_SQL,
    "op10_decontamination": decontaminate.REPORT_SQL,
    "op11_vector_codes": vector_codes.report_sql(),
    "op13_source_divergence": divergence.audit_sql(),
}
