"""The operators over their whole tables, as named queries, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketspark.llm import (
    alignment, ann, audit, bpe, ctw, decontaminate, licenses, pfp, pii, sharding, simhash, toxicity, warc,
)
from marketspark.llm.common import table
from marketspark.llm.oracle import ORACLE  # noqa: F401

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents", "doc_id", "text"), VOCABULARY, PATTERN)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_pfp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfp.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_BPE, PIECE_BPE)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_pii": op2_pii,
    "op3_simhash": op3_simhash,
    "op4_sharding": op4_sharding,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_ann": op7_ann,
    "op8_ctw": op8_ctw,
    "op9_pfp": op9_pfp,
    "op10_warc": op10_warc,
    "op11_licenses": op11_licenses,
    "op12_alignment": op12_alignment,
    "op13_filter_audit": op13_filter_audit,
}